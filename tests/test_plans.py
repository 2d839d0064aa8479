"""Plan shape: exchanges, no Python in the hot path, top-k windows, no
"""

import pytest

from conftest import SF_MID
from skuflow.plans import inspect as PI
from skuflow.plans import pipeline
from skuflow.plans.queries import REGISTRY
from skuflow.sources.fixtures import from_testdata


@pytest.fixture(scope="module")
def reports(spark):
    return pipeline.build_reports(from_testdata(spark, SF_MID))


@pytest.mark.parametrize("name", ["retention_table", "sunset_table", "report_non_bundle",
                                  "report_only_bundle", "report_merged"])
def test_no_python_no_cartesian(reports, name):
    plan = PI.plan_text(reports.as_dict()[name])
    assert not PI.python_nodes(plan), name
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan            # no global window / single-task exchange


def test_stock_flow_chain_single_order_exchange(spark):
    """Everything after the lines' shuffle reuses its (brand, order_id) hash
    partitioning: of the plan that ran, the only other shuffle is the count of
    lines per order that looks for hot orders."""
    report = REGISTRY["report_non_bundle"](spark, SF_MID)
    report.collect()
    plan = PI.final_plan_text(report)
    assert PI.distinct_shuffles(plan) <= 3              # lines, counts, the fixture's item ids
    keyed = [e for e in PI.hash_exchanges(plan) if "order_id" in e and "REPARTITION_BY_COL" in e]
    assert len(keyed) == 1, keyed
    assert "Window" in plan or "window" in plan.lower()


def test_top_k_windows_use_group_limit(reports):
    plan = PI.plan_text(reports.retention_table)
    assert "WindowGroupLimit" in plan


def test_filters_and_columns_reach_the_scan(spark):
    src = from_testdata(spark, SF_MID)
    from skuflow.operators.extract import extract_orders
    plan = PI.plan_text(extract_orders(src))
    assert "PushedFilters" in plan
    orders_scan = [ln for ln in plan.splitlines() if "ReadSchema" in ln and "o_orderkey" in ln]
    assert orders_scan and "o_clerk" not in orders_scan[0]


@pytest.mark.parametrize("name, most", [("retention_table", 9), ("sunset_table", 7)])
def test_customer_reports_share_one_frame_of_item_facts(reports, name, most):
    plan = PI.plan_text(reports.as_dict()[name])
    assert PI.distinct_shuffles(plan) <= most           # the fixture's item ids among them
    by_name = {e for e in PI.hash_exchanges(plan) if "order_id" in e and "product_name" in e}
    assert len(by_name) == 1


def test_item_facts_equal_the_single_blocks(spark):
    from pyspark.sql import functions as F

    from skuflow.operators import orders as O
    from skuflow.operators.extract import extract_items

    items = extract_items(from_testdata(spark, SF_MID))
    key = ["brand", "order_id"]
    facts = O.item_facts(items).join(O.second_item_names(items), key, "left")
    two = O.first_two_items(items)
    by_id = O.same_product_by_id(items, two, keep=["first_product_variant", "first_product_quantity", "second_product_name"])
    by_rows = O.same_product_by_rows(items, O.first_nonnull_item(items), keep=["first_product_variant", "first_product_quantity"])
    counts = O.item_order_counts(items)

    def hashed(df, *cols):
        return df.agg(F.count("*"), F.sum(F.xxhash64(*key, *cols).cast("decimal(38,0)"))).first()

    assert hashed(facts, "total_items_count") == hashed(counts, "total_items_count")
    assert hashed(facts, "first.product_name", "first.product_variant", "first.product_quantity", "first.same_product", "second_product_name") == \
        hashed(by_id, "first_product_name", "first_product_variant", "first_product_quantity", "same_product", "second_product_name")
    assert hashed(facts, "total_items_count", "nonnull.product_name", "nonnull.product_variant", "nonnull.product_quantity",
                  F.col("nonnull.same_product") & (F.col("total_items_count") > 1)) == \
        hashed(by_rows, "first_order_total_item_count", "first_product_name", "first_product_variant", "first_product_quantity", "same_product")
