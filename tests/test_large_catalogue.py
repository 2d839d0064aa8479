"""Catalogue tables too large to broadcast: how the items meet them, and that the rows are the same."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from skuflow.operators import extract as X
from skuflow.operators import orders as O
from skuflow.plans import inspect as PI
from skuflow.plans.queries import REGISTRY
from skuflow.sources import fixtures, tables
from skuflow.sources.fixtures import from_testdata, read_table


@pytest.fixture(scope="module")
def many_parts(spark, tmp_path_factory):
    """SF_SMALL with half a million parts more: few bytes each in the file, far more in memory."""
    root = str(tmp_path_factory.mktemp("many-parts"))
    for name in ("customer", "orders", "lineitem"):
        read_table(spark, SF_SMALL, name).write.parquet(f"{root}/{name}.parquet")
    more = spark.range(1_000_000, 1_500_000).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"),
                                                    F.lit("t").alias("p_type"), F.lit(1.0).alias("p_retailprice"))
    read_table(spark, SF_SMALL, "part").unionByName(more).coalesce(1).write.parquet(f"{root}/part.parquet")
    return root


@pytest.mark.parametrize("name", ["extract_items", "extract_stock_lines", "item_count_window", "bundle_explode", "retention_table"])
def test_a_large_catalogue_is_not_broadcast(spark, many_parts, name):
    plan = PI.plan_text(REGISTRY[name](spark, many_parts)).splitlines()
    for i, line in enumerate(plan):
        if "BroadcastExchange" in line:                 # nothing below it, before the next shuffle, reads the parts
            depth = len(line) - len(line.lstrip(" :+-"))
            for below in plan[i + 1:]:
                if len(below) - len(below.lstrip(" :+-")) <= depth or "Exchange hashpartitioning" in below:
                    break
                assert "p_partkey" not in below, line


def _odd(src):
    """Items, variants and prices with null keys, twice over."""
    def spoil(name, t):
        if name in ("sylius_product_variant", "sylius_channel_pricing", "sylius_channel_pricing_item", "sylius_order_item"):
            last = {"sylius_product_variant": "product_id", "sylius_channel_pricing": "id", "sylius_channel_pricing_item": "channel_pricing_id",
                    "sylius_order_item": "variant_id"}[name]
            t = t.withColumn(last, F.when(F.col(last) % 7 != 0, F.col(last)))
            t = t.unionByName(t.where(F.col("id") % 9 == 0)).select(*t.columns)
        return t
    return src.map(spoil)


def test_both_ways_give_the_same_rows(spark, monkeypatch):
    def hashed(src):
        frames = {"orders": X.extract_orders(src), "items": X.extract_items(src), "lines": X.extract_stock_lines(src).rows(*X.STOCK_COLUMNS),
                  "fans": X.with_pricings(src.sylius_order_item, src)}
        return {n: tuple(f.select(F.xxhash64(*sorted(f.columns)).alias("h")).agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)"))).first()) for n, f in frames.items()}

    want = hashed(_odd(from_testdata(spark, SF_SMALL)))
    for at in (X, fixtures):
        monkeypatch.setattr(at, "joinable", lambda t, *_: t.hint("merge"))
    monkeypatch.setattr(X, "is_small", lambda *_: False)
    assert hashed(_odd(from_testdata(spark, SF_SMALL))) == want
    assert all(n for n, _ in want.values())


def test_estimates_are_read_without_a_job(spark):
    spark.sparkContext.setJobGroup("estimates", "")
    part = read_table(spark, SF_SMALL, "part")
    assert 0 < tables.estimated_bytes(part) < tables.estimated_bytes(read_table(spark, SF_SMALL, "lineitem")) < float("inf")
    assert tables.is_small(part) and not tables.is_small(part, most=1)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("estimates")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_second_item_names_read_the_shuffles_of_the_item_facts(spark, many_parts):
    """Below the per-order steps of retention the items are made once."""
    items = X.extract_items(from_testdata(spark, many_parts))
    facts = PI.distinct_shuffles(PI.plan_text(O.item_facts(items)))
    key = ["brand", "order_id"]
    both = PI.distinct_shuffles(PI.plan_text(O.item_facts(items).join(O.second_item_names(items), key)))
    assert both == facts + 1                            # the window's own, by order


def test_second_item_names_where_ids_repeat(spark):
    """The second row in the order of id and name, whatever variants and quantities rows of one item have."""
    rows = [("A", 1, 5, "b", "v1", 2), ("A", 1, 5, "b", None, 9), ("A", 1, 5, "a", "v2", None),
            ("A", 2, 7, None, "v", 1), ("A", 2, 7, "z", None, None), ("A", 3, 9, "only", "v", 1),
            ("A", None, 1, "n1", "v", 1), ("A", None, 2, "n2", None, 1)]
    items = spark.createDataFrame(rows, "brand string, order_id long, id long, product_name string, variant_name string, quantity int")
    got = {(r.order_id, r.second_product_name) for r in O.second_item_names(items).collect()}
    assert got == {(1, "b"), (2, None), (None, "n2")}
