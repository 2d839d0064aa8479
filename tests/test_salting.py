"""Hot-order salting: the salted plan gives the same reports as the
co-located one, and moves the line rows once."""

import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from skuflow.operators import extract as X
from skuflow.operators import salting as S
from skuflow.operators import stock_flow as SF
from skuflow.plans import inspect as PI
from skuflow.sources.fixtures import from_testdata


def _hash(df):
    rows = sorted("|".join("" if v is None else str(v) for v in r) for r in df.collect())
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def _reports(ex):
    lines = SF.stock_lines(ex)
    return {
        "lines": lines.rows(*SF.RESOLVED_COLUMNS),
        "flagged": SF.flag_lines(lines).rows("brand", "order_id", "variant_id", "unit_price", "final_sku", "reset", "is_bundle", "header"),
        "non_bundle": SF.report_non_bundle(lines).rows(),
        "only_bundle": SF.report_only_bundle(SF.order_summary(lines)).rows(),
    }


@pytest.fixture()
def limit(spark):
    old = spark.conf.get(S.ROWS_CONF, str(S.DEFAULT_ROWS))
    yield lambda v: spark.conf.set(S.ROWS_CONF, str(v))
    spark.conf.set(S.ROWS_CONF, old)


def test_salted_equals_colocated(spark, limit):
    src = from_testdata(spark, SF_SMALL)
    limit(10 ** 9)
    plain_ex = X.extract_stock_lines(src)
    assert plain_ex.hot.count() == 0
    plain = {k: _hash(v) for k, v in _reports(plain_ex).items()}
    limit(2)
    all_hot = X.extract_stock_lines(src)
    assert all_hot.hot.where(F.col("n_salts") > 1).count() > 0
    assert {k: _hash(v) for k, v in _reports(all_hot).items()} == plain
    limit(9)                                                       # some orders take one way, some the other
    some_hot = X.extract_stock_lines(src)
    assert some_hot.hot.count() > 0 < some_hot.ordinary.count()
    keys = ["brand", "order_id"]
    assert some_hot.hot.join(some_hot.ordinary, keys, "left_semi").count() == 0
    assert {k: _hash(v) for k, v in _reports(some_hot).items()} == plain


def test_hot_table_is_bounded(spark):
    items = from_testdata(spark, SF_SMALL).sylius_order_item
    total = items.count()
    for lim in (2, 5, 50):
        hot = S.hot_orders(items.select("brand", "order_id"), lim)
        assert hot.count() <= total / lim


def test_building_a_plan_runs_no_job(spark, limit):
    from skuflow.plans.queries import REGISTRY

    tracker = spark.sparkContext.statusTracker()
    for name in ("report_non_bundle", "report_only_bundle", "report_merged", "retention_table", "sunset_table"):
        spark.sparkContext.setJobGroup(f"build {name}", "")
        REGISTRY[name](spark, SF_SMALL)
        assert list(tracker.getJobIdsForGroup(f"build {name}")) == [], name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_without_hot_orders_the_salted_plan_is_dropped(spark, limit):
    src = from_testdata(spark, SF_SMALL)
    limit(10 ** 9)
    report = SF.report_non_bundle(SF.stock_lines(X.extract_stock_lines(src))).rows()
    assert "salt" in PI.plan_text(report)
    report.collect()
    final = PI.final_plan_text(report)
    assert "hashpartitioning(brand" in final and "salt" not in final.replace("n_salts", "")
    limit(9)                                                       # with one, the ordinary rows' plan is the same
    report = SF.report_non_bundle(SF.stock_lines(X.extract_stock_lines(src))).rows()
    report.collect()
    assert "salt" in PI.final_plan_text(report).replace("n_salts", "")
    plan = PI.plan_text(SF.report_non_bundle(SF.stock_lines(X.extract_stock_lines(src))).ordinary)
    lines = [e for e in PI.hash_exchanges(plan) if "order_id" in e and "REPARTITION_BY_COL" in e]
    assert len(lines) == 1                                         # the ordinary lines move once


def test_hot_lines_move_by_salt_and_variant_only(spark, limit):
    limit(2)
    ex = X.extract_stock_lines(from_testdata(spark, SF_SMALL))
    plan = PI.plan_text(SF.report_non_bundle(SF.stock_lines(ex)).hot)
    keyed = [e for e in PI.hash_exchanges(plan) if "created_at" not in e and "final_sku" not in e and "product_name" not in e]
    by_order = [e for e in keyed if "order_id" in e and "salt" not in e and "variant_id" not in e]
    assert by_order                                                # per-order facts: counts, ladders, variants
    assert all("Window" not in e for e in by_order)


def test_tier_ladder_holds_a_row_per_count(spark, limit):
    src = from_testdata(spark, SF_SMALL)
    limit(2)
    ex = X.extract_stock_lines(src).hot
    ladder = SF.tier_ladder(ex)
    counts = ex.where(F.col(SF.SCPI).isNotNull()).select("brand", "order_id", "count").distinct()
    assert ladder.count() == counts.count() < ex.where(F.col(SF.SCPI).isNotNull()).select("brand", "order_id", "count", SF.SCPI).distinct().count() + 1
    assert S.replicate(ladder).count() == ladder.agg(F.sum("n_salts")).first()[0]


def test_pipeline_checkpoint_path_salted(spark, limit):
    from skuflow.plans import pipeline

    src = from_testdata(spark, SF_SMALL)
    limit(10 ** 9)
    plain = pipeline.build_reports(src)
    want = {n: _hash(plain.as_dict()[n]) for n in ("report_non_bundle", "report_only_bundle")}
    limit(2)
    cut = pipeline.build_reports(src, cut_lineage=True)
    assert {n: _hash(cut.as_dict()[n]) for n in want} == want


def _fans(src):
    """(brand, variant_id, fan): the lines an item of each variant becomes."""
    variants = src.sylius_product_variant.select("brand", F.col("id").alias("variant_id"))
    return X.with_prices(variants, src).groupBy("brand", "variant_id").agg(F.count("*").alias("fan"))


def _one_order(spark, src, rows):
    """The sources with the given (variant, price) lines as the only items of one paid order."""
    order = src.sylius_order.where("payment_state = 'paid'").select("brand", "id").first()
    items = spark.createDataFrame([(order["brand"], i, order["id"], v, "p", "v", 3, price, price) for i, (v, price) in enumerate(rows)],
                                  src.sylius_order_item.select("brand", "id", "order_id", "variant_id", "product_name", "variant_name",
                                                               "quantity", "unit_price", "units_total").schema)
    return src.map(lambda n, t: items if n == "sylius_order_item" else t)


def test_identical_lines_never_meet_in_one_task(spark, limit):
    src = from_testdata(spark, SF_SMALL)
    variant = _fans(src).where("fan > 1").select("variant_id").first()[0]
    src = _one_order(spark, src, [(variant, 10)] * 20_000)
    src = src.map(lambda n, t: t.repartition(4) if n == "sylius_order_item" else t)
    limit(1000)
    ex = X.extract_stock_lines(src).hot
    assert ex.select("salt").distinct().count() > 0
    narrow = src.sylius_order_item.select("brand", "order_id", "variant_id", "product_name", "variant_name", "quantity", "unit_price", "units_total")
    plan = PI.plan_text(narrow.distinct()).splitlines()
    moved = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line)
    assert "HashAggregate" in plan[moved + 1]                       # combined on the map side before they move
    assert narrow.distinct().count() == 1
    assert ex.count() == _fans(src).where(F.col("variant_id") == variant).first()["fan"]


def test_tiers_count_towards_the_limit(spark, limit):
    src = from_testdata(spark, SF_SMALL)
    variant, n = _fans(src).orderBy(F.col("fan").desc(), "variant_id").select("variant_id", "fan").first()
    src = _one_order(spark, src, [(variant, k) for k in range(100)])
    limit(100)
    ex = X.extract_stock_lines(src).hot
    assert n > 1 and ex.count() == 100 * n
    assert ex.select("salt").distinct().count() > 1


def test_second_order_per_customer_is_limited_before_it_moves(spark):
    from skuflow.operators import sunset as SU

    src = from_testdata(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = PI.plan_text(SU.order_pairs(X.extract_orders(src), X.valid_orders(src)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("WindowGroupLimit") == 2
