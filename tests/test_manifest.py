"""Version numbers, commits of two writers, expiry, the ledger of a run."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from skuflow.sources import manifest as M
from skuflow.sources import sinks
from skuflow.sources import snapshot as S
from skuflow.sources.fixtures import from_testdata, shop_from_testdata
from skuflow.sources.tables import COPIED_TABLES, SOURCE_TABLES


def test_numbers_decide_not_clocks(spark, tmp_root):
    assert M.heads(spark, tmp_root) == {}
    assert M.commit(spark, tmp_root, "ABC", "run-z") == 1
    assert M.commit(spark, tmp_root, "ABC", "run-a", rows=5) == 2
    os.utime(f"{tmp_root}/manifest/brand=ABC/v=1/entry.json", (4e9, 4e9))       # a later clock changes nothing
    assert M.heads(spark, tmp_root) == {"ABC": (2, "run-a", 5)}


def test_of_two_writers_one_wins(spark, tmp_root):
    M.commit(spark, tmp_root, "ABC", "run-0")

    def attempt(k):
        try:
            return M.commit(spark, tmp_root, "ABC", f"run-{k}", base=1)
        except M.CommitConflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(attempt, range(1, 9)))
    assert sorted(x for x in got if x) == [2]
    assert M.heads(spark, tmp_root)["ABC"][1] == f"run-{got.index(2) + 1}"
    with ThreadPoolExecutor(8) as pool:                                           # without a base all take a number
        numbers = list(pool.map(lambda k: M.commit(spark, tmp_root, "DEF", f"run-{k}"), range(8)))
    assert sorted(numbers) == list(range(1, 9))


def test_a_run_that_was_overtaken_is_told(spark, tmp_root):
    bases = S.open_run(spark, tmp_root, "run-slow", ["ABC", "DEF"])
    assert bases == {"ABC": 0, "DEF": 0}
    S.promote(spark, tmp_root, "run-fast", ["ABC"])
    with pytest.raises(S.CommitConflict, match="ABC"):
        S.promote(spark, tmp_root, "run-slow", ["ABC", "DEF"], bases)
    assert S.live_runs(spark, tmp_root) == {"ABC": "run-fast", "DEF": "run-slow"}


def test_expiry_keeps_what_any_brand_uses(spark, tmp_root):
    def write(run, brands):
        os.makedirs(f"{tmp_root}/{run}/t")
        for b in brands:
            M.commit(spark, tmp_root, b, run)

    for run, brands in (("r1", "AB"), ("r2", "A"), ("r3", "A"), ("r4", "A")):
        write(run, [{"A": "ABC", "B": "DEF"}[b] for b in brands])
    os.makedirs(f"{tmp_root}/still-writing")
    assert M.expire(spark, tmp_root, keep=2) == ["r2"]                            # r1 is live for DEF
    assert sorted(os.listdir(tmp_root)) == ["manifest", "r1", "r3", "r4", "still-writing"]
    assert M.heads(spark, tmp_root)["ABC"][:2] == (4, "r4") and M.heads(spark, tmp_root)["DEF"][:2] == (1, "r1")
    assert M.expire(spark, tmp_root, keep=2) == []
    assert M.commit(spark, tmp_root, "ABC", "r5") == 5                            # numbers go on
    with pytest.raises(ValueError):
        M.expire(spark, tmp_root, keep=0)


def test_expired_snapshots_and_reports(spark, tmp_root):
    shop = shop_from_testdata(spark, SF_SMALL)
    runs = [S.snapshot_and_promote(spark, shop, f"{tmp_root}/stage", brands=["ABC"])[0] for _ in range(2)]
    assert S.expire(spark, f"{tmp_root}/stage", keep=1) == runs[:1]
    assert S.read_live(spark, f"{tmp_root}/stage", ["ABC"]).sylius_order.count() > 0
    rows = spark.createDataFrame([("ABC", 1)], "brand string, order_id long")
    for k in range(3):
        sinks.publish_version(rows, f"{tmp_root}/rep", f"run-{k}", brands=["ABC"])
    assert sinks.expire(spark, f"{tmp_root}/rep", keep=2) == ["run-0"]
    assert sinks.read_report(spark, f"{tmp_root}/rep", rows.schema, ["ABC"]).count() == 1


def test_gate_asks_for_every_listed_table(spark, tmp_root):
    with pytest.raises(S.GateFailed) as failed:
        S.snapshot_and_promote(spark, from_testdata(spark, SF_SMALL), tmp_root, brands=["ABC", "DEF"])
    assert failed.value.brands == ["ABC", "DEF"] and S.live_runs(spark, tmp_root) == {}
    missing = set(COPIED_TABLES) - set(SOURCE_TABLES)
    assert len(missing) == 9 and set(failed.value.tables["ABC"]) == missing
    assert "product_cost" in str(failed.value)


def test_part_of_a_table_does_not_pass(spark, tmp_root):
    shop = shop_from_testdata(spark, SF_SMALL)
    S.open_run(spark, tmp_root, "run-1", ["ABC"])
    S.stage(spark, shop.for_brands(["ABC"]), tmp_root, "run-1", brands=["ABC"])
    path = f"{tmp_root}/run-1/sylius_customer/brand=ABC"
    whole = {r.table_name: (r.landed, r.n_rows == r.n_written) for r in S.audit(spark, tmp_root, "run-1").collect()}
    assert len(whole) == 17 and set(whole.values()) == {(True, True)}
    one = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))[0]
    os.remove(f"{path}/{one}")
    bad = S.audit(spark, tmp_root, "run-1").where("n_rows <> n_written").collect()
    assert [r.table_name for r in bad] == ["sylius_customer"]
    gate = S.gate(S.audit(spark, tmp_root, "run-1").drop("landed"), S.expected_tables(spark, ["ABC"])).collect()
    assert [(r.passed, r.tables_empty) for r in gate] == [(False, 1)]


def test_a_run_that_staged_nothing_is_not_audited(spark, tmp_root):
    S.open_run(spark, tmp_root, "run-1", ["ABC"])
    with pytest.raises(S.TableMissing):
        S.audit(spark, tmp_root, "run-1")


def test_rows_are_counted_while_written(spark, tmp_root):
    rows = spark.createDataFrame([("ABC", 1), ("ABC", 2), ("DEF", 3)], "brand string, order_id long")
    assert sinks.publish_version(rows, tmp_root, "run-1", brands=["ABC", "DEF", "GHI"]) == {"ABC": 2, "DEF": 1, "GHI": 0}
    assert sinks.publish_version(rows.where("false"), tmp_root, "run-2", brands=["ABC"]) == {"ABC": 0}
    assert M.heads(spark, tmp_root)["DEF"] == (1, "run-1", 1) and M.heads(spark, tmp_root)["ABC"] == (2, "run-2", 0)
    with pytest.raises(sinks.BrandAbsent, match="JKL"):
        sinks.read_report(spark, tmp_root, rows.schema, ["ABC", "JKL"])


def test_views_follow_the_current_version(spark, tmp_root):
    spark.sql(f"CREATE DATABASE follow_views LOCATION '{tmp_root}/db'")
    schema = "brand string, order_id long, created_at timestamp_ntz, quantity int, warehouse_sku string"
    at = "2024-01-01"
    one = spark.createDataFrame([("ABC", 1, None, 2, "x"), ("DEF", 2, None, None, "y")], schema).withColumn("created_at", F.lit(at).cast("timestamp_ntz"))
    path, columns = f"{tmp_root}/report_non_bundle", ["order_id", "created_at", "quantity", "warehouse_sku"]
    jobs = []
    for run, df in (("run-1", one), ("run-2", one.where("brand = 'DEF'"))):
        sinks.publish_version(df, path, run, brands=["ABC", "DEF"])
        spark.sparkContext.setJobGroup(f"views {run}", "")
        sinks.publish_views(spark, path, "non_bundle", df.schema, ["ABC", "DEF"], "follow_views")
        sinks.publish_merged_view(spark, columns, ["ABC", "DEF"], "follow_views")
        jobs += spark.sparkContext.statusTracker().getJobIdsForGroup(f"views {run}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        merged = spark.table(f"follow_views.{sinks.MERGED}")
        assert merged.columns == columns and merged.count() == df.count()
    assert len(jobs) <= 4                                             # the manifest is read, no rows are
    assert spark.table("follow_views.report_abc_non_bundle").count() == 0
    assert spark.table("follow_views.report_def_non_bundle").select("warehouse_sku").first()[0] == "y"
    with pytest.raises(Exception, match="report_jkl_non_bundle"):
        sinks.publish_merged_view(spark, columns, ["ABC", "JKL"], "follow_views")
