"""Snapshot -> gate -> promote -> live read -> publish round trip."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from skuflow.plans import pipeline
from skuflow.sources import snapshot as S
from skuflow.sources.fixtures import from_testdata, shop_from_testdata
from skuflow.sources.tables import SOURCE_TABLES, Sources


def _digest(df):
    return sorted(tuple(r) for r in df.collect())


def test_stage_gate_promote_read_live(spark, tmp_root):
    src = shop_from_testdata(spark, SF_SMALL)
    run_id, g = S.snapshot_and_promote(spark, src, f"{tmp_root}/stage")
    assert all(r.passed for r in g.collect())
    live = S.read_live(spark, f"{tmp_root}/stage")
    assert S.live_runs(spark, f"{tmp_root}/stage") == {b: run_id for b in ("ABC", "DEF", "GHI", "JKL", "MNO")}
    # The staged copy is the whole-row distinct of each source.
    for n in SOURCE_TABLES:
        assert live.table(n).count() == S.snapshot_frame(n, src.table(n)).count()
    # Reports over the live snapshot equal reports over the sources.
    a = pipeline.build_reports(src).report_only_bundle
    b = pipeline.build_reports(live).report_only_bundle
    assert _digest(a) == _digest(b)


def test_m17_empty_table_blocks_promotion(spark, tmp_root):
    src = shop_from_testdata(spark, SF_SMALL)
    root = f"{tmp_root}/stage"
    first, _ = S.snapshot_and_promote(spark, src, root)
    tables = src.as_dict()
    tables["sylius_channel_pricing"] = tables["sylius_channel_pricing"].where(F.col("brand") != "DEF")
    with pytest.raises(S.GateFailed) as failed:                      # loud, after the others are promoted
        S.snapshot_and_promote(spark, Sources.of(tables), root)
    assert failed.value.brands == ["DEF"]
    live = S.live_runs(spark, root)
    assert live["DEF"] == first and live["ABC"] == failed.value.run_id
    run3, g = S.snapshot_and_promote(spark, Sources.of(tables), root, allow_failed=True)
    passed = {r.brand: r.passed for r in g.collect()}
    assert passed["DEF"] is False and passed["ABC"] is True and S.live_runs(spark, root)["ABC"] == run3


def test_missing_brands_and_tables_raise(spark, tmp_root):
    src = shop_from_testdata(spark, SF_SMALL)
    root = f"{tmp_root}/stage"
    run_id, _ = S.snapshot_and_promote(spark, src, root, brands=["ABC"])
    assert S.read_live(spark, root, brands=["ABC"]).sylius_order.count() > 0
    for brands in (None, ["ABC", "DEF"]):
        with pytest.raises(ValueError, match="DEF"):
            S.read_live(spark, root, brands=brands)
    with pytest.raises(S.TableMissing, match="sylius_shipment"):
        S.staged_counts(spark, root, run_id, (*SOURCE_TABLES, "sylius_shipment")).count()


def test_entries_of_concurrent_runs_do_not_meet(spark, tmp_root):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda b: S.promote(spark, tmp_root, f"run-{b}", [b]), ("ABC", "DEF", "GHI", "JKL")))
    assert S.live_runs(spark, tmp_root) == {b: f"run-{b}" for b in ("ABC", "DEF", "GHI", "JKL")}


def test_only_a_missing_path_counts_as_nothing_landed(spark, tmp_root):
    import os

    assert S.live_runs(spark, f"{tmp_root}/none") == {}
    os.makedirs(f"{tmp_root}/bad/manifest/brand=ABC/v=1")
    with open(f"{tmp_root}/bad/manifest/brand=ABC/v=1/entry.json", "w") as f:
        f.write("{not json")
    with pytest.raises(Exception, match="(?i)malformed|read"):
        S.live_runs(spark, f"{tmp_root}/bad")


def test_listed_tables_are_copied_with_all_columns(spark, tmp_root):
    src = from_testdata(spark, SF_SMALL)
    extra = src.sylius_customer.select("brand", "id", F.lit(1.5).alias("cost"), F.array(F.lit(1)).alias("parts"))
    both = Sources.of({**src.as_dict(), "product_cost": extra.unionByName(extra)})
    run_id, g = S.snapshot_and_promote(spark, both, f"{tmp_root}/stage", tables=(*SOURCE_TABLES, "product_cost"))
    assert {r.tables_expected for r in g.collect()} == {len(SOURCE_TABLES) + 1}
    back = spark.read.parquet(f"{tmp_root}/stage/{run_id}/product_cost")
    assert back.count() == extra.count() and dict(back.dtypes)["parts"] == "string"
    names = spark.read.parquet(f"{tmp_root}/stage/{run_id}/sylius_product_translation")
    assert names.count() == src.sylius_product_translation.count()      # two locales of one name stay two rows
    assert names.select("brand", "translatable_id", "name").distinct().count() < names.count()
    with pytest.raises(ValueError):
        Sources.of({**src.as_dict(), "unlisted": extra})


def test_brand_list_prunes_and_validates(spark, tmp_root):
    src = shop_from_testdata(spark, SF_SMALL)
    _, g = S.snapshot_and_promote(spark, src, f"{tmp_root}/stage", brands=["GHI"])
    assert [r.brand for r in g.collect()] == ["GHI"]
    with pytest.raises(ValueError):
        S.snapshot_and_promote(spark, src, f"{tmp_root}/stage", brands=["XYZ"])


def test_publish_writes_all_reports(spark, tmp_root):
    src = from_testdata(spark, SF_SMALL)
    spark.sql(f"CREATE DATABASE all_reports LOCATION '{tmp_root}/db'")
    counts = pipeline.run(spark, src, f"{tmp_root}/out", database="all_reports")
    reps = pipeline.build_reports(src)
    assert counts["report_merged"] == counts["report_non_bundle"] == reps.report_non_bundle.count()
    assert counts["retention_table"] == reps.retention_table.count()
    from skuflow.sources.sinks import read_report

    back = read_report(spark, f"{tmp_root}/out/report_only_bundle", reps.report_only_bundle.schema)
    assert _digest(back) == _digest(reps.report_only_bundle)
    merged = spark.table("all_reports.report_merged_non_bundle")
    assert merged.columns == ["order_id", "created_at", "quantity", "warehouse_sku"] and merged.count() == counts["report_non_bundle"]
    exports = sum(spark.table(f"all_reports.report_{b}_non_bundle").count() for b in ("abc", "def", "ghi", "jkl", "mno"))
    assert exports == counts["report_non_bundle"]
    assert spark.table("all_reports.report_abc_only_bundle").columns == reps.report_only_bundle.columns[1:]
    assert spark.read.parquet(f"{tmp_root}/out/retention_null_audit/*").count() == 5 * 13
    assert spark.read.parquet(f"{tmp_root}/out/stage_counts/*").where("stage = 'report_lines'").count() == 5
    assert "customer_id" in spark.read.parquet(f"{tmp_root}/out/retention_missing_first_items/*").columns


def test_second_run_replaces_stock_reports_and_keeps_empty_customer_reports(spark, tmp_root):
    from skuflow.sources.sinks import read_report

    src = from_testdata(spark, SF_SMALL)
    spark.sql(f"CREATE DATABASE second_run LOCATION '{tmp_root}/db'")
    first = pipeline.run(spark, src, f"{tmp_root}/out", database="second_run")
    gone = ("sylius_channel_pricing", "sylius_channel_pricing_item", "sylius_order_item")
    less = src.map(lambda n, t: t.where("brand <> 'ABC'") if n in gone else t)
    second = pipeline.run(spark, less, f"{tmp_root}/out", database="second_run")
    assert spark.table("second_run.report_abc_non_bundle").count() == 0 < spark.table("second_run.report_def_non_bundle").count()
    reps = pipeline.build_reports(src)
    read = lambda n: read_report(spark, f"{tmp_root}/out/{n}", reps.as_dict()[n].schema)
    for n in ("report_non_bundle", "report_only_bundle"):
        assert read(n).where("brand = 'ABC'").count() == 0 and second[n] < first[n]
    assert second["report_merged"] == second["report_non_bundle"] == read("report_non_bundle").count()
    assert read("retention_table").where("brand = 'ABC'").count() == reps.retention_table.where("brand = 'ABC'").count() > 0


def test_per_brand_exports(spark):
    from skuflow.brands import export_table_name
    from skuflow.sources.sinks import per_brand_exports

    rep = pipeline.build_reports(from_testdata(spark, SF_SMALL)).report_non_bundle
    outs = per_brand_exports(rep, "non_bundle")
    assert sorted(outs) == [export_table_name(b, "non_bundle") for b in ("ABC", "DEF", "GHI", "JKL", "MNO")]
    assert export_table_name("ABC", "only_bundle") == "report_abc_only_bundle"
    assert sum(df.count() for df in outs.values()) == rep.count()
    assert all("brand" not in df.columns for df in outs.values())
    with pytest.raises(ValueError):
        export_table_name("ABC", "other")


def test_checkpointed_reports_equal_lazy_ones(spark):
    src = from_testdata(spark, SF_SMALL)
    lazy = pipeline.build_reports(src)
    cut = pipeline.build_reports(src, cut_lineage=True)
    for name in ("report_non_bundle", "report_only_bundle", "report_merged"):
        assert _digest(lazy.as_dict()[name]) == _digest(cut.as_dict()[name])


def test_versions_of_a_report(spark, tmp_root):
    from skuflow.sources.sinks import publish_version, read_report

    rep = pipeline.build_reports(from_testdata(spark, SF_SMALL)).retention_table
    path, n = f"{tmp_root}/retention", rep.count()
    publish_version(rep, path, "run-1", keep_old_when_empty=True)
    publish_version(rep.where("false"), path, "run-2", keep_old_when_empty=True)        # S9: old rows stay
    assert read_report(spark, path, rep.schema).count() == n
    publish_version(rep.where("brand = 'ABC'"), path, "run-3", brands=["ABC"])           # other brands untouched
    assert read_report(spark, path, rep.schema).count() == n
    publish_version(rep.where("brand = 'DEF'"), path, "run-4", brands=["ABC", "DEF"])    # ABC replaced by nothing
    assert read_report(spark, path, rep.schema).where("brand = 'ABC'").count() == 0


def test_schema_conformance(spark):
    from pyspark.sql import functions as F

    from skuflow.sources.tables import check_schema, conform

    src = from_testdata(spark, SF_SMALL)
    for name, df in src.as_dict().items():
        check_schema(name, df)                                   # S2: declared columns and types
    wide = src.sylius_customer.withColumn("extra", F.lit(1))
    assert conform("sylius_customer", wide).columns == ["brand", "id", "email"]
    with pytest.raises(ValueError):
        conform("sylius_customer", src.sylius_customer.drop("email"))
    with pytest.raises(ValueError):
        check_schema("sylius_customer", src.sylius_customer.withColumn("id", F.col("id").cast("string")))
