
import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from skuflow.plans import pipeline
from skuflow.sources.fixtures import from_testdata


@pytest.fixture(scope="module")
def reports(spark):
    return pipeline.build_reports(from_testdata(spark, SF_SMALL))


def test_one_row_per_email(reports):
    for df in (reports.retention_table, reports.sunset_table):
        assert df.count() == df.select("brand", "email").distinct().count()
        assert df.where(F.col("order_count") < 1).count() == 0


def test_one_header_per_bundle_order(reports):
    ob = reports.report_only_bundle
    assert ob.count() == ob.select("brand", "order_id").distinct().count()
    # every bundle order has at least two exploded lines
    lines = reports.report_non_bundle.groupBy("brand", "order_id").count()
    assert ob.join(lines, ["brand", "order_id"]).where(F.col("count") < 2).count() == 0
    assert ob.join(lines, ["brand", "order_id"], "left_anti").count() == 0


def test_merged_is_the_union(reports):
    assert reports.report_merged.count() == reports.report_non_bundle.count()


def test_retention_has_no_nulls_after_fill(reports):
    from skuflow.operators.retention import null_audit
    bad = null_audit(reports.retention_table).where("null_count > 0 and column_name != 'first_order_date'")
    assert bad.count() == 0


def _hash(df):
    rows = sorted("|".join("" if v is None else str(v) for v in r) for r in df.collect())
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def test_same_result_for_any_partition_count(spark):
    src = from_testdata(spark, SF_SMALL)
    seen = {}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 5, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            r = pipeline.build_reports(src)
            seen[n] = tuple(_hash(df) for df in r.as_dict().values())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(set(seen.values())) == 1
