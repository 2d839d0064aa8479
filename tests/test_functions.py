"""The SKU mini-language and the day arithmetic on literal values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skuflow.functions import (clean_bundle_sku, floor_days_between, has_pipe, nonzero_qty, override_quantity,
                               sku_code, sku_priority, sku_qty, split_bundle)


def _eval(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("sku,code,qty", [
    ("MS-1#2", "MS-1", 2), ("MS-1", "MS-1", None), ("PX-3#x", "PX-3", None),
    ("PA-1#2|PB#0|PC", "PA-1", None), ("BB#0", "BB", 0), ("A#4.0", "A", None),
    ("A#", "A", None), ("#5", "", 5), ("A#-3", "A", -3),
])
def test_code_and_qty(spark, sku, code, qty):
    assert _eval(spark, sku_code(F.col("s")), sku) == code
    assert _eval(spark, sku_qty(F.col("s")), sku) == qty


def test_nonzero_qty(spark):
    assert _eval(spark, nonzero_qty(F.col("s")), "A#0") is None
    assert _eval(spark, nonzero_qty(F.col("s")), "A#7") == 7


def test_pipe_split_clean(spark):
    assert _eval(spark, has_pipe(F.col("s")), None) is False
    assert _eval(spark, has_pipe(F.col("s")), "A|B") is True
    assert _eval(spark, split_bundle(F.col("s")), "A#4||B#0|") == ["A#4", "", "B#0", ""]
    assert _eval(spark, clean_bundle_sku(F.col("s")), "A#4|B#0|C") == "A|B|C"
    assert _eval(spark, clean_bundle_sku(F.col("s")), "A#1#2|B") == "A|B"


def test_priority(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), (None, None)], "scp string, scpi string")
    got = [r[0] for r in df.select(sku_priority("scp", "scpi")).collect()]
    assert got == [0, 1, 2, 3]


def test_override_quantity(spark):
    df = spark.createDataFrame([("S#3", None, 4), ("S#3", "T", 4), ("S#3", "", 4), ("S#0", "T", 4),
                                ("S#x", "T", 4)], "raw string, own string, q int")
    got = [r[0] for r in df.select(override_quantity("raw", "own", "q")).collect()]
    assert got == [4, 3, 4, 4, 4]


def test_floor_days(spark):
    rows = [(dt.datetime(2020, 1, 1, 23, 0), dt.datetime(2020, 1, 2, 1, 0)),   # 2 h over midnight
            (dt.datetime(2020, 1, 2, 12, 0), dt.datetime(2020, 1, 2, 0, 0)),   # -12 h
            (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 31, 0, 0, 1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(floor_days_between("a", "b")).collect()] == [0, -1, 30]
