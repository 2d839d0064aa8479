"""Brand databases as sources (S1-S3 read side, S14).

Each brand has its own database holding the same tables.  A table is read whole:
its columns come from the database's own metadata in ordinal order, nothing is cut
before the snapshot's DISTINCT; the columns the reports read are picked later, from
the live snapshot (:func:`skuflow.sources.snapshot.read_live`).

Reads are split over tasks by predicates:

* a table with an integer key is split into key ranges of about equal rows, taken from
  a histogram the database counts (keys are rarely spread evenly: old rows are deleted,
  imports leave gaps); rows without a key form one more split;
* a table without one is split by a hash of its first columns.

The brand code is added as a literal column and the brands are unioned by name.
Reads of one table are separate statements, so a database that changes meanwhile may
be seen at slightly different moments by different splits.

No database may be started here: the tests stand in for the reader.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.brands import validate_brand
from skuflow.sources.snapshot import TableMissing
from skuflow.sources.tables import COPIED_TABLES, Sources

#: Types whose columns can be split into ranges, as information_schema names them.
INTEGER_TYPES = ("tinyint", "smallint", "mediumint", "int", "integer", "bigint")
#: Histogram buckets counted for each split.
BUCKETS_PER_SPLIT = 32
#: Columns that take part in a hash split.
HASHED_COLUMNS = 4


@dataclass(frozen=True)
class SourceColumn:
    name: str
    type: str
    key: str                # 'PRI' for a primary-key column


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def source_columns(spark: SparkSession, url: str, database: str, table: str, props: dict) -> list[SourceColumn]:
    """The table's columns in ordinal order, from the database's metadata (S2).  A table that is
    not there raises :class:`TableMissing`."""
    q = ("(SELECT column_name AS name, data_type AS type, column_key AS col_key, ordinal_position AS pos FROM information_schema.columns "
         f"WHERE table_schema = {_text(database)} AND table_name = {_text(table)}) c")
    rows = spark.read.jdbc(url, q, properties=props).collect()                  # a row per column
    if not rows:
        raise TableMissing(f"{database}: no table {table}")
    return [SourceColumn(r["name"], r["type"].lower(), r["col_key"] or "") for r in sorted(rows, key=lambda r: int(r["pos"]))]


def split_column(columns: list[SourceColumn]) -> str | None:
    """The integer column to split by: of the primary key, else one named ``id``, else the first
    that is named like a key; None when there is none."""
    whole = [c for c in columns if c.type in INTEGER_TYPES]
    for fits in (lambda c: c.key == "PRI", lambda c: c.name == "id", lambda c: c.name.endswith("_id")):
        for c in whole:
            if fits(c):
                return c.name
    return None


def key_ranges(histogram: list[tuple[int, int]], low: int, width: int, splits: int) -> list[int]:
    """First keys of the ranges after the first one: ``splits`` ranges of about equal rows, cut at
    the edges of histogram buckets ((bucket, rows), bucket 0 begins at ``low``)."""
    total = sum(n for _, n in histogram)
    cuts, seen = [], 0
    for bucket, n in sorted(histogram):
        if len(cuts) < splits - 1 and seen >= total * (len(cuts) + 1) / splits:
            cuts.append(low + bucket * width)
        seen += n
    return cuts


def range_predicates(column: str, cuts: list[int]) -> list[str]:
    """One predicate per range; every key, and a missing one, is in exactly one."""
    c = _quoted(column)
    if not cuts:
        return [f"{c} IS NOT NULL", f"{c} IS NULL"]
    inner = [f"{c} >= {a} AND {c} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{c} < {cuts[0]}", *inner, f"{c} >= {cuts[-1]}", f"{c} IS NULL"]


def hash_predicates(columns: list[str], splits: int) -> list[str]:
    """One predicate per hash value; equal rows share a split."""
    text = ", ".join(f"COALESCE(CAST({_quoted(c)} AS CHAR(255)), '')" for c in columns[:HASHED_COLUMNS])
    return [f"MOD(CRC32(CONCAT_WS('|', {text})), {splits}) = {k}" for k in range(splits)]


def split_predicates(spark: SparkSession, url: str, table: str, columns: list[SourceColumn], props: dict, splits: int) -> list[str]:
    """Predicates that split ``table`` into about ``splits`` parts of about equal rows."""
    column = split_column(columns)
    if column is None:
        return hash_predicates([c.name for c in columns], splits)
    key, name = _quoted(column), _quoted(table)
    bounds = spark.read.jdbc(url, f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {name}) b", properties=props).first()
    if bounds["lo"] is None:
        return range_predicates(column, [])
    low, high = int(bounds["lo"]), int(bounds["hi"])
    width = max(1, -(-(high - low + 1) // (splits * BUCKETS_PER_SPLIT)))
    q = f"(SELECT FLOOR(({key} - {low}) / {width}) AS bucket, COUNT(*) AS n FROM {name} WHERE {key} IS NOT NULL GROUP BY FLOOR(({key} - {low}) / {width})) h"
    histogram = [(int(r["bucket"]), int(r["n"])) for r in spark.read.jdbc(url, q, properties=props).collect()]   # a row per bucket
    return range_predicates(column, key_ranges(histogram, low, width, splits))


def read_table(spark: SparkSession, url: str, database: str, table: str, brand: str, props: dict, splits: int = 16) -> DataFrame:
    """One brand's ``table``: all its columns in ordinal order, then ``brand``."""
    validate_brand(brand)
    columns = source_columns(spark, url, database, table, props)
    names = [c.name for c in columns]
    if "brand" in names:
        raise ValueError(f"{database}.{table}: has a column named brand")
    parts = split_predicates(spark, url, table, columns, props, splits)
    df = spark.read.jdbc(url, _quoted(table), predicates=parts, properties=props)
    return df.select(*[df[_quoted(n)] for n in names], F.lit(brand).alias("brand"))


def read_sources(spark: SparkSession, brands: dict[str, tuple[str, str]], props: dict, splits: int = 16,
                 tables=COPIED_TABLES) -> Sources:
    """All copied tables of every brand (code -> (url, database)) as one brand-keyed
    :class:`Sources`.  A column that a brand's table does not have is null there."""
    out = {}
    for name in tables:
        frames = [read_table(spark, url, database, name, b, props, splits) for b, (url, database) in sorted(brands.items())]
        df = frames[0]
        for f in frames[1:]:
            df = df.unionByName(f, allowMissingColumns=True)
        out[name] = df
    return Sources.of(out)
