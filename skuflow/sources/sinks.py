"""Report sinks (S9-S13): full-refresh writes.

A report is published as versions: every run writes its rows, partitioned by
brand, to a path of its own -- counting them on the way -- and then commits one
manifest entry per brand (:mod:`skuflow.sources.manifest`).  Readers follow the
newest entry of each brand.  A brand without rows in a run is committed as well --
what was published before is gone -- unless the report is one that keeps its
old rows when a run comes out empty (S9).

The per-brand targets and the merged one (S12, S13) are catalogue views over the
published versions: no row is written a second time.  ``write_jdbc`` is the same
refresh into a database table (truncate + batched inserts of 7000 rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuflow.brands import BRANDS, export_table_name, validate_brands
from skuflow.sources import manifest

# Fixed value: rows per insert batch of the database load.
INSERT_BATCH = 7000
#: The cross-brand table of all non-bundle lines.
MERGED = "report_merged_non_bundle"


class BrandAbsent(LookupError):
    """A brand has no published version of a report."""


def publish_version(df: DataFrame, path: str, run_id: str, brands=BRANDS, keep_old_when_empty: bool = False,
                    sort_within: list[str] | None = None) -> dict[str, int]:
    """Write ``df`` (with a ``brand`` column) as version ``run_id`` of the report
    at ``path`` and make it current for ``brands``; returns the rows per brand.

    Rows are counted while they are written.  With ``keep_old_when_empty`` a
    brand without rows keeps its current version.  ``sort_within`` orders rows
    inside each output file (O4) without a global sort."""
    spark, root = df.sparkSession, path.rstrip("/")
    seen = Observation(f"{root}/{run_id}")
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    out = out.observe(seen, *[F.count_if(F.col("brand") == b).alias(b) for b in brands])
    out.write.mode("errorifexists").partitionBy("brand").parquet(f"{root}/{run_id}")
    counts = {b: int(seen.get[b]) for b in brands}
    for b, n in counts.items():
        if n or not keep_old_when_empty:
            manifest.commit(spark, root, b, run_id, rows=n)
    return counts


def current_versions(spark: SparkSession, path: str, brands=BRANDS) -> dict[str, tuple[str, int | None]]:
    """brand -> (run, rows) of the report at ``path``; a brand without a version raises."""
    found = manifest.heads(spark, path.rstrip("/"))
    if absent := [b for b in validate_brands(brands) if b not in found]:
        raise BrandAbsent(f"{path}: nothing published for {', '.join(absent)}")
    return {b: found[b][1:] for b in brands}


def read_report(spark: SparkSession, path: str, schema, brands=BRANDS) -> DataFrame:
    """The current rows of the report at ``path`` for ``brands``: each brand's
    newest version, pruned to its partition; raises :class:`BrandAbsent` for a
    brand that has none.  ``schema``: the report's own."""
    root = path.rstrip("/")
    by_run: dict[str, list[str]] = {}
    for b, (run_id, _) in current_versions(spark, root, brands).items():
        by_run.setdefault(run_id, []).append(b)
    out = spark.createDataFrame([], schema)
    for run_id, bs in sorted(by_run.items()):
        own = spark.read.schema(schema).parquet(f"{root}/{run_id}").where(F.col("brand").isin(*bs))
        out = out.unionByName(own)
    return out


def publish_views(spark: SparkSession, path: str, kind: str, schema: T.StructType, brands=BRANDS, database: str = "default") -> dict[str, str]:
    """Point the per-brand targets (``report_<brand>_<kind>``, S13) at the brands' current
    versions of the report at ``path``; view -> run.  A version is an external table over its
    partition's folder, with the report's schema, so nothing is read or written; the view of
    that name is replaced at once."""
    out = {}
    columns = [f for f in schema.fields if f.name != "brand"]
    told = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    for b, (run_id, _) in current_versions(spark, path, brands).items():
        view = export_table_name(b, kind)
        table = f"`{database}`.`{view}__{run_id.replace('-', '_').lower()}`"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({told}) USING parquet LOCATION '{path.rstrip('/')}/{run_id}/brand={b}'")
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{view}` AS SELECT * FROM {table}")
        out[view] = run_id
    return out


def publish_merged_view(spark: SparkSession, columns, brands=BRANDS, database: str = "default") -> str:
    """The cross-brand target as a view over all brands' non-bundle views; a brand whose
    view is not there is an error."""
    names = [export_table_name(b, "non_bundle") for b in validate_brands(brands)]
    own = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{MERGED}` AS " + " UNION ALL ".join(f"SELECT {own} FROM `{database}`.`{n}`" for n in names))
    return f"{database}.{MERGED}"


def expire(spark: SparkSession, path: str, keep: int = 3) -> list[str]:
    """Delete the versions of a report that are not among the newest ``keep`` of any brand."""
    return manifest.expire(spark, path, keep)


def write_table(df: DataFrame, path: str, run_id: str) -> str:
    """Write a table without brands as ``<path>/<run_id>``; returns that path."""
    df.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/{run_id}")
    return f"{path.rstrip('/')}/{run_id}"


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               skip_if_empty: bool = True) -> bool:
    """Full refresh of a database table: truncate (keeping its definition) and
    insert in batches of :data:`INSERT_BATCH` rows, one connection per task."""
    if skip_if_empty and df.isEmpty():
        return False
    (df.write.mode("overwrite").option("truncate", "true").option("batchsize", INSERT_BATCH)
     .jdbc(url, table, properties=properties or {}))
    return True


def per_brand_exports(df: DataFrame, kind: str, brands=BRANDS) -> dict[str, DataFrame]:
    """The per-brand export tables (``report_<brand>_<kind>``) as frames
    without the brand column; each is a partition-pruned filter."""
    out = {}
    for b in validate_brands(brands):
        out[export_table_name(b, kind)] = df.where(F.col("brand") == b).drop("brand")
    return out
