"""The whole refresh as one Spark job per stage, all brands at once.

    snapshot -> audit -> gate -> promote          (skuflow.sources.snapshot)
    live sources -> extracts -> reports -> sinks  (this module)

Brands are a column, not a loop: one plan serves every brand and a brand
list only adds a partition filter.  The stock lines, which feed two reports,
are written once into the shared folder as a table of the run, so a lost
executor recomputes from there, not from the sources.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.brands import BRANDS, validate_brands
from skuflow.operators import extract as X
from skuflow.operators import orders as O
from skuflow.operators import retention as R
from skuflow.operators import stock_flow as SF
from skuflow.operators import sunset as SU
from skuflow.session import scratch_path
from skuflow.sources import manifest
from skuflow.sources.sinks import publish_merged_view, publish_version, publish_views, write_table
from skuflow.sources.snapshot import new_run_id
from skuflow.sources.tables import Sources

#: Reports whose old rows stay when a run has none for a brand (S9); the others are always replaced.
KEEP_OLD_WHEN_EMPTY = ("retention_table", "sunset_table")


@dataclass
class Reports:
    retention_table: DataFrame
    sunset_table: DataFrame
    report_non_bundle: DataFrame
    report_only_bundle: DataFrame
    report_merged: DataFrame
    quality: dict[str, DataFrame] = field(default_factory=dict)

    def as_dict(self) -> dict[str, DataFrame]:
        return {"retention_table": self.retention_table, "sunset_table": self.sunset_table,
                "report_non_bundle": self.report_non_bundle, "report_only_bundle": self.report_only_bundle,
                "report_merged": self.report_merged}


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows of each stage per brand, in one job: brand, stage, n_rows."""
    parts = [df.groupBy("brand").agg(F.count(F.lit(1)).alias("n_rows")).select("brand", F.lit(n).alias("stage"), "n_rows")
             for n, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_reports(sources: Sources, brands=None, cut_lineage: bool = False) -> Reports:
    """Report frames for ``brands`` (all when None).  Building them runs no job;
    the reports run when they are written.

    With ``cut_lineage`` the stock lines with their per-order facts -- shared
    by both stock-flow reports -- are written once into the shared folder, now,
    without the order's header on every line; the headers are a table of their own.
    """
    if brands is not None:
        sources = sources.for_brands(validate_brands(brands))
    ox, ix = X.extract_orders(sources), X.extract_items(sources)
    ex = X.extract_stock_lines(sources)
    lines = SF.stock_lines(ex)
    if cut_lineage:
        flagged = SF.flag_lines(lines).rows()
        spark = flagged.sparkSession
        path = scratch_path(spark, "stock-lines")
        # the header stays on the order's lines of the lowest rank only
        head = F.row_number().over(SF.header_order()) == 1
        flagged = flagged.withColumn("header", F.when(F.col("is_bundle") & head, F.col("header")))
        flagged.write.parquet(path)
        flagged = spark.read.schema(flagged.schema).parquet(path)
        non_bundle = SF.non_bundle_rows(flagged)
        only_bundle = SF.header_rows(flagged.where(F.col("header").isNotNull()))
    else:
        non_bundle = SF.report_non_bundle(lines).rows()
        only_bundle = SF.report_only_bundle(SF.order_summary(lines)).rows()
    base = R.retention_base(ox, ix)
    retention = R.fill_retention(base)
    return Reports(
        retention_table=retention,
        sunset_table=SU.sunset_table(ox, ix, X.valid_orders(sources)),
        report_non_bundle=non_bundle,
        report_only_bundle=only_bundle,
        report_merged=SF.report_merged(non_bundle),
        quality={"retention_missing_first_items": R.missing_first_items(base),
                 "retention_null_audit": R.null_audit(retention),
                 "stage_counts": stage_counts({"orders": ox, "items": ix, "orders_with_items": O.orders_with_items(ox, ix),
                                               "stock_lines": ex.rows(), "report_lines": lines.rows()})},
    )


def publish(spark: SparkSession, reports: Reports, out_root: str, brands=None, run_id: str | None = None,
            database: str = "default") -> dict[str, int]:
    """Write every report as a new version and make it current; returns the rows
    of each.  Stock-flow reports are replaced for every brand of the run, also
    by nothing; retention and sunset keep their rows where a run has none (S9).
    The per-brand exports and the cross-brand merge are views over the published
    versions in ``database``: all five brands, or, for a run over some brands,
    those published so far.  The quality reports are written beside them."""
    root, run_id = out_root.rstrip("/"), run_id or new_run_id()
    chosen = validate_brands(brands) if brands is not None else BRANDS
    counts: dict[str, int] = {}
    frames = reports.as_dict()
    for name, df in frames.items():
        if name != "report_merged":
            rows = publish_version(df, f"{root}/{name}", run_id, chosen, keep_old_when_empty=name in KEEP_OLD_WHEN_EMPTY,
                                   sort_within=["order_id"] if name.startswith("report_") else None)
            counts[name] = sum(rows.values())
    heads = manifest.heads(spark, f"{root}/report_non_bundle")
    merged = BRANDS if brands is None else tuple(b for b in BRANDS if b in heads)
    for kind, own in (("non_bundle", merged), ("only_bundle", chosen)):
        publish_views(spark, f"{root}/report_{kind}", kind, frames[f"report_{kind}"].schema, own, database)
    publish_merged_view(spark, reports.report_merged.columns, merged, database)
    counts["report_merged"] = sum(heads[b][2] for b in merged)
    for name, df in reports.quality.items():
        write_table(df, f"{root}/{name}", run_id)
    return counts


def run(spark: SparkSession, sources: Sources, out_root: str, brands=None, database: str = "default") -> dict[str, int]:
    """Build and publish all reports; returns rows written per report."""
    return publish(spark, build_reports(sources, brands, cut_lineage=True), out_root, brands, database=database)
