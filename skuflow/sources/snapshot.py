"""Snapshot, audit, gate and promote.

A run first writes its ledger: the (brand, table) pairs it must land, all copied
tables whatever it is given, and the version each brand had when it began.  It then
copies every table with all columns as found into an immutable staged version
``<stage_root>/<run_id>/<table>/brand=<B>/`` (complex types as text, then whole-row
DISTINCT); rows are counted while they are written.  The audit holds what landed
against the ledger and those counts; the gate passes a brand only when every table of
the ledger landed, whole, with rows; the promote step commits, per passing brand,
which run is live (:mod:`skuflow.sources.manifest`).  A brand that another run has
promoted meanwhile is left to that run.  Readers resolve the newest entry of each
brand, prune to the brand's partition and project onto the columns the reports read,
so a failed brand keeps serving its previous snapshot.

No table is dropped or renamed in place: versions are append-only paths until
:func:`expire` removes the oldest.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuflow.brands import BRANDS, validate_brands
from skuflow.sources import manifest
from skuflow.sources.manifest import CommitConflict
from skuflow.sources.tables import COPIED_TABLES, SOURCE_TABLES, Sources, conform

LEDGER = "expected"
WRITTEN = "written"


class TableMissing(RuntimeError):
    """A table of the run did not land."""


class GateFailed(RuntimeError):
    """Some brands did not pass the gate; the others have been promoted.  ``tables``:
    the tables of each that did not land, landed in part or are empty."""

    def __init__(self, run_id: str, brands: list[str], tables: dict[str, list[str]] | None = None):
        self.run_id, self.brands, self.tables = run_id, brands, tables or {}
        told = [f"{b} ({', '.join(self.tables[b])})" if self.tables.get(b) else b for b in brands]
        super().__init__(f"{run_id}: not promoted: {', '.join(told)}")


def normalise_types(df: DataFrame) -> DataFrame:
    """Landing normalisation (S4): nested/JSON-like columns become JSON text;
    everything else keeps its type."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StructType, T.MapType, T.ArrayType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def snapshot_frame(name: str, df: DataFrame) -> DataFrame:
    """The rows a snapshot of table ``name`` holds: all columns as found (S2),
    normalised (S4), whole-row distinct (S3, U3)."""
    return normalise_types(df).distinct()


def snapshot_counts(sources: Sources) -> DataFrame:
    """Rows per (brand, table) of the snapshot frames, without writing.

    brand, table_name, n_rows
    """
    parts = [snapshot_frame(n, t).groupBy("brand")
             .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(n))
             for n, t in sources.as_dict().items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("brand", "table_name", "n_rows")


def expected_tables(spark: SparkSession, brands=None, tables=COPIED_TABLES) -> DataFrame:
    """The (brand, table) pairs a run must land: brands x tables, built by
    exploding two literal arrays (a handful of rows)."""
    chosen = validate_brands(brands) if brands is not None else BRANDS
    return (spark.range(1)
            .select(F.explode(F.array(*[F.lit(b) for b in chosen])).alias("brand"))
            .select("brand", F.explode(F.array(*[F.lit(t) for t in tables])).alias("table_name")))


def gate(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """All-or-nothing promotion gate per brand (S6): every expected table
    exists, is whole (where ``counts`` has the rows written) and has rows; a
    missing table counts as zero rows.

    brand, tables_expected, tables_empty, passed
    """
    whole = F.col("n_rows") == F.col("n_written") if "n_written" in counts.columns else F.lit(True)
    joined = expected.join(counts.withColumn("fine", (F.col("n_rows") > 0) & whole), ["brand", "table_name"], "left") \
        .withColumn("fine", F.coalesce("fine", F.lit(False)))
    return joined.groupBy("brand").agg(
        F.count(F.lit(1)).alias("tables_expected"),
        F.count_if(~F.col("fine")).alias("tables_empty"),
        F.bool_and("fine").alias("passed"))


def new_run_id() -> str:
    return time.strftime("run-%Y%m%dT%H%M%S", time.gmtime()) + f"-{time.time_ns() % 1_000_000:06d}"


def open_run(spark: SparkSession, stage_root: str, run_id: str, brands=None, tables=COPIED_TABLES) -> dict[str, int]:
    """Write the run's ledger before anything is copied; returns the version each brand has now."""
    bases = {b: v for b, (v, _, _) in manifest.heads(spark, stage_root).items()}
    ledger = expected_tables(spark, brands, tables)
    versions = F.create_map(*[F.lit(x) for pair in bases.items() for x in pair]) if bases else F.create_map().cast("map<string,int>")
    ledger = ledger.withColumn("base", F.coalesce(F.try_element_at(versions, F.col("brand")), F.lit(0)).cast("long"))
    ledger.coalesce(1).write.mode("errorifexists").parquet(f"{stage_root.rstrip('/')}/{run_id}/{LEDGER}")
    chosen = validate_brands(brands) if brands is not None else BRANDS
    return {b: bases.get(b, 0) for b in chosen}


def stage(spark: SparkSession, sources: Sources, stage_root: str, run_id: str,
          max_parallel: int = 4, brands=BRANDS) -> dict[str, str]:
    """Write every table's snapshot frame under ``<stage_root>/<run_id>``,
    partitioned by brand.  Tables are submitted as concurrent Spark jobs; the
    rows of each brand are counted as they are written and kept beside the run."""
    tables, root = sources.as_dict(), f"{stage_root.rstrip('/')}/{run_id}"
    paths = {n: f"{root}/{n}" for n in tables}

    def write(n: str) -> list[tuple[str, str, int]]:
        seen = Observation(f"{run_id}/{n}")
        rows = snapshot_frame(n, tables[n]).observe(seen, *[F.count_if(F.col("brand") == b).alias(b) for b in brands])
        rows.write.mode("errorifexists").partitionBy("brand").parquet(paths[n])
        return [(b, n, seen.get[b]) for b in brands]

    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        counts = [row for rows in pool.map(write, tables) for row in rows]
    (spark.createDataFrame(counts, "brand string, table_name string, n_written long")     # a row per brand and table
     .coalesce(1).write.mode("errorifexists").parquet(f"{root}/{WRITTEN}"))
    return paths


def _read_landed(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The parquet dataset at ``path``, or None when the path does not exist.
    Any other failure is raised."""
    from pyspark.errors import AnalysisException

    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            return None
        raise


def staged_counts(spark: SparkSession, stage_root: str, run_id: str, tables=SOURCE_TABLES) -> DataFrame:
    """S5 audit of a staged run: rows per (brand, table) that landed.  Raises
    :class:`TableMissing` when a table of ``tables`` has not landed at all."""
    parts = []
    for n in tables:
        df = _read_landed(spark, f"{stage_root.rstrip('/')}/{run_id}/{n}", "brand string")
        if df is None:
            raise TableMissing(f"{run_id}: {n} did not land")
        parts.append(df.groupBy("brand")
                     .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(n)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("brand", "table_name", "n_rows")


def audit(spark: SparkSession, stage_root: str, run_id: str) -> DataFrame:
    """S5 audit against the run's ledger: what landed of every (brand, table) it had to land.

    brand, table_name, landed, n_rows, n_written
    """
    root = f"{stage_root.rstrip('/')}/{run_id}"
    expected = spark.read.schema("brand string, table_name string, base long").parquet(f"{root}/{LEDGER}")
    names = [r["table_name"] for r in expected.select("table_name").distinct().collect()]        # the list of tables
    counts = expected.sparkSession.createDataFrame([], "brand string, n_rows long, table_name string")
    for n in sorted(names):
        df = _read_landed(spark, f"{root}/{n}", "brand string")
        if df is not None:
            counts = counts.unionByName(df.groupBy("brand").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(n)))
    written = _read_landed(spark, f"{root}/{WRITTEN}", "brand string, table_name string, n_written long")
    if written is None:
        raise TableMissing(f"{run_id}: staging did not end")
    keys = ["brand", "table_name"]
    out = expected.select(*keys).join(counts, keys, "left").join(written, keys, "left")
    return out.select(*keys, F.col("n_written").isNotNull().alias("landed"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                      F.coalesce("n_written", F.lit(0)).alias("n_written"))


def promote(spark: SparkSession, stage_root: str, run_id: str, passed_brands, bases: dict[str, int] | None = None) -> dict[str, int]:
    """Make ``run_id`` live for ``passed_brands``; other brands keep their
    current run.  Commits one manifest entry per brand and returns its number.
    With ``bases`` (:func:`open_run`) a brand that another run has promoted since
    raises :class:`CommitConflict`, after the other brands are promoted."""
    done, lost = {}, []
    for b in validate_brands(passed_brands):
        try:
            done[b] = manifest.commit(spark, stage_root, b, run_id, base=None if bases is None else bases[b])
        except CommitConflict:
            lost.append(b)
    if lost:
        raise CommitConflict(f"{run_id}: promoted by another run meanwhile: {', '.join(lost)}")
    return done


def live_runs(spark: SparkSession, stage_root: str) -> dict[str, str]:
    """brand -> live run id: each brand's newest manifest entry."""
    return {b: run for b, (_, run, _) in manifest.heads(spark, stage_root).items()}


def expire(spark: SparkSession, stage_root: str, keep: int = 3) -> list[str]:
    """Delete the runs that are not among the newest ``keep`` of any brand; returns them."""
    return manifest.expire(spark, stage_root, keep)


def read_live(spark: SparkSession, stage_root: str, brands=None) -> Sources:
    """The live snapshot of the report tables as one brand-keyed DataFrame each,
    projected onto the columns the reports read.  A brand filter prunes to the
    brand's partition of its live run.  Raises when a brand (of ``brands``, or
    of all) has no live run."""
    runs = live_runs(spark, stage_root)
    chosen = validate_brands(brands) if brands is not None else BRANDS
    if missing := [b for b in chosen if b not in runs]:
        raise ValueError(f"no live snapshot of {', '.join(missing)} under {stage_root}")
    by_run: dict[str, list[str]] = {}
    for b in chosen:
        by_run.setdefault(runs[b], []).append(b)
    tables = {}
    for n in SOURCE_TABLES:
        frames = [conform(n, spark.read.parquet(f"{stage_root.rstrip('/')}/{r}/{n}").where(F.col("brand").isin(*bs)))
                  for r, bs in sorted(by_run.items())]
        df = frames[0]
        for f in frames[1:]:
            df = df.unionByName(f)
        tables[n] = df
    return Sources(**tables)


def snapshot_and_promote(spark: SparkSession, sources: Sources, stage_root: str, brands=None,
                         allow_failed: bool = False, tables=COPIED_TABLES) -> tuple[str, DataFrame]:
    """S1-S7 end to end: ledger, stage, audit, gate, promote the brands that pass.
    ``tables`` must land, whatever ``sources`` holds.  Returns (run_id, gate
    DataFrame); raises :class:`GateFailed` when a brand did not pass, unless
    ``allow_failed``, and :class:`CommitConflict` when another run came first."""
    run_id = new_run_id()
    chosen = validate_brands(brands) if brands is not None else BRANDS
    bases = open_run(spark, stage_root, run_id, chosen, tables)
    stage(spark, sources.for_brands(chosen), stage_root, run_id, brands=chosen)
    landed = audit(spark, stage_root, run_id)
    g = gate(landed.select("brand", "table_name", "n_rows", "n_written"), expected_tables(spark, chosen, tables))
    passed = {r["brand"]: r["passed"] for r in g.select("brand", "passed").collect()}
    promote(spark, stage_root, run_id, [b for b in chosen if passed[b]], bases)
    if not all(passed.values()) and not allow_failed:
        bad: dict[str, list[str]] = {}
        for r in landed.where("not landed or n_rows <= 0 or n_rows <> n_written").orderBy("table_name").collect():   # at most the ledger
            bad.setdefault(r["brand"], []).append(r["table_name"])
        raise GateFailed(run_id, [b for b in chosen if not passed[b]], bad)
    return run_id, g
