"""Versioned manifests: which run is current for a brand.

``<root>/manifest/brand=<B>/v=<number>/entry.json`` names a run.  An entry is
committed by creating its file, which fails when the file is there already, so of
two writers that saw the same newest number one gets the next number and the other
is told; the number, not a clock, says which entry is newest.  HDFS and local files
create exclusively; on an object store the file system's conditional create must be on.

``expire`` keeps the newest entries of every brand and deletes the data of the runs
that only dropped entries name.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "manifest"
ENTRY = "run_id string, rows long, brand string, v long"


class CommitConflict(RuntimeError):
    """Another writer has committed since the version this commit builds on."""


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its path object."""
    context = spark.sparkContext
    p = context._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(context._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _files(spark, path)
    return fs.exists(p)


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with ``text``; False when it is there already."""
    fs, p = _files(spark, path)
    if fs.getUri().getScheme() == "file":              # Hadoop's local create only looks first
        import os

        local = p.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x") as f:
                f.write(text)
        except FileExistsError:
            return False
        return True
    from py4j.protocol import Py4JJavaError

    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    try:
        out.write(text.encode())
    finally:
        out.close()
    return True


def entries(spark: SparkSession, root: str) -> DataFrame:
    """All entries below ``root``: run_id, rows, brand, v (no rows when there is no manifest)."""
    path = f"{root.rstrip('/')}/{MANIFEST}"
    if not exists(spark, path):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).option("mode", "FAILFAST").json(path)


def heads(spark: SparkSession, root: str) -> dict[str, tuple[int, str, int | None]]:
    """brand -> (newest version, its run, its rows); a row per brand reaches the driver."""
    newest = entries(spark, root).groupBy("brand").agg(F.max("v").alias("v"), F.max_by("run_id", "v").alias("run_id"), F.max_by("rows", "v").alias("rows"))
    return {r["brand"]: (r["v"], r["run_id"], r["rows"]) for r in newest.collect()}


def commit(spark: SparkSession, root: str, brand: str, run_id: str, rows: int | None = None, base: int | None = None) -> int:
    """Make ``run_id`` the brand's newest entry; returns its number.  With ``base`` (the newest
    number when the run began) another writer's commit since then raises :class:`CommitConflict`;
    without, the run takes the next free number."""
    at = heads(spark, root).get(brand, (0,))[0] if base is None else base
    text = json.dumps({"run_id": run_id, "rows": rows})
    while not create_exclusive(spark, f"{root.rstrip('/')}/{MANIFEST}/brand={brand}/v={at + 1}/entry.json", text):
        if base is not None:
            raise CommitConflict(f"{brand}: version {at + 1} was committed by another run than {run_id}")
        at += 1
    return at + 1


def expire(spark: SparkSession, root: str, keep: int = 3, part: str = "{run_id}") -> list[str]:
    """Keep the newest ``keep`` entries of every brand; drop the others and delete the runs that
    no kept entry names (``part``: where a run's data lies below ``root``).  Runs without an entry
    (still being written, or failed) are left alone.  Returns the runs deleted."""
    if keep < 1:
        raise ValueError("at least one entry of each brand is kept")
    root = root.rstrip("/")
    by_brand: dict[str, list[tuple[int, str]]] = {}
    for r in entries(spark, root).select("brand", "v", "run_id").collect():       # a row per brand and kept or new run
        by_brand.setdefault(r["brand"], []).append((r["v"], r["run_id"]))
    kept, dropped = set(), []
    for brand, own in by_brand.items():
        own.sort(reverse=True)
        kept |= {run for _, run in own[:keep]}
        dropped += [(brand, v, run) for v, run in own[keep:]]
    gone = sorted({run for _, _, run in dropped} - kept)
    for run in gone:
        if not re.fullmatch(r"[\w.-]+", run) or run.startswith("."):
            raise ValueError(f"not a run id: {run!r}")
        fs, p = _files(spark, f"{root}/{part.format(run_id=run)}")
        fs.delete(p, True)
    for brand, v, _ in dropped:                        # entries last: an interrupted expiry can be repeated
        fs, p = _files(spark, f"{root}/{MANIFEST}/brand={brand}/v={v}")
        fs.delete(p, True)
    return gone
