"""Helpers shared by the operators: text input, written intermediates, components.

``documents`` input may carry null texts (read as empty), null ids, repeated
rows, extra columns and columns whose names clash with an operator's own: every
operator selects the columns it needs by position into private names first.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = "/{name}.parquet"
#: Bytes of rows that Spark and Python hand each other at a time; both sides hold a batch several times over.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per context: they need not have it installed,
    nor share a folder with the driver."""
    context = spark.sparkContext
    if getattr(context, "_skuflow_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="skuflow-ship-")) / "skuflow_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(target))
    context._skuflow_shipped = True


def give_back() -> None:
    """Hand what a large step has let go back to the system: Spark keeps a Python worker, with all
    it holds, for the tasks to come."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):             # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(sf_dir.rstrip("/") + TABLES.format(name=name))


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): the two columns an operator works on; a null text is empty."""
    ship(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); only where it is
    unset, and the master is local, a temporary folder is made and set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="skuflow-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, jobs hand Python batches of about BATCH_BYTES (10,000 whole texts at once
    take some 200 MB of an executor more); the session's setting is put back after it."""
    old = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, old)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the
    lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()   # lets Spark's cleaner drop the finished step's shuffle files
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): (node, component) with the smallest node id.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): every
    round keeps at most one row per edge, a hub of any degree is reduced by
    partial aggregation first, and nothing but a row count and a checksum
    reaches the driver.  Null ends and loops are ignored; nodes without an edge
    do not appear.
    """
    e = (edges.toDF("a", "b").where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = written(e, label)
    before = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: every larger neighbour points to the smallest one
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # small star: all smaller neighbours and the node itself point to the smallest
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")),
                                           F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("p"))
                 .select(F.col("p.x").alias("a"), F.col("p.y").alias("b")).where("a <> b").distinct())
        e = written(small, label)
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = state
    raise RuntimeError("components did not settle")


# --- vectorised words --------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Odd multiplier of the rolling hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(_BASE ** i, _INVERSE ** i) for i < n, modulo 2**64; kept for the next call."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (_BASE, _INVERSE)]
    return _POWERS[0][:n], _POWERS[1][:n]


class Words:
    """Words (runs of bytes that are not ASCII white space) of a batch of texts, A-Z lower-cased.

    ``doc``: index of each word's text; ``start``, ``end``: byte offsets in
    ``data`` (all texts with a blank after each); ``code``: 64-bit hash of a word.
    """

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self.raw, self.data = raw, _LOWER[raw]
        space = _SPACE[raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        stops = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        self.doc = np.searchsorted(stops, self.start, side="right")
        self.code = range_hash(self.data, self.start, self.end)


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """64-bit hash of data[start:end] for ascending, non-overlapping ranges: prefix sums
    of a polynomial modulo 2**64 in blocks, so that a table of powers stays small."""
    out = np.zeros(len(start), np.uint64)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(start):
            first = start[lo]
            hi = max(lo + 1, int(np.searchsorted(end, first + block, side="right")))
            last = end[hi - 1]
            n = int(last - first)
            power, inverse = _powers(n + 1)
            total = np.concatenate([[np.uint64(0)], np.cumsum((data[first:last].astype(np.uint64) + np.uint64(1)) * power[:n])])
            s, t = start[lo:hi] - first, end[lo:hi] - first
            out[lo:hi] = mix((total[t] - total[s]) * inverse[s] + (t - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            lo = hi
    return out
