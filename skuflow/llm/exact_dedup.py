"""Exact deduplication with a heavy-hitter split.

Every row is reduced to (doc_id, SHA-256 of the whole text, row number), written
once.  Each task then keeps a Misra-Gries summary of its digests: a table of
counters into which batches of counts are merged; when it is too full, the count of
the largest surplus counter is taken off all of them.  The summaries' counts are
summed by digest, and with what was taken off they bound every digest's true count
from both sides, so no digest above ``share`` of all rows is missed.  These
candidates -- at most ``2 / share``, whatever the input -- are counted exactly; the
verified ones, with the row that stays, are broadcast, and their rows are decided
where they lie.  All other digests hold less than ``share`` of the rows each and take
the ordinary way: a group-by with partial aggregation, joined back.

Cases: a null text is the empty text; texts are equal when their bytes are.  The row
of the largest id stays; a null id is below every other, and of rows that share the
largest id exactly one stays.  ``keep_id`` is null only where the whole group has no
id.  Further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import texts_of, written

#: A digest above this share of all rows is decided on the map side.
SHARE = 1 / 1024


def merge_counts(kept: dict[bytes, int], more: dict[bytes, int], capacity: int) -> int:
    """Merge ``more`` into the Misra-Gries counters ``kept`` (at most ``capacity`` stay);
    returns what was taken off every counter: the most by which a count is now too low."""
    for key, n in more.items():
        kept[key] = kept.get(key, 0) + n
    if len(kept) <= capacity:
        return 0
    off = sorted(kept.values(), reverse=True)[capacity]
    for key in [k for k, n in kept.items() if n <= off]:
        del kept[key]
    for key in kept:
        kept[key] -= off
    return off


def frequent(rows: DataFrame, share: float, column: str = "digest") -> DataFrame:
    """(column): the values that may hold at least ``share`` of the rows; at most ``2 / share``.

    A task's summary of k counters takes off at most rows / (k + 1), so all of them together
    take off at most half of ``share`` here; a value's summed count reaches the other half."""
    capacity = int(2 / share) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        n = off = 0
        for batch in batches:
            counts = pa.compute.value_counts(batch.column(0))
            off += merge_counts(kept, dict(zip(counts.field(0).to_pylist(), counts.field(1).to_pylist())), capacity)
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *kept], pa.binary()), pa.array([n, *kept.values()], pa.int64()), pa.array([off, *[0] * len(kept)], pa.int64())],
            ["value", "low", "off"])

    found = written(rows.select(column).mapInArrow(run, "value binary, low long, off long"), "frequent-summaries")
    total = found.where("value is null").agg(F.sum("low"), F.sum("off")).first()
    n, off = total[0] or 0, total[1] or 0
    return (found.where("value is not null").groupBy("value").agg(F.sum("low").alias("low"))
            .where(F.col("low") + F.lit(off) >= F.lit(max(share * n, 2.0))).select(F.col("value").alias(column)))


def _groups(rows: DataFrame) -> DataFrame:
    """(digest, best, group_size): the row that stays of each digest."""
    return rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))


def mark_copies(docs: DataFrame, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, digest (binary)."""
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    rows = texts_of(docs, id_col, text_col).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"),
                                                   F.monotonically_increasing_id().alias("row"))
    rows = written(rows, "dedup-rows")
    likely = written(frequent(rows, share), "dedup-likely")
    n = rows.count()
    winners = _groups(rows.join(F.broadcast(likely), "digest")).where(F.col("group_size") >= F.lit(share * n))
    winners = F.broadcast(written(winners, "dedup-winners"))         # at most 1 / share rows
    rest = rows.join(winners, "digest", "left_anti")
    decided = rows.join(winners, "digest").unionByName(rest.join(_groups(rest), "digest"))
    return decided.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                          (F.col("row") == F.col("best.row")).alias("kept"), "digest")


def digest_columns(marked: DataFrame) -> DataFrame:
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
