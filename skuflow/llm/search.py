"""Exact top-k BM25 search: sharded inverted index, block-max WAND, exact merge.

*Index.*  Every task cuts its documents into shards of at most ``SHARD_DOCS``
documents or ``SHARD_BYTES`` bytes and inverts each: a row per block of up to
``BLOCK`` postings of a term (document numbers, term frequencies, and the block's
largest frequency and shortest document, which bound its scores for any average
length).  Shards are self-contained and written to the shared folder.

*Statistics.*  Number of documents, average length and document frequencies come
from the whole index, so scores do not depend on the sharding.

*Search.*  Queries are dealt into blocks of ``QUERY_BLOCK``; a shard meets each
block of queries once, with the postings of that block's terms only.  WAND picks
the next document that could reach the current k-th score by the terms' bounds,
checks the bounds of the current blocks, skips to the end of the nearest block if
they rule it out, and scores it otherwise.  The shards' top lists are merged by
score, rounded to six digits, then the smaller id.

Cases: null and empty documents count as documents of length 0 and are never
found; null and empty queries find nothing; null ids rank behind others of equal
score; repeated rows are documents of their own; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.llm.common import Words, ship, texts_of, written

K1, B = 1.2, 0.75
SHARD_DOCS, SHARD_BYTES = 20_000, 48_000_000
BLOCK = 64
QUERY_BLOCK = 64
#: Terms and postings, and (term null) the shard's documents with their lengths.
INDEX = "shard long, term long, docs array<int>, tfs array<int>, most int, least int, ids array<long>, total long"
DIGITS = 6


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values, kind))


class Shard:
    """Documents gathered for one shard."""

    def __init__(self):
        self.ids, self.lengths, self.terms, self.docs, self.bytes = [], [], [], [], 0

    def add(self, ids: list, texts: list[bytes]) -> None:
        w = Words(texts)
        self.terms.append(w.code)
        self.docs.append(w.doc + len(self.ids))
        self.lengths.extend(np.bincount(w.doc, minlength=len(texts)).tolist())
        self.ids.extend(ids)
        self.bytes += sum(map(len, texts))

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in INDEX.split(", ")]
        terms, docs = np.concatenate(self.terms), np.concatenate(self.docs)
        length = np.array(self.lengths, np.int64)
        order = np.lexsort((docs, terms))
        terms, docs = terms[order], docs[order]
        at = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (docs[1:] != docs[:-1])])) if len(terms) else np.zeros(0, int)
        tf = np.diff(np.concatenate([at, [len(terms)]]))
        terms, docs = terms[at], docs[at]
        new = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else at
        place = np.arange(len(terms)) - np.repeat(new, np.diff(np.concatenate([new, [len(terms)]])))
        start = np.flatnonzero(place % BLOCK == 0)
        for a in range(0, len(start), 100_000):
            s = start[a:a + 100_000]
            stop = start[a + 100_000] if a + 100_000 < len(start) else len(terms)
            own, ends = slice(s[0], stop), np.concatenate([s[1:], [stop]]) - s[0]
            n = len(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, shard)), pa.array(terms[s].view(np.int64)), _lists(docs[own], ends, pa.int32()), _lists(tf[own], ends, pa.int32()),
                 pa.array(np.maximum.reduceat(tf[own], s - s[0]).astype(np.int32)), pa.array(np.minimum.reduceat(length[docs[own]], s - s[0]).astype(np.int32)),
                 pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64())], names)
        one = pa.array([0], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.nulls(1, pa.int64()), pa.array([length.tolist()], pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int32())),
             one, one, pa.array([self.ids], pa.list_(pa.int64())), pa.array([int(length.sum())])], names)


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of every row of ``docs``, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, shard = TaskContext.get().partitionId() << 24, 0, Shard()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                shard.add(part.column(0).to_pylist(), [t.as_buffer().to_pybytes() for t in part.column(1)])
                if len(shard.ids) >= SHARD_DOCS or shard.bytes >= SHARD_BYTES:
                    yield from shard.rows(base + made)
                    made, shard = made + 1, Shard()
        if shard.ids:
            yield from shard.rows(base + made)

    return written(texts_of(docs, id_col, text_col).mapInArrow(run, INDEX), "search-index")


def _query_terms(queries: DataFrame) -> DataFrame:
    """(query, term, weight, place): the distinct terms of each query text in a fixed order, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = Words([t.as_buffer().to_pybytes() for t in batch.column(1)])
            order = np.lexsort((w.code, w.doc))
            doc, code = w.doc[order], w.code[order]
            at = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])])) if len(doc) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc[at])), pa.array(code[at].view(np.int64)),
                                              pa.array(np.diff(np.concatenate([at, [len(doc)]])))], ["query", "term", "weight"])

    ship(queries.sparkSession)
    return queries.mapInArrow(run, "query long, term long, weight long")


class Cursor:
    """One query term's postings in a shard, by blocks."""

    __slots__ = ("place", "weight", "docs", "tfs", "bound", "last", "blocks", "at", "doc")

    def __init__(self, place: int, weight: float, blocks: list, bound):
        self.place, self.weight = place, weight
        self.docs = np.concatenate([b[0] for b in blocks]).tolist()
        self.tfs = np.concatenate([b[1] for b in blocks]).tolist()
        self.last = [int(b[0][-1]) for b in blocks]
        self.blocks = [weight * bound(b[2], b[3]) for b in blocks]
        self.bound = max(self.blocks)
        self.at, self.doc = 0, self.docs[0]

    def seek(self, doc: int) -> None:
        from bisect import bisect_left

        self.at = bisect_left(self.docs, doc, self.at)
        self.doc = self.docs[self.at] if self.at < len(self.docs) else END


END = 2 ** 62


def block_max_wand(cursors: list[Cursor], length: list[int], ids: list, k: int, average: float) -> tuple[list[tuple], int]:
    """The best ``k`` (score, number) by score and id, and how many documents were scored."""
    from bisect import bisect_left
    from heapq import heappush, heapreplace

    none = 2 ** 63
    best: list[tuple] = []                          # worst first: (score, -id, -number)
    least, scored, slack = -1.0, 0, 10.0 ** -DIGITS
    while True:
        cursors = sorted((c for c in cursors if c.doc < END), key=lambda c: c.doc)
        total, pivot = 0.0, None
        for i, c in enumerate(cursors):
            total += c.bound
            if total + slack >= least:
                pivot = i
                break
        if pivot is None:
            break
        doc = cursors[pivot].doc
        upto = pivot + 1
        while upto < len(cursors) and cursors[upto].doc == doc:
            upto += 1
        total, edge = 0.0, END
        for c in cursors[:upto]:
            b = bisect_left(c.last, doc)
            if b < len(c.last):
                total += c.blocks[b]
                edge = min(edge, c.last[b])
        if total + slack >= least:
            if cursors[0].doc == doc:
                scored += 1
                share = K1 * (1 - B + B * length[doc] / average)
                score = 0.0
                for c in sorted(cursors[:upto], key=lambda c: c.place):
                    tf = c.tfs[c.at]
                    score += c.weight * tf * (K1 + 1) / (tf + share)
                score = round(score, DIGITS)
                entry = (score, -(none if ids[doc] is None else ids[doc]), -doc)
                if len(best) < k:
                    heappush(best, entry)
                elif entry > best[0]:
                    heapreplace(best, entry)
                if len(best) == k:
                    least = best[0][0]
                for c in cursors[:upto]:
                    c.seek(doc + 1)
            else:
                for c in cursors[:pivot]:
                    if c.doc < doc:
                        c.seek(doc)
        else:                                       # no document before the nearest block's end can do
            to = edge + 1
            if upto < len(cursors):
                to = min(to, cursors[upto].doc)
            to = max(to, doc + 1)
            for c in cursors[:upto]:
                c.seek(to)
    return [(e[0], -e[2]) for e in best], scored


def search(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """(query, rank, doc_id, score, scored) of the ``k`` best documents of every row of ``queries``;
    ``scored``: documents that the shard with this hit had to score."""
    own = queries.select(queries[id_col].cast("long").alias("query"), F.coalesce(queries[text_col].cast("string"), F.lit("")).alias("text"))
    terms = written(_query_terms(own), "search-terms")
    numbers = index.where("term is null").agg(F.sum(F.size("ids")).alias("n"), F.sum("total").alias("total"))
    df = (index.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum(F.size("docs")).alias("df")))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = written(terms.join(df, "term").crossJoin(F.broadcast(numbers))          # one row: the collection's statistics
                      .select(F.pmod(F.xxhash64("query"), F.lit(1 << 30)).alias("deal"), "query", "term", (F.col("weight") * idf).alias("weight"),
                              (F.col("total") / F.col("n")).alias("average")), "search-weights")
    n_queries = weights.select("query").distinct().count()
    blocks = max(1, -(-n_queries // QUERY_BLOCK))
    weights = weights.withColumn("part", (F.col("deal") % blocks).cast("int")).drop("deal")
    wanted = weights.select("part", "term").distinct()
    columns = {"kind": "int", "term": "long", "docs": "array<int>", "tfs": "array<int>", "most": "int", "least": "int", "ids": "array<long>",
               "query": "long", "weight": "double", "average": "double"}

    def rows(df: DataFrame, kind: int) -> DataFrame:
        own = df.withColumn("kind", F.lit(kind))
        return own.select("shard", "part", *((F.col(c) if c in own.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()))

    postings = index.join(wanted, "term").select("shard", "part", "term", "docs", "tfs", "most", "least")
    parts = weights.select("part").distinct()                                         # the numbers of the query blocks
    heads = index.where("term is null").select("shard", "docs", "ids").crossJoin(F.broadcast(parts))
    # the queries of a block go to the shards that hold one of its terms
    asked = postings.select("shard", "part").distinct().join(weights, "part")
    units = rows(heads, 0).union(rows(postings, 1)).union(rows(asked, 2)).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind", "query", "term")

    def unit(rows: list[dict]) -> list[tuple]:
        length, ids = rows[0]["docs"], rows[0]["ids"]
        lists: dict[int, list] = {}
        asks: dict[int | None, list] = {}
        for r in rows[1:]:
            if r["kind"] == 1:
                lists.setdefault(r["term"], []).append((np.array(r["docs"], np.int64), np.array(r["tfs"], np.int64), r["most"], r["least"]))
            else:
                asks.setdefault(r["query"], []).append(r)
        for blocks_ in lists.values():
            blocks_.sort(key=lambda b: b[0][0])
        out = []
        for query, ask in asks.items():
            average = ask[0]["average"]

            def bound(tf: int, short: int, average: float = average) -> float:
                return tf * (K1 + 1) / (tf + K1 * (1 - B + B * short / average))

            cursors = [Cursor(i, a["weight"], lists[a["term"]], bound) for i, a in enumerate(ask) if a["term"] in lists]
            hits, scored = block_max_wand(cursors, length, ids, k, average)
            out += [(query, ids[number], score, scored) for score, number in hits]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def close() -> pa.RecordBatch:
            cols = list(zip(*unit(held))) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64()))],
                                              ["query", "doc_id", "score", "scored"])

        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["shard"], row["part"]) != (held[0]["shard"], held[0]["part"]):
                    yield close()
                    held = []
                held.append(row)
        if held:
            yield close()

    hits = units.mapInArrow(run, "query long, doc_id long, score double, scored long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "rank", "doc_id", "score", "scored")
