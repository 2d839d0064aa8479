"""Removal of repeated byte strings with a sparse suffix array, sorted deep-shallow.

A byte goes when it lies in a string of ``length`` bytes that starts anywhere
else too, in another document or the same one (Lee et al., "Deduplicating
training data", with every occurrence removed).

1. Anchors.  Every window of ``length`` bytes is represented by the smallest
   hash among its ``GRAM``-byte grams, leftmost on ties.  Equal windows have
   equal anchors at equal offsets, so only anchors need to meet, about one for
   each 77 bytes.  The windows of one anchor form a *run*: its text is the
   anchor's suffix and the bytes before it.
2. Anchors that occur once in the corpus drop out after a pre-aggregated count.
   Runs of equal text need one representative; an anchor with a single distinct
   run has all its windows repeated.
3. For the other anchors the representatives' suffixes are sorted, and so are
   the reversed texts before them: multikey sorting by 8-byte symbols to a
   shallow depth, then blind tries for the groups whose common prefix is longer.
   With the neighbours' common prefixes at hand, two windows at offset ``d``
   before the anchor are equal exactly when they share a class of depth
   ``length - d`` in the one order and of depth ``d`` in the other, so repeated
   windows are found without comparing pairs.
4. Repeated windows go back to the texts that hold the run and become spans.

Equal texts meet as one (128-bit hash) with their number; copies within a batch
are anchored once.  Texts travel once, by their hash.  Anchors, counts and spans
are shuffled by their keys and nothing is collected on the driver.

Cases: null is empty; texts under ``length`` bytes lose nothing; null ids,
repeated rows and further columns are kept as separate rows of the result (equal
rows repeat each other); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import mix, texts_of, written

LENGTH = 200
GRAM = 48
#: Bytes hashed in one numpy block; a longer text is cut, its pieces overlap by LENGTH - 1.
BLOCK = 1 << 18
#: Bytes compared by the multikey sort before blind tries take over.
SHALLOW = 64
#: Rows of whole groups sorted together.
CHUNK = 20_000

_POSITION = np.uint64((1 << 24) - 1)
RUNS = "h long, run long, t1 long, t2 long, at long, lo int, hi int, k long"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM = 32 + 16 bytes from each place on."""
    x = data.astype(np.uint64) + np.uint64(1)
    n, mult, sixteen = 1, np.uint64(0x9E3779B97F4A7C15), None
    while n < 32:
        x = x[:-n] * mult + x[n:]
        mult = mult * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
        x ^= x >> np.uint64(29)
        n *= 2
        if n == 16:
            sixteen = x
    return mix(x[:len(x) - 16] * mult + sixteen[32:])


def runs_of(data: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, anchor, first window, last window) of the runs in texts that end at ``stops``."""
    n_windows = len(data) - length + 1
    if n_windows <= 0:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    with np.errstate(over="ignore"):
        grams = gram_hashes(data)
    low = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    width, reach = length - GRAM + 1, 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[:n_windows], low[width - reach:][:n_windows])
    anchor = (low & _POSITION).astype(np.int64)
    window = np.arange(n_windows)
    end = stops[np.searchsorted(stops, window, side="right")]
    inside = window + length <= end
    first = inside.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    last = inside.copy()
    last[:-1] &= (anchor[1:] != anchor[:-1]) | ~inside[1:]
    p0, p1 = np.flatnonzero(first), np.flatnonzero(last)
    at = anchor[p0]
    return grams[at], at, p0, p1


def _blocks(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text index, offset, bytes) of about BLOCK bytes."""
    block, size = [], 0
    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        if len(t) > 4 * BLOCK:
            step = 4 * BLOCK
            for a in range(0, len(t) - length + 1, step):
                yield [(i, a, t[a:a + step + length - 1])]
            continue
        block.append((i, 0, t))
        size += len(t)
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def anchor_runs(docs: DataFrame, length: int) -> DataFrame:
    """One row per run of each text: anchor hash, hash of the run's text, the text's two-part
    hash, the anchor's place, the offsets of its windows before it (lo..hi), and how many
    equal texts of the batch the row stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            copies: dict[tuple[int, int], list] = {}
            for t1, t2, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (t1, t2) in copies:
                    copies[t1, t2][1] += 1
                else:
                    copies[t1, t2] = [t.as_buffer().to_pybytes(), 1]
            keys = np.array(list(copies), np.int64).reshape(-1, 2)
            number = np.array([k for _, k in copies.values()], np.int64)
            for block in _blocks([t for t, _ in copies.values()], length):
                stops = np.cumsum([len(t) for _, _, t in block])
                data = b"".join(t for _, _, t in block)
                h, at, p0, p1 = runs_of(np.frombuffer(data, np.uint8), stops, length)
                whole = [digest(data[a:b]) for a, b in zip(p0.tolist(), (p1 + length).tolist())]
                part = np.searchsorted(stops, p0, side="right")
                owner = np.array([i for i, _, _ in block])[part]
                shift = np.array([o for _, o, _ in block])[part] - (stops - [len(t) for _, _, t in block])[part]
                columns = (h.view(np.int64), np.array(whole, np.uint64).view(np.int64), keys[owner, 0], keys[owner, 1], at + shift,
                           (at - p1).astype(np.int32), (at - p0).astype(np.int32), number[owner])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in RUNS.split(", ")])

    return docs.select("t1", "t2", "text").mapInArrow(run, RUNS)


# --- deep-shallow sorting ----------------------------------------------------

class BlindTrie:
    """Patricia trie over byte strings: descends without looking at skipped bytes, then one
    comparison with the leaf found tells where the new string belongs."""

    def __init__(self, strings: list[bytes], width: int):
        self.strings, self.bits = strings, 8 * width
        self.numbers = [int.from_bytes(s.ljust(width, b"\0"), "big") for s in strings]
        self.root: list | tuple = [0]          # a list: leaf with the rows of one string; a tuple: (depth, children)
        for i in range(1, len(strings)):
            self.insert(i)

    def common(self, i: int, j: int) -> int:
        same = (self.bits - (self.numbers[i] ^ self.numbers[j]).bit_length()) // 8
        return min(same, len(self.strings[i]), len(self.strings[j]))

    def insert(self, i: int) -> None:
        s = self.strings[i]
        node = self.root
        while isinstance(node, tuple):
            depth, children = node
            node = children.get(s[depth] if depth < len(s) else -1) or next(iter(children.values()))
        leaf = node[0]
        n = self.common(i, leaf)
        parent, key, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < n:
            parent, key = node, s[node[0]]
            node = node[1][key]
        if isinstance(node, tuple) and node[0] == n:
            own = s[n] if n < len(s) else -1
            if own in node[1]:
                node[1][own].append(i)         # only the end of equal strings can meet here
            else:
                node[1][own] = [i]
            return
        other = self.strings[leaf]
        if n == len(s) == len(other):
            node.append(i)
            return
        split = (n, {(other[n] if n < len(other) else -1): node, (s[n] if n < len(s) else -1): [i]})
        if parent is None:
            self.root = split
        else:
            parent[1][key] = split

    def order(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node, list):
                out.extend(node)
            else:
                todo.extend(node[1][c] for c in sorted(node[1], reverse=True))
        return out


def deep_shallow(group: np.ndarray, strings: list[bytes], width: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``strings`` within their groups, and each one's common prefix with its predecessor
    (-1 at the start of a group)."""
    n = len(strings)
    wide = (width + 7) // 8 * 8
    padded = np.frombuffer(b"".join(s.ljust(wide, b"\0") for s in strings), np.uint8).reshape(n, wide)
    size = np.array([len(s) for s in strings])
    symbols = padded.view(">u8")
    order = np.argsort(group, kind="stable")
    segment = np.concatenate([[0], np.cumsum(np.diff(group[order]) != 0)]) if n else np.zeros(0, np.int64)
    start = segment.copy()

    def tied(seg: np.ndarray) -> np.ndarray:
        same = seg[1:] == seg[:-1]
        return np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(seg) else np.zeros(0, bool)

    for j in range(min(shallow, wide) // 8):
        open_ = np.flatnonzero(tied(segment))
        if not len(open_):
            break
        rows, seg = order[open_], segment[open_]
        symbol = symbols[rows, j]
        sub = np.lexsort((symbol, seg))
        order[open_] = rows[sub]
        symbol, seg = symbol[sub], seg[sub]
        new = np.concatenate([[0], (seg[1:] != seg[:-1]) | (symbol[1:] != symbol[:-1])])
        segment[open_] = open_[np.maximum.accumulate(np.where(new | (np.arange(len(new)) == 0), np.arange(len(new)), 0))] + n
        segment = np.unique(segment, return_inverse=True)[1] if len(segment) else segment
    open_ = np.flatnonzero(tied(segment))
    for rows_at in np.split(open_, np.flatnonzero(np.diff(segment[open_])) + 1) if len(open_) else []:
        rows = order[rows_at]
        order[rows_at] = rows[BlindTrie([strings[i] for i in rows], wide).order()]
    common = np.full(n, -1)
    if n > 1:
        differ = padded[order[1:]] != padded[order[:-1]]
        lcp = np.where(differ.any(1), differ.argmax(1), wide)
        lcp = np.minimum(lcp, np.minimum(size[order[1:]], size[order[:-1]]))
        common[1:] = np.where(start[1:] == start[:-1], lcp, -1)
    return order, common


def repeated_windows(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, number: np.ndarray, text: list[bytes], length: int) -> np.ndarray:
    """(rows, length) table: whether the window ``d`` bytes before the anchor occurs more than once."""
    m = len(h)
    after = [t[b:] for t, b in zip(text, hi.tolist())]
    before = [t[:b][::-1] for t, b in zip(text, hi.tolist())]
    classes = []
    for strings in (after, before):
        order, common = deep_shallow(h, strings, length)
        classes.append((order, common))
    out = np.zeros((m, length), bool)
    ranks = []
    for order, common in classes:
        place = np.empty(m, np.int64)
        place[order] = np.arange(m)
        ranks.append((place, common))
    for d in range(int(lo.min(initial=length)), int(hi.max(initial=-1)) + 1):
        rows = np.flatnonzero((lo <= d) & (d <= hi))
        if len(rows):
            key = np.zeros(len(rows), np.int64)
            for (place, common), depth in zip(ranks, (length - d, d)):
                key = key * m + np.cumsum(common < depth)[place[rows]] - 1
            _, place_of, = np.unique(key, return_inverse=True)
            out[rows, d] = np.bincount(place_of, number[rows])[place_of] > 1
    return out


def _ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of true values."""
    wide = np.zeros((flags.shape[0], flags.shape[1] + 2), np.int8)
    wide[:, 1:-1] = flags
    step = np.diff(wide, axis=1)
    row, first = np.nonzero(step == 1)
    return row, first, np.nonzero(step == -1)[1] - 1


def sort_groups(rows: DataFrame, length: int) -> DataFrame:
    """(h, run, first, last): repeated windows of runs whose anchor has several distinct runs."""

    def work(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        h, run, lo, hi, k = (t.column(c).to_numpy() for c in ("h", "run", "lo", "hi", "k"))
        row, first, last = _ranges(repeated_windows(h, lo, hi, k, t.column("window").to_pylist(), length))
        return pa.RecordBatch.from_arrays([pa.array(h[row]), pa.array(run[row]), pa.array(first.astype(np.int32)),
                                           pa.array(last.astype(np.int32))], ["h", "run", "first", "last"])

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            h = batch.column(0).to_numpy()
            if n >= CHUNK:                      # close before the last anchor's group begins
                cut = int(np.searchsorted(h != held[-1].column(0)[held[-1].num_rows - 1].as_py(), True))
                if cut < len(h):
                    yield work([*held, batch.slice(0, cut)])
                    held, n, batch = [], 0, batch.slice(cut)
            held.append(batch)
            n += batch.num_rows
        if held:
            yield work(held)

    return (rows.repartition("h").sortWithinPartitions("h").select("h", "run", "lo", "hi", "k", "window")
            .mapInArrow(run_, "h long, run long, first int, last int"))


def _cut(texts: DataFrame) -> DataFrame:
    """(t1, t2, n_bytes, n_removed, n_spans, kept, kept_sha256) of texts with their spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                data = batch.column(2)[i].as_buffer()
                data = data.to_pybytes()
                spans = batch.column(3)[i].as_py() or []
                kept, at, n_spans, end = [], 0, 0, -1
                for s in sorted(spans, key=lambda x: (x["s"], x["e"])):
                    if s["s"] > end:
                        kept.append(data[max(at, 0):s["s"]])
                        n_spans += 1
                        end = s["e"]
                    elif s["e"] > end:
                        end = s["e"]
                    at = end
                kept.append(data[at:])
                rest = b"".join(kept)
                out.append((len(data), len(data) - len(rest), n_spans, rest, hashlib.sha256(rest).hexdigest()))
            cols = list(zip(*out)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(cols, types))],
                                             ["t1", "t2", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return texts.select("t1", "t2", "text", "spans").mapInArrow(
        run, "t1 long, t2 long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def _texts_and_cuts(docs: DataFrame, length: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with their text's hash, and per text what is left of it."""
    if length < GRAM + 16:
        raise ValueError(f"length must be at least {GRAM + 16}")
    own = texts_of(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("t1"), F.xxhash64("text", F.lit(7)).alias("t2"), "text")
    runs = anchor_runs(own, length)
    shared = (runs.groupBy("h").agg(F.sum("k").alias("n"), F.min("run").alias("r0"), F.max("run").alias("r1"))
              .where("n > 1").select("h", (F.col("r0") != F.col("r1")).alias("mixed")))
    # written, so that the join meets two plain exchanges and a hot anchor's rows can be split
    found = written(runs.join(written(shared, "repeat-anchors"), "h"), "repeat-runs")
    # one text per hash; every later step takes it from the same exchange
    texts = own.groupBy("t1", "t2").agg(F.first("text").alias("text"))
    mixed = (found.where("mixed").groupBy("h", "run")
             .agg(F.sum("k").alias("k"), F.min(F.struct("t1", "t2", "at", "lo", "hi")).alias("r"))
             .select("h", "run", "k", "r.*"))
    windows = mixed.join(texts, ["t1", "t2"]).select(
        "h", "run", "lo", "hi", "k",
        F.expr(f"substring(cast(text as binary), cast(at - hi + 1 as int), hi - lo + {length})").alias("window"))
    sorted_ = sort_groups(windows, length)
    spans = (found.where("mixed").join(sorted_, ["h", "run"])
             .select("t1", "t2", (F.col("at") - F.col("last")).alias("s"), (F.col("at") - F.col("first") + length).alias("e"))
             .union(found.where("not mixed").select("t1", "t2", F.col("at") - F.col("hi"), F.col("at") - F.col("lo") + length)))
    spans = spans.groupBy("t1", "t2").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    return own, _cut(texts.join(spans, ["t1", "t2"], "left"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, t1, t2, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256."""
    own, cut = _texts_and_cuts(docs, length, id_col, text_col)
    return own.select("doc_id", "t1", "t2").join(cut, ["t1", "t2"])


def cut_texts(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    """(t1, t2, text): per distinct text (by its two-part hash) what is left of it as a string;
    bytes of characters that were cut in half are left out."""
    _, cut = _texts_and_cuts(docs, length, docs.columns[0], text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [k.decode("utf-8", "ignore") for k in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["t1", "t2", "text"])

    return cut.select("t1", "t2", "kept").mapInArrow(run, "t1 long, t2 long, text string")
