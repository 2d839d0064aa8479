"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct shingles (``words`` words, A-Z lower-cased).
Two documents link when ``100 * intersection >= percent * union``.

1. Equal sets meet as one (64-bit set hash).
2. Size bands.  Linked sets ``a <= b`` have ``100 * a >= percent * b``, so a set
   joins the sets of its own band, and those of the next one if it is large enough.
3. Parity sketch.  Within a band a linked pair's symmetric difference is at most
   ``t``.  The shingles of a set are dealt by hash over ``T > t`` parts of a bit
   sketch; each shingle flips one bit, so the sketches' Hamming distance is at
   most ``t`` and at least ``T - t`` parts are equal (pigeonhole).  The bits of a
   part are so many that its parity vector is kept as the XOR of 64-bit codes.
   Parts that many sets share (none but common shingles, or no shingle) would
   bring together sets that have no more than a passage in common.  So all parts
   have an order, the commonest first; a set whose partners differ from it in ``d``
   parts at most leaves out its ``T - 1 - d`` first ones.  The last one that two
   linked sets share has as many shared ones before it, so both keep it.  What
   counts as common is read from all texts beforehand; it decides what is left
   out, never what links.
4. Sets that share a part first meet the smallest one of theirs.  Then members of
   different classes within a part are compared, in rounds that let through a few
   pairs of each set, then more, at last all, and merge the classes that link in
   between: what is linked already needs no test.  Each time a parity sketch of at least as many bits as the
   set has shingles, whose Hamming distance bounds the symmetric difference from
   below, rules pairs out (the longer of two is folded to the length of the other),
   and the others are verified on whole sets.  Pairs inside a class need no test, so a group of copies
   costs one row each.
5. Connected components of the verified links.

Nothing grows with the square of a group: a part's members are listed once, a
hub's partners are dealt over several tasks, and large mixed parts are compared
block by block.  Intermediate tables go to the shared folder.

Cases: null and empty texts have the empty set and link with nothing (their
component is their own id); a text with fewer words is one shingle of all of
them; rows without an id take part, and a component's id is its smallest id that
is not null; repeated rows and further columns are fine; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import Words, components, mix, texts_of, written

#: Least bits of the sketch that is compared before whole sets are.
SKETCH = 512
#: Members of a hub, or of a mixed part, that one task compares at a time.
BLOCK = 4096
#: Pairs whose sketches are compared at a time, word by word: few, so that they stay in the cache.
PAIRS = 1 << 13
#: Sets that a task remembers, so that their copies do not give their parts again.
SEEN = 100_000
#: Shingles that a task counts at a time; those of one set alone are not told.
COUNTED = 1 << 20
#: Common shingles that tasks know, at most.
COMMON = 1 << 15
#: Parts a class is dealt into when its sets get their smallest id.
SALTS = 16
#: Pairs of a set that a chunk of parts lets through, round by round; the last round knows no bound.
ROUNDS = (2, None)
_M = [np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF | 1) for k in range(16)]


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, code) of the distinct shingles of each text, ascending."""
    w = Words(texts)
    n = len(texts)
    per = np.bincount(w.doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(per)[:-1]]) if n else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        codes, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(w.code) >= words:
            run = np.zeros(len(w.code) - words + 1, np.uint64)
            for k in range(words):
                run += mix(w.code[k:len(run) + k] ^ _M[k]) * _M[k]
            ok = w.doc[words - 1:] == w.doc[:len(run)]
            codes, owner = mix(run)[ok], w.doc[:len(run)][ok]
        short = np.flatnonzero((per > 0) & (per < words))
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for k in range(words - 1):
                has = per[short] > k
                whole[has] += mix(w.code[first[short[has]] + k] ^ _M[k]) * _M[k]
            codes = np.concatenate([codes, mix(whole + per[short].astype(np.uint64))])
            owner = np.concatenate([owner, short])
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], codes[new]


class Bands:
    """Size bands, and for each the number of parts and the slack, for one threshold."""

    def __init__(self, percent: int, largest: int, spread: int = 2):
        self.percent = percent
        bounds = [1]
        while bounds[-1] <= largest + 1:
            b = bounds[-1]
            for _ in range(spread):
                b = b * 100 // percent + 1
            bounds.append(b)
        self.low = np.array(bounds)
        widest = 2 * (self.low[1:] - 1)
        self.t = widest * (100 - percent) // (100 + percent)
        self.slack = (self.t + 1) // 2
        self.parts = self.t + 1 + self.slack

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, size, side="right") - 1

    def joins_next(self, size: np.ndarray) -> np.ndarray:
        return 100 * size >= self.percent * self.low[self.of(size) + 1]

    def apart(self, size: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Largest symmetric difference of a set and one that it links with in the band ``level``."""
        partner = np.minimum(size * 100 // self.percent, self.low[level + 1] - 1)
        return np.minimum((size + partner) * (100 - self.percent) // (100 + self.percent), self.t[level])


class Common:
    """How many sets hold a shingle, of the common ones."""

    def __init__(self, codes: np.ndarray, times: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.times = codes[order], times[order]
        self.some = np.zeros(1 << 20, bool)
        self.some[codes >> np.uint64(44)] = True

    def of(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes), np.int64)
        if len(self.codes):
            at = np.flatnonzero(self.some[codes >> np.uint64(44)])     # few go on to the search
            place = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
            out[at] = np.where(self.codes[place] == codes[at], self.times[place], 0)
        return out


def part_keys(owner: np.ndarray, codes: np.ndarray, size: np.ndarray, bands: Bands, common: Common | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(set index, key) of the parts that each set offers in its band and, if it joins it, the next.
    ``codes`` ascend within a set, so the shingles of a part are neighbours."""
    keys, sets = [], []
    band = bands.of(size)
    times = np.zeros(len(codes), np.int64) if common is None else common.of(codes)
    # a part without shingles is known by its number alone
    for step in (0, 1):
        use = (size > 0) if step == 0 else (size > 0) & bands.joins_next(size)
        rows = use[owner]
        o, c = owner[rows], codes[rows]
        if not len(o):
            continue
        level = band + step
        total = bands.parts[level].astype(np.uint64)
        part = ((c >> np.uint64(32)) * total[o]) >> np.uint64(32)
        new = np.ones(len(o), bool)
        new[1:] = (o[1:] != o[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(new)
        o, part = o[at], part[at].astype(np.int64)
        held = np.diff(np.concatenate([at, [len(c)]]))
        with np.errstate(over="ignore"):
            xor = np.bitwise_xor.reduceat(mix(c ^ np.uint64(0xA5A5A5A5)), at)
            name = lambda lv, p: mix((lv.astype(np.uint64) << np.uint64(40)) + p.astype(np.uint64) + np.uint64(1))
            key = mix(xor ^ name(level[o], part))
        # the order: parts without a shingle by number, then by the rarest shingle's sets, those of one shingle, by key
        filled = np.bincount(o, minlength=len(size))
        out = np.where(use, bands.parts[level] - 1 - bands.apart(size, level), 0)
        empty = np.where(use, bands.parts[level] - filled, 0)
        first = np.minimum(np.minimum.reduceat(times[rows], at), (1 << 23) - 1).astype(np.uint64) << np.uint64(41)
        first |= (held == 1).astype(np.uint64) << np.uint64(40) | key >> np.uint64(24)
        order = np.lexsort((~first, o))
        rank = np.arange(len(o)) - (np.cumsum(filled) - filled)[o]
        keep = order[rank >= (out - empty)[o]]
        keys.append(key[keep])
        sets.append(o[keep])
        for s in np.flatnonzero(empty > out):       # few sets
            rest = np.setdiff1d(np.arange(bands.parts[level[s]]), part[o == s])[out[s]:]
            keys.append(mix(name(np.full(len(rest), level[s]), rest)))
            sets.append(np.full(len(rest), s))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(sets), np.concatenate(keys)


def set_hash(owner: np.ndarray, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and size of each of ``n`` sets."""
    size = np.bincount(owner, minlength=n)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        if len(owner):
            at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            out[owner[at]] = np.add.reduceat(mix(codes + np.uint64(9)), at)
        return mix(out + size.astype(np.uint64)).view(np.int64), size


def sketches(owner: np.ndarray, codes: np.ndarray, size: np.ndarray) -> pa.ListArray:
    """Parity sketch of each set: a power of two of bits, SKETCH at least and not fewer than shingles, as 64-bit numbers."""
    bits = np.maximum(SKETCH, 2 ** np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    stop = np.cumsum(bits)
    place = (stop - bits)[owner] + (codes & (bits - 1).astype(np.uint64)[owner]).astype(np.int64)
    odd = np.bincount(place, minlength=int(stop[-1]) if len(stop) else 0) & 1
    words = np.packbits(odd.astype(bool)).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stop // 64]).astype(np.int32)), pa.array(words))


def _pieces(sizes: list[int], most: int = 500_000) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``most`` bytes."""
    at = 0
    while at < len(sizes):
        to, total = at, 0
        while to < len(sizes) and (to == at or total + sizes[to] <= most):
            total += sizes[to]
            to += 1
        yield at, to
        at = to


SIGNED = "key long, node long, doc_id long, text_hash long, n_shingles long, sketch array<long>"


def _common(own: DataFrame, words: int) -> Common:
    """The commonest shingles, at most COMMON, by how many sets hold them.  Tasks count what they read,
    some COUNTED shingles at a time, and tell those that two sets of them hold."""

    def told(held: list[np.ndarray]) -> pa.RecordBatch:
        codes, times = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(codes[times > 1].view(np.int64)), pa.array(times[times > 1])], ["code", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, done = [], 0, set()
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
            for a, b in _pieces([len(t) for t in texts]):
                owner, codes = shingle_sets(texts[a:b], words)
                node, _ = set_hash(owner, codes, b - a)
                fresh = np.array([not (s in done or done.add(s)) for s in node.tolist()], bool)
                held.append(codes[fresh[owner]])
                n += len(held[-1])
                if n >= COUNTED or len(done) > SEEN:
                    yield told(held)
                    held, n, done = [], 0, set()
        if held:
            yield told(held)

    counts = own.select("text").mapInArrow(run, "code long, times long").groupBy("code").agg(F.sum("times").alias("times"))
    counts = written(counts, "shingle-common")
    total, least = 0, 62
    for power, n in sorted(counts.groupBy(F.floor(F.log2("times")).alias("power")).count().collect(), reverse=True):
        total += n
        if total > COMMON:
            break
        least = power
    found = np.array([tuple(r) for r in counts.where(F.col("times") >= F.lit(2 ** least)).collect()], np.int64).reshape(-1, 2)
    return Common(found[:, 0].copy().view(np.uint64), found[:, 1])


def _signed(own: DataFrame, words: int, percent: int, common: Common | None = None) -> DataFrame:
    """Two kinds of rows from one pass: per document (text_hash not null) its set's hash and size,
    under a key of its own; per part of a set a key that equal parts share.  Equal sets of a
    task give their parts once (the last SEEN of them are known)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent, 1 << 16)
        names = [c.split()[0] for c in SIGNED.split(", ")]
        done: set[int] = set()
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
            ids, hashes = batch.column("doc_id"), batch.column("text_hash")
            for a, b in _pieces([len(t) for t in texts]):
                owner, codes = shingle_sets(texts[a:b], words)
                node, size = set_hash(owner, codes, b - a)
                if size.max(initial=0) >= bands.low[-2]:
                    bands = Bands(percent, int(size.max()) * 4)
                own_key = mix(np.arange(b - a, dtype=np.uint64) + np.uint64(hash((a, batch.num_rows)) & 0xFFFFFFFF) + node.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own_key.view(np.int64)), pa.array(node), ids.slice(a, b - a), hashes.slice(a, b - a),
                     pa.array(size.astype(np.int64)), sketches(owner, codes, size)], names)
                if len(done) > SEEN:
                    done.clear()
                fresh = np.array([not (s in done or done.add(s)) for s in node.tolist()], bool)
                sets, keys = part_keys(owner, codes, np.where(fresh, size, 0), bands, common)
                n = len(keys)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(node[sets]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                                                  pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))], names)

    return own.select("doc_id", "text_hash", "text").mapInArrow(run, SIGNED)


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, codes) of the texts' sets; codes ascend, 8 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
            for a, b in _pieces([len(t) for t in texts]):
                owner, codes = shingle_sets(texts[a:b], words)
                node, size = set_hash(owner, codes, b - a)
                held = [codes[e - n:e].tobytes() for e, n in zip(np.cumsum(size), size)]
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(held, pa.binary())], ["node", "codes"])

    return texts.select("text").mapInArrow(run, "node long, codes binary")


def _pick(doc_id: str = "doc_id"):
    """The id of a row as a key; rows without one share a key of their own."""
    return F.coalesce(F.col(doc_id), F.lit(-(1 << 63)))


def _verified(edges: DataFrame, nodes: DataFrame, own: DataFrame, words: int, percent: int) -> DataFrame:
    """The edges (a, b) whose sets reach the threshold; writes them.  Sets are made anew from one
    text of each node in ``edges``.  All partners ``a`` of a hub ``b`` come with their sets, the
    hub's own set comes once per block of partners and is all that is held."""
    chosen = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().join(nodes, "node").select("text_hash", "pick")
    # by hash and id: of a group of copies one row is looked for, and the group's rows are dealt by their ids
    texts = own.select("text_hash", _pick().alias("pick"), "text").join(chosen, ["text_hash", "pick"]).groupBy("text_hash").agg(F.first("text").alias("text"))
    whole = written(_sets(texts, words), "shingle-sets")
    blocks = edges.groupBy("b").agg(F.count("*").alias("partners")).select(
        "b", F.ceil(F.col("partners") / BLOCK).cast("int").alias("blocks"))
    members = (edges.join(blocks, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("block"))
               .join(whole.withColumnRenamed("node", "a"), "a").select("b", "block", "a", "codes"))
    hubs = (blocks.join(whole.withColumnRenamed("node", "b"), "b")
            .select("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("long").alias("a"), "codes"))
    rows = (hubs.union(members).repartition("b", "block")
            .sortWithinPartitions("b", "block", F.col("a").asc_nulls_first()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = None
        for batch in batches:
            out_a, out_b = [], []
            for b, a, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = np.frombuffer(codes.as_buffer(), "<u8")
                if a is None:
                    hub = own.copy()
                    continue
                at = np.searchsorted(hub, own)
                both = int((hub[np.minimum(at, len(hub) - 1)] == own).sum())
                if 100 * both >= percent * (len(hub) + len(own) - both):
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return written(rows.select("b", "a", "codes").mapInArrow(run, "a long, b long"), "shingle-links")


def _alike(percent: int) -> str:
    """SQL condition on sizes and sketches (n_a, sketch_a, n_b, sketch_b) that every linked pair meets.
    Sizes that pass the first part differ by less than a factor of two, so one fold is enough."""

    def even(c: str, other: str) -> str:
        half = f"size({c}) div 2"
        return (f"case when size({c}) > size({other}) then zip_with(slice({c}, 1, {half}), slice({c}, {half} + 1, {half}), (p, q) -> p ^ q) else {c} end")

    apart = (f"aggregate(zip_with({even('sketch_a', 'sketch_b')}, {even('sketch_b', 'sketch_a')}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")
    return (f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b) "
            f"and {apart} * {100 + percent} <= (n_a + n_b) * {100 - percent}")


def _unlinked_pairs(members: DataFrame, percent: int, most: int | None) -> DataFrame:
    """Pairs (a, b) of different classes within a part that their sketches do not rule out; of each
    node at most ``most`` from one chunk of parts (None: all), chosen by a hash, and then also the
    keys of the parts that had more.
    ``members``: key, side_a, side_b, own, node, class, n, sketch; rows of one (key, side_a, side_b)
    are one block (side_a = side_b), or two blocks to be compared with each other."""

    def pairs(x: np.ndarray, y: np.ndarray, c: dict) -> np.ndarray:
        """Of the row pairs (x, y) those that may link, as nodes."""
        ok = c["class"][x] != c["class"][y]
        x, y = x[ok], y[ok]
        n_x, n_y = c["n"][x], c["n"][y]
        ok = 100 * np.minimum(n_x, n_y) >= percent * np.maximum(n_x, n_y)
        x, y = x[ok], y[ok]
        most_apart = (n_x[ok] + n_y[ok]) * (100 - percent) // (100 + percent)
        ok = np.zeros(len(x), bool)
        words = np.minimum(c["words"][x], c["words"][y])
        for w, (place, columns) in c["folded"].items():
            same = np.flatnonzero(words == w)
            for k in range(0, len(same), PAIRS):
                p = same[k:k + PAIRS]
                at_x, at_y, left, apart = place[x[p]], place[y[p]], most_apart[p], np.zeros(len(p), np.int64)
                # half of the words rules most pairs out, of sparse sketches a quarter does
                for words_from, words_to in ((0, w // 4), (w // 4, w // 2), (w // 2, w)):
                    for column in columns[words_from:words_to]:
                        apart += np.bitwise_count(column[at_x] ^ column[at_y])
                    stay = apart <= left
                    p, at_x, at_y, left, apart = p[stay], at_x[stay], at_y[stay], left[stay], apart[stay]
                ok[p] = True
        x, y = x[ok], y[ok]
        return np.stack([np.maximum(c["node"][x], c["node"][y]), np.minimum(c["node"][x], c["node"][y]), c["key"][x]], 1)

    def few(found: np.ndarray) -> np.ndarray:
        """Which pairs are among the first ``most`` of their larger node, by a hash."""
        with np.errstate(over="ignore"):
            deal = mix(mix(found[:, 0].view(np.uint64)) + found[:, 1].view(np.uint64))
        order = np.lexsort((deal, found[:, 0]))
        node = found[order, 0]
        new = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        out = np.zeros(len(found), bool)
        out[order] = np.arange(len(order)) - np.repeat(new, np.diff(np.concatenate([new, [len(order)]]))) < most
        return out

    def folded(c: dict) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By number of words: each row's place among the sketches of as many or, folded, of twice as
        many words, and those sketches word by word."""
        out = {}
        for w in np.unique(c["words"]).tolist():
            own, twice = np.flatnonzero(c["words"] == w), np.flatnonzero(c["words"] == 2 * w)
            place = np.full(len(c["words"]), -1, np.int64)
            place[np.concatenate([own, twice])] = np.arange(len(own) + len(twice))
            columns = np.empty((w, len(own) + len(twice)), np.uint64)
            at, long = c["first"][own], c["first"][twice]
            for k in range(w):
                columns[k, :len(own)] = c["sketch"][at + k]
                columns[k, len(own):] = c["sketch"][long + k] ^ c["sketch"][long + k + w]
            out[w] = place, columns
        return out

    def close(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        g = [t.column(k).to_numpy() for k in ("key", "side_a", "side_b")]
        c = {k: t.column(k).to_numpy() for k in ("key", "own", "node", "class", "n")}
        lists = t.column("sketch").combine_chunks()
        c["sketch"], c["words"] = lists.flatten().to_numpy().view(np.uint64), pa.compute.list_value_length(lists).to_numpy().astype(np.int64)
        c["first"] = np.cumsum(c["words"]) - c["words"]
        c["folded"] = folded(c)
        cut = np.flatnonzero(np.concatenate([[True], np.any([x[1:] != x[:-1] for x in g], axis=0), [True]]))
        start, size = cut[:-1], np.diff(cut)
        out = [np.zeros((0, 3), np.int64)]
        for s in np.unique(size[(size > 1) & (size <= 64)]):       # small groups: all of one size at once
            i, j = np.triu_indices(s, 1)
            at = start[size == s]
            x, y = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
            one = (g[1][x] == g[2][x]) | (c["own"][x] != c["own"][y])
            out.append(pairs(x[one], y[one], c))
        for at, s in zip(start[size > 64], size[size > 64]):
            rows, same = at + np.argsort(c["class"][at:at + s], kind="stable"), g[1][at] == g[2][at]
            x, y = (rows, rows) if same else (rows[c["own"][rows] == g[1][at]], rows[c["own"][rows] == g[2][at]])
            first, last = (np.searchsorted(c["class"][y], c["class"][x], side) for side in ("left", "right"))
            step = max(1, 4 * PAIRS // s)
            for k in range(0, len(x), step):
                some = np.arange(k, min(k + step, len(x)))
                # a class stands together: its rows are not paired with each other
                other = np.arange(last[k], len(y)) if same else np.concatenate([np.arange(first[k]), np.arange(last[k] if first[k] == first[some[-1]] else first[k], len(y))])
                a, b = np.repeat(some, len(other)), np.tile(other, len(some))
                if same:
                    a, b = a[a < b], b[a < b]
                out.append(pairs(x[a], y[b], c))
        found = np.concatenate(out)
        both, place = np.unique(found[:, :2], axis=0, return_inverse=True)
        kept = few(both) if most is not None and len(both) else np.ones(len(both), bool)
        again = np.unique(found[~kept[place.ravel()], 2])               # parts that have more to say
        names, none = ["a", "b", "key"], pa.nulls
        yield pa.RecordBatch.from_arrays([pa.array(both[kept, 0]), pa.array(both[kept, 1]), none(int(kept.sum()), pa.int64())], names)
        yield pa.RecordBatch.from_arrays([none(len(again), pa.int64()), none(len(again), pa.int64()), pa.array(again)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            mark = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
            if n >= 2 * BLOCK:
                other = np.flatnonzero((mark != last).any(1))
                if len(other):
                    yield from close([*held, batch.slice(0, int(other[0]))])
                    held, n, batch, mark = [], 0, batch.slice(int(other[0])), mark[other[0]:]
            held.append(batch)
            n += batch.num_rows
            last = mark[-1]
        if held:
            yield from close(held)

    return (members.repartition("key", "side_a", "side_b").sortWithinPartitions("key", "side_a", "side_b")
            .select("key", "side_a", "side_b", "own", "node", "class", "n", "sketch").mapInArrow(run, "a long, b long, key long").distinct())


def link(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, node (hash of its set), n_shingles, component_id
    (smallest id of its class), class (smallest set of its class; rows of one id may be in several)."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    own = texts_of(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    signed = _signed(own, words, percent, _common(own, words))
    by_key = signed.withColumn("m", F.expr("min(node) over (partition by key)"))
    kept = written(by_key.where("sketch is not null or node <> m"), "shingle-parts")
    rows = kept.where("sketch is not null").select("doc_id", "text_hash", "node", "n_shingles", "sketch")
    parts = kept.where("sketch is null").select("key", "node", "m").distinct()
    nodes = rows.groupBy("node").agg(F.min(F.struct("text_hash", _pick().alias("pick"))).alias("one"), F.min("n_shingles").alias("n"),
                                     F.min("sketch").alias("sketch"))
    nodes = written(nodes.select("node", "one.text_hash", "one.pick", "n", "sketch"), "shingle-nodes")
    seen = [nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab"]

    def meet(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
        """The pairs (a, b) that may link by size and sketch and have not been tried."""
        out = pairs.join(seen[0], "a").join(seen[1], "b").where(_alike(percent)).select("a", "b")
        return written(out if tried is None else out.join(tried, ["a", "b"], "left_anti"), "shingle-tried")

    star = parts.groupBy("node").agg(F.min("m").alias("b")).select(F.col("node").alias("a"), "b")
    tried = meet(star, None)
    links = _verified(tried, nodes, own, words, percent)
    classes = components(links, "shingle-classes")

    # parts whose members are in different classes
    members = parts.select("key", "node").union(parts.select("key", F.col("m").alias("node"))).distinct()
    for most in ROUNDS:
        listed = members.join(classes, "node", "left").select("key", "node", F.coalesce("component", "node").alias("class"))
        mixed = (listed.groupBy("key").agg(F.min("class").alias("c0"), F.max("class").alias("c1"), F.count("*").alias("members"))
                 .where("c0 <> c1").select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")))
        listed = written(listed.join(mixed, "key"), "shingle-members")
        blocks = (listed.join(nodes, "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                  .select("key", F.least("own", "other").alias("side_a"), F.greatest("own", "other").alias("side_b"),
                          "own", "node", "class", "n", "sketch"))
        out = written(_unlinked_pairs(blocks, percent, most), "shingle-pairs")
        now = out.where("a is not null").select("a", "b").join(tried, ["a", "b"], "left_anti")
        more = _verified(now, nodes, own, words, percent)
        tried, links = tried.union(now), links.union(more)
        # a part that has told all its pairs is done
        members = listed.join(out.where("key is not null").select("key"), "key", "left_semi").select("key", "node")
        classes = components(links, "shingle-classes")

    # a row per set and class before the documents' rows come in; a class of very many sets is dealt by salt
    low = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("low"))
    linked = written(classes.join(low, "node").select("node", F.col("component").alias("class"), "low",
                                                      F.pmod(F.xxhash64("node"), F.lit(SALTS)).alias("salt")), "shingle-linked")
    lowest = (linked.groupBy("class").agg(F.min("low").alias("lowest"))
              .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))))
    named = linked.join(lowest, ["class", "salt"]).select("node", "class", "lowest")
    single = low.join(classes, "node", "left_anti").select("node", F.col("node").alias("class"), F.col("low").alias("lowest"))
    return (rows.join(named.union(single), "node", "left")
            .select("doc_id", "text_hash", "node", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("lowest")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce("class", "node").alias("class")))
