"""Embedding near-duplicates: subspace pigeonhole join for cosine similarity.

Vectors are scaled to length 1, so a cosine of at least ``c`` is a squared distance
of at most ``2 - 2c``, and turned by a random rotation that spreads it evenly.
The rotated vector is split into blocks and each block gets its proportional
share of the squared distance: a linked pair meets the share in at least one
block (pigeonhole).  Each block is range-joined on its own: a grid along its first
coordinate, with cells as wide as the block's radius, leaves neighbouring cells to
be compared; large cells are dealt into chunks, and chunk pairs are the units of
work.  A unit rules pairs out by the block's distance, verifies the others on
the whole vectors in double precision, and counts a link only in the first block
that finds it.  Units return counts and a spanning forest, not pairs, so a group
of thousands of alike vectors costs a row each, not its square.

Equal vectors meet as one, with their number.  Components come from the forests.

For vectors spread evenly in many dimensions no exact range join leaves out much:
the units' arithmetic then grows with the square of the number of vectors (in
matrix products); clustered vectors fall into few neighbouring cells.

Cases: a vector that is null, empty, all zero, or holds null or non-finite numbers
links with nothing and is its own component; vectors of different lengths never
link; null ids take part (a component's id is its smallest id that is not null);
repeated rows and further columns are fine; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import components, written

BLOCKS = 4
#: Vectors of one chunk; two chunks are one unit of work.
CHUNK = 16_384


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def split(dim: int, blocks: int) -> list[slice]:
    edges = np.linspace(0, dim, min(blocks, dim) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def shares(dim: int, blocks: int, budget: float) -> list[float]:
    return [budget * (s.stop - s.start) / dim for s in split(dim, blocks)]


def _placed(reps: DataFrame, budget: float, blocks: int) -> DataFrame:
    """(rep, weight, dim, block, cell, point): the rotated unit vector once per block, with its cell there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rep", "weight", "dim", "block", "cell", "point"]
        for batch in batches:
            rep, weight, values = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            dims = pa.compute.list_value_length(values).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = np.stack([values[int(i)].values.to_numpy() for i in rows]).astype(np.float64)
                x /= np.abs(x).max(1, keepdims=True)               # no overflow in the norm
                x /= np.sqrt((x * x).sum(1, keepdims=True))
                x = x @ rotation(int(dim))
                points = [p.tobytes() for p in x]
                for b, (s, share) in enumerate(zip(split(int(dim), blocks), shares(int(dim), blocks, budget))):
                    cell = np.floor(x[:, s.start] / (np.sqrt(share) * (1 + 1e-9))).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rep[rows]), pa.array(weight[rows]), pa.array(np.full(len(rows), dim, np.int32)), pa.array(np.full(len(rows), b, np.int32)),
                         pa.array(cell), pa.array(points, pa.binary())], names)

    return reps.select("rep", "weight", "vector").mapInArrow(run, "rep long, weight long, dim int, block int, cell long, point binary")


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each of ``n`` rows by the pairs (i, j)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _compare(units: DataFrame, cosine: float, blocks: int) -> DataFrame:
    """(rep, links, low): links found in a unit of work, and the smallest row they lead to."""
    budget = 2 - 2 * cosine

    def unit(t: pa.Table) -> pa.RecordBatch:
        dim, block = t.column("dim")[0].as_py(), t.column("block")[0].as_py()
        rep, weight, side = (t.column(c).to_numpy() for c in ("rep", "weight", "side"))
        x = np.frombuffer(b"".join(t.column("point").to_pylist()), np.float64).reshape(len(rep), dim)
        parts, limits = split(dim, blocks), shares(dim, blocks, budget)
        left, right = (np.flatnonzero(side != 2), np.flatnonzero(side != 1))   # side 0: a chunk with itself
        own = x[:, parts[block]].astype(np.float32)
        norm, one = (own * own).sum(1, keepdims=True), np.ones((len(rep), 1), np.float32)
        # one product gives the squared distances: |a|^2 * 1 + 1 * |b|^2 - 2 ab
        near, far = np.hstack([own, norm, one])[left], np.ascontiguousarray(np.hstack([-2 * own, one, norm])[right].T)
        links, pi, pj = np.zeros(len(rep), np.int64), [], []
        for at in range(0, len(left), 256):
            d = (near[at:at + 256] @ far).ravel()
            u, v = np.divmod(np.flatnonzero(d <= np.float32(limits[block] + 1e-5)), len(right))    # rounding in single precision
            i, j = left[at + u], right[v]
            if side[0] == 0:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 100_000):
                p, q = i[k:k + 100_000], j[k:k + 100_000]
                ok = np.einsum("ij,ij->i", x[p], x[q]) >= cosine
                p, q = p[ok], q[ok]
                gap = (x[p] - x[q]) ** 2
                first = np.full(len(p), blocks)
                for b in reversed(range(len(parts))):
                    first[gap[:, parts[b]].sum(1) <= limits[b]] = b
                p, q = p[first == block], q[first == block]
                links += np.bincount(p, weight[q], len(rep)).astype(np.int64) + np.bincount(q, weight[p], len(rep)).astype(np.int64)
                pi.append(p)
                pj.append(q)
        low = _forest(len(rep), np.concatenate([np.zeros(0, int), *pi]), np.concatenate([np.zeros(0, int), *pj]))
        found = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(rep[found]), pa.array(links[found]), pa.array(rep[low[found]])], ["rep", "links", "low"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            marks = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(marks[1:] != marks[:-1]) + 1).tolist(), len(marks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and marks[a] != last:
                    yield unit(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = marks[a]
        if held:
            yield unit(pa.Table.from_batches(held))

    return (units.repartition("unit").sortWithinPartitions("unit")
            .select("unit", "side", "rep", "weight", "dim", "block", "point").mapInArrow(run, "rep long, links long, low long"))


def link(vectors: DataFrame, cosine: float = 0.9, blocks: int = BLOCKS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept."""
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    own = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector"))
    fine = ("size(vector) > 0 and forall(vector, v -> v is not null and not isnan(v) and abs(v) < double('infinity')) "
            "and exists(vector, v -> v <> 0)")
    # equal vectors (0.0 and -0.0 alike) are one
    own = own.withColumn("vector", F.when(F.expr(fine), F.transform("vector", lambda v: v + F.lit(0.0))))
    mark = [F.xxhash64("vector").alias("h1"), F.xxhash64("vector", F.lit(7)).alias("h2")]
    rows = own.select("vec_id", F.col("vector").isNotNull().alias("fine"), *mark)
    reps = written(own.where("vector is not null").select("vector", *mark).groupBy("h1", "h2")
                   .agg(F.first("vector").alias("vector"), F.count("*").alias("weight"))
                   .withColumn("rep", F.monotonically_increasing_id()), "vector-reps")
    placed = written(_placed(reps, 2 - 2 * cosine, blocks), "vector-cells")
    cells = placed.groupBy("dim", "block", "cell").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    ahead = cells.select("dim", "block", (F.col("cell") - 1).alias("cell"), F.col("chunks").alias("ahead"))
    behind = cells.select("dim", "block", (F.col("cell") + 1).alias("cell"), F.col("chunks").alias("behind"))
    keys = ["dim", "block", "cell"]
    cells = written(cells.join(ahead, keys, "left").join(behind, keys, "left"), "vector-grid")
    chunk = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    none = "cast(array() as array<struct<cell:bigint,a:int,b:int,kind:int,side:int>>)"
    # a chunk meets itself, the later chunks of its cell, and all chunks of the next cell
    meets = F.expr(f"""concat(
        transform(sequence(0, chunks - 1), c -> named_struct('cell', cell, 'a', least(c, chunk), 'b', greatest(c, chunk), 'kind', 0,
                  'side', case when c = chunk then 0 when chunk < c then 1 else 2 end)),
        case when ahead is null then {none} else transform(sequence(0, ahead - 1), c -> named_struct('cell', cell, 'a', chunk, 'b', c, 'kind', 1, 'side', 1)) end,
        case when behind is null then {none} else transform(sequence(0, behind - 1), c -> named_struct('cell', cell - 1, 'a', c, 'b', chunk, 'kind', 1, 'side', 2)) end)""")
    units = (placed.join(cells, keys).withColumn("chunk", chunk).withColumn("m", F.explode(meets))
             .select(F.xxhash64("dim", "block", "m.cell", "m.a", "m.b", "m.kind").alias("unit"), "m.side", "rep", "weight", "dim", "block", "point"))
    found = written(_compare(units, cosine, blocks), "vector-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")), "vector-classes")
    known = (reps.select("h1", "h2", "rep", "weight").join(counts, "rep", "left").join(classes.withColumnRenamed("node", "rep"), "rep", "left")
             .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("class")))
    named = rows.where("fine").join(known, ["h1", "h2"])
    lowest = named.groupBy("class").agg(F.min("vec_id").alias("component_id"))
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (named.join(lowest, "class").select("vec_id", "n_links", "component_id").union(alone)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
