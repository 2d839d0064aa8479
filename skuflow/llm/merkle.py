"""Merkle manifest of a table: a persistent tree, versions by path copying.

Every row is a leaf; the leaves of a group (a language) in id order are the lowest
level of its tree, whose root is the group's subroot; the subroots in group order are
the leaves of one more tree, whose root stands for the table.  A node is the hash of
its two children, or of the one child that the last run of a level has left.

Leaves get their place from one range shuffle: ids inside a task's range count up, and
the tasks' counts, summed, give each range its first place.  Aligned blocks of
``2 ** BLOCK_LEVELS`` leaves are complete subtrees, so each is built by a task of its own; the
blocks' roots are the leaves of the next level of blocks, until one root is left.
Then paths come down: every block learns the siblings from its root up to the table's.

A block keeps its nodes in a :class:`Store`, which never changes a node.  A tampered
leaf makes a new version of the block: copies of the leaf's ancestors, all other nodes
shared.  The version goes on above its block: it copies the ancestors along the
block's own path, in the block's task, so versions are never brought together.

Cases: null fields are marked apart from empty ones; a null group is a group, the
first; null ids come first, equal ids in the order of their leaf hashes; a table of
one row is its own root, with an empty proof; tampering leaves a null count, or a row
without an id, as it is; an empty table gives no rows.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.llm.common import ship, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: log2 of the leaves of a block.
BLOCK_LEVELS = 12


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Store:
    """Nodes of persistent binary trees: (digest, left, right), never changed once made.  A
    version is the index of its root; versions share every node they have in common."""

    def __init__(self):
        self.nodes: list[tuple[str, int, int]] = []

    def _add(self, value: str, left: int = -1, right: int = -1) -> int:
        self.nodes.append((value, left, right))
        return len(self.nodes) - 1

    def join(self, left: int, right: int = -1) -> int:
        """A new node over one or two nodes."""
        value = digest(self.nodes[left][0], self.nodes[right][0]) if right >= 0 else digest(self.nodes[left][0])
        return self._add(value, left, right)

    def build(self, leaves: list[str], levels: int) -> int:
        """The first version: a tree of exactly ``levels`` levels above the leaves."""
        level = [self._add(v) for v in leaves]
        for _ in range(levels):
            level = [self.join(*level[i:i + 2]) for i in range(0, len(level), 2)]
        return level[0]

    def siblings(self, root: int, at: int, levels: int) -> list[str]:
        """From leaf ``at`` to the root, per level: '-' (an only child), or the side ('<' left,
        '>' right) and digest of the other child."""
        out = []
        for k in reversed(range(levels)):
            _, left, right = self.nodes[root]
            if at >> k & 1:
                out.append("<" + self.nodes[left][0])
                root = right
            else:
                out.append(">" + self.nodes[right][0] if right >= 0 else "-")
                root = left
        return out[::-1]

    def with_leaf(self, root: int, at: int, value: str, levels: int) -> int:
        """A new version in which leaf ``at`` is ``value``: copies of its ancestors only."""
        if not levels:
            return self._add(value)
        _, left, right = self.nodes[root]
        if at >> (levels - 1) & 1:
            return self.join(left, self.with_leaf(right, at - (1 << levels - 1), value, levels - 1))
        return self.join(self.with_leaf(left, at, value, levels - 1), right)


def fold(value: str, path: list[str]) -> str:
    """The root that ``value`` leads to along a path of siblings."""
    for step in path:
        value = digest(step[1:], value) if step[0] == "<" else digest(value, step[1:])
    return value


def levels_of(n: int, most: int) -> int:
    """Levels of a block in a level of ``n`` nodes: enough for one root, at most ``most``."""
    return min(most, (n - 1).bit_length())


def field_text(*columns: Column) -> Column:
    """The text that is hashed for a row: '-' for null, else the UTF-8 length, ':' and the value."""
    def one(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return F.concat(*[one(c) for c in columns])


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (with a column ``g``, never null) with ``pos``, their place in their group by
    ``order``, and ``n``, the group's rows.  One range shuffle; no group has to fit a task."""
    ranged = written(rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
                     .withColumn("at", F.monotonically_increasing_id()), "merkle-ranges")
    part = F.shiftright("at", 33)                                   # the task that numbered the row
    runs = ranged.groupBy("g", part.alias("part")).agg(F.min("at").alias("low"), F.count("*").alias("c"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(runs.select("g", "part", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("low")).alias("shift"),
                               F.sum("c").over(Window.partitionBy("g")).alias("n")), "merkle-runs")
    return (ranged.withColumn("part", part).join(runs, ["g", "part"])
            .withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift"))


def _blocks(nodes: DataFrame, levels: int):
    return nodes.withColumn("block", F.shiftright("pos", levels)).groupBy("g", "block")


def _roots(nodes: DataFrame, most: int) -> DataFrame:
    """The next level: one node per block of ``nodes`` (g, pos, n, value)."""

    def build(block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        n, store = block.column("n")[0].as_py(), Store()
        root = store.build(block.column("value").to_pylist(), levels_of(n, most))
        return pa.table({"g": block.column("g").slice(0, 1), "pos": block.column("block").slice(0, 1),
                         "n": pa.array([-(-n >> most) if n > 1 else 1], pa.int64()), "value": pa.array([store.nodes[root][0]])})

    own = _blocks(nodes.select("g", "pos", "n", "value"), most)
    return own.applyInArrow(build, "g string, pos long, n long, value string")


def _tree(nodes: DataFrame, most: int) -> list[DataFrame]:
    """All levels of blocks above ``nodes``; the last one has one node per group."""
    out = [nodes]
    widest = nodes.agg(F.max("n")).first()[0] or 0
    while widest > 1:
        out.append(written(_roots(out[-1], most), "merkle-level"))
        widest = -(-widest >> most)
    return out


PATH = "g string, pos long, path string, subroot string, root string"


def _down(nodes: DataFrame, above: DataFrame, most: int) -> DataFrame:
    """Paths (g, pos, path, subroot, root) of the nodes of a level, from those of the level above."""

    def extend(block: pa.Table) -> pa.Table:
        head, own = _split(block)
        levels = levels_of(own.column("n")[0].as_py(), most)
        store = Store()
        root = store.build(own.column("value").to_pylist(), levels)
        paths = [" ".join(store.siblings(root, at, levels) + head["path"]) for at in range(own.num_rows)]
        return pa.table({"g": own.column("g"), "pos": own.column("pos"), "path": pa.array(paths, pa.string()),
                         "subroot": pa.array([head["subroot"]] * own.num_rows, pa.string()), "root": pa.array([head["root"]] * own.num_rows, pa.string())})

    return _with_paths(nodes.select("g", "pos", "n", "value"), above, most).applyInArrow(extend, PATH)


def _with_paths(nodes: DataFrame, above: DataFrame, most: int):
    """Blocks of ``nodes`` with one row more: the path of the block's root."""
    head = above.select("g", F.col("pos").alias("block"), "path", "subroot", "root")
    own = nodes.withColumn("block", F.shiftright("pos", most))
    return own.unionByName(head, allowMissingColumns=True).groupBy("g", "block")


def _split(block: pa.Table) -> tuple[dict, pa.Table]:
    own = block.filter(pa.compute.is_valid(block.column("pos"))).sort_by("pos")
    head = block.filter(pa.compute.is_null(block.column("pos"))).slice(0, 1).to_pylist()[0]
    return {**head, "path": head["path"].split()}, own


def manifest(docs: DataFrame, tampered: Column | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, proof (the siblings from leaf to root,
    joined by blanks, '<' or '>' for their side, '-' for none), proof_sha256, version_root (the
    root of the version in which n_chars is one more, for rows where ``tampered`` holds; for the
    others the root that leaf and siblings lead to)."""
    ship(docs.sparkSession)
    most = block_levels
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
                      docs["lang"].cast("string").alias("lang"), docs["n_chars"].cast("long").alias("n_chars"), docs["text"].cast("string").alias("text"))
    columns = {c: F.col(c) for c in FIELDS}
    changed = {**columns, "n_chars": F.col("n_chars") + 1}
    broken = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    leaves = own.select(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("g"), "doc_id", F.sha2(field_text(*columns.values()), 256).alias("value"),
                        F.when(broken, F.sha2(field_text(*changed.values()), 256)).alias("changed"), F.monotonically_increasing_id().alias("row"))
    leaves = placed(written(leaves, "merkle-rows"), "doc_id", "value", "row")
    leaves = written(leaves.select("g", "pos", "n", "value", "doc_id", "changed"), "merkle-leaves")
    groups = _tree(leaves, most)
    subroots = groups[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), "value")
    subroots = written(placed(subroots, "name"), "merkle-subroots")
    top = _tree(subroots.select("g", "pos", "n", "value"), most)
    paths = top[-1].select("g", "pos", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("value").alias("root"))
    for level in reversed(top[:-1]):
        paths = written(_down(level, paths, most), "merkle-paths")
    # the path of a group's subroot goes on above the group's tree
    paths = paths.select("pos", "path", "root").join(subroots.select("pos", F.col("name"), F.col("value").alias("subroot")), "pos")
    paths = paths.select(F.col("name").alias("g"), F.lit(0).cast("long").alias("pos"), "path", "subroot", "root")
    for level in reversed(groups[1:-1]):
        paths = written(_down(level, paths, most), "merkle-paths")
    return _versions(leaves, paths, most)


def _versions(leaves: DataFrame, paths: DataFrame, most: int) -> DataFrame:
    def answer(block: pa.Table) -> pa.Table:
        head, own = _split(block)
        levels = levels_of(own.column("n")[0].as_py(), most)
        values, store = own.column("value").to_pylist(), Store()
        first = store.build(values, levels)
        proofs, hashes, versions = [], [], []
        for at, changed in enumerate(own.column("changed").to_pylist()):
            path = store.siblings(first, at, levels) + head["path"]
            proofs.append(" ".join(path))
            hashes.append(digest(*[step[1:] for step in path]))
            if changed is None:
                versions.append(fold(values[at], path))             # proves the leaf in the first version
            else:
                version = store.with_leaf(first, at, changed, levels)
                versions.append(fold(store.nodes[version][0], head["path"]))
        one = own.num_rows
        return pa.table({"doc_id": own.column("doc_id"), "leaf": pa.array(values, pa.string()), "subroot": pa.array([head["subroot"]] * one, pa.string()),
                         "root": pa.array([head["root"]] * one, pa.string()), "proof": pa.array(proofs, pa.string()),
                         "proof_sha256": pa.array(hashes, pa.string()), "version_root": pa.array(versions, pa.string())})

    schema = "doc_id long, leaf string, subroot string, root string, proof string, proof_sha256 string, version_root string"
    return _with_paths(leaves, paths, most).applyInArrow(answer, schema)


def digest_columns(answered: DataFrame) -> DataFrame:
    return answered.select("doc_id", "leaf", "subroot", "root", "proof_sha256", F.col("version_root").alias("folded_root"),
                           (F.col("version_root") == F.col("root")).alias("verified"))
