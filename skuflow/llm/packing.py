"""Sum-of-squares online packing of tokenised documents into training sequences.

Every task packs the documents of its own partition: documents stream through
once, in order, and a level array ``open[l]`` counts the windows filled to level
``l``.  A piece of ``n`` tokens goes to the level ``l`` (0: a new window) that
minimises the sum of squares of ``open`` after the move (Csirik et al., "On the
sum-of-squares algorithm for bin packing"); ties take the fullest window.  A
document of at least one whole window is cut into whole windows first, and its
rest is packed.  What is still open at the end of a task is cut to fill up
(fullest windows first), so a task leaves at most one window that is not full.
Nothing is shuffled and no state is shared: a lost task is simply packed again,
and ``sequence_id`` depends on the partition number only.

Cases: null or empty text is the closing id alone; null and repeated ids are
packed like any other row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import texts_of

#: Bits of a sequence id below the partition's number.
LOCAL_BITS = 36
SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


class Tokenizer:
    """Ids of the byte-level BPE as the ``tokenizers`` library gives them.

    Texts in Latin letters go through tiktoken with the same ranks (same merges,
    same pattern, same ids, about six times as fast); texts with other letters,
    very long words or very long texts go through ``tokenizers`` itself, since
    the Unicode tables of the two may differ and tiktoken is slow on long words.
    """

    _other = re.compile("[^\x00-ɏ]|[^\\s]{2000}|\\s{2000}")

    def __init__(self, tokenizer_file: str, ranks_file: str | None):
        self.file, self.slow, self.fast = tokenizer_file, None, None
        if ranks_file:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={"<|endoftext|>": len(ranks)})

    def __call__(self, text: str) -> list[int]:
        if self.fast and len(text) < 1_000_000 and not self._other.search(text):
            return self.fast.encode(text, allowed_special="all")
        if self.slow is None:
            from tokenizers import Tokenizer as Library

            self.slow = Library.from_file(self.file)
        return self.slow.encode(text, add_special_tokens=False).ids


class Window:
    __slots__ = ("fill", "number", "pieces")

    def __init__(self, number: int):
        self.number, self.fill, self.pieces = number, 0, []

    def add(self, piece: tuple) -> None:
        self.pieces.append((*piece, self.fill))
        self.fill += len(piece[2])


class LevelPacker:
    """The level array of one task.  ``put`` and ``finish`` yield windows that are done."""

    def __init__(self, size: int):
        self.size, self.made = size, 0
        self.open = np.zeros(size + 1, np.int64)
        self.windows: list[list[Window]] = [[] for _ in range(size + 1)]

    def new(self) -> Window:
        self.made += 1
        return Window(self.made - 1)

    def put(self, doc, ids: np.ndarray) -> Iterator[Window]:
        start, total = 0, len(ids)
        while total - start >= self.size:
            w = self.new()
            w.add((doc, start, ids[start:start + self.size], total))
            yield w
            start += self.size
        n = total - start
        if not n:
            return
        # change of the sum of squares when a window moves from level l to l + n
        last = self.size - n
        change = 2 * self.open[n:self.size + 1] + 1
        change[last] = 0                                  # a full window is not open any more
        change[1:] -= 2 * self.open[1:last + 1] - 1
        change[1:][self.open[1:last + 1] == 0] = np.iinfo(np.int64).max
        level = last - int(np.argmin(change[::-1]))       # the fullest of the best
        if level:
            w = self.windows[level].pop()
            self.open[level] -= 1
        else:
            w = self.new()
        w.add((doc, start, ids[start:], total))
        if w.fill == self.size:
            yield w
        else:
            self.windows[w.fill].append(w)
            self.open[w.fill] += 1

    def finish(self) -> Iterator[Window]:
        left = [w for level in reversed(self.windows) for w in level]
        i, rest = 0, []
        for w in left:
            rest.append(w)
        while i < len(rest):
            w = rest[i]
            while w.fill < self.size and len(rest) > i + 1:
                donor = rest[-1]
                doc, start, ids, total, _ = donor.pieces.pop()
                room = self.size - w.fill
                w.add((doc, start, ids[:room], total))
                donor.fill -= min(room, len(ids))
                if len(ids) > room:
                    donor.pieces.append((doc, start + room, ids[room:], total, donor.fill - (len(ids) - room)))
                if not donor.pieces:
                    rest.pop()
            yield w
            i += 1


def _offsets(w: Window) -> Iterator[tuple]:
    at = 0
    for doc, start, ids, total, _ in w.pieces:
        yield doc, start, ids, total, at
        at += len(ids)


def pack(docs: DataFrame, tokenizer_file: str, ranks_file: str | None = None, size: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack ``docs`` into sequences of at most ``size`` tokens; one row per piece.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers;
    ``start`` is its place in its document, ``offset`` its place in the sequence.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = Tokenizer(tokenizer_file, ranks_file), LevelPacker(size)
        base = TaskContext.get().partitionId() << LOCAL_BITS
        names = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
        types = (pa.int64(),) * 6 + (pa.binary(),)
        rows: list[tuple] = []

        def emit() -> pa.RecordBatch:
            cols = list(zip(*rows)) or [()] * 7
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], list(names))

        def done(windows: Iterator[Window]) -> None:
            for w in windows:
                for doc, start, ids, total, at in _offsets(w):
                    rows.append((doc, start, len(ids), total, base + w.number, at, ids.tobytes()))

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*tokenizer(text.as_py()), end_id], "<u4")
                done(packer.put(doc, ids))
                if len(rows) >= 2000:
                    yield emit()
        done(packer.finish())
        yield emit()

    return texts_of(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def pieces_digest(packed: DataFrame) -> DataFrame:
    """The packed rows with ``ids_crc32`` in place of the ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
