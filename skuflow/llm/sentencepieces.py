"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text gets a leading blank, blanks become U+2581, and every character starts as
a symbol.  An agenda (heap) of adjacent symbol pairs whose join is a piece is
worked off by score, highest first, leftmost on ties; a merged symbol pairs anew
with its neighbours, and entries whose symbols have changed meanwhile are
skipped.  Symbols that are no piece become their UTF-8 byte pieces.

No piece of a vocabulary trained on white-space units has U+2581 behind another
character, so no merge crosses such a place: the agenda runs once per distinct
unit (blanks and the word behind them), and a bounded cache in each Python
worker keeps the ids.  The new units of a batch work off their agendas in step:
one row of pair ranks per unit, each round merges every unit's best pair; long
units and those with unknown characters use a heap each.  Every unit that enters the cache is checked against the
sentencepiece library, one call for each Arrow batch; a difference raises.
Decoding is the library's, batch by batch.  Map-only: nothing is shuffled.

Cases: null or empty text has no ids and decodes to the empty text; null and
repeated ids and further columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import texts_of

BLANK = "▁"
SCHEMA = "doc_id long, ids array<int>, decoded string"
#: Units kept by one Python worker; the cache starts anew beyond it (results do not depend on it).
CACHE_UNITS = 1_000_000
#: Characters of the longest unit whose agenda is worked off in step with others.
WIDEST = 64
NONE = 2 ** 31 - 1


class AgendaEncoder:
    _unit = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")

    def __init__(self, model_file: str, check: bool = True):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib, n = self.library, self.library.get_piece_size()
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        if any(lib.is_unused(i) for i in plain):
            raise ValueError("vocabularies with unused pieces are not supported")
        pieces = [lib.id_to_piece(i) for i in plain]
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece crosses white space: units cannot be encoded one by one")
        self.ids = dict(zip(pieces, plain))
        #: order of a merge: by falling score
        self.order = {p: -lib.get_score(i) for p, i in zip(pieces, plain)}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.check, self.cache = check, {}
        self._tables(pieces, plain)

    def _tables(self, pieces: list[str], plain: list[int]) -> None:
        """For the agendas in step: ids of characters, and rank and result of every pair of pieces whose join is one."""
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in zip(pieces, plain):
            if len(p) == 1:
                self.char[ord(p)] = i
        ranks = {o: r for r, o in enumerate(sorted(set(self.order.values())))}
        self.span = max(plain, default=0) + 1
        found = sorted((self.ids[p[:k]] * self.span + self.ids[p[k:]], ranks[self.order[p]], i)
                       for p, i in zip(pieces, plain) for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids)
        self.pair, self.rank, self.join = (np.array(c, t) for c, t in zip(zip(*found) if found else ((), (), ()), (np.int64, np.int32, np.int32)))

    def _rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NONE: no merge) and its place in the table."""
        key = a.astype(np.int64) * self.span + b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (b >= 0), self.rank[at], NONE), at

    def in_step(self, symbols: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Merge the rows of ``symbols`` (character ids, -1 behind the end); merged-away places become -1."""
        n, width = symbols.shape
        out = symbols.copy()
        after = np.tile(np.arange(1, width + 1), (n, 1))
        before = after - 2
        rank = np.full((n, width), NONE, np.int32)
        inside = np.arange(width - 1)[None] < length[:, None] - 1
        r, k = np.nonzero(inside)
        rank[r, k] = self._rank(out[r, k], out[r, k + 1])[0]
        row = np.arange(n)
        while len(row):
            left = rank[row].argmin(1)                    # the best score; the leftmost of equal ones
            open_ = rank[row, left] < NONE
            row, left = row[open_], left[open_]
            right = after[row, left]
            end = after[row, right]
            out[row, left] = self.join[self._rank(out[row, left], out[row, right])[1]]
            out[row, right], rank[row, right], after[row, left] = -1, NONE, end
            more = end < length[row]
            before[row[more], end[more]] = left[more]
            rank[row, left] = np.where(more, self._rank(out[row, left], out[row, np.minimum(end, width - 1)])[0], NONE)
            prev = before[row, left]
            had = prev >= 0
            rank[row[had], prev[had]] = self._rank(out[row[had], prev[had]], out[row[had], left[had]])[0]
        return out

    def units(self, fresh: list[str]) -> list[bytes]:
        """Ids of each unit as little-endian 32-bit numbers."""
        size = np.array([len(u) for u in fresh], np.int64)
        codes = self.char[np.frombuffer("".join(fresh).encode("utf-32-le"), "<u4")]
        stop = np.cumsum(size)
        first = stop - size
        unknown = np.concatenate([[0], np.cumsum(codes < 0)])
        alone = (size > WIDEST) | (unknown[stop] > unknown[first])
        out: list = [None] * len(fresh)
        for i in np.flatnonzero(alone).tolist():
            out[i] = array("i", self.unit(fresh[i])).tobytes()
        low = 0
        for width in (6, 10, 16, 32, WIDEST):
            rows = np.flatnonzero(~alone & (size > low) & (size <= width))
            low = width
            for part in np.array_split(rows, max(1, len(rows) // 20_000)):
                if not len(part):
                    continue
                place = first[part][:, None] + np.arange(width)
                inside = np.arange(width) < size[part][:, None]
                merged = self.in_step(np.where(inside, codes[np.minimum(place, len(codes) - 1)], -1), size[part])
                left = merged >= 0
                flat, ends = merged[left].astype("<i4").tobytes(), (4 * np.cumsum(left.sum(1))).tolist()
                for i, a, b in zip(part.tolist(), [0, *ends], ends):
                    out[i] = flat[a:b]
        return out

    def unit(self, text: str) -> list[int]:
        """Ids of one unit by the agenda."""
        if text in self.ids and len(text) == 1:
            return [self.ids[text]]
        order, ids, n = self.order.get, self.ids.get, len(text)
        # a symbol is text[i:after[i]]; after[i] is -1 once it has merged into the one before it
        after, before = list(range(1, n + 2)), list(range(-1, n))
        agenda = [(rank, i, i + 2) for i, rank in enumerate(map(order, map(add, text, text[1:]))) if rank is not None]
        heapify(agenda)
        while agenda:
            _, left, end = heappop(agenda)
            right = after[left]
            if right < 0 or right >= n or after[right] != end:
                continue                                   # one of the two has changed since
            after[left], after[right] = end, -1
            before[end] = left
            if end < n:
                stop = after[end]
                if (rank := order(text[left:stop])) is not None:
                    heappush(agenda, (rank, left, stop))
            prev = before[left]
            if prev >= 0 and (rank := order(text[prev:end])) is not None:
                heappush(agenda, (rank, prev, end))
        out, i = [], 0
        while i < n:
            s = text[i:after[i]]
            if (piece := ids(s)) is not None:
                out.append(piece)
            else:
                out.extend(self.bytes[b] for b in s.encode())
            i = after[i]
        return out

    def batch(self, texts: list[str]) -> list[list[bytes]]:
        """For each text its units' ids as little-endian 32-bit numbers."""
        if len(self.cache) > CACHE_UNITS:
            self.cache.clear()
        cache = self.cache
        units = [self._unit.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        fresh = list({u for row in units for u in row if u not in cache})
        cache.update(zip(fresh, self.units(fresh)))
        if self.check:
            whole = [u for u in fresh if u[0] == BLANK and len(u) > 1]   # the library adds the first blank itself
            told = self.library.encode([u[1:] for u in whole], num_threads=1) if whole else []
            if array("i", chain.from_iterable(told)).tobytes() != b"".join(cache[u] for u in whole):
                raise ValueError("the agenda and the library differ")
        return [[cache[u] for u in row] for row in units]


_ENCODERS: dict[str, AgendaEncoder] = {}


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """(doc_id, ids, decoded): the ids of every whole text, and their decoding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(model_file) or _ENCODERS.setdefault(model_file, AgendaEncoder(model_file, check))
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 1000):
                batch = whole.slice(at, 1000)
                rows = encoder.batch(batch.column(1).to_pylist())
                joined = [b"".join(r) for r in rows]
                values = np.frombuffer(b"".join(joined), "<i4")
                offsets = np.concatenate([[0], np.cumsum([len(j) // 4 for j in joined])]).astype(np.int32)
                decoded = encoder.library.decode([np.frombuffer(j, "<i4").tolist() for j in joined]) if rows else []
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
