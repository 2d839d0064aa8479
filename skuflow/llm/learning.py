"""Fitting on a bounded sample of labelled rows, and scoring every whole text."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import give_back, ship, small_batches, texts_of


def bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id: null)."""
    return F.crc32(doc_id.cast("string")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, train: Callable[[Column], Column],
                    max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled training rows, chosen by a hash
    of the id.  Null ids and labels are left out; a document labelled more than once has its
    smallest label, and a repeated document counts once."""
    own = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
    own = (own.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & train(F.col("doc_id")))
           .groupBy("doc_id").agg(F.min("label").alias("label")))
    chosen = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return (texts_of(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")   # at most max_rows ids
            .groupBy("doc_id").agg(F.max("text").alias("text"), F.min("label").alias("label")))


def fit(sample: DataFrame, learn: Callable[[list[bytes], np.ndarray], object]) -> object:
    """``learn(texts, labels)`` in one task over the bounded ``sample`` (ordered by id); runs now
    and brings only the model to the driver.  ``learn`` may empty the list of texts as it goes."""

    def learnt(batches: Iterator[pa.RecordBatch]) -> bytes:
        ids, texts, labels = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            texts += _bytes(batch.column(1))
            labels += batch.column(2).to_pylist()
        order = sorted(range(len(ids)), key=ids.__getitem__)
        texts = [texts[i] for i in order]
        return pickle.dumps(learn(texts, np.array([labels[i] for i in order], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = learnt(batches)
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    one = sample.select("doc_id", "text", "label").repartition(1)
    with small_batches(sample.sparkSession):
        row = one.mapInArrow(run, "model binary").first()
    return pickle.loads(row[0]) if row else learn([], np.zeros(0, np.int64))   # no rows: no task ran


def _bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of the texts; a null text is empty."""
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in texts]


def _chunks(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``most`` bytes; a longer text is one of its own."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
    at = 0
    while at < len(sizes):
        size, to = 0, at
        while to < len(sizes) and (to == at or size + sizes[to] <= most):
            size += sizes[to]
            to += 1
        yield at, to
        at = to


def score(docs: DataFrame, scorer: Callable[[list[bytes]], np.ndarray], id_col: str = "doc_id", text_col: str = "text",
          chunk_bytes: int = 1_000_000) -> DataFrame:
    """(doc_id, score) for every row of ``docs``; ``scorer`` gets bounded lists of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in _chunks(batch.column(1), chunk_bytes):
                values = np.asarray(scorer(_bytes(batch.column(1).slice(at, to - at))), float)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(values, pa.float64())], ["doc_id", "score"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, accepts: Callable[[list[bytes]], np.ndarray], text_col: str = "text", chunk_bytes: int = 1_000_000) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text ``accepts``; a null text is empty."""
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for at, to in _chunks(batch.column(place), chunk_bytes):
                ok[at:to] = accepts(_bytes(batch.column(place).slice(at, to - at)))
            yield batch.filter(pa.array(ok))

    return docs.mapInArrow(run, docs.schema)


def decisions(scored: DataFrame, modulus: int, remainder: int, threshold: float = 0.3) -> DataFrame:
    return scored.select("doc_id", (bucket(F.col("doc_id"), modulus) == remainder).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's (a, b): probability 1 / (1 + exp(-(a * margin + b))), by Newton's method on smoothed targets."""
    if not len(margin):
        return 1.0, 0.0
    hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    t = np.where(y == 1, hi, lo)
    a, b = 1.0, 0.0
    x = np.stack([margin, np.ones_like(margin)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ (a, b), -35, 35)))
        g, w = x.T @ (p - t), np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((x * w[:, None]).T @ x + 1e-6 * np.eye(2), g)
        step *= min(1.0, 5 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-6), float(b)
