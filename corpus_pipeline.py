"""The training-data pipeline: documents in, packed training sequences out.

Stages, each written as Parquet and read again as the next one's documents:

1. quality  documents that the quality classifier rejects go
2. near     one document of each group of near duplicates stays (shingles of five
            words, Jaccard similarity of at least 0.8)
3. repeats  byte strings of 200 and more that occur anywhere else are cut out
4. pii      personal data and the terms that disclose it are replaced or removed
5. pack     the texts become sequences of at most 2048 tokens

A stage takes (spark, docs, sf_dir) and works on all of ``docs``; every stage but
the last returns the columns of ``documents``, with ``n_chars`` kept up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm import learning, packing, pii, quality, shingle_join, substrings
from skuflow.llm.common import read_table, written
from skuflow.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KEEP_AT = 0.3


def _hashes(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(*COLUMNS).withColumns({"t1": F.xxhash64(text), "t2": F.xxhash64(text, F.lit(7))})


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that score at least KEEP_AT.  The model is learnt from ``labels`` (a fifth
    is held out) and the documents of the same ids; rows are scored where they lie, nothing is joined."""
    labels = read_table(spark, sf_dir, "labels")
    model = quality.learn_from(docs, labels, lambda i: learning.bucket(i, 5) != 0)
    return learning.keep(docs.select(*COLUMNS), lambda texts: quality.predict(model, texts) >= KEEP_AT)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one of the smallest id (rows without an id come
    last), of several texts of that id the one of the smallest hash, of equal rows one.  A group is
    a class of linked sets, whatever ids stand on its rows.  Empty texts stay, once for each id."""
    linked = shingle_join.link(docs, words=5, percent=80)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("id"), F.col("text_hash").alias("t1"))).alias("k")
    keep = linked.where("n_shingles > 0").groupBy("class").agg(first).select(F.col("k.id").alias("doc_id"), F.col("k.t1").alias("t1"))
    keep = keep.union(linked.where("n_shingles = 0").select("doc_id", F.col("text_hash").alias("t1")))
    row = F.xxhash64("doc_id", "t1").alias("row")                 # null ids are equal here
    keep = written(keep.select("t1", row).distinct(), "near-kept")
    kept = _hashes(docs).select("*", row).join(keep, ["t1", "row"], "left_semi").dropDuplicates(["t1", "row"])
    return kept.select(*COLUMNS)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated byte strings out; a character cut in half goes as a whole."""
    cut = substrings.cut_texts(docs)
    own = _hashes(docs).drop("text", "n_chars")
    out = own.join(cut, ["t1", "t2"]).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*COLUMNS)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by placeholders, and generalises or removes the terms that disclose it."""
    found = pii.find(docs).where(F.size("spans") > 0).groupBy("t1", "t2").agg(F.first("spans").alias("spans"))
    found = written(found, "pii-found")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(pii.sanitised(F.col("text"), F.col("spans")))
    out = _hashes(docs).join(found, ["t1", "t2"], "left").withColumn("text", text)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0))).select(*COLUMNS)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts; one row per piece, with its ids (little-endian, 32 bits each)."""
    packed = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))
    return packed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality", quality_stage), ("near", near_stage), ("repeats", repeats_stage), ("pii", pii_stage), ("pack", pack_stage)]

#: Trained scores, similarity classes and tokens are beyond SQL; tests/llm holds every stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
