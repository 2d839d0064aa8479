"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm import exact_dedup, learning, licences, merkle, packing, pii, quality, search, sentencepieces, shingle_join, substrings, toxicity, vector_join, whitening
from skuflow.llm.common import read_table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(read_table(spark, sf_dir, "documents")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read_table(spark, sf_dir, "documents"))


def op4_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.link(read_table(spark, sf_dir, "embeddings"), cosine=0.9)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pieces_digest(packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken")))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shingle_join.link(read_table(spark, sf_dir, "documents"), words=4, percent=85)
    return out.select("doc_id", F.col("n_shingles").cast("long"), "component_id")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return sentencepieces.digest(sentencepieces.encode(docs, tokenizer_path("piece_bpe_32k.model")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return learning.decisions(quality.classify(docs, labels, lambda i: learning.bucket(i, 5) != 0), 5, 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return learning.decisions(toxicity.classify(docs, labels, lambda i: learning.bucket(i, 4) != 2), 4, 2)


def op10_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item whose id is divisible by 20."""
    index = search.build(read_table(spark, sf_dir, "documents"))
    asked = read_table(spark, sf_dir, "benchmark").where("item_id % 20 = 0")
    out = search.search(index, asked, k=10, id_col="item_id")
    return out.select(F.col("query").alias("item_id"), F.col("rank").cast("long"), "doc_id", F.round("score", search.DIGITS).alias("score"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest_columns(whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=8))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id's crc32 is divisible by 7 are checked after tampering."""
    docs = read_table(spark, sf_dir, "documents")
    return merkle.digest_columns(merkle.manifest(docs, tampered=learning.bucket(F.col("doc_id"), 7) == 0))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.digest_columns(exact_dedup.mark_copies(read_table(spark, sf_dir, "documents")))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_licences": op3_licences,
    "op4_vector_join": op4_vector_join,
    "op5_packing": op5_packing,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_search": op10_search,
    "op11_whitening": op11_whitening,
    "op12_merkle": op12_merkle,
    "op13_exact_dedup": op13_exact_dedup,
}

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"""

ORACLE_SQL: dict[str, str] = {
    "op10_search": f"""
        with d as (select row_number() over () as row, doc_id, {_WORDS} as words from documents),
        stats as (select count(*) as n, avg(len(words)) as average from d),
        tf as (select row, term, count(*) as tf from (select row, unnest(words) as term from d) group by all),
        df as (select term, count(*) as df from tf group by term),
        q as (select item_id, term, count(*) as c from (select item_id, unnest({_WORDS}) as term from benchmark where item_id % 20 = 0) group by all),
        s as (select item_id, row, round(sum(c * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / average))), 6) as score
              from q join df using (term) join tf using (term) join d using (row), stats group by all),
        r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank, doc_id, score from s join d using (row))
        select item_id, rank, doc_id, score from r where rank <= 10""",
    "op13_exact_dedup": """
        select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
               row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
        from (select doc_id, coalesce(text, '') as t from documents)""",
}
