"""From raw documents to the tokens of a training mix, in five stages.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame; ``run`` writes each result and reads it back for the next.
Columns of documents beyond the five known ones are dropped at the start.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.llm import byte_bpe, exact_dedup, mixing, near_dup, quality, queries
from shelfline.llm.common import DOCUMENT_COLUMNS, table, text_of
from shelfline.session import materialize


def _kept(docs: DataFrame, decisions: DataFrame, once: Column) -> DataFrame:
    """The rows of ``docs`` whose ``_key`` (never null) a decision keeps; of those with one key and ``once``, one row."""
    keys = decisions.filter("kept").select("_key").distinct()
    rows = docs.join(keys, "_key", "left_semi").withColumn("_once", once)
    return rows.dropDuplicates(["_key", "_once"]).select(*DOCUMENT_COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rules or the model reject."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, prefix="_q_").filter("_q_kept").select(*DOCUMENT_COLUMNS)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, one stays.

    Rows are told apart by id, text and length, so documents without an id, or with an id of others, stay as well.
    """
    def key(digest: Column, length: Column) -> Column:
        return F.concat_ws(":", digest, length.cast("string"), F.col("doc_id").cast("string"))

    index = f"pipeline_index_{uuid.uuid4().hex}"
    decisions = exact_dedup.deduplicate(docs, index, batch="pipeline")
    exact_dedup.drop_index(spark, index)
    decisions = decisions.withColumn("_key", key(F.col("text_sha256"), F.col("n_chars")))
    own = key(exact_dedup.digest_of(), F.length(text_of()))
    return _kept(docs.withColumn("_key", own), decisions, F.lit(0))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the one with the smallest id stays.

    Null ids come last: such documents go by a number above 2^62 that their text gives.
    Different texts with one id are one document here, and stay or go together.
    """
    stand_in = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(text_of()), 2)
    docs = docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), stand_in))
    decisions = near_dup.near_duplicates(
        docs.select(F.col("_key").alias("doc_id"), "text"), words_in_shingle=5, percent=80, bands=48)
    return _kept(docs, decisions.withColumnRenamed("doc_id", "_key"), F.sha2(text_of(), 256))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs).select(*DOCUMENT_COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its very bytes."""
    texts = docs.select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), "text")
    encoded = byte_bpe.encode(texts, queries.RANK_FILE, queries.PATTERN)
    decoded = byte_bpe.decode(encoded, queries.RANK_FILE, queries.PATTERN)
    return decoded.select(
        "doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("mixing sources", source_mix),
    ("byte-level BPE", tokens),
]

# The fitted model and the tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
