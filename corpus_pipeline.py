"""The corpus pipeline: from documents to encoded training text.

Each stage works on all rows that the stage before it kept, read back from Parquet. All but the
last return the columns of documents.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.bpe_tree import encode_decode
from tillmart.llm.common import kept, without_spaces
from tillmart.llm.exact_dedup import exact_duplicates
from tillmart.llm.language_id import UNDETERMINED, identify
from tillmart.llm.queries import tokenizer_path
from tillmart.llm.simhash_trie import near_duplicates
from tillmart.llm.source_mix import mixture


# Rows that go to a Python worker at once, where the session does not say: texts are long, and a batch lies outside the JVM's heap.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "512"


def in_small_batches(stage):
    """The stage, with batches whose size does not follow the default of ten thousand rows."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_SETTING, None) is None:
            spark.conf.set(BATCH_SETTING, BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, which no language has. A toss-up between languages is no reason: close
    languages and texts in several score 1 over their number, however long and clean they are.

    Null and empty texts have no letter. Rows that repeat, or have no doc_id, are judged by themselves. Columns of any other name stay
    as they are. An empty table gives an empty one.
    """
    found = identify(docs, tokenizer_path("piece_bpe_32k.model"), docs.columns)
    return found.where(F.col("lang_pred") != UNDETERMINED).select("document.*")


@in_small_batches
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of equal texts: the longest as written, then the smallest doc_id, null last.

    Null texts, empty ones and those of white space are one group. Rows that repeat both doc_id and text are told apart by nothing:
    one of them stays. Columns of any other name stay as they are.
    """
    stays = exact_duplicates(docs).where("kept").select(F.col("doc_id").alias("id"), "text_sha256").distinct()
    named = docs.select(F.struct(*docs.columns).alias("document"), F.sha2(without_spaces(F.col("text")), 256).alias("sha"))
    same = F.col("document.doc_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("text_sha256"))
    one = named.join(stays, same, "left_semi").withColumn("id", F.col("document.doc_id")).dropDuplicates(["id", "sha"])
    return one.select("document.*")


@in_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that the SimHash operator links: the one with the smallest doc_id.

    Null doc_ids come last. Rows that share a doc_id are told apart by their texts, of which that with the smaller hash comes first; rows
    that repeat both are one document and share its fate. Null and empty texts have one fingerprint, and so are one group. Columns
    of any other name stay as they are. An empty table gives an empty one.
    """
    # A key of its own for each document, so that a group has exactly one smallest.
    key = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    found = near_duplicates(docs.select(key.alias("doc_id"), "text"))
    gone = kept(found.where("doc_id <> component_id").select(F.col("doc_id").alias("key")).distinct(), "near-gone")
    named = docs.select(F.struct(*docs.columns).alias("document"))
    same = F.col("document.doc_id").eqNullSafe(F.col("key.id")) & (F.xxhash64("document.text") == F.col("key.hash"))
    return named.join(gone, same, "left_anti").select("document.*")


@in_small_batches
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops and repeats documents so that sources come near their targets.

    A document comes as often as the mix takes it, to the nearest whole number. Only the
    one that a source's last pass ends in is rounded. Rows that share a doc_id share the mean of what is taken of them; those
    without one are such rows too. Texts without words are never taken. Columns of any other name stay as they are.
    """
    shares = mixture(docs).groupBy(F.col("doc_id").alias("id")).agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("share"))
    named = docs.select(F.struct(*docs.columns).alias("document"))
    drawn = named.join(shares, F.col("document.doc_id").eqNullSafe(F.col("id"))).withColumn("times", F.round("share").cast("int")).where("times > 0")
    return drawn.select("document", F.explode(F.sequence(F.lit(1), "times"))).select("document.*")


@in_small_batches
def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every document of the mix: doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded.

    Null and empty texts have no tokens. Every row is encoded for itself, so a document that the mix repeats comes as often.
    """
    found = encode_decode(docs, tokenizer_path())
    return found.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("bpe", bpe),
]

# Hashes of shingles and subword pieces have no SQL form; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
