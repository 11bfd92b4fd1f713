"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.arc_convert import convert, http_field, read_warc, resolved, write_arc
from tillmart.llm.bpe_tree import encode_decode
from tillmart.llm.common import SPACE_CLASS, kept, scratch_path, table
from tillmart.llm.exact_dedup import exact_duplicates
from tillmart.llm.html_paths import extract
from tillmart.llm.language_id import held_out, identify
from tillmart.llm.link_graph import judge
from tillmart.llm.secret_index import BASE, MORE, digest, find_secrets
from tillmart.llm.simhash_trie import near_duplicates
from tillmart.llm.source_mix import mixture
from tillmart.llm.syncmers import as_text, edited_fingerprints
from tillmart.llm.toxicity import toxicity
from tillmart.llm.vector_codes import books_text, product_codes
from tillmart.llm.word_runs import periodic_runs, strongest
from tillmart.plans.warehouse import remove_folder


TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where a public tokenizer's file is on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())
    return found.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return found.select("document.doc_id", held_out(F.col("document.doc_id")).alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    found = toxicity(table(spark, sf_dir, "documents"), labels)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op8_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("anchors")).alias("fingerprint"),
        as_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op9_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    kinds = F.transform("found", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, n))).cast("long").alias(f"n_{rule.kind}") for n, rule in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(digest(base, BASE), 256).alias("base_sha256"), digest(F.col("found"), BASE + MORE).alias("spans"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every tenth document, by the CRC-32 of its id, repeating a stretch of its words up to its end."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", f"[{SPACE_CLASS}]+"), lambda w: w != "")
    cut = docs.select("doc_id", "text", F.floor(crc / 10).alias("g"), F.when((crc % 10 == 0) & F.col("text").isNotNull(), words).alias("words"))
    sized = cut.select("*", F.size("words").alias("n")).select("*", F.when(F.col("n") > 0, F.expr("int(g % n)")).alias("a"))
    placed = sized.select("*", F.expr("int(1 + (n - a) div (3 + g % 8))").alias("p"))
    repeated = F.expr("concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), int((n - a) div p + 1))), 1, n - a))")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    best = strongest(F.col("runs"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return told.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


PAGE_NUMBER = "X-Page-Id"


def op12_arc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as legacy archives, those converted, and what the new archives say."""
    line = F.concat(F.lit(f"{PAGE_NUMBER}: "), F.col("page_id").cast("string"), F.lit("\r\n"))
    captures = table(spark, sf_dir, "pages").select("url", F.coalesce(line, F.lit("")).alias("http"), F.col("html").cast("binary").alias("payload"))
    old, new = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(captures, old)
    number = http_field(F.col("block"), F.col("head").cast("int"), PAGE_NUMBER).cast("long")
    convert(spark, old, new, [number])
    remove_folder(spark, old)
    found = resolved(read_warc(spark, new), PAGE_NUMBER.lower())
    whole = lambda c: F.col(c).cast("long")
    return found.select(whole("number").alias("page_id"), "payload_bytes", "payload_digest", "record_type", whole("refers_to").alias("refers_to"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = product_codes(table(spark, sf_dir, "embeddings"))
    rows = kept(rows, "codes-rows")
    # Written first, so that its size decides how it is joined.
    totals = kept(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "codes-labels")
    return rows.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(books_text(books).encode()).hexdigest()).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_paths": op1_html_paths,
    "op2_bpe": op2_bpe,
    "op3_source_mix": op3_source_mix,
    "op4_language_id": op4_language_id,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_syncmers": op8_syncmers,
    "op9_link_graph": op9_link_graph,
    "op10_secrets": op10_secrets,
    "op11_word_runs": op11_word_runs,
    "op12_arc_convert": op12_arc_convert,
    "op13_vector_codes": op13_vector_codes,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
