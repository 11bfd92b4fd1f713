"""Landed API pages: reading them, taking them apart, checking they are all there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions.payload import computed_once
from tillmart.schemas import PAGES

PAGE_SIZE = 500

_BODY = "data array<string>, _corrupt string"
_BODY_OPTIONS = {"columnNameOfCorruptRecord": "_corrupt"}


def read_page_lines(spark: SparkSession, path: str) -> DataFrame:
    """Pages as JSON lines with branch_id, entity, page_no, body and, if known, landed_at; files split freely.

    A line that does not say when it landed did so when its file was written.

    Files under ``entity=…`` folders, with the entity left out of the lines, are the
    better layout: the load of an entity then reads its own files only.
    """
    return landed(spark.read.schema(PAGES).option("mode", "FAILFAST").json(path))


def landed(pages: DataFrame) -> DataFrame:
    """Pages read from files, dated by their file unless dated themselves."""
    return pages.select(
        *[c for c in PAGES.fieldNames() if c != "landed_at"],
        F.coalesce("landed_at", "_metadata.file_modification_time").alias("landed_at"),
    )


def read_page_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Pages already packed into parquet; the better form for many small pages."""
    return spark.read.schema(PAGES).parquet(path)


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """One file per page, as ``branch_id=…/entity=…/<anything>-<page_no>.json``."""
    schema = "value string, branch_id string, entity string"
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.[^.]+$", 1)
    return (
        spark.read.schema(schema).option("wholetext", True).format("text").load(path)
        .select(
            "branch_id",
            "entity",
            # A name without a number gives a page without one, which is rejected by itself.
            number.try_cast("int").alias("page_no"),
            F.col("value").alias("body"),
            F.col("_metadata.file_modification_time").alias("landed_at"),
        )
    )


def split_by_entity(pages: DataFrame, folder: str) -> DataFrame:
    """Rewrite pages once so that each entity lies apart, for loads that follow.

    For pages that came mixed: one pass over all of them here, instead of one per entity.
    """
    pages.hint("rebalance", "entity").write.mode("overwrite").partitionBy("entity").parquet(folder)
    return read_page_parquet(pages.sparkSession, folder)


def _parsed(pages: DataFrame) -> DataFrame:
    return computed_once(pages, "_page", F.from_json("body", _BODY, _BODY_OPTIONS))


def _page_error() -> Column:
    unreadable = F.col("_page").isNull() | F.col("_page._corrupt").isNotNull() | (F.trim("body") == "")
    # Without a number its records have no address, and whether all pages came can't be told.
    return F.when(F.col("body").isNull() | unreadable | F.col("page_no").isNull(), F.lit("bad_page"))


def unnest_pages(pages: DataFrame) -> DataFrame:
    """One row per record of each page's ``data``; a page without it gives no rows.

    ``ingest_seq`` orders records by page and position, ``extracted_at`` is when the page
    landed (null if unknown). An unreadable page, or one without a number, gives one row
    without a record and with ``page_error`` set, so that it cannot get lost.
    """
    rows = unnest_with_pages(pages).where("pos >= 0 OR page_error IS NOT NULL")
    # What stands for a page that can't be read has the place of its first record.
    place = F.when(F.col("page_error").isNotNull(), F.lit(0)).otherwise(F.col("pos"))
    return rows.withColumn("pos", place).drop("page_records")


def unnest_with_pages(pages: DataFrame, *carried: str) -> DataFrame:
    """As ``unnest_pages``, with a row of ``pos`` -1 before the records of each page, which has its number of records.

    That row has ``page_error`` if the page can't be read. ``carried`` are further columns of the pages.
    """
    dated = "landed_at" in pages.columns
    number = F.coalesce("page_no", F.lit(-1))
    none = F.array().cast("array<string>")
    records = F.when(F.col("page_error").isNotNull(), none).otherwise(F.coalesce(F.col("_page.data"), none))
    first = F.array(F.lit(None).cast("string"))
    told = _parsed(pages).select("*", _page_error().alias("page_error"))
    return (
        told.select(
            "branch_id",
            "entity",
            "page_no",
            (F.col("landed_at") if dated else F.lit(None).cast("timestamp")).alias("extracted_at"),
            F.when(F.col("page_error").isNotNull(), F.coalesce(F.md5("body"), F.lit(""))).alias("page_md5"),
            "page_error",
            F.coalesce(F.size("_page.data"), F.lit(0)).cast("bigint").alias("page_records"),
            *carried,
            F.posexplode(F.concat(first, records)).alias("_at", "record"),
        )
        .select(
            "branch_id",
            "entity",
            "page_no",
            (F.col("_at") - 1).alias("pos"),
            (F.shiftleft(number.cast("bigint"), 32) + F.greatest(F.col("_at") - 1, F.lit(0))).alias("ingest_seq"),
            "extracted_at",
            "record",
            "page_error",
            "page_md5",
            "page_records",
            *carried,
        )
    )


def page_completeness(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Per branch and entity: are pages 1..n there, all full but the last, the last short?

    Each page is counted where it lies, and aggregates with map-side partial sums bring the
    counts together, so a branch with most of the pages is no hot spot. A page that landed
    more than once counts once, with the most records it had.
    """
    counted = _parsed(pages).select(
        "branch_id",
        "entity",
        "page_no",
        F.coalesce(F.size("_page.data"), F.lit(0)).cast("bigint").alias("n"),
        _page_error().isNotNull().alias("bad"),
    )
    return completeness(page_counts(counted), page_size)


def page_counts(counted: DataFrame) -> DataFrame:
    """One row for each page number of each pair, out of a row (n records, bad or not) for each page that landed."""
    return counted.groupBy("branch_id", "entity", "page_no").agg(
        F.max("n").alias("n"), F.sum("n").alias("all"), F.bool_or("bad").alias("bad"), F.count("*").alias("times")
    )


def completeness(each: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """What ``page_completeness`` returns, from page counts."""
    short = F.col("n") < page_size
    numbered = F.col("page_no").isNotNull()
    summary = each.groupBy("branch_id", "entity").agg(
        F.count_if(numbered).alias("pages"),
        F.sum(F.greatest("all", F.lit(0))).alias("records"),
        F.max("page_no").alias("last_page"),
        F.max_by("n", "page_no").alias("last_page_size"),
        F.count_if(short & numbered).alias("_short"),
        F.sum(F.when(~numbered, F.col("times")).otherwise(F.col("bad").cast("bigint"))).alias("bad_pages"),
    )
    last_is_short = F.col("last_page_size") < page_size
    return summary.select(
        "branch_id",
        "entity",
        "pages",
        "records",
        "last_page",
        "last_page_size",
        "bad_pages",
        (F.col("_short") - last_is_short.cast("bigint")).alias("short_pages_before_last"),
        (F.col("last_page") - F.col("pages")).alias("missing_pages"),
    ).withColumn(
        "is_complete",
        (F.col("short_pages_before_last") == 0)
        & (F.col("missing_pages") == 0)
        & (F.col("bad_pages") == 0)
        & (F.col("last_page_size") < page_size),
    )


def completeness_over_loads(counts: DataFrame, held: DataFrame, page_size: int = PAGE_SIZE) -> tuple[DataFrame, DataFrame]:
    """Completeness of the pairs of a load, with pages of their sets that came in earlier loads, and all pages of the unfinished sets.

    ``counts`` are the load's page counts, ``held`` those of unfinished sets, as returned here by the load before. A pair's set is
    complete if the load's own pages are, or if they are together with those held; a page that came again counts as it came
    last. ``records`` and ``bad_pages`` are the load's own.
    """
    pairs, key = ["branch_id", "entity"], ["branch_id", "entity", "page_no"]
    earlier = held.join(counts.select(*pairs).distinct(), pairs, "left_semi")
    both = counts.withColumn("_now", F.lit(1)).unionByName(earlier.withColumn("_now", F.lit(0)))
    rest = [c for c in counts.columns if c not in key]
    together = both.groupBy(*key).agg(F.max_by(F.struct(*rest), "_now").alias("_r")).select(*key, "_r.*")
    whole = completeness(together, page_size).select(*pairs, F.col("is_complete").alias("_together"))
    told = completeness(counts, page_size).join(whole, pairs).withColumn("is_complete", F.col("is_complete") | F.col("_together")).drop("_together")
    unfinished = together.where("page_no IS NOT NULL AND NOT bad").join(told.where("NOT is_complete").select(*pairs), pairs, "left_semi")
    return told, unfinished
