"""Helpers that several operators share: tables kept in the shared folder, and small column expressions."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.session import scratch_folder

# What counts as white space between words, as a Java regular expression and as characters.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACES = (" ", "\t", "\n", "\x0b", "\f", "\r")


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, computed once and read back from a table in the folder that all executors share.

    This cuts the lineage: a lost executor costs the reading of some files, and two readers
    see the same rows. The folder is ``spark.checkpoint.dir``, else the warehouse, which must not be a
    folder of one machine unless Spark runs on one.
    """
    return written(df, name)[0]


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``kept``, with the folder of the table, for those who remove it when they are done."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    shared, warehouse = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.sql.warehouse.dir")
    if not shared and urlparse(warehouse).scheme in ("", "file") and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{scratch_folder(spark, warehouse)}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_spaces(text: Column) -> Column:
    """The text with every white space character deleted; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for space in SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
