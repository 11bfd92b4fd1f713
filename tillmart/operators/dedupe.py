"""One row per key.

Both forms rank with row_number and keep rank 1. Spark then drops all but the best
row of each key within every input partition before it shuffles, so a key that
holds a large share of the rows reaches its reducer as a few rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.schemas import ARRIVAL_ORDER, RECORD_KEY


def _top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def latest_per_key(
    df: DataFrame, keys: Sequence[str] = RECORD_KEY, order: Sequence[str] | None = None
) -> DataFrame:
    """The row that arrived last for each key: by the columns of ARRIVAL_ORDER that ``df`` has, unless told otherwise."""
    order = [c for c in ARRIVAL_ORDER if c in df.columns] if order is None else order
    return _top_row(df, keys, [F.col(c).desc() for c in order])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    """The row that arrived first for each key."""
    return _top_row(df, keys, [F.col(c).asc() for c in order])


def latest_per_key_by_max(
    df: DataFrame, keys: Sequence[str] = RECORD_KEY, order: Sequence[str] = ARRIVAL_ORDER
) -> DataFrame:
    """Same result as an aggregate; kept to compare the two plans."""
    row = F.struct(*[c for c in df.columns if c not in keys])
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)
