"""Key and null checks, and additive schema changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.entities import Entity
from tillmart.functions.payload import leaf, typed, with_parsed_payload
from tillmart.schemas import Contract


class CheckFailed(Exception):
    """A table breaks one of its constraints and must not be published."""


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with ``copies``; null keys are exempt."""
    present = df.select(*keys).dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    found = unique_violations(df, keys).limit(1).collect()
    if found:
        raise CheckFailed(f"{name}: key {list(keys)} is not unique, e.g. {found[0].asDict()}")


def null_columns(columns: Sequence[str]):
    """Names of the given columns that are null in a row."""
    flags = [F.when(F.col(c).isNull(), F.lit(c)) for c in columns]
    return F.array_compact(F.array(*flags))


def split_by_required(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that have all required columns, and the rest with ``missing``."""
    flagged = df.withColumn("missing", null_columns(columns))
    complete = flagged.where(F.size("missing") == 0).drop("missing")
    return complete, flagged.where(F.size("missing") > 0)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of nulls of each column, from one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def assert_not_null(df: DataFrame, columns: Sequence[str], name: str = "table") -> None:
    if not columns:
        return
    counts = null_counts(df, columns).first().asDict()
    broken = {c: n for c, n in counts.items() if n}
    if broken:
        raise CheckFailed(f"{name}: nulls in required columns {broken}")


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """How a mart stands against its documented target: one row per column."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = contract.columns.fields
    counted = df.agg(
        *[
            (F.count_if(F.col(f.name).isNull()) if f.name in have else F.lit(None).cast("bigint")).alias(f.name)
            for f in wanted
        ]
    )
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("wanted_type"),
            F.lit(have.get(f.name)).cast("string").alias("actual_type"),
            F.lit(f.name in contract.required).alias("required"),
            F.col(f.name).alias("nulls"),
        )
        for f in wanted
    ]
    return counted.select(F.inline(F.array(*rows)))


def evolve_schema(df: DataFrame, columns: T.StructType) -> DataFrame:
    """Add the columns that are missing, as nulls; keep the rest as it is."""
    missing = [f for f in columns.fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def cast_failures(raw: DataFrame, entity: Entity) -> DataFrame:
    """Raw rows with values that do not fit their column's type, and which columns."""
    parsed = with_parsed_payload(raw, entity)
    flags = [
        F.when(leaf(f.path).isNotNull() & typed(leaf(f.path), f.type, strict=False).isNull(), F.lit(f.column))
        for f in entity.leaves
        if f.type != "string"
    ]
    if not flags:
        return parsed.select("source_id", "branch_id", "extracted_at", F.array().cast("array<string>").alias("bad")).where("false")
    return parsed.select(
        "source_id", "branch_id", "extracted_at", F.array_compact(F.array(*flags)).alias("bad")
    ).where(F.size("bad") > 0)
