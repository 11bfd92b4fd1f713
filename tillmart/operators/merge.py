"""Merges into keyed tables, as joins on the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.operators.dedupe import first_per_key, latest_per_key
from tillmart.schemas import ARRIVAL_ORDER, RECORD_KEY, VERSION_KEY


def new_versions(raw: DataFrame, batch: DataFrame, order: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    """Batch rows whose (record, checksum) is not yet held, first arrival of each by ``order``.

    The join hashes on all three columns, so the many versions of one record spread
    over the reducers, and it reads only those three columns of the raw table. The
    ranking before it leaves the batch partitioned and sorted the way the join needs. The raw table is never
    broadcast: keys taken out of a parsed payload look far smaller to Spark than they are.
    """
    held = raw.select(*VERSION_KEY).hint("merge")
    return first_per_key(batch, VERSION_KEY, order).join(held, VERSION_KEY, "left_anti")


def append_new_versions(raw: DataFrame, batch: DataFrame) -> DataFrame:
    """The raw table after the batch: old rows untouched, new versions added."""
    return raw.unionByName(new_versions(raw, batch).select(*raw.columns))


def _one_per_record(batch: DataFrame, on_duplicate: str) -> DataFrame:
    if on_duplicate == "last":
        return latest_per_key(batch, RECORD_KEY)
    if on_duplicate != "error":
        raise ValueError(f"on_duplicate is 'last' or 'error', not {on_duplicate!r}")
    # The check is part of the plan: it costs no pass of its own, and fails whatever uses the rows.
    ranked = batch.withColumn("_n", F.row_number().over(Window.partitionBy(*RECORD_KEY).orderBy(*ARRIVAL_ORDER)))
    twice = F.raise_error(F.lit("the batch holds a record more than once")).cast("boolean")
    return ranked.where(F.when(F.col("_n") > 1, twice).otherwise(F.lit(True))).drop("_n")


def _supersedes(held: Column) -> Column:
    """Whether a row changes the content of ``held``, a struct of the arrival order, and arrived after it."""
    arrival = F.struct(*ARRIVAL_ORDER)
    return held.isNull() | (~F.col("payload_checksum").eqNullSafe(held["payload_checksum"]) & (arrival > held))


def changed_records(current: DataFrame, batch: DataFrame, on_duplicate: str = "last") -> DataFrame:
    """Batch rows that insert a record or change its content, with ``action``.

    ``current`` has one row per record. What is left out is unchanged, or arrived before what is held: an older landing
    that is loaded late, or again, changes nothing. ``current`` is never broadcast, see ``new_versions``.
    """
    held = current.select(*RECORD_KEY, F.struct(*ARRIVAL_ORDER).alias("_held")).hint("merge")
    joined = _one_per_record(batch, on_duplicate).join(held, RECORD_KEY, "left")
    return (
        joined.where(_supersedes(F.col("_held")))
        .withColumn("action", F.when(F.col("_held").isNull(), "insert").otherwise("update"))
        .drop("_held")
    )


def upsert_latest(raw: DataFrame, batch: DataFrame, on_duplicate: str = "last") -> DataFrame:
    """The table after the batch, one row per record.

    A record with the same checksum keeps its old row, extraction time included; so does one whose new row arrived before it.
    """
    rest = [c for c in raw.columns if c not in RECORD_KEY]
    old = raw.select(*RECORD_KEY, F.struct(*rest).alias("_old"))
    new = _one_per_record(batch, on_duplicate).select(*RECORD_KEY, F.struct(*rest).alias("_new"))
    arrival = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in ARRIVAL_ORDER])
    differs = ~F.col("_old.payload_checksum").eqNullSafe(F.col("_new.payload_checksum"))
    later = F.col("_old").isNull() | (differs & (arrival("_new") > arrival("_old")))
    row = F.when(F.col("_new").isNotNull() & later, F.col("_new")).otherwise(F.col("_old"))
    return (
        old.join(new, RECORD_KEY, "full_outer").select(*RECORD_KEY, row.alias("_row"))
        .select(*RECORD_KEY, "_row.*").select(*raw.columns)
    )


def merge_by_key(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    on_insert: dict[str, Column] | None = None,
) -> DataFrame:
    """Insert new keys and refresh ``update_columns`` of known ones.

    Other columns of known keys stay; those of new keys come from ``on_insert``,
    else from ``updates``, else they are null. ``updates`` has one row per key.
    """
    on_insert = on_insert or {}
    known, given = F.col("_known").isNotNull(), F.col("_given").isNotNull()
    joined = (
        target.withColumn("_known", F.lit(True)).alias("t")
        .join(updates.withColumn("_given", F.lit(True)).alias("u"), list(keys), "full_outer")
    )

    def value(column: str) -> Column:
        if column in keys:
            return F.col(column)
        held = F.col(f"t.{column}")
        fresh = F.col(f"u.{column}") if column in updates.columns else F.lit(None)
        first = on_insert.get(column, fresh)
        if column in update_columns:
            return F.when(~known, first).when(given, fresh).otherwise(held)
        return F.when(known, held).otherwise(first)

    types = {f.name: f.dataType for f in target.schema.fields}
    return joined.select(*[value(c).cast(types[c]).alias(c) for c in target.columns])


def merge_branches(branches: DataFrame, seed: DataFrame, now: Column) -> DataFrame:
    """Refresh names of known branches and add new ones as active."""
    return merge_by_key(
        branches,
        seed.withColumn("updated_at", now),
        ["branch_id"],
        ["source_branch", "branch_name", "updated_at"],
        on_insert={"is_active": F.lit(True), "created_at": now, "updated_at": now},
    )


def set_last_extraction(status: DataFrame, loaded: DataFrame) -> DataFrame:
    """Status after a load; ``loaded`` has the pairs that brought records, and when."""
    newest = loaded.groupBy("branch_id", "entity").agg(
        F.max("last_successful_extraction").alias("last_successful_extraction")
    )
    return merge_by_key(status, newest, ["branch_id", "entity"], ["last_successful_extraction"])


def last_extraction(status: DataFrame, branch_id: str, entity: str) -> DataFrame:
    """The status row of one pair, empty if it was never loaded."""
    return status.where((F.col("branch_id") == branch_id) & (F.col("entity") == entity)).select(
        "last_successful_extraction"
    )


def delete_by_key(df: DataFrame, column: str, value) -> DataFrame:
    """All rows but those with that key; rows with a null key stay."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))
