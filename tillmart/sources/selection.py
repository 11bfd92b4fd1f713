"""What to take from the source: branches, fields, and records since a date."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.entities import Entity
from tillmart.functions.payload import computed_once
from tillmart.functions.records import parse_iso_timestamp


def active_branches(branches: DataFrame) -> DataFrame:
    """Branches to load; an empty result means there is nothing to do."""
    return branches.where("is_active").select("branch_id", "source_branch", "branch_name")


def project_fields(records: DataFrame, entity: Entity) -> DataFrame:
    """Cut records down to the fields asked of the source, if the entity has such a list."""
    if entity.requested is None:
        return records
    wanted = [F.lit(name) for name in entity.requested]
    # Values stay variants, so nothing but the choice of keys changes.
    parts = F.from_json(
        "record", "id variant, type variant, attributes map<string,variant>, relationships map<string,variant>"
    )

    def pruned(member: str):
        return F.map_filter(F.col(f"_r.{member}"), lambda k, _: k.isin(*wanted)).alias(member)

    kept = F.to_json(
        F.struct(F.col("_r.id").alias("id"), F.col("_r.type").alias("type"), pruned("attributes"), pruned("relationships"))
    )
    # Only objects can be cut; anything else goes on as it is and is rejected later.
    return (
        computed_once(records, "_r", parts)
        .withColumn("record", F.when(F.trim("record").startswith("{") & F.col("_r").isNotNull(), kept).otherwise(F.col("record")))
        .drop("_r")
    )


def incremental_filter(records: DataFrame, entity: Entity, since: datetime | None) -> DataFrame:
    """Records dated at or after ``since``; all of them if it is None or the entity is undated.

    What has no readable date may be new, and what is no record is to be rejected: both stay.
    """
    if since is None or entity.incremental_by is None:
        return records
    created = _attribute_date(entity.incremental_by)
    return records.where(created.isNull() | (created >= F.lit(since).cast("timestamp")))


def incremental_filter_by_status(records: DataFrame, entity: Entity, status: DataFrame) -> DataFrame:
    """The same with each branch's own last extraction; a new branch is taken whole.

    The status has one row per branch and entity, so its share for an entity is small, and
    Spark's own size rule decides how it gets to the records.
    """
    if entity.incremental_by is None:
        return records
    since = status.where(F.col("entity") == entity.name).select(
        "branch_id", F.col("last_successful_extraction").alias("_since")
    )
    created = _attribute_date(entity.incremental_by)
    old = F.coalesce(created < F.col("_since"), F.lit(False))
    return records.join(since, "branch_id", "left").where(~old).drop("_since")


def _attribute_date(name: str):
    return parse_iso_timestamp(F.get_json_object("record", f"$.attributes.{name}"))
