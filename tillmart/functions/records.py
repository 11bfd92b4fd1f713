"""From a source record to a raw row: id, checksum, dates, and reasons to reject."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.entities import Entity
from tillmart.functions.payload import computed_once, with_parsed_payload
from tillmart.schemas import RAW_COLUMNS


def canonical_json(variant: Column) -> Column:
    """JSON text that does not depend on the order of keys."""
    return F.to_json(variant)


def payload_checksum(variant: Column) -> Column:
    """md5 of the canonical text; tells versions of a record apart."""
    return F.md5(canonical_json(variant))


def parse_iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to a timestamp; null for null and for anything unreadable.

    It must begin with a whole date: Spark alone would take a time of day as today's.
    """
    return F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))


def bad_date(entity: Entity, text_of) -> Column:
    """Whether one of the entity's dates is given but can't be read."""
    found = F.lit(False)
    for name in entity.dated_by:
        text = text_of(name)
        found = found | (text.isNotNull() & parse_iso_timestamp(text).isNull())
    return found


def source_updated_at(entity: Entity, text_of) -> Column:
    """First readable date among the entity's dating attributes.

    ``text_of`` gives the text column of an attribute name.
    """
    dates = [parse_iso_timestamp(text_of(name)) for name in entity.dated_by]
    return F.coalesce(*dates) if dates else F.lit(None).cast("timestamp")


def name_uuid(*parts: Column) -> Column:
    """UUID-shaped id out of the parts, the same again if a task is run again."""
    digest = F.md5(F.concat_ws("|", *parts))
    pieces = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *pieces)


def record_id(variant: Column, surrogate: Column) -> Column:
    """The record's own id; the surrogate if it has none; null if it is JSON null."""
    # Most records have one, so it is looked for once.
    missing = F.try_variant_get(variant, "$.id", "variant").isNull()
    return F.coalesce(F.try_variant_get(variant, "$.id", "string"), F.when(missing, surrogate))


def reject_reason(record: Column, variant: Column, entity: Entity, text_of=None) -> Column:
    """Why a record (text and parsed form) cannot become a raw row; null if it can.

    ``text_of`` gives the text column of a date's name, where it is there already.
    """
    reason = F.when(variant.isNull() | ~F.ltrim(record).startswith("{"), F.lit("bad_record")).when(
        F.is_variant_null(F.try_variant_get(variant, "$.id", "variant")), F.lit("null_id")
    )
    if entity.dated_by:
        # Dates are read out of the attributes, so those must be an object if given.
        # That is plain where one of the dates was found; only the rest is looked at.
        dates = [F.try_variant_get(variant, f"$.attributes.{name}", "variant") for name in entity.dated_by]
        given = F.try_variant_get(variant, "$.attributes", "variant").isNotNull()
        as_object = F.try_variant_get(variant, "$.attributes", "map<string,variant>")
        undated = F.coalesce(*dates).isNull()
        if text_of is not None:
            undated = F.coalesce(*[text_of(name) for name in entity.dated_by]).isNull() & undated
        reason = reason.when(undated & given & as_object.isNull(), F.lit("bad_attributes"))
    return reason


def to_raw(records: DataFrame, entity: Entity, run_ts: datetime | None = None) -> DataFrame:
    """Raw rows (envelope, payload, checksum) plus ``reject_reason``.

    ``records`` has branch_id, ingest_seq and record (JSON text). ``extracted_at``
    is taken from the records if they carry it, else it is ``run_ts``. ``bad_date`` marks
    records with a date that can't be read.
    """
    stamped = records
    if "extracted_at" not in records.columns:
        if run_ts is None:
            raise ValueError("run_ts is needed for records without extracted_at")
        stamped = records.withColumn("extracted_at", F.lit(run_ts).cast("timestamp"))
    elif run_ts is not None:
        stamped = records.withColumn("extracted_at", F.coalesce("extracted_at", F.lit(run_ts).cast("timestamp")))
    v = F.col("_v")
    surrogate = name_uuid(F.col("branch_id"), F.unix_micros("extracted_at").cast("string"), F.col("ingest_seq").cast("string"))
    page_error = F.col("page_error") if "page_error" in records.columns else F.lit(None).cast("string")
    date_text = lambda name: F.try_variant_get(v, f"$.attributes.{name}", "string")
    return computed_once(stamped, "_v", F.try_parse_json("record")).select(
        record_id(v, surrogate).alias("source_id"),
        "branch_id",
        "extracted_at",
        F.col("record").alias("payload"),
        source_updated_at(entity, date_text).alias("source_updated_at"),
        payload_checksum(v).alias("payload_checksum"),
        "ingest_seq",
        F.coalesce(page_error, reject_reason(F.col("record"), v, entity)).alias("reject_reason"),
        *([F.col("page_md5")] if "page_md5" in records.columns else []),
        bad_date(entity, date_text).alias("bad_date"),
    )


def accepted(rows: DataFrame) -> DataFrame:
    """Raw rows that pass, in the envelope's columns."""
    return rows.where("reject_reason IS NULL").select(*RAW_COLUMNS)


def shred(raw: DataFrame, entity: Entity) -> DataFrame:
    """Raw rows with their leaves and subtrees as columns, the form that is stored."""
    return with_parsed_payload(raw, entity)
