"""A landing taken apart once, for all entities that are in it.

Pages of a landing come mixed. They are read and parsed once, each record is parsed once, and what the loads need of it (id,
dates, checksum, reasons to reject, the payload as it came) is written by entity. Names, page counts, changes and payloads
are then read from there, each from just its own columns and folders.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.entities import ENTITIES, Entity
from tillmart.functions.payload import computed_once
from tillmart.functions.records import bad_date, name_uuid, parse_iso_timestamp, payload_checksum, record_id, reject_reason, source_updated_at
from tillmart.session import PACKED
from tillmart.sources.pages import unnest_with_pages

UNKNOWN = "_unknown"


def _by_entity(value, otherwise: Column) -> Column:
    """``value`` of each row's own entity; entities with the same rule share a branch."""
    groups: dict[tuple, list[Entity]] = {}
    for entity in ENTITIES.values():
        rule = (entity.dated_by, entity.requested, entity.incremental_by)
        groups.setdefault(rule, []).append(entity)
    found = None
    for entities in groups.values():
        condition = F.col("entity").isin(*[e.name for e in entities])
        one = value(entities[0])
        found = F.when(condition, one) if found is None else found.when(condition, one)
    return found.otherwise(otherwise)


def requested_fields(variant: Column, entity: Entity) -> Column:
    """A record cut down to the fields asked of the source; as it is if there is no such list or it is no object."""
    if entity.requested is None:
        return variant
    as_map = lambda v: F.try_variant_get(v, "$", "map<string,variant>")
    wanted = lambda k, _: k.isin(*entity.requested)

    def cut(member: Column, value: Column) -> Column:
        nested = member.isin("attributes", "relationships") & as_map(value).isNotNull()
        return F.when(nested, F.to_variant_object(F.map_filter(as_map(value), wanted))).otherwise(value)

    members = F.map_filter(as_map(variant), lambda k, _: k.isin("id", "type", "attributes", "relationships"))
    return F.when(as_map(variant).isNotNull(), F.to_variant_object(F.transform_values(members, cut))).otherwise(variant)


def staged_rows(pages: DataFrame, branches: DataFrame, run_ts: datetime) -> DataFrame:
    """A row for each record of the pages of active branches and known entities, and one with ``pos`` -1 for each page.

    ``branches`` has all configured branches with is_active. Of unknown entities and branches there is the row of
    the page only, under the entity UNKNOWN, with the entity's name in ``reject_reason``. A page that can't be read has its reason there.
    """
    config = branches.select("branch_id", "is_active", F.lit(True).alias("_known"))
    named = pages.join(config, "branch_id", "left")
    known = F.col("entity").isin(*ENTITIES) & F.col("_known")
    # The pages of inactive branches are not to be loaded; those of unknown names must not vanish.
    taken = named.where(F.col("is_active") | F.col("_known").isNull() | ~F.coalesce(known, F.lit(False)))
    strange = ~F.coalesce(known, F.lit(False))
    readable = taken.withColumn("_strange", strange).withColumn("body", F.when(~F.col("_strange"), F.col("body")))
    rows = unnest_with_pages(readable, "_strange").where("pos < 0 OR NOT _strange")
    rows = rows.withColumn("extracted_at", F.coalesce("extracted_at", F.lit(run_ts).cast("timestamp")))

    parsed = computed_once(rows, "_whole", F.try_parse_json("record"))
    parsed = computed_once(parsed, "_v", _by_entity(lambda e: requested_fields(F.col("_whole"), e), F.col("_whole")))
    v, none = F.col("_v"), F.lit(None)
    # The dates' texts are used many times below, and looking one up reads the names of all attributes.
    names = sorted({name for e in ENTITIES.values() for name in (*e.dated_by, e.incremental_by) if name})
    texts = F.struct(*[F.try_variant_get(v, f"$.attributes.{name}", "string").alias(name) for name in names])
    parsed = computed_once(parsed, "_texts", texts)
    is_page = F.col("pos") < 0
    text = lambda name: F.col(f"_texts.{name}")
    surrogate = name_uuid(F.col("branch_id"), F.unix_micros("extracted_at").cast("string"), F.col("ingest_seq").cast("string"))
    reason = _by_entity(lambda e: reject_reason(F.col("record"), v, e, text), none)
    # Only what was cut is printed anew; other payloads stay as they came.
    payload = _by_entity(lambda e: F.col("record") if e.requested is None else F.coalesce(F.to_json(v), F.col("record")), F.col("record"))
    of_record = lambda value: F.when(~is_page, value)
    return parsed.select(
        F.when(F.col("_strange"), F.lit(UNKNOWN)).otherwise(F.col("entity")).alias("entity"),
        "branch_id",
        "page_no",
        "pos",
        "ingest_seq",
        "page_records",
        F.when(F.col("_strange"), F.coalesce("entity", F.lit("")))
        .when(is_page, F.col("page_error"))
        .otherwise(reason)
        .alias("reject_reason"),
        "page_md5",
        of_record(record_id(v, surrogate)).alias("source_id"),
        "extracted_at",
        of_record(payload).alias("payload"),
        of_record(_by_entity(lambda e: source_updated_at(e, text), none.cast("timestamp"))).alias("source_updated_at"),
        of_record(payload_checksum(v)).alias("payload_checksum"),
        F.coalesce(of_record(_by_entity(lambda e: bad_date(e, text), F.lit(False))), F.lit(False)).alias("bad_date"),
        of_record(_by_entity(lambda e: parse_iso_timestamp(text(e.incremental_by)) if e.incremental_by else none.cast("timestamp"), none)).alias("dated"),
    )


def stage(pages: DataFrame, branches: DataFrame, run_ts: datetime, path: str) -> DataFrame:
    """Write ``staged_rows`` by entity; what is returned reads them back.

    Each task writes what it has of each entity, 17 files at most: a landing is not shuffled.
    """
    rows = staged_rows(pages, branches, run_ts)
    # The entity's name is part of the path, and a column of the rows read back.
    rows.write.mode("overwrite").option("compression", PACKED).partitionBy("entity").parquet(path)
    return pages.sparkSession.read.schema(rows.schema).parquet(path)


def landed_names(staged: DataFrame) -> tuple[set[str], set[str], set[str]]:
    """Entities that brought pages, and the unknown entities and branches that did."""
    found = staged.where("pos < 0").select("entity").where(F.col("entity") != UNKNOWN).distinct()
    strange = staged.where((F.col("entity") == UNKNOWN) & (F.col("pos") < 0))
    entities = strange.where(~F.col("reject_reason").isin(*ENTITIES)).select("reject_reason").distinct()
    branches = strange.where(F.col("reject_reason").isin(*ENTITIES)).select("branch_id").distinct()
    # Names only; of unknown ones a few are enough to report.
    return (
        {r.entity for r in found.collect()},
        {r.reject_reason for r in entities.limit(20).collect()},
        {str(r.branch_id) for r in branches.limit(20).collect()},
    )
