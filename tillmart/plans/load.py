"""Loading one entity: landed pages to staged rows to the raw table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillmart.entities import Entity
from tillmart.functions.records import name_uuid, to_raw
from tillmart.operators.dedupe import first_per_key
from tillmart.operators.merge import changed_records, new_versions
from tillmart.plans import raw_store
from tillmart.plans.warehouse import Conflict, Warehouse, new_version, remove_folder
from tillmart.schemas import AUDIT, RAW_COLUMNS, REJECTS, UNFINISHED
from tillmart.session import scratch_folder
from tillmart.sources.pages import completeness_over_loads, page_counts


REJECT_FOLDER, AUDIT_FOLDER = "rejects", "audit"
UNFINISHED_TABLE = "config/unfinished_pages"
TRIES = 3  # a load is tried against other runners


@dataclass(frozen=True)
class LoadOptions:
    # "batch": a bad record fails the whole load of its branch; "row": only itself.
    on_reject: str = "batch"
    # "last" or "error", for a record twice in a batch of an upserted entity.
    on_duplicate: str = "last"
    # Take only records dated since the last load, where the entity allows it.
    incremental: bool = False


def staged_changes(
    records: DataFrame, raw: DataFrame, entity: Entity, run_ts: datetime, on_duplicate: str = "last"
) -> DataFrame:
    """``changes_of`` the records of one entity, taken from their JSON here."""
    return changes_of(to_raw(records, entity, run_ts), raw, entity, on_duplicate)


def changes_of(rows: DataFrame, raw: DataFrame, entity: Entity, on_duplicate: str = "last") -> DataFrame:
    """What a batch adds to the raw table, with ``action``, and its rejects; no payloads.

    Most records of a full reload are known, so what is shuffled to find that out is
    ids and checksums only. Rejects get a key of their own, which equals no other, and
    so ride along through the merge: the batch is read once for both.
    """
    rejected = F.col("reject_reason").isNotNull()
    what = F.coalesce(F.col("page_md5") if "page_md5" in rows.columns else F.lit(None), F.col("payload_checksum"), F.md5("payload"), F.lit(""))
    own_key = name_uuid(F.lit("reject"), F.col("branch_id"), F.col("ingest_seq").cast("string"), F.unix_micros("extracted_at").cast("string"), what)
    batch = rows.withColumn("source_id", F.when(rejected, own_key).otherwise(F.col("source_id"))).withColumn(
        "payload_checksum", F.when(rejected, own_key).otherwise(F.col("payload_checksum"))
    )
    if entity.merge == "upsert":
        delta = changed_records(raw, batch, on_duplicate)
    else:
        # A batch may hold several landings, so time comes before page and place.
        delta = new_versions(raw, batch, ["extracted_at", "ingest_seq"]).withColumn("action", F.lit("insert"))
    action = F.when(rejected, "reject").otherwise(F.col("action"))
    envelope = [c for c in RAW_COLUMNS if c != "payload"]
    return delta.select(*envelope, action.alias("action"), "reject_reason", "bad_date")


def with_payload(changes: DataFrame, rows: DataFrame) -> DataFrame:
    """Raw rows: the changes and, from the rows they came from (branch_id, ingest_seq, payload and checksum), the payloads.

    The changes are a written table, so Spark knows their size: few of them are
    broadcast and the rows stay where they are, many are joined by a shuffle.
    The checksum is compared too, in case a page number was used twice in a load.
    """
    address = ["branch_id", "ingest_seq", "payload_checksum"]
    found = rows.select(*address, "payload").join(changes, address)
    return first_per_key(found.select(*RAW_COLUMNS), address)


def changed_rows(changes: DataFrame, rows: DataFrame, due: int) -> DataFrame:
    """Raw rows of the ``due`` changes, out of the staged ``rows`` that they are some of.

    Only rows of the changes' landings are looked at. Where there are no more of these than changes, as in a first load, they are the
    changes, and nothing is joined.
    """
    # One row.
    first, last = changes.agg(F.min("extracted_at").cast("string"), F.max("extracted_at").cast("string")).first()
    landed = rows.where(F.col("extracted_at").between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")))
    return landed.select(*RAW_COLUMNS) if landed.count() == due else with_payload(changes, landed)


def since_last_load(rows: DataFrame, entity: Entity, status: DataFrame) -> DataFrame:
    """Staged rows without the records dated before their branch's last extraction. What has no date stays."""
    if entity.incremental_by is None:
        return rows
    since = status.where(F.col("entity") == entity.name).select("branch_id", F.col("last_successful_extraction").alias("_since"))
    old = F.coalesce(F.col("dated") < F.col("_since"), F.lit(False))
    return rows.join(since, "branch_id", "left").where(~old).drop("_since")


def load_entity(
    warehouse: Warehouse,
    staged: DataFrame,
    entity: Entity,
    status: DataFrame,
    run_ts: datetime,
    audit_path: str,
    options: LoadOptions = LoadOptions(),
) -> None:
    """Load all branches of an entity together out of ``staged`` rows (see ``staging``), and write its audit rows.

    The changes are first written to a staging folder. That settles them for the counts,
    for the decision which branches failed, and for the append, and a lost executor
    costs no more than its own tasks. Loading the same run again adds nothing, and if another
    runner adds to the table meanwhile, the changes are found anew against what it added.

    Page counts of page sets that are not complete yet are left beside the audit rows, for the load that brings the rest.
    """
    mine = staged.where(F.col("entity") == entity.name)
    # A page that can't be read is a reject; the rows of other pages are for counting only.
    rows = mine.where("pos >= 0 OR reject_reason IS NOT NULL")
    if options.incremental:
        rows = since_last_load(rows, entity, status)

    scratch = scratch_folder(warehouse.spark, f"{warehouse.root}/_staging")
    rejects_path = f"{warehouse.folder(REJECT_FOLDER)}/{entity.table}/load={new_version()}"
    for attempt in range(TRIES):
        folder = f"{scratch}/{entity.table}-{new_version()}"
        changes_of(rows, raw_store.read_raw(warehouse, entity), entity, options.on_duplicate).write.mode("overwrite").parquet(folder)
        changes = warehouse.spark.read.parquet(folder)
        try:
            _add(warehouse, entity, changes, rows, rejects_path, options)
            break
        except Conflict:
            if attempt + 1 == TRIES:
                raise
            warehouse.refresh()
            remove_folder(warehouse.spark, folder)

    counted = mine.where("pos < 0").select("branch_id", "entity", "page_no", F.col("page_records").alias("n"), F.col("reject_reason").isNotNull().alias("bad"))
    told, unfinished = completeness_over_loads(page_counts(counted), warehouse.read(UNFINISHED_TABLE, UNFINISHED).where(F.col("entity") == entity.name))
    audit = load_audit(told, changes, entity, run_ts, options.on_reject)
    audit.coalesce(1).write.mode("overwrite").parquet(audit_path)
    # Pages of branches that failed were not loaded: they do not count as come.
    failed = warehouse.spark.read.schema(AUDIT).parquet(audit_path).where("status = 'FAILED'").select("branch_id")
    unfinished.join(failed, "branch_id", "left_anti").write.mode("overwrite").parquet(unfinished_path(audit_path))
    remove_folder(warehouse.spark, folder)


def unfinished_path(audit_path: str) -> str:
    """Where a load leaves the page counts of unfinished sets, beside its audit rows."""
    return audit_path.replace(f"/{AUDIT_FOLDER}/", f"/{AUDIT_FOLDER}_pages/")


def _add(warehouse: Warehouse, entity: Entity, changes: DataFrame, rows: DataFrame, rejects_path: str, options: LoadOptions) -> None:
    """Write the rejects of staged changes and add the rest to the raw table."""
    rejects, good = changes.where("action = 'reject'"), changes.where("action <> 'reject'")
    if not rejects.isEmpty():
        rejects.select(*REJECTS.fieldNames()).write.mode("overwrite").parquet(rejects_path)
        if options.on_reject == "batch":
            # Read back from its own small files, whose size Spark knows.
            failed = warehouse.spark.read.schema(REJECTS).parquet(rejects_path).select("branch_id").distinct()
            good = good.join(failed, "branch_id", "left_anti")
    due = good.count()
    if due:
        written = Observation()
        found = changed_rows(good, rows.where("reject_reason IS NULL"), due).observe(written, F.count(F.lit(1)).alias("n"))
        raw_store.add(warehouse, entity, found, good)
        if written.get["n"] != due:
            raise RuntimeError(f"{entity.table}: {due} rows are new or changed, but {written.get['n']} were written")


def read_rejects(warehouse: Warehouse, entity: Entity) -> DataFrame:
    """Where the records that were not loaded lie in their pages, and why not."""
    folder = f"{warehouse.folder(REJECT_FOLDER)}/{entity.table}"
    rows = warehouse.spark.read.schema(REJECTS).option("recursiveFileLookup", True).parquet(folder)
    page = F.shiftright("ingest_seq", 32).cast("int")
    return rows.select(
        F.col("extracted_at").alias("run_ts"),
        "branch_id",
        page.alias("page_no"),
        (F.col("ingest_seq") - F.shiftleft(page.cast("bigint"), 32)).cast("int").alias("pos"),
        "reject_reason",
    )


def load_audit(
    pages: DataFrame, staged: DataFrame, entity: Entity, run_ts: datetime, on_reject: str = "batch"
) -> DataFrame:
    """One row per branch: records extracted, what became of them, and the outcome.

    A branch with rejects has FAILED (unless rejects are taken row by row). One whose pages are not all
    there, or not full, is INCOMPLETE: what came is kept, but it does not count as loaded.

    ``pages`` is the page summary, ``staged`` the staged changes. Records that were held
    already, or came twice in the batch, count as unchanged.
    """
    counts = staged.groupBy("branch_id").agg(
        F.count_if(F.col("action") == "insert").alias("inserted"),
        F.count_if(F.col("action") == "update").alias("updated"),
        F.count_if(F.col("action") == "reject").alias("rejected"),
        F.count_if(F.col("reject_reason") == "bad_page").alias("_bad_pages"),
        F.count_if("bad_date").alias("bad_dates"),
        F.concat_ws(",", F.array_sort(F.collect_set("reject_reason"))).alias("detail"),
    )
    joined = pages.select("branch_id", F.col("records").alias("extracted"), "is_complete").join(counts, "branch_id", "left")
    zero = F.lit(0).cast("bigint")
    rejected = F.coalesce("rejected", zero)
    failed = (rejected > 0) if on_reject == "batch" else F.lit(False)
    inserted = F.when(failed, zero).otherwise(F.coalesce("inserted", zero))
    updated = F.when(failed, zero).otherwise(F.coalesce("updated", zero))
    # An unreadable page is a reject but holds no counted record.
    bad_records = rejected - F.coalesce("_bad_pages", zero)
    unchanged = F.when(failed, zero).otherwise(F.col("extracted") - bad_records - inserted - updated)
    outcome = F.when(failed, "FAILED").when(~F.col("is_complete"), "INCOMPLETE").when(F.col("extracted") == 0, "EMPTY").otherwise("LOADED")
    return joined.select(
        F.lit(run_ts).cast("timestamp").alias("run_ts"),
        "branch_id",
        F.lit(entity.name).alias("entity"),
        "extracted",
        inserted.alias("inserted"),
        updated.alias("updated"),
        unchanged.alias("unchanged"),
        rejected.alias("rejected"),
        F.coalesce("bad_dates", zero).alias("bad_dates"),
        outcome.alias("status"),
        F.nullif(F.col("detail"), F.lit("")).alias("detail"),
    ).select(*AUDIT.fieldNames())
