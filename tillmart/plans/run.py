"""A full run: load all entities, note what was loaded, rebuild views and marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.entities import ENTITIES, Entity
from tillmart.operators.checks import assert_unique
from tillmart.operators.merge import set_last_extraction
from tillmart.plans import raw_store
from tillmart.plans.load import AUDIT_FOLDER, UNFINISHED_TABLE, LoadOptions, load_entity, unfinished_path
from tillmart.plans.marts import MARTS, mart_rejects, mart_table, rules
from tillmart.plans.parts import PartTable
from tillmart.plans.raw_store import create_raw_tables, read_raw
from tillmart.plans.staging import landed_names, stage
from tillmart.plans.views import register_marts, register_raw_views
from tillmart.plans.warehouse import Conflict, Warehouse, new_version, remove_folder
from tillmart.schemas import AUDIT, BRANCHES, STATUS, STATUS_KEY, UNFINISHED
from tillmart.session import pin_semantics, scratch_folder, size_shuffles
from tillmart.sources.selection import active_branches

BRANCH_TABLE = "config/branches"
STATUS_TABLE = "config/extraction_status"


@dataclass
class RunReport:
    """Errors by job; the counts are in the audit table."""

    load_errors: dict[str, str] = field(default_factory=dict)
    view_errors: dict[str, str] = field(default_factory=dict)
    mart_errors: dict[str, str] = field(default_factory=dict)
    # (branch, entity): FAILED or INCOMPLETE, where a load ended but not well.
    not_loaded: dict[tuple[str, str], str] = field(default_factory=dict)
    skipped: bool = False

    @property
    def ok(self) -> bool:
        return not (self.load_errors or self.view_errors or self.mart_errors or self.not_loaded)


def _attempt(spark: SparkSession, jobs: dict[str, Callable[[], None]], parallelism: int) -> dict[str, str]:
    """Run independent jobs side by side; returns name -> error of those that failed."""

    def guarded(name: str) -> tuple[str, str | None]:
        try:
            jobs[name]()
            return name, None
        except Exception as error:  # recorded, and the other jobs go on
            return name, f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        outcomes = list(pool.map(inheritable_thread_target(spark)(guarded), jobs))
    return {name: error for name, error in outcomes if error}


def refresh_mart(warehouse: Warehouse, name: str, version: str, strict: bool = True) -> bool:
    """Write a new version of a mart out of the parts of its raw table that changed; False if none did.

    A mart lies in the same parts as its raw table, and each notes what it was made from. All versions of a record are in one
    part, so that an older version comes back when the newest is filtered out. Only the stale parts are read,
    and the others stay where they are. Where the code of marts changed, all are stale.
    """
    mart = MARTS[name]
    entity, table = ENTITIES[mart.entity], PartTable(warehouse, mart_table(name))
    raw = raw_store.table_of(warehouse, entity)
    made = {place: f"{rules()} {strict} {signature}" for place, signature in raw.signatures().items()}
    held = {(p.branch_id, p.bucket): p.source for p in table.parts}
    stale = {place: source for place, source in made.items() if held.get(place) != source}
    gone = [place for place in held if place not in made]
    if not (stale or gone) and warehouse.current_version(table.table) is not None:
        return False
    df = mart.build(read_raw(warehouse, entity, stale.keys()), strict, keyed=True)
    parts = table.rebuild(df, stale, raw.buckets(), gone, version)
    schema = df.drop("source_id").schema
    checked = [p for p in parts if p.version == version] if mart.key_is_the_record else parts
    assert_unique(warehouse.read_parts(table.table, checked, schema), mart.key, table.table)
    warehouse.write_manifest(table.table, version, schema, parts)
    return True


def build_marts(
    warehouse: Warehouse, names: Iterable[str] = MARTS, strict: bool = True, parallelism: int = 4
) -> dict[str, str]:
    """Bring marts up to their raw tables, then show those that came out well, all at once.

    Marts do not depend on each other; one that fails keeps its old version. Unless ``strict``,
    rows with a value that can't be read are left out of a mart and published beside it.
    """
    names, version = list(names), new_version()
    changed = []

    def job(name: str) -> Callable[[], None]:
        mart = MARTS[name]

        def build() -> None:
            if mart.entity is None:
                warehouse.publish(mart_table(name), mart.build(warehouse.read(BRANCH_TABLE, BRANCHES)), version, unique=mart.key)
                return
            if not strict:
                rejects = mart_rejects(read_raw(warehouse, ENTITIES[mart.entity]), name)
                warehouse.publish(mart_table(f"{name}_rejects"), rejects, version)
            if refresh_mart(warehouse, name, version, strict):
                changed.append(name)

        return build

    before = {name: warehouse.current_version(mart_table(name)) for name in names}
    errors = _attempt(warehouse.spark, {name: job(name) for name in names}, parallelism)
    expected = {mart_table(name): before[name] for name in changed}
    try:
        warehouse.mark_published({mart_table(name): version for name in changed}, in_parts=True, expected=expected)
    except Conflict:
        # Another runner brought some of them up to date; this one's raw tables may be newer.
        warehouse.refresh()
        return errors | build_marts(warehouse, [name for name in names if name not in errors], strict, parallelism)
    return errors


def run(
    spark: SparkSession,
    pages: DataFrame,
    root: str,
    run_ts: datetime,
    options: LoadOptions = LoadOptions(),
    strict: bool = True,
    parallelism: int = 4,
    marts: Iterable[str] = MARTS,
    keep_versions: int = 3,
    register: bool = True,
) -> RunReport:
    """Load ``pages`` into the warehouse at ``root`` and rebuild what depends on them.

    ``run_ts`` stamps every row of the run; it is UTC if it has no time zone, and it must
    not go back from run to run. A run may be repeated with its ``run_ts``: what the
    broken attempt added is then found to be there already. ``marts`` names the marts to
    bring up to date, of which ``keep_versions`` stay for readers that are still at it. With
    ``register`` this session knows all views and marts by name afterwards.
    """
    run_ts = run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=timezone.utc)
    size_shuffles(pin_semantics(spark))
    warehouse = Warehouse(spark, root)
    report = RunReport()
    config = warehouse.read(BRANCH_TABLE, BRANCHES)
    if active_branches(config).isEmpty():
        report.skipped = True
        return report
    warehouse.create_if_absent([STATUS_TABLE, UNFINISHED_TABLE])
    create_raw_tables(warehouse)
    status = warehouse.read(STATUS_TABLE, STATUS)

    audit_folder = f"{warehouse.folder(AUDIT_FOLDER)}/run={run_ts:%Y%m%dT%H%M%S%f}"
    staging = f"{scratch_folder(spark, f'{warehouse.root}/_staging')}/landing-{new_version()}"
    staged = stage(pages, config, run_ts, staging)

    def load(entity: Entity) -> Callable[[], None]:
        # One folder per run and entity, overwritten if the run is repeated.
        return lambda: load_entity(warehouse, staged, entity, status, run_ts, _audit_path(audit_folder, entity), options)

    # An entity without pages brought nothing. Names that are none of ours are reported.
    landed, strange_entities, strange_branches = landed_names(staged)
    jobs = {name: load(entity) for name, entity in ENTITIES.items() if name in landed}
    report.load_errors = _attempt(spark, jobs, parallelism)
    if strange_entities:
        report.load_errors["unknown"] = "there are pages of entities that are not known"
    # Branches that nobody configured would vanish from their entities' loads.
    if strange_branches:
        names = ", ".join(sorted(strange_branches))
        report.load_errors["unknown branch"] = f"there are pages of branches that are not configured: {names}"
    if report.load_errors:
        _note_errors(spark, audit_folder, run_ts, report.load_errors)

    done = [ENTITIES[name] for name in jobs if name not in report.load_errors]
    if done:
        rows = _audit_rows(spark, audit_folder).where("branch_id IS NOT NULL")
        # One row for each branch and entity at most.
        bad = rows.where("status IN ('FAILED', 'INCOMPLETE')").select("branch_id", "entity", "status").collect()
        report.not_loaded = {(row.branch_id, row.entity): row.status for row in bad}
        finished = F.lit(datetime.now(timezone.utc)).cast("timestamp").alias("last_successful_extraction")
        loaded = rows.where("status = 'LOADED'").select("branch_id", "entity", finished)
        warehouse.publish_merge(STATUS_TABLE, STATUS, lambda held: set_last_extraction(held, loaded), unique=STATUS_KEY, required=STATUS_KEY)
        _keep_unfinished(warehouse, rows, [unfinished_path(_audit_path(audit_folder, entity)) for entity in done])
    remove_folder(spark, staging)
    if register:
        report.view_errors = register_raw_views(warehouse, strict)
    marts = list(marts)
    report.mart_errors = build_marts(warehouse, marts, strict, parallelism)
    replaced = [e.table for e in ENTITIES.values() if e.merge == "upsert"]
    warehouse.drop_old_versions([mart_table(name) for name in marts] + [STATUS_TABLE] + replaced, keep_versions)
    if register:
        register_marts(warehouse)
    return report


def _audit_path(folder: str, entity: Entity) -> str:
    return f"{folder}/table={entity.table}"


def _keep_unfinished(warehouse: Warehouse, audit: DataFrame, paths: list[str]) -> None:
    """Note the pages of page sets that are not complete; pairs that failed keep what was noted before."""
    spark, pairs = warehouse.spark, ["branch_id", "entity"]
    came = spark.read.schema(UNFINISHED).parquet(*paths)
    settled = audit.where("status <> 'FAILED'").select(*pairs).distinct()
    # Most runs leave nothing unfinished behind, and there is nothing to write then.
    if came.isEmpty() and warehouse.read(UNFINISHED_TABLE, UNFINISHED).isEmpty():
        return
    warehouse.publish_merge(UNFINISHED_TABLE, UNFINISHED, lambda held: held.join(settled, pairs, "left_anti").unionByName(came))
    for path in paths:
        remove_folder(spark, path)


def _note_errors(spark: SparkSession, audit_folder: str, run_ts: datetime, errors: dict[str, str]) -> None:
    """Audit rows of entities whose load broke off for all branches."""
    rows = [(run_ts, None, entity, None, None, None, None, None, None, "FAILED", error) for entity, error in errors.items()]
    spark.createDataFrame(rows, AUDIT).coalesce(1).write.mode("overwrite").parquet(f"{audit_folder}/table=_errors")


def _audit_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(AUDIT).option("recursiveFileLookup", True).parquet(folder)


def read_audit(warehouse: Warehouse) -> DataFrame:
    """Audit rows of all runs."""
    return _audit_rows(warehouse.spark, warehouse.folder(AUDIT_FOLDER))
