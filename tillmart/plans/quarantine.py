"""Pages of branch and entity pairs that did not load, kept until they do.

A pair that fails holds up nobody: its pages are put aside, and the next load tries them again together with what has come
since. A page that has landed again since takes the place of the one put aside; pages without a number give way as soon
as their pair lands again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.entities import ENTITIES
from tillmart.plans.run import BRANCH_TABLE, RunReport
from tillmart.plans.warehouse import Warehouse
from tillmart.schemas import BRANCHES, PAGES

QUARANTINE_TABLE = "quarantine/pages"
_PAIR = ["branch_id", "entity"]


def held_pages(warehouse: Warehouse) -> DataFrame:
    return warehouse.read(QUARANTINE_TABLE, PAGES)


def with_held(batch: DataFrame, held: DataFrame) -> DataFrame:
    """The pages of a batch, and those put aside before that none of it takes the place of. Only names of pages are shuffled of the batch."""
    numbered = held.where("page_no IS NOT NULL").join(batch.select(*_PAIR, "page_no").distinct(), [*_PAIR, "page_no"], "left_anti")
    nameless = held.where("page_no IS NULL").join(batch.select(*_PAIR).distinct(), _PAIR, "left_anti")
    columns = PAGES.fieldNames()
    return batch.select(*columns).unionByName(numbered.select(*columns)).unionByName(nameless.select(*columns))


def failed(warehouse: Warehouse, pages: DataFrame, report: RunReport) -> DataFrame:
    """The pages that ``report`` says did not load: of failed pairs, of entities whose load broke off, and of names nobody knows."""
    pairs = [pair for pair, status in report.not_loaded.items() if status == "FAILED"]
    broken = [name for name in report.load_errors if name in ENTITIES]
    known = warehouse.read(BRANCH_TABLE, BRANCHES).select("branch_id", F.lit(True).alias("_known"))
    # One row a pair; branches are few beside pages.
    listed = warehouse.spark.createDataFrame(pairs, "branch_id string, entity string").withColumn("_failed", F.lit(True))
    told = pages.join(known, "branch_id", "left").join(listed, _PAIR, "left")
    bad = F.col("_failed") | F.col("entity").isin(broken) | F.col("_known").isNull() | ~F.col("entity").isin(*ENTITIES) | F.col("entity").isNull()
    return told.where(F.coalesce(bad, F.lit(False))).select(*PAGES.fieldNames())


def put_aside(warehouse: Warehouse, pages: DataFrame, report: RunReport) -> int:
    """Keep the pages that did not load, in the place of those kept before; returns how many there are."""
    anything = report.load_errors or any(status == "FAILED" for status in report.not_loaded.values())
    if not anything and held_pages(warehouse).isEmpty():
        return 0
    kept = warehouse.publish_merge(QUARANTINE_TABLE, PAGES, lambda _: failed(warehouse, pages, report))
    warehouse.drop_old_versions([QUARANTINE_TABLE])
    return kept.count()
