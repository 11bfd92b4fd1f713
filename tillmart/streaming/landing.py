"""Loading pages as they land, each file once."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillmart.plans.load import LoadOptions
from tillmart.plans.marts import MARTS
from tillmart.plans.quarantine import held_pages, put_aside, with_held
from tillmart.plans.run import RunReport, run
from tillmart.plans.warehouse import Warehouse
from tillmart.schemas import PAGES
from tillmart.sources.pages import landed


def follow_pages(
    spark: SparkSession,
    folder: str,
    root: str,
    checkpoint: str | None = None,
    options: LoadOptions = LoadOptions(on_reject="row"),
    marts: Iterable[str] = MARTS,
    reports: list[RunReport] | None = None,
) -> StreamingQuery:
    """Load the page files (JSON lines) that came since the last call, then stop.

    The stream's checkpoint, kept with the warehouse, knows which files were loaded, so a scheduled call reads new
    files only. All of them are one load, since the pages of a branch belong together. A batch
    that broke off is loaded again: rows that it had added already are found to be there, so
    nothing is added twice. Made-up ids depend on when a page landed, not on the try.

    A bad record is rejected by itself, unless ``options`` say that it fails its branch. Pages of a branch and
    entity that failed, or that nobody knows, are put aside (see ``quarantine``) and tried again with the next
    files; the stream goes on with the others.
    """
    root = root.rstrip("/")
    checkpoint = checkpoint or f"{root}/_checkpoints/landing"
    marts = list(marts)

    def load(batch: DataFrame, _: int) -> None:
        warehouse = Warehouse(batch.sparkSession, root)
        pages = with_held(batch, held_pages(warehouse))
        report = run(batch.sparkSession, pages, root, datetime.now(timezone.utc), options, marts=marts, register=False)
        if not report.skipped:
            put_aside(warehouse, pages, report)
        if reports is not None:
            reports.append(report)

    return (
        landed(spark.readStream.schema(PAGES).option("mode", "FAILFAST").json(folder))
        .writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
