"""What costs much to find in a record is looked for once."""

from conftest import at, item, page, sale
from test_staging import CONFIG

from tillmart.plans.staging import staged_rows
from tillmart.schemas import BRANCHES, PAGES


def test_dates_of_staged_records_are_looked_up_once(spark):
    pages = [("001", "sales", 1, page(sale("1", closedAt="2024-01-03T00:00:00Z"), sale("2", createdAt=None)), at(1)), ("001", "items", 1, page(item("3"), {"attributes": {}}), at(1))]
    staged = staged_rows(spark.createDataFrame(pages, PAGES), spark.createDataFrame(CONFIG, BRANCHES), at(2))
    lookups = staged._jdf.queryExecution().optimizedPlan().toString().split("try_variant_get(")
    assert [sum(t.split(", ")[1:3] == [f"$.attributes.{name}", "StringType"] for t in lookups[1:]) for name in ("createdAt", "closedAt")] == [1, 1]
    found = staged.where("pos >= 0").orderBy("source_id").collect()
    assert [(r.source_updated_at and r.source_updated_at.day, r.dated and r.dated.day, r.bad_date, r.reject_reason) for r in found if r.source_id in "123"] == [
        (3, 1, False, None), (None, None, False, None), (1, None, False, None)
    ]
