"""What is stored is read from its own columns, not taken out of the payload again."""

import pytest
from conftest import at, item, page, rows_of, sale
from test_run import go, warehouse  # noqa: F401

from tillmart.entities import ENTITIES
from tillmart.plans import raw_store
from tillmart.plans.parts import shape_of


@pytest.mark.parametrize("name, record", [("sales", sale), ("items", item)])
def test_stored_rows_are_not_parsed_again(warehouse, name, record):  # noqa: F811
    entity = ENTITIES[name]
    for day, comment in ((2, "early"), (3, "late")):
        assert go(warehouse, at(day), [("001", name, 1, page(record("1", comment=comment), record("2", comment="same")))], marts=[]).ok
    assert {p.shape for p in raw_store.table_of(warehouse, entity).parts} == {shape_of(raw_store.stored_schema(entity))}
    rows = raw_store.read_raw(warehouse, entity)
    assert "json" not in rows._jdf.queryExecution().optimizedPlan().toString().lower()
    kept = [("1", "late")] if entity.merge == "upsert" else [("1", "early"), ("1", "late")]
    assert rows_of(rows, "source_id", "doc.attributes.comment") == [*kept, ("2", "same")]
