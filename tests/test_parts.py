"""Tables in parts: current state, history, marts kept up by change, older landings, runners side by side."""

import random
import threading

import pytest
from conftest import at, item, page, payment, rows_of, sale
from pyspark.sql import functions as F
from test_run import audit_of, go, mart, warehouse  # noqa: F401

from tillmart.entities import ENTITIES
from tillmart.operators.flatten import flatten
from tillmart.plans import parts as parts_module
from tillmart.plans import raw_store
from tillmart.plans.marts import MARTS, mart_table
from tillmart.plans.parts import PartTable
from tillmart.plans.run import STATUS_TABLE, build_marts
from tillmart.plans.warehouse import Conflict, Warehouse
from tillmart.schemas import STATUS

SALES, ITEMS = ENTITIES["sales"], ENTITIES["items"]


@pytest.fixture
def small_parts(monkeypatch):
    """Parts of eight rows, so that a few records make several."""
    monkeypatch.setattr(parts_module, "ROWS_PER_PART", 8)
    monkeypatch.setattr(PartTable.__init__, "__defaults__", (8, ()))


def landing(day, *pages):
    return [(branch, entity, number, body, at(day)) for branch, entity, number, body in pages]


def stored(warehouse, entity):  # noqa: F811
    """Rows in all files of a raw table, shown or not."""
    folder = warehouse.folder(entity.table)
    return warehouse.spark.read.schema("source_id string").option("recursiveFileLookup", True).parquet(folder).count()


def test_older_landings_change_nothing_however_often(warehouse):  # noqa: F811
    new = landing(5, ("001", "sales", 1, page(sale("1", total=2), sale("2"))))
    old = landing(4, ("001", "sales", 1, page(sale("1", total=1), sale("3"))))
    assert go(warehouse, at(6), new, marts=[]).ok
    for hour in (1, 2, 3):
        assert go(warehouse, at(6, hour), old, marts=[]).ok
    assert rows_of(raw_store.read_raw(warehouse, SALES), "source_id", F.day("extracted_at")) == [("1", 5), ("2", 5), ("3", 4)]
    assert stored(warehouse, SALES) == 5  # the part of three rows, and the two it was before the third came
    assert raw_store.read_history(warehouse, SALES).isEmpty()
    assert [r[2:6] for h in (1, 2, 3) for r in audit_of(warehouse, at(6, h))] == [(2, 1, 0, 1), (2, 0, 0, 2), (2, 0, 0, 2)]


def test_current_state_and_history_over_many_loads(warehouse, small_parts):  # noqa: F811
    """Against a dictionary: what readers see, what was replaced, one row a record in the files that count."""
    rng, state, replaced = random.Random(1), {}, []
    for day in range(2, 9):
        ids = rng.sample(range(60), 25)
        totals = {(b, str(i)): rng.randrange(4) for i in ids for b in ("001", "b2")}
        pages = landing(day, *[(b, "sales", 1, page(*[sale(str(i), total=totals[b, str(i)]) for i in ids])) for b in ("001", "b2")])
        assert go(warehouse, at(day, 12), pages, marts=[]).ok
        for key, total in totals.items():
            if key in state and state[key][0] != total:
                replaced.append((*key, state[key][1]))
            if key not in state or state[key][0] != total:
                state[key] = (total, day)
        held = raw_store.read_raw(warehouse, SALES).select("branch_id", "source_id", F.col("doc.attributes.total").cast("int").alias("total"), F.day("extracted_at").alias("day"))
        assert rows_of(held, "*") == sorted([(*k, *v) for k, v in state.items()], key=repr)
    history = raw_store.read_history(warehouse, SALES).select("branch_id", "source_id", F.day("extracted_at"))
    assert rows_of(history, "*") == sorted(replaced, key=repr) and replaced
    table = raw_store.table_of(warehouse, SALES)
    assert len({(p.branch_id, p.bucket) for p in table.parts}) == len(table.parts) > 8
    assert sum(p.rows for p in table.parts) == len(state)
    raw_store.compact(warehouse, SALES)
    assert raw_store.read_raw(warehouse, SALES).count() == len(state) and raw_store.read_history(warehouse, SALES).isEmpty()


def test_only_touched_parts_are_written(warehouse, small_parts):  # noqa: F811
    everything = [sale(str(i)) for i in range(120)]
    assert go(warehouse, at(2), [("001", "sales", 1, page(*everything))], marts=[]).ok
    before = {(p.branch_id, p.bucket): p.version for p in raw_store.table_of(warehouse, SALES).parts}
    everything[7] = sale("7", total=9)
    assert go(warehouse, at(3), [("001", "sales", 1, page(*everything))], marts=[]).ok
    after = {(p.branch_id, p.bucket): p.version for p in raw_store.table_of(warehouse, SALES).parts}
    assert len(before) > 8 and before.keys() == after.keys()
    assert sum(before[place] != version for place, version in after.items()) == 1


def test_no_reader_ranks(warehouse):  # noqa: F811
    assert go(warehouse, at(2), [("001", "sales", 1, page(sale("1")))], marts=[]).ok
    plan = raw_store.read_raw(warehouse, SALES)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def whole(warehouse, name):  # noqa: F811
    """A mart built from all of its raw table."""
    return MARTS[name].build(raw_store.read_raw(warehouse, ENTITIES[MARTS[name].entity]))


def test_marts_kept_up_by_change_equal_whole_rebuilds(warehouse, small_parts):  # noqa: F811
    """Four random loads: changes, cancelations that bring older versions back, new records, branches that grow."""
    rng, names = random.Random(2), ["sales_order", "sales_order_line", "payments"]
    for day in range(2, 6):
        some = [str(i) for i in rng.sample(range(20 * day), 15)]
        pages = []
        for b in ("001", "b2"):
            pages.append((b, "items", 1, page(*[item(i, price=rng.randrange(3), canceled=rng.random() < 0.4) for i in some])))
            pages.append((b, "sales", 1, page(*[sale(i, total=rng.randrange(3), saleState=rng.choice(["OPEN", "CANCELED"])) for i in some])))
            pages.append((b, "payments", 1, page(*[payment(i, sale_id="7", amount=rng.randrange(3), canceled=rng.random() < 0.4) for i in some])))
        assert go(warehouse, at(day), pages, marts=names).ok
        for name in names:
            shown = warehouse.read_published(mart_table(name))
            want = whole(warehouse, name)
            assert shown.columns == want.columns and rows_of(shown, "*") == rows_of(want, "*")
    canceled = raw_store.read_raw(warehouse, ITEMS).where(F.col("doc.attributes.canceled") == "true")
    assert canceled.join(warehouse.read_published(mart_table("sales_order_line")), F.col("source_id") == F.col("id_order_line_source"), "left_semi").count() > 0


def test_marts_read_in_proportion_to_the_change(warehouse, small_parts):  # noqa: F811
    everything = [item(str(i)) for i in range(200)]
    assert go(warehouse, at(2), [("001", "items", 1, page(*everything)), ("b2", "items", 1, page(*everything))], marts=["sales_order_line"]).ok
    first = warehouse.current_version(mart_table("sales_order_line"))
    everything[3] = item("3", price=99)
    assert go(warehouse, at(3), [("001", "items", 1, page(*everything))], marts=["sales_order_line"]).ok
    parts = PartTable(warehouse, mart_table("sales_order_line")).parts
    fresh = [p for p in parts if p.version != first]
    assert len(fresh) == 1 and fresh[0].branch_id == "001" and len(parts) > 20
    # Nothing new: no part is read, no version is written.
    now = warehouse.current_version(mart_table("sales_order_line"))
    assert build_marts(warehouse, ["sales_order_line"]) == {} and warehouse.current_version(mart_table("sales_order_line")) == now
    assert rows_of(warehouse.read_published(mart_table("sales_order_line")), "*") == rows_of(whole(warehouse, "sales_order_line"), "*")


def test_mart_that_failed_catches_up(warehouse, small_parts):  # noqa: F811
    assert go(warehouse, at(2), [("001", "items", 1, page(*[item(str(i)) for i in range(40)]))], marts=["sales_order_line"]).ok
    report = go(warehouse, at(3), [("001", "items", 1, page(item("3", price="much"), item("4", price=7)))], marts=["sales_order_line"])
    assert list(report.mart_errors) == ["sales_order_line"] and len(mart(warehouse, "sales_order_line", "order_line_key")) == 40
    assert build_marts(warehouse, ["sales_order_line"], strict=False) == {}
    lenient = MARTS["sales_order_line"].build(raw_store.read_raw(warehouse, ITEMS), False)
    assert rows_of(warehouse.read_published(mart_table("sales_order_line")), "*") == rows_of(lenient, "*")


def test_field_added_to_an_entity_shows_for_old_rows(warehouse, monkeypatch):  # noqa: F811
    """Without compaction: parts stored before take the new leaf from their payloads, those after from their columns."""
    from dataclasses import replace

    old = replace(ITEMS, fields=tuple(f for f in ITEMS.fields if f.path != "attributes.comment"))
    pages = lambda *records: [("001", "items", 1, page(*records))]
    import tillmart.plans.run as run_module

    monkeypatch.setattr(run_module, "ENTITIES", {**ENTITIES, "items": old})
    assert go(warehouse, at(2), pages(item("1", comment="early")), marts=[]).ok
    assert "comment" not in raw_store.read_raw(warehouse, old).schema["doc"].dataType.simpleString()
    monkeypatch.setattr(run_module, "ENTITIES", ENTITIES)
    assert go(warehouse, at(3), pages(item("1", comment="early"), item("2", comment="late")), marts=[]).ok
    view = flatten(raw_store.read_raw(warehouse, ITEMS), ITEMS)
    assert rows_of(view, "item_id", "comment") == [("1", "early"), ("2", "late")]
    assert len({p.shape for p in raw_store.table_of(warehouse, ITEMS).parts}) == 2
    raw_store.compact(warehouse, ITEMS)
    assert len({p.shape for p in raw_store.table_of(warehouse, ITEMS).parts}) == 1
    assert rows_of(flatten(raw_store.read_raw(warehouse, ITEMS), ITEMS), "item_id", "comment") == [("1", "early"), ("2", "late")]


def test_runner_that_built_upon_an_older_version_is_told(warehouse, spark):  # noqa: F811
    other = Warehouse(spark, warehouse.root)
    other.refresh()
    df = spark.createDataFrame([(1,)], "n int")
    held = other.current_version("some")
    warehouse.publish("some", df, "1")
    with pytest.raises(Conflict, match="some"):
        other.mark_published({"some": "2"}, expected={"some": held})
    assert warehouse.refresh()["some"] == "1"
    other.mark_published({"some": "3"}, expected={"some": "1"})
    assert warehouse.refresh()["some"] == "3"


def test_status_rows_of_interleaved_runners_all_stay(warehouse, spark):  # noqa: F811
    """Six runners that merge rows of their own at once."""
    row = lambda n: spark.createDataFrame([(f"b{n}", "sales", at(2))], STATUS)

    def runner(n):
        Warehouse(spark, warehouse.root).publish_merge(STATUS_TABLE, STATUS, lambda held: held.unionByName(row(n)))

    threads = [threading.Thread(target=runner, args=(n,)) for n in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    warehouse.refresh()
    assert rows_of(warehouse.read(STATUS_TABLE, STATUS), "branch_id") == [(f"b{n}",) for n in range(6)]


def test_loads_of_interleaved_runners_all_stay(warehouse, monkeypatch):  # noqa: F811
    """Another runner's load of the same table comes between the finding of changes and their showing."""
    import tillmart.plans.load as load_module

    real, times = raw_store.add, []

    def slow(wh, entity, rows, changes):
        if not times:
            times.append(1)
            second = Warehouse(wh.spark, wh.root)
            assert go(second, at(3), [("001", "sales", 1, page(sale("1", total=3), sale("5")))], marts=[]).ok
        return real(wh, entity, rows, changes)

    monkeypatch.setattr(load_module.raw_store, "add", slow)
    assert go(warehouse, at(2), [("001", "sales", 1, page(sale("1", total=2), sale("4")))], marts=[]).ok
    held = raw_store.read_raw(warehouse, SALES).select("source_id", F.col("doc.attributes.total").cast("double"))
    assert rows_of(held, "*") == [("1", 3.0), ("4", 5.5), ("5", 5.5)]


@pytest.mark.parametrize("entity", [SALES, ITEMS])
def test_null_in_a_required_column_fails_the_load(warehouse, raw, entity):  # noqa: F811
    good = {"sales": sale, "items": item}[entity.name]
    assert go(warehouse, at(2), [("001", entity.name, 1, page(good("1")))], marts=[]).ok
    from tillmart.functions.records import shred

    rows = shred(raw(entity.name, ("001", at(3), 0, good("2"))), entity).withColumn("payload_checksum", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="payload_checksum"):
        raw_store.add(warehouse, entity, rows, rows.select("source_id", "branch_id"))
    warehouse.refresh()
    assert rows_of(raw_store.read_raw(warehouse, entity), "source_id") == [("1",)]
