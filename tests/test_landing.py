"""Pages loaded as a stream of files."""

import json

from conftest import item, rows_of, sale

from tillmart.entities import ENTITIES
from tillmart.plans import raw_store
from tillmart.plans.run import BRANCH_TABLE, read_audit
from tillmart.plans.warehouse import Warehouse
from tillmart.schemas import BRANCHES
from tillmart.session import scratch_folder
from tillmart.streaming.landing import follow_pages


def land(folder, name, entity, *records):
    folder.mkdir(exist_ok=True)
    line = {"branch_id": "b", "entity": entity, "page_no": 1, "body": {"data": list(records)}}
    (folder / name).write_text(json.dumps(line))


def test_each_file_is_loaded_once(spark, tmp_path):
    pages, root = tmp_path / "pages", str(tmp_path / "wh")
    warehouse = Warehouse(spark, root)
    warehouse.publish(BRANCH_TABLE, spark.createDataFrame([("b", "s", "B", True, None, None)], BRANCHES), "1")

    def follow():
        reports = []
        follow_pages(spark, str(pages), root, marts=["sales_order"], reports=reports).awaitTermination()
        warehouse.refresh()
        return reports

    land(pages, "1.json", "sales", sale("1"), sale("2"))
    assert [r.ok for r in follow()] == [True]
    land(pages, "2.json", "sales", sale("2", saleState="CANCELED"), sale("3"))
    land(pages, "3.json", "items", item("1"))
    assert [r.ok for r in follow()] == [True]
    assert follow() == []
    assert rows_of(warehouse.read_published("marts/sales_order"), "id_order") == [(1,), (3,)]
    assert raw_store.read_raw(warehouse, ENTITIES["items"]).count() == 1
    assert rows_of(read_audit(warehouse), "entity", "extracted", "inserted", "updated") == [
        ("items", 1, 1, 0), ("sales", 2, 1, 1), ("sales", 2, 2, 0)
    ]


def test_scratch_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_folder(spark, "/own/") == (named or "/own").rstrip("/")
