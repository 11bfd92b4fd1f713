"""Physical plans: what is read, what is shuffled, where rows are cut down."""

import re

import pytest
from conftest import as_text, at, item, payment, sale

from tillmart.entities import ENTITIES
from tillmart.functions.records import shred, to_raw
from tillmart.operators.checks import unique_violations
from tillmart.operators.dedupe import latest_per_key
from tillmart.operators.flatten import flatten
from tillmart.operators.merge import changed_records, new_versions
from tillmart.plans.load import staged_changes, with_payload
from tillmart.plans.marts import MARTS, payments, sales_order, sales_order_line
from tillmart.plans.raw_store import stored_schema
from tillmart.schemas import RECORDS


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (\S+)", plan)


@pytest.fixture(scope="module")
def stored(spark, raw, tmp_path_factory):
    """Raw tables as they lie on disk, split by branch."""
    folder = tmp_path_factory.mktemp("stored")
    records = {"items": item("1"), "sales": sale("1"), "payments": payment("1", sale_id="1")}

    def read(name):
        entity = ENTITIES[name]
        path = str(folder / name)
        if not (folder / name).exists():
            shred(raw(name, ("b", at(1), 0, records[name]), ("c", at(1), 1, records[name])), entity).write.partitionBy("branch_id").parquet(path)
        return spark.read.schema(stored_schema(entity)).parquet(path)

    return read


@pytest.fixture(autouse=True)
def long_plans(spark):
    """Whole plans, and those of large tables: no join side fits a broadcast or a bloom filter."""
    settings = {
        "spark.sql.maxMetadataStringLength": "5000",
        "spark.sql.debug.maxToStringFields": "500",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "false",
        # It shows as a subplan even where it can only run with a broadcast.
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("name, build", [("items", sales_order_line), ("sales", sales_order), ("payments", payments)])
def test_mart_reads_its_leaves_and_shuffles_once(stored, name, build):
    plan = plan_of(build(stored(name)))
    (schema,) = read_schemas(plan)
    assert "payload:" not in schema and "trees" not in schema and "comment" not in schema
    assert "from_json" not in plan and "parseJson" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    # The best row of a key within each input partition is all that is shuffled.
    assert "row_number(), 1, Partial" in plan
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_current_sales_need_one_shuffle_and_no_payload(stored):
    """Choosing the last state of a sale and the mart's own choice share a shuffle."""
    plan = plan_of(sales_order(latest_per_key(stored("sales"))))
    (schema,) = read_schemas(plan)
    assert "payload:" not in schema and "trees" not in schema and "comment" not in schema and "customerName" not in schema
    assert plan.count("Exchange hashpartitioning") == 1


def test_latest_first_shuffles_needed_leaves_only(stored):
    plan = plan_of(sales_order_line(stored("items"), latest_first=True))
    (schema,) = read_schemas(plan)
    assert "payload:" not in schema and "comment" not in schema
    assert plan.count("Exchange hashpartitioning") == 1 and "row_number(), 1, Partial" in plan


def test_mart_filters_reach_the_scan(stored):
    plan = plan_of(sales_order(stored("sales")))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "IsNotNull(doc.id)" in pushed and "IsNotNull(doc.attributes.total)" in pushed
    assert "Not(EqualTo(doc.attributes.saleState,CANCELED))" in pushed


def test_branch_filter_prunes_folders(stored):
    plan = plan_of(sales_order(stored("sales")).where("branch_id = 'b'"))
    assert re.search(r"PartitionFilters: \[[^\]]*branch_id[^\]]* = b", plan)


def test_view_has_no_shuffle(stored):
    plan = plan_of(flatten(stored("items"), ENTITIES["items"]))
    assert "Exchange" not in plan
    narrow = plan_of(flatten(stored("items"), ENTITIES["items"]).select("item_id", "price"))
    assert read_schemas(narrow)[0].count(":") <= 5 and "payload" not in read_schemas(narrow)[0]


def test_append_reads_keys_of_the_raw_table_and_shuffles_each_side_once(stored, raw):
    batch = raw("items", ("b", at(2), 0, item("2")))
    plan = plan_of(new_versions(stored("items"), batch))
    assert read_schemas(plan) == ["struct<source_id:string,payload_checksum:string>"]
    assert plan.count("Exchange hashpartitioning") == 2
    assert all("payload_checksum" in keys for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan))


def test_change_detection_reads_keys_only(stored, raw):
    batch = raw("sales", ("b", at(2), 0, sale("2")))
    plan = plan_of(changed_records(stored("sales"), batch))
    assert read_schemas(plan) == ["struct<source_id:string,extracted_at:timestamp,payload_checksum:string,ingest_seq:bigint>"]
    assert plan.count("Exchange hashpartitioning") == 2


def test_unique_check_sums_before_it_shuffles(stored):
    plan = plan_of(unique_violations(stored("items"), ["source_id", "branch_id"]))
    assert "partial_count" in plan and plan.count("Exchange") == 1


def test_payload_is_parsed_once_per_row(raw):
    plan = plan_of(sales_order_line(raw("items", ("b", at(1), 0, item("1")))))
    assert plan.count("from_json(") == 1
    assert plan.count("parseJson(") == 1


def test_no_join_is_forced_to_broadcast(stored, raw):
    plan = plan_of(new_versions(stored("items"), raw("items", ("b", at(2), 0, item("2")))))
    assert "BroadcastHashJoin" not in plan


def test_every_mart_has_one_shuffle_at_most(raw):
    for mart in MARTS.values():
        if mart.entity is not None:
            plan = plan_of(mart.build(raw(mart.entity, ("b", at(1), 0, {"id": "1"}))))
            assert plan.count("Exchange hashpartitioning") == 1


def exchange_inputs(df) -> list[str]:
    """Columns that go into each shuffle."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)


@pytest.mark.parametrize("name, record", [("items", item("2")), ("sales", sale("2"))])
def test_finding_changes_shuffles_no_payload(spark, stored, name, record):
    records = spark.createDataFrame([("b", 1, as_text(record))], RECORDS)
    changes = staged_changes(records, stored(name), ENTITIES[name], at(3))
    inputs = exchange_inputs(changes)
    assert len(inputs) == 2
    assert not any("payload#" in columns or "record#" in columns or "doc#" in columns for columns in inputs)


def test_few_changes_are_broadcast_to_the_records(spark, stored, tmp_path):
    """Without a hint: the written changes are small, so their size allows it."""
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    records = spark.createDataFrame([("b", 1, as_text(item("2")))], RECORDS)
    rows = to_raw(records, ENTITIES["items"], at(3))
    path = str(tmp_path / "changes")
    staged_changes(records, stored("items"), ENTITIES["items"], at(3)).write.parquet(path)
    plan = plan_of(with_payload(spark.read.parquet(path), rows))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(with_payload(spark.read.parquet(path), rows))
    # The choice of one row per address uses the partitioning of the join.
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2
