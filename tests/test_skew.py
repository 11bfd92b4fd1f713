"""Keys that hold a large share of the rows."""

from conftest import at
from pyspark.sql import functions as F

from tillmart.entities import ENTITIES
from tillmart.functions.records import accepted, to_raw
from tillmart.operators.checks import unique_violations
from tillmart.operators.dedupe import latest_per_key
from tillmart.operators.merge import append_new_versions
from tillmart.plans.marts import payments_with_sale

N = 30_000


def skewed(spark, body):
    """A third of the records has one id; the others have one each."""
    hot = F.col("id") % 3 == 0
    key = F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string"))
    return spark.range(N).repartition(8).select(
        F.lit("b").alias("branch_id"),
        F.lit(at(1)).cast("timestamp").alias("extracted_at"),
        F.col("id").alias("ingest_seq"),
        F.concat(F.lit('{"id":"'), key, body, F.lit("}")).alias("record"),
    )


def shuffled_rows(df) -> int:
    """Rows written by all shuffles of the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()

    def walk(node):
        total = 0
        if "ShuffleQueryStage" in node.getClass().getSimpleName():
            metrics = node.shuffle().metrics()
            total += metrics.get("shuffleRecordsWritten").get().value()
            node = node.shuffle()
        children = node.children()
        return total + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(plan)


def test_hot_record_is_cut_down_before_the_shuffle(spark):
    raw = accepted(to_raw(skewed(spark, F.concat(F.lit('","v":'), F.col("id").cast("string"))), ENTITIES["items"]))
    latest = latest_per_key(raw.select("source_id", "branch_id", "extracted_at", "ingest_seq", "payload_checksum"))
    assert shuffled_rows(latest) < 2 * N // 3 + N // 2 + N  # the repartition of the fixture moves N rows
    rows = latest.where("source_id = 'hot'").collect()
    assert [r.ingest_seq for r in rows] == [N - 3]
    assert latest.count() == 2 * N // 3 + 1


def test_many_versions_of_one_record_are_all_kept(spark):
    raw = accepted(to_raw(skewed(spark, F.concat(F.lit('","v":'), F.col("id").cast("string"))), ENTITIES["items"]))
    merged = append_new_versions(raw.where("ingest_seq % 2 = 0"), raw)
    assert merged.count() == N
    assert unique_violations(merged, ["source_id"]).first().copies == N // 3


def test_copies_of_one_version_are_one(spark):
    raw = accepted(to_raw(skewed(spark, F.lit('"')), ENTITIES["items"]))
    merged = append_new_versions(raw.limit(0), raw)
    assert merged.count() == 2 * N // 3 + 1
    assert merged.where("source_id = 'hot'").first().ingest_seq == 0


def test_payments_without_a_sale_do_not_pile_up(spark):
    third = F.col("id") % 3 == 0
    sale = F.when(third, F.lit("")).otherwise(
        F.concat(F.lit(',"sale":{"data":{"id":"'), (F.col("id") % 7).cast("string"), F.lit('"}}'))
    )
    records = spark.range(N).select(
        F.lit("b").alias("branch_id"), F.lit(at(1)).cast("timestamp").alias("extracted_at"), F.lit(0).cast("bigint").alias("ingest_seq"),
        F.concat(F.lit('{"id":"'), F.col("id").cast("string"),
                 F.lit('","attributes":{"amount":1,"createdAt":"2024-01-01"},"relationships":{"paymentMethod":{"data":{"id":"1"}}'),
                 sale, F.lit("}}")).alias("record"),
    )
    sales = spark.range(5).select(
        F.lit("b").alias("branch_id"), F.lit(at(1)).cast("timestamp").alias("extracted_at"), F.lit(0).cast("bigint").alias("ingest_seq"),
        F.concat(F.lit('{"id":"'), F.col("id").cast("string"), F.lit('"}')).alias("record"),
    )
    joined = payments_with_sale(accepted(to_raw(records, ENTITIES["payments"])), accepted(to_raw(sales, ENTITIES["sales"])))
    expected = [i % 3 != 0 and i % 7 < 5 for i in range(N)]
    assert joined.count() == N
    assert joined.where("has_sale").count() == sum(expected)
