"""Tables of one row group: their rows are dealt out before they become JSON."""

from pyspark.sql import functions as F

from parity import fixtures as fx


def test_pieces_follow_cores_and_size():
    assert fx.pieces(2_000, 12) == 1
    assert fx.pieces(6_000_000, 12) == 36
    assert fx.pieces(100_000, 12) == 3
    assert fx.pieces(4_000_000_000, 12) == 239


def test_one_row_group_feeds_several_tasks(spark, tmp_path):
    made = spark.range(40_000).select(
        F.col("id").alias("p_partkey"), F.md5(F.col("id").cast("string")).alias("p_name"), F.lit("b").alias("p_brand"),
        F.lit("t").alias("p_type"), (F.col("id") % 50).cast("int").alias("p_size"), F.lit(1.0).alias("p_retailprice"),
    )
    made.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    rows = fx.products(spark, str(tmp_path))
    used = rows.groupBy(F.spark_partition_id().alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in used) == 40_000 * fx.N_BRANCHES
    assert len(used) == 3 * spark.sparkContext.defaultParallelism
    assert max(r.n for r in used) < 2 * min(r.n for r in used)
