"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Result-relevant settings: one time zone, failing casts, last-wins duplicate keys.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Speed only. AQE starts from many small shuffle partitions and merges them to
# the advisory size, so one setting serves both 60 thousand and 60 billion rows.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.scheduler.mode": "FAIR",
}

# How payloads and checksums are packed, in whatever session: hex digits and JSON take little more than half of what snappy makes of them.
PACKED = "zstd"


def build_session(app_name: str = "tillmart", **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` uses ``__`` for dots and wins."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SEMANTICS, **TUNING}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_semantics(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant settings to a session somebody else made."""
    for key, value in SEMANTICS.items():
        spark.conf.set(key, value)
    # Rebalanced writes and skewed joins rely on it.
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def size_shuffles(spark: SparkSession) -> None:
    """Start shuffles with three partitions per core where the setting is below one.

    AQE merges small partitions but does not cut up those of a window, so on a large
    cluster the number to start from must grow with it.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    cores = spark.sparkContext.defaultParallelism
    if spark.conf.get(key, None) is None and int(spark.conf.get("spark.sql.shuffle.partitions")) < cores:
        spark.conf.set(key, str(3 * cores))


def scratch_folder(spark: SparkSession, otherwise: str) -> str:
    """Folder all executors share for intermediate tables: the cluster's, if it names one."""
    return (spark.conf.get("spark.checkpoint.dir", None) or otherwise).rstrip("/")
