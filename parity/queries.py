"""All queries by name, and the SQL each is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parity import expected_marts, expected_views, fixtures, operator_queries, stored_queries
from parity.operator_queries import Query, raw_of
from tillmart.entities import ENTITIES
from tillmart.operators.flatten import flatten
from tillmart.plans.marts import MARTS
from tillmart.session import pin_semantics, size_shuffles


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as SQL TIMESTAMP columns have none."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _mart(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        mart = MARTS[name]
        if mart.entity is None:
            return mart.build(fixtures.branch_config(spark, sf_dir))
        return mart.build(raw_of(spark, sf_dir, mart.entity))

    return build


def _view(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The payload and its checksum have other bytes than a SQL engine would print.
        return flatten(raw_of(spark, sf_dir, name), ENTITIES[name]).drop("payload_checksum", "original_payload")

    return build


def _pinned(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        size_shuffles(pin_semantics(spark))
        return comparable(build(spark, sf_dir))

    return run


def _sql_name(prefix: str, name: str) -> str:
    return f"{prefix}_{name.replace('-', '_')}"


def queries() -> dict[str, Query]:
    found = {_sql_name("mart", name): _mart(name) for name in MARTS}
    found |= {_sql_name("view", name): _view(name) for name in expected_views.VIEWS}
    found |= operator_queries.QUERIES | stored_queries.QUERIES
    return {name: _pinned(build) for name, build in found.items()}


def oracle_sql() -> dict[str, str]:
    found = {_sql_name("mart", name): sql for name, sql in expected_marts.MARTS.items()}
    found |= {_sql_name("view", name): sql for name, sql in expected_views.VIEWS.items()}
    return found | operator_queries.ORACLES | stored_queries.ORACLES
