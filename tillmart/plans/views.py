"""Registering raw views and published marts under the names queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmart.entities import ENTITIES, Entity
from tillmart.operators.flatten import flatten
from tillmart.plans.marts import MARTS, mart_table
from tillmart.plans.raw_store import read_raw
from tillmart.plans.warehouse import Warehouse


def view_name(entity: Entity) -> str:
    return "view_" + entity.name.replace("-", "_")


def register_view(name: str, df: DataFrame) -> None:
    """Create the view or take the place of the one with that name."""
    df.createOrReplaceTempView(name)


def register_raw_views(warehouse: Warehouse, strict: bool = True, ordered: bool = False) -> dict[str, str]:
    """All 15 views; returns name -> error for those that could not be made."""
    errors = {}
    for entity in ENTITIES.values():
        if not entity.has_view:
            continue
        try:
            register_view(view_name(entity), flatten(read_raw(warehouse, entity), entity, strict, ordered))
        except Exception as error:  # one bad view must not stop the others
            errors[view_name(entity)] = f"{type(error).__name__}: {error}"
    return errors


def register_marts(warehouse: Warehouse) -> None:
    """Each published mart, under its own name and the one reports know it by."""
    for name, mart in MARTS.items():
        if warehouse.current_version(mart_table(name)) is None:
            continue
        df = warehouse.read_published(mart_table(name))
        register_view(name, df)
        register_view(mart.report_name, df)


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """Everything a reader needs: all views and marts, ready for ``spark.sql``."""
    warehouse = Warehouse(spark, root)
    register_raw_views(warehouse)
    register_marts(warehouse)
    return warehouse
