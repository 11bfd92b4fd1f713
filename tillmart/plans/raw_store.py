"""The raw tables: one table in parts per entity.

Rows carry the payload as it came and, next to it, its leaves as nested text columns.
The JSON is thereby parsed once per version, on arrival; marts and views read only the
nested columns they use. Most tables are only ever added to. For an entity of which just
the last state counts, the parts that hold changed records are written anew, and what was there before goes to a history beside them.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.entities import ENTITIES, Entity
from tillmart.functions.payload import leaf_type
from tillmart.functions.records import shred
from tillmart.plans.parts import PartTable, Place, Reader, shape_of
from tillmart.plans.warehouse import Part, Warehouse
from tillmart.schemas import RAW, RAW_COLUMNS, RECORD_KEY


def stored_schema(entity: Entity) -> T.StructType:
    fields = list(RAW.fields) + [T.StructField("doc", leaf_type(["id"] + [f.path for f in entity.leaves]))]
    if entity.subtrees:
        fields.append(T.StructField("trees", T.StructType([T.StructField(f.column, T.StringType()) for f in entity.subtrees])))
    return T.StructType(fields)


def create_raw_tables(warehouse: Warehouse) -> None:
    """The 17 raw tables, empty, unless they exist."""
    warehouse.create_if_absent(e.table for e in ENTITIES.values())


def table_of(warehouse: Warehouse, entity: Entity) -> PartTable:
    return PartTable(warehouse, entity.table, required=[f.name for f in RAW.fields if not f.nullable])


def reader(warehouse: Warehouse, entity: Entity) -> Reader:
    """How parts of the raw table are read. Those stored before a field was added to the entity get it from their payloads."""
    schema = stored_schema(entity)
    shape = shape_of(schema)

    def read(parts: list[Part], more: dict[str, Column] = {}) -> DataFrame:  # noqa: B006
        known, older = ([p for p in parts if p.rows and (p.shape == shape) == same] for same in (True, False))
        rows = warehouse.read_parts(entity.table, known, schema, more) if known or not older else None
        if older:
            parsed = shred(warehouse.read_parts(entity.table, older, RAW, more), entity).select(*schema.names, *more)
            rows = rows.unionByName(parsed) if rows is not None else parsed
        return rows

    return read


def read_raw(warehouse: Warehouse, entity: Entity, places: Collection[Place] | None = None) -> DataFrame:
    """The raw table as readers see it, or the parts of it at ``places`` (branch and bucket).

    Where just the last state of a record counts, that is what the parts hold: nothing is ranked on reading.
    """
    parts = table_of(warehouse, entity).parts
    return reader(warehouse, entity)([p for p in parts if places is None or (p.branch_id, p.bucket) in places])


def read_history(warehouse: Warehouse, entity: Entity) -> DataFrame:
    """Rows that later ones took the place of, since the table was last compacted."""
    paths = [f"{warehouse.version_path(entity.table, p.version)}/state=replaced" for p in table_of(warehouse, entity).history]
    if not paths:
        return warehouse.spark.createDataFrame([], RAW).select(*RAW_COLUMNS)
    rows = warehouse.spark.read.schema(RAW).option("basePath", warehouse.folder(entity.table)).parquet(*paths)
    return rows.select(*RAW_COLUMNS)


def add(warehouse: Warehouse, entity: Entity, rows: DataFrame, changes: DataFrame) -> None:
    """Add raw rows, in the place of older ones where just the last state counts. ``changes`` is their written list.

    Their leaves and subtrees, which make them some three times as large, are taken out of the payloads where they are written.
    """
    columns = stored_schema(entity).fieldNames()
    # One row a branch.
    counts = {r.branch_id: r.n for r in changes.groupBy("branch_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    table, read = table_of(warehouse, entity), reader(warehouse, entity)
    stored = lambda some: shred(some, entity).select(*columns)
    if entity.merge == "upsert":
        table.replace(rows, changes.select(*RECORD_KEY), counts, read, stored)
    else:
        table.add(rows, counts, read, stored)


def compact(warehouse: Warehouse, entity: Entity) -> None:
    """Rewrite a raw table: one version a part, history forgotten, leaves of older parts taken from their payloads for good."""
    table_of(warehouse, entity).rewrite(reader(warehouse, entity), stored_schema(entity))
