"""Raw rows to typed columns, one view per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.entities import Entity
from tillmart.functions.payload import leaf, typed, with_parsed_payload

ENVELOPE = ["source_id", "branch_id", "extracted_at", "payload_checksum"]


def flatten(raw: DataFrame, entity: Entity, strict: bool = True, ordered: bool = False) -> DataFrame:
    """Every version of every record with its attributes and relationships as columns.

    The global sort of ``ordered`` costs a range shuffle, so it is left to the reader.
    """
    parsed = with_parsed_payload(raw, entity)
    columns = [
        F.col(f"trees.{f.column}").alias(f.column)
        if f.type == "json"
        else typed(leaf(f.path), f.type, strict).alias(f.column)
        for f in entity.fields
    ]
    view = parsed.select(
        *ENVELOPE, leaf("id").alias(entity.id_column), *columns, F.col("payload").alias("original_payload")
    )
    if ordered:
        view = view.orderBy("source_id", "branch_id", F.col("extracted_at").desc())
    return view
