"""Reading JSON payloads: text leaves, kept subtrees, typed columns.

A payload is parsed once into a struct column ``doc`` that has only the leaves
asked for, all as text, so later steps are plain struct access. Stored raw tables
already hold ``doc`` and ``trees``; on those the parse is skipped and parquet
reads just the nested columns in use.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.entities import Entity, Field


def leaf_type(paths: Iterable[str]) -> T.StructType:
    """Struct type with a text leaf at each dotted path."""
    nested: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        nested.setdefault(head, [])
        if rest:
            nested[head].append(rest)
    return T.StructType(
        [T.StructField(name, leaf_type(rest) if rest else T.StringType()) for name, rest in nested.items()]
    )


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that costs much, such as a parse, so that it runs once per row.

    Catalyst pushes filters below a plain projection and repeats its expressions inside
    them, one parse per condition. It does not push them below an explode.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_doc(raw: DataFrame, paths: Iterable[str]) -> DataFrame:
    """Add ``doc`` with the leaves at ``paths``, unless the table stores it."""
    if "doc" in raw.columns:
        return raw
    return computed_once(raw, "doc", F.from_json("payload", leaf_type(paths)))


def leaf(path: str) -> Column:
    """Text at a dotted path of ``doc``; null if absent, JSON null or of another shape."""
    return F.col("doc." + ".".join(f"`{part}`" for part in path.split(".")))


def variant_subtree(variant: Column, path: str) -> Column:
    """JSON text of the subtree at ``path``: ``null`` for JSON null, null if absent."""
    return F.to_json(F.try_variant_get(variant, f"$.{path}", "variant"))


def with_trees(raw: DataFrame, subtrees: list[Field]) -> DataFrame:
    """Add ``trees``, the subtrees kept as JSON text, unless the table stores it."""
    if "trees" in raw.columns or not subtrees:
        return raw
    parsed = computed_once(raw, "_v", F.parse_json("payload"))
    trees = F.struct(*[variant_subtree(F.col("_v"), f.path).alias(f.column) for f in subtrees])
    return parsed.withColumn("trees", trees).drop("_v")


def with_parsed_payload(raw: DataFrame, entity: Entity) -> DataFrame:
    """Both of the above for everything the entity's view shows."""
    return with_trees(with_doc(raw, ["id"] + [f.path for f in entity.leaves]), entity.subtrees)


def half_even_int(text: Column, strict: bool = True) -> Column:
    """Text to a whole number by way of double, halves to the even neighbour.

    BIGINT, so that record ids beyond 2^31 do not overflow.
    """
    return typed(F.rint(typed(text, "double", strict)), "bigint", strict)


def typed(text: Column, type: str, strict: bool = True) -> Column:
    """Cast; a bad value fails the query if strict, else turns into null."""
    if type in ("string", "json"):
        return text
    return text.cast(type) if strict else text.try_cast(type)


def varchar(text: Column, length: int = 255) -> Column:
    """Silent truncation, as an explicit cast to VARCHAR(n) does."""
    return F.left(text, F.lit(length))


def branch_key(id_text: Column) -> Column:
    """Key of a record across branches; null if the id is null."""
    return F.concat(id_text, F.lit("-"), F.col("branch_id"))


def all_present(*paths: str) -> Column:
    """True where every leaf has a value."""
    condition = F.lit(True)
    for path in paths:
        condition = condition & leaf(path).isNotNull()
    return condition
