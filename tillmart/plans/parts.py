"""Tables in parts, of which a load writes only those it touches.

A part is a bucket of the records of one branch, by a hash of the record's id. A branch has as many buckets as its rows
need, so one with a third of all rows is cut finer than the others. A version of such a table is a manifest: for each part the
version it was last written in, where it was written whole, or the versions whose rows make it up, where it is only added to. Parts that a
load leaves alone stay where they are, and readers list folders that the manifest names.

Through the driver go manifests, one small row for each part and version, never rows of the table.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.operators.checks import CheckFailed
from tillmart.plans.warehouse import REPLACED, Part, Warehouse, new_version, remove_folder
from tillmart.schemas import RECORD_KEY
from tillmart.session import PACKED, scratch_folder

# A branch is cut anew, finer, when its buckets hold twice as many on average.
ROWS_PER_PART = 1 << 20
BITS = 1 << 15  # of a bitmap as Spark makes them

Place = tuple[str, int]  # branch and bucket
Reader = Callable[..., DataFrame]  # of parts and, by name, further columns of their files
Maker = Callable[[DataFrame], DataFrame]


def shape_of(schema: T.StructType) -> str:
    """A short name for the columns that rows are stored with: names and types. What may be null differs from plan to plan, and files don't keep it."""
    return hashlib.md5(schema.simpleString().encode()).hexdigest()


def bucket_of(buckets: dict[str, int]) -> Column:
    """The bucket of a row (branch_id, source_id), by the number of buckets of each branch."""
    known = F.create_map(*[F.lit(v) for pair in buckets.items() for v in pair])
    return F.pmod(F.xxhash64("source_id"), F.try_element_at(known, F.col("branch_id"))).cast("int")


class PartTable:
    """Reads and writes one table of ``warehouse``. Rows have branch_id and source_id, besides what is stored."""

    def __init__(self, warehouse: Warehouse, table: str, rows_per_part: int = ROWS_PER_PART, required: Sequence[str] = ()):
        self.warehouse, self.table, self.rows_per_part, self.required = warehouse, table, rows_per_part, list(required)
        self.version = warehouse.current_version(table)
        manifest = warehouse.manifest(table) or []
        self.parts = [p for p in manifest if p.bucket >= 0]
        self.history = [p for p in manifest if p.bucket == REPLACED]
        self._marks = f"{scratch_folder(warehouse.spark, f'{warehouse.root}/_staging')}/{table}-marks-{new_version()}"

    def buckets(self) -> dict[str, int]:
        return {p.branch_id: p.buckets for p in self.parts}

    def signatures(self) -> dict[Place, str]:
        """What each part is made of: the same text as long as nothing was written to it."""
        made: dict[Place, list[str]] = defaultdict(list)
        for p in self.parts:
            made[p.branch_id, p.bucket].append(f"{p.version}/{p.buckets}")
        return {place: ",".join(sorted(versions)) for place, versions in made.items()}

    def _room(self, added: dict[str, int]) -> tuple[dict[str, int], set[str]]:
        """Buckets of each branch once ``added`` rows have come, and which branches must be cut anew for it."""
        held = Counter()
        for p in self.parts:
            held[p.branch_id] += p.rows
        buckets, grown = self.buckets(), set()
        for branch, n in added.items():
            rows = held[branch] + n
            if branch not in buckets or rows > 2 * buckets[branch] * self.rows_per_part:
                if branch in buckets:
                    grown.add(branch)
                buckets[branch] = max(1, -(-rows // self.rows_per_part))
        return buckets, grown

    def add(self, rows: DataFrame, added: dict[str, int], reader: Reader, stored: Maker = lambda rows: rows) -> None:
        """Add rows; ``added`` counts them by branch. Branches that outgrow their buckets are written anew as a whole.

        ``stored`` makes of ``rows`` what is stored. That is done where they are written, so what it adds to them is never shuffled.
        """
        buckets, grown = self._room(added)
        old = [p for p in self.parts if p.branch_id in grown]
        rows = stored(rows.hint("rebalance", "branch_id"))
        if old:
            rows = reader(old).unionByName(rows)
        new = self._write(rows.withColumn("state", F.lit("current")), buckets, rows.schema)
        self._show([p for p in self.parts if p.branch_id not in grown] + new, self.history, rows.schema)

    def replace(self, rows: DataFrame, keys: DataFrame, added: dict[str, int], reader: Reader, stored: Maker = lambda rows: rows) -> None:
        """Put ``rows`` in the place of those with the record keys ``keys``, which go to the history.

        ``keys`` is a written table, whose size Spark knows: few keys are broadcast, and the touched parts are read and
        written where they lie. ``added`` counts the rows by branch, as an upper bound of what is new. ``stored`` is as for ``add``.
        """
        buckets, grown = self._room(added)
        hit = keys.select("branch_id", bucket_of(buckets).alias("bucket")).distinct()
        # One row a part at most.
        touched = {(r.branch_id, r.bucket) for r in hit.collect()}
        old = [p for p in self.parts if p.branch_id in grown or (p.branch_id, p.bucket) in touched]
        rows = stored(rows.hint("rebalance", "branch_id"))
        schema = rows.schema
        state = F.lit("current")
        out = rows.withColumn("state", state)
        if old:
            base = self._marked(old, keys, reader).withColumn("state", F.when(F.col("_hit"), "replaced").otherwise(state))
            out = base.select(*schema.names, "state").unionByName(out)
        new = self._write(out, buckets, schema)
        remove_folder(self.warehouse.spark, self._marks)
        gone = set(old)
        self._show([p for p in self.parts if p not in gone] + new, self.history, schema)

    def _marked(self, old: list[Part], keys: DataFrame, reader: Reader) -> DataFrame:
        """The rows of these parts, and whether one of ``keys`` is theirs (``_hit``).

        Rows are many times as large as keys and stay where they lie: keys are joined with keys, and what comes of it is a bit for each row of
        a file, in a written table whose size decides how it is joined.
        """
        rows = reader(old, {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
        chunk, at = F.shiftright("_row", 15).alias("_chunk"), F.col("_row").bitwiseAND(F.lit(BITS - 1))
        hit = rows.select(*RECORD_KEY, "_file", "_row").join(keys.select(*RECORD_KEY).distinct(), RECORD_KEY, "left_semi")
        schema = T.StructType([rows.schema["_file"], T.StructField("_chunk", T.LongType()), T.StructField("_bits", T.BinaryType())])
        hit.groupBy("_file", chunk).agg(F.bitmap_construct_agg(at).alias("_bits")).write.mode("overwrite").parquet(self._marks)
        bits = self.warehouse.spark.read.schema(schema).parquet(self._marks)
        byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_hit = F.coalesce(F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
        return rows.select("*", chunk).join(bits, ["_file", "_chunk"], "left").withColumn("_hit", is_hit)

    def rewrite(self, reader: Reader, schema: T.StructType) -> None:
        """Write all parts anew, one version each, and forget the history."""
        counted = Counter()
        for p in self.parts:
            counted[p.branch_id] += p.rows
        buckets = {branch: max(1, -(-n // self.rows_per_part)) for branch, n in counted.items()}
        if self.parts:
            rows = reader(self.parts).hint("rebalance", "branch_id")
            self._show(self._write(rows.withColumn("state", F.lit("current")), buckets, schema), [], schema)

    def rebuild(self, rows: DataFrame, source: dict[Place, str], buckets: dict[str, int], dropped: Iterable[Place], version: str) -> list[Part]:
        """Write the parts named in ``source`` (with what each was made from) out of ``rows``, but don't show them yet.

        Returns the parts of the new version, without those ``dropped``. Parts without rows are parts too: they
        need not be made again.
        """
        schema = T.StructType([f for f in rows.schema.fields if f.name != "source_id"])
        written = {(p.branch_id, p.bucket): p for p in self._write(rows.withColumn("state", F.lit("current")), buckets, schema, version)}
        new = [
            written.get(place, Part(*place, buckets[place[0]], version, 0, shape_of(schema), None))._replace(source=made) for place, made in source.items()
        ]
        gone = {*source, *dropped}
        return [p for p in self.parts if (p.branch_id, p.bucket) not in gone] + new

    def _write(self, rows: DataFrame, buckets: dict[str, int], schema: T.StructType, version: str | None = None) -> list[Part]:
        """Write ``rows`` (with state) as parts of a new version; what became of them is read back from the files' footers."""
        self.written = version or new_version()
        path = self.warehouse.version_path(self.table, self.written)
        # The branch's name is in the files too, and never empty in the folder's.
        named = rows.select(*schema.names, "state", F.concat(F.lit("b-"), F.col("branch_id")).alias("part_branch"), bucket_of(buckets).alias("bucket"))
        # Nulls are counted as the rows go by, and stop the version before anybody sees it.
        if self.required:
            seen = Observation()
            named = named.observe(seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in self.required])
        named.write.mode("overwrite").option("compression", PACKED).partitionBy("state", "part_branch", "bucket").parquet(path)
        if self.required and any(seen.get.values()):
            raise CheckFailed(f"{self.table}: nulls in required columns { {c: n for c, n in seen.get.items() if n} }")
        found = self.warehouse.spark.read.schema("state string, part_branch string, bucket int").parquet(path)
        counts = found.groupBy("state", "part_branch", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        self.replaced = sum(r.n for r in counts if r.state == "replaced")
        return [
            Part(branch, r.bucket, buckets[branch], self.written, r.n, shape_of(schema), None)
            for r in counts
            if r.state == "current"
            for branch in [r.part_branch.removeprefix("b-")]
        ]

    def _show(self, parts: list[Part], history: list[Part], schema: T.StructType) -> None:
        if self.replaced:
            history = [*history, Part(None, REPLACED, 0, self.written, self.replaced, None, None)]
        self.warehouse.write_manifest(self.table, self.written, schema, [*parts, *history])
        self.warehouse.mark_published({self.table: self.written}, in_parts=True, expected={self.table: self.version})
        self.parts, self.history, self.version = parts, history, self.written
