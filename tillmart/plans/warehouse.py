"""Where tables live, and how a new version of one takes the place of the old.

Every table is a folder of versions. One small log lists what was published and when,
and readers take the version of a table that was published last. A version becomes
visible by an entry in that log after it is written and checked, so a failed job
leaves the old version in place, and the marts of one run change over together.

Entries are numbered, and a number is only ever created, never written over. Of two runners that publish at once one
gets the next number and the other finds it taken; it looks at the log again, and if what it built upon is no longer
the current version, it has to build anew (``Conflict``). So no runner undoes another's work without knowing of it.
The file system must refuse to create a file that exists, as HDFS does.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterable, Sequence
from datetime import datetime, timezone
from typing import NamedTuple
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.operators.checks import assert_not_null, assert_unique
from tillmart.schemas import struct

# The version of a table that was just created.
CREATED = "0"

# Rows of a manifest that are no parts: the table's schema, and versions that hold replaced rows.
HEADER, REPLACED = -1, -2


class Part(NamedTuple):
    """One row of a manifest: a bucket of a branch, the version that holds rows of it, and what those were made from."""

    branch_id: str | None
    bucket: int
    buckets: int
    version: str
    rows: int
    shape: str | None
    source: str | None


_PUBLICATIONS = struct("table:string version:string published_at:timestamp in_parts:boolean")
# File systems of one machine look before they create; runners in one process take turns instead.
_PUBLISHING = threading.Lock()


class Conflict(Exception):
    """Another runner has published a table since it was read here."""


def new_version() -> str:
    """Name of a version: sorts by time, and never meets one of an earlier attempt."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid4().hex[:8]}"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._current: dict[str, str] | None = None
        self._in_parts: set[str] = set()
        # By path: what is written once never changes.
        self._manifests: dict[str, list[Part]] = {}

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def version_path(self, table: str, version: str) -> str:
        return f"{self.folder(table)}/v={version}"

    def _log(self) -> DataFrame | None:
        """All publications, with the number of their entry; None if there are none."""
        number = F.regexp_extract("_metadata.file_name", r"^(\d+)[.]json$", 1).try_cast("bigint")
        try:
            log = self.spark.read.schema(_PUBLICATIONS).json(self._log_folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        # An entry that is just being written has no whole line yet.
        return log.select("*", F.coalesce(number, F.lit(-1)).alias("entry")).where("table IS NOT NULL AND version IS NOT NULL")

    @property
    def _log_folder(self) -> str:
        return f"{self.root}/_publications"

    def refresh(self) -> dict[str, str]:
        """Read the log anew: table -> version published last, some 30 entries."""
        log = self._log()
        rows = []
        if log is not None:
            last = F.max_by(F.struct("version", "in_parts"), F.struct("entry", "published_at", "version"))
            rows = log.groupBy("table").agg(last.alias("last")).collect()
        self._in_parts = {row.table for row in rows if row.last.in_parts}
        self._current = {row.table: row.last.version for row in rows}
        return self._current

    def current_version(self, table: str) -> str | None:
        """Version published last as of the last refresh, or None."""
        if self._current is None:
            self.refresh()
        return self._current.get(table)

    def current_path(self, table: str) -> str | None:
        version = self.current_version(table)
        return version and self.version_path(table, version)

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """Current version with an explicit schema; empty if there is none yet."""
        version = self.current_version(table)
        try:
            if version is not None:
                return self.spark.read.schema(_nullable(schema)).parquet(self.version_path(table, version))
        except AnalysisException as error:
            # A table that was created and never added to has no files.
            if version != CREATED or error.getCondition() != "PATH_NOT_FOUND":
                raise
        return self.spark.createDataFrame([], _nullable(schema))

    def read_published(self, table: str) -> DataFrame:
        """Current version with the schema it was written with."""
        path = self.current_path(table)
        if path is None:
            raise LookupError(f"{table} was never published")
        manifest = self.manifest(table)
        if manifest is None:
            return self.spark.read.parquet(path)
        schema = next(T.StructType.fromJson(json.loads(p.shape)) for p in manifest if p.bucket == HEADER)
        return self.read_parts(table, [p for p in manifest if p.bucket >= 0], schema)

    def manifest(self, table: str, version: str | None = None) -> list[Part] | None:
        """What a version of a table in parts is made of: a row for each part and version. None for other tables."""
        version = version or self.current_version(table)
        if version in (None, CREATED) or table not in self._in_parts:
            return None
        path = f"{self._manifest_path(table, version)}/manifest.json"
        if path not in self._manifests:
            self._manifests[path] = [Part(*json.loads(line)) for line in _read_text(self.spark, path).splitlines()]
        return self._manifests[path]

    def _manifest_path(self, table: str, version: str) -> str:
        return f"{self.root}/manifests/{table}/v={version}"

    def write_manifest(self, table: str, version: str, schema: T.StructType, parts: Iterable[Part]) -> None:
        rows = [Part(None, HEADER, 0, version, 0, _nullable(schema).json(), None), *parts]
        text = "".join(json.dumps(row) + "\n" for row in rows)
        _create_text(self.spark, f"{self._manifest_path(table, version)}/manifest.json", text, overwrite=True)

    def part_path(self, table: str, part: Part) -> str:
        named = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        return f"{self.version_path(table, part.version)}/state=current/{named('part_branch', f'b-{part.branch_id}')}/bucket={part.bucket}"

    def read_parts(self, table: str, parts: Iterable[Part], schema: T.StructType, more: dict[str, Column] = {}) -> DataFrame:  # noqa: B006
        """The rows of these parts, with further columns of their files if there are any parts."""
        paths = [self.part_path(table, p) for p in parts if p.rows]
        if not paths:
            return self.spark.createDataFrame([], _nullable(schema))
        rows = self.spark.read.schema(_nullable(schema)).parquet(*paths)
        return rows.select("*", *[c.alias(name) for name, c in more.items()]) if more else rows

    def mark_published(self, versions: dict[str, str], in_parts: bool = False, expected: dict[str, str | None] | None = None) -> None:
        """Show these versions, all at once.

        ``expected`` names the versions that tables had when this was built upon them; ``Conflict`` if one has another by now.
        """
        if not versions:
            return
        at = datetime.now(timezone.utc).isoformat()
        lines = [json.dumps({"table": t, "version": v, "published_at": at, "in_parts": in_parts}) + "\n" for t, v in versions.items()]
        with _PUBLISHING:
            while True:
                current = self.refresh()
                moved = [t for t, v in (expected or {}).items() if current.get(t) != v]
                if moved:
                    raise Conflict(f"published by another runner meanwhile: {', '.join(moved)}")
                if self._create_entry("".join(lines)):
                    break
            self._current = {**self._current, **versions}
            self._in_parts = self._in_parts | set(versions) if in_parts else self._in_parts - set(versions)

    def _create_entry(self, text: str) -> bool:
        """Write the entry after the last one; False if another runner has just done so."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._log_folder)
        names = _names_in(folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder)
        numbers = [int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit()]
        try:
            _create_text(self.spark, f"{self._log_folder}/{max(numbers, default=0) + 1:012d}.json", text)
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    def drop_old_versions(self, tables: Iterable[str], keep: int = 3) -> list[str]:
        """Delete what lies behind the last ``keep`` published versions; returns the paths.

        The folders are listed, so versions that were written but never shown go too, once
        they are older than the oldest version that stays. Names of versions sort by time.
        """
        wanted = list(tables)
        recent = Window.partitionBy("table").orderBy(F.col("entry").desc(), F.col("published_at").desc(), F.col("version").desc())
        ranked = self._log().where(F.col("table").isin(wanted)).withColumn("rank", F.row_number().over(recent))
        # At most ``keep`` rows a table.
        shown: dict[str, set[str]] = {}
        for row in ranked.where(F.col("rank") <= keep).collect():
            shown.setdefault(row.table, set()).add(row.version)
        stale = []
        for table, versions in shown.items():
            # A table in parts still reads the versions that its last manifests name.
            used = versions | {p.version for v in versions for p in self.manifest(table, v) or [] if p.bucket != HEADER}
            for folder, kept in ((self.folder(table), used), (f"{self.root}/manifests/{table}", versions)):
                stale += [f"{folder}/v={v}" for v in _versions_in(self.spark, folder) if v not in kept and v < min(versions)]
            stale += self._superseded_parts(table, used, versions)
        return [path for path in stale if remove_folder(self.spark, path)]

    def _superseded_parts(self, table: str, used: set[str], shown: set[str]) -> list[str]:
        """Folders of parts that no shown manifest names, in versions that stay for something else."""
        named = {self.part_path(table, p) for v in shown for p in self.manifest(table, v) or [] if p.bucket >= 0}
        if not named:
            return []
        keep = {p.removeprefix(self.folder(table)) for p in named}
        found = [path for v in used - shown if v < min(shown) for path in _paths(self.spark, f"{self.version_path(table, v)}/state=current/*/*")]
        return [path for path in found if path[path.rindex("/v=") :] not in keep]

    def write_version(
        self,
        table: str,
        df: DataFrame,
        version: str,
        unique: Sequence[str] = (),
        required: Sequence[str] = (),
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """Write a version and check what was written, without showing it yet.

        The checks read just the checked columns of the new files, so the table is
        not computed a second time for them.
        """
        path = self.version_path(table, version)
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        written = self.spark.read.schema(_nullable(df.schema)).parquet(path)
        if required:
            assert_not_null(written, required, table)
        if unique:
            assert_unique(written, unique, table)
        return written

    def publish(self, table: str, df: DataFrame, version: str, **checks: Sequence[str]) -> DataFrame:
        """Write, check and show one table."""
        written = self.write_version(table, df, version, **checks)
        self.mark_published({table: version})
        return written

    def publish_merge(self, table: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame], **checks: Sequence[str]) -> DataFrame:
        """Show what ``merge`` makes of the current version; made again if another runner published one meanwhile."""
        while True:
            self.refresh()
            held, version = self.current_version(table), new_version()
            written = self.write_version(table, merge(self.read(table, schema)), version, **checks)
            try:
                self.mark_published({table: version}, expected={table: held})
                return written
            except Conflict:
                continue

    def create_if_absent(self, tables: Iterable[str]) -> None:
        """Enter tables without rows; those that exist are left alone."""
        wanted = [table for table in tables if self.current_version(table) is None]
        try:
            self.mark_published({table: CREATED for table in wanted}, expected=dict.fromkeys(wanted))
        except Conflict:
            self.create_if_absent(wanted)


def _create_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Write a small file, on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, overwrite)
    out.write(bytearray(text.encode()))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _names_in(files, folder) -> list[str]:
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def _paths(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a pattern."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return [status.getPath().toString() for status in found or []]


def _versions_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the versions that a table's folder holds, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = _names_in(folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder)
    return [name.removeprefix("v=") for name in names if name.startswith("v=")]


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system it is; False if there was none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _nullable(schema: T.StructType) -> T.StructType:
    """File sources read every column as nullable."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
