"""Product codes of vectors: k-means over each part, with norm-of-sum bounds.

Vectors are cut into PARTS parts, each coded by the nearest of ENTRIES entries of its position's codebook. Every round needs
the nearest entry of every part, but few parts change theirs. Of each part is kept, besides its entry,

* the exact distance to its entry, and a lower bound of the distance to any other, as they were when last measured;
* the stamp of the round they were measured in.

All codebooks of all rounds are kept too, which is little. An entry that has moved since round s lies at
``||c(now) - c(s)||`` from where it was: the norm of the sum of its steps, which is what it has really moved and at most the sum of
their norms. So the distance to the own entry has grown by no more than the own entry's displacement, and that to any other has
shrunk by no more than the greatest displacement of the others. If the one bound stays strictly under the other the entry stands.
Else the distance to the own entry is measured anew, and if that does not settle it, the part is scanned against all entries
and gets a new stamp. Distances are whole numbers, compared exactly; bounds are rounded outward, so that they only ever ask for a scan too many.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import written
from tillmart.plans.warehouse import remove_folder

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LARGEST = 1 << 28  # of a component as a whole number: squares of differences then add up within 64 bits
SCAN = 1 << 10  # parts scanned against all entries at once

STATE = "code binary, own array<long>, own_stamp binary, lower array<double>, lower_stamp binary"
NONE = 255  # the stamp of what was never measured
OUT, IN = 1 + 1e-12, 1 - 1e-12  # more than a square root and a product can be off


@dataclass
class Bounds:
    """State of one position's parts, an array element each."""

    code: np.ndarray
    own: np.ndarray  # exact squared distance to the own entry, as of own_stamp
    own_stamp: np.ndarray
    lower: np.ndarray  # at most the distance to any other entry, as of lower_stamp
    lower_stamp: np.ndarray

    @staticmethod
    def unknown(n: int) -> Bounds:
        stamps = np.full(n, NONE, dtype=np.uint8)
        return Bounds(np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.int64), stamps, np.zeros(n), stamps.copy())


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each part its nearest entry (of equal ones the first), the squared distance to it, and that to the nearest other entry (-1: none)."""
    n = len(parts)
    code, best, second = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    for at in range(0, n, SCAN):
        some = parts[at : at + SCAN]
        apart = np.zeros((len(some), len(book)), dtype=np.int64)
        for k in range(parts.shape[1]):
            step = some[:, k, None] - book[None, :, k]
            apart += step * step
        rows, own = np.arange(len(some)), apart.argmin(axis=1)
        code[at : at + SCAN], best[at : at + SCAN] = own, apart[rows, own]
        if len(book) > 1:
            apart[rows, own] = np.iinfo(np.int64).max
            second[at : at + SCAN] = apart.min(axis=1)
    return code, best, second


def displacements(history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far entries lie from where they were in each round: (round, entry) their own way, and the longest of any other. Rounded up.

    ``history`` is one position's (round, entry, component); its last round is now.
    """
    steps = (history[-1][None] - history).astype(np.float64)
    moved = np.sqrt((steps * steps).sum(axis=2)) * OUT
    others = np.zeros_like(moved)
    if moved.shape[1] > 1:
        ranked = np.argsort(moved, axis=1)
        rounds = np.arange(len(moved))
        others[:] = moved[rounds, ranked[:, -1]][:, None]
        # Of the entry that moved most, the others moved no more than the next.
        others[rounds, ranked[:, -1]] = moved[rounds, ranked[:, -2]]
    return moved, others


def bring_up(parts: np.ndarray, history: np.ndarray, state: Bounds) -> int:
    """Bring one position's state up to the last codebook of ``history``, in place. Returns how many parts had to be scanned."""
    now = len(history) - 1
    scan = state.lower_stamp == NONE
    if not scan.all():
        moved, others = displacements(history)
        least = state.lower - others[np.where(scan, 0, state.lower_stamp), state.code]
        most = np.sqrt(state.own.astype(np.float64)) * OUT + moved[np.where(scan, 0, state.own_stamp), state.code]
        unsure = np.flatnonzero(~scan & ~(most < least * IN))
        step = parts[unsure] - history[-1][state.code[unsure]]
        state.own[unsure] = (step * step).sum(axis=1)
        state.own_stamp[unsure] = now
        scan[unsure] = ~(np.sqrt(state.own[unsure].astype(np.float64)) * OUT < least[unsure] * IN)
    code, own, other = nearest(parts[scan], history[-1])
    state.code[scan], state.own[scan], state.own_stamp[scan], state.lower_stamp[scan] = code, own, now, now
    # Where there is a single entry, no other is ever nearer.
    state.lower[scan] = np.where(other < 0, np.inf, np.sqrt(np.maximum(other, 0).astype(np.float64)) * IN)
    return int(scan.sum())


def _whole(vectors: DataFrame) -> DataFrame:
    """The usable rows: vec_id, label, vector as whole numbers. A vector that is null or holds null, NaN or infinity is left out."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    scaled = lambda x: F.floor(x.cast("double") * SCALE)
    too_large = F.raise_error(F.lit(f"a component times {SCALE} is beyond {LARGEST}")).cast("int")
    whole = F.transform("embedding", lambda x: F.when(F.abs(x.cast("double")) * SCALE < LARGEST, scaled(x).cast("int")).otherwise(too_large))
    return vectors.where(F.col("embedding").isNotNull() & usable).select("vec_id", "label", whole.alias("vector"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix; a list of another length raises."""
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths != width).any():
        raise ValueError(f"a vector has {lengths[lengths != width][0]} components, others have {width}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _assigned(rows: DataFrame, history: np.ndarray) -> DataFrame:
    """The rows with their state brought up to the last codebook of ``history`` (position, round, entry, component)."""
    fresh, width = "code" not in rows.columns, PARTS * history.shape[3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            parts = _matrix(batch.column("vector"), width).astype(np.int64).reshape(n, PARTS, width // PARTS)
            if fresh:
                states = [Bounds.unknown(n) for _ in range(PARTS)]
            else:
                code, own_stamp, lower_stamp = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(n, PARTS) for c in ("code", "own_stamp", "lower_stamp")
                )
                own, lower = _matrix(batch.column("own"), PARTS), _matrix(batch.column("lower"), PARTS)
                states = [Bounds(*(a[:, p].copy() for a in (code, own, own_stamp, lower, lower_stamp))) for p in range(PARTS)]
            for p, state in enumerate(states):
                bring_up(parts[:, p], history[p], state)
            columns = [batch.column(c) for c in ("vec_id", "label", "vector")]
            for name in ("code", "own", "own_stamp", "lower", "lower_stamp"):
                values = np.stack([getattr(s, name) for s in states], axis=1)
                if values.dtype == np.uint8:
                    columns.append(pa.array([r.tobytes() for r in values], pa.binary()))
                else:
                    starts = pa.array(np.arange(0, n * PARTS + 1, PARTS), pa.int32())
                    columns.append(pa.ListArray.from_arrays(starts, pa.array(values.ravel())))
            yield pa.record_batch(columns, names=["vec_id", "label", "vector", "code", "own", "own_stamp", "lower", "lower_stamp"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, vector array<int>, {STATE}")


def _moved(rows: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebook (position, entry, component) whose entries are the rounded down means of their parts; unused ones stay.

    Every task adds up what it has of each entry; the sums of all tasks are one row an entry.
    """
    entries, width = book.shape[1], book.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((PARTS, entries, width), dtype=np.int64), np.zeros((PARTS, entries), dtype=np.int64)
        for batch in batches:
            n = batch.num_rows
            parts = _matrix(batch.column("vector"), PARTS * width).astype(np.int64).reshape(n, PARTS, width)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8).reshape(n, PARTS)
            for p in range(PARTS):
                np.add.at(sums[p], code[:, p], parts[:, p])
                counts[p] += np.bincount(code[:, p], minlength=entries)
        part, entry = np.nonzero(counts)
        columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))]
        yield pa.record_batch(columns, names=["part", "entry", "n", "sums"])

    told = rows.select("vector", "code").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    totals = told.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)])
    after = book.copy()
    # PARTS * ENTRIES rows at most, whatever the table.
    for row in totals.collect():
        after[row.part, row.entry] = [row[f"s{i}"] // row.n for i in range(width)]
    return after


def product_codes(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Codes of ``vectors`` (vec_id, embedding, label), and the codebooks they refer to, as (position, entry, component).

    The rows are vec_id, label, code (an entry's number a byte, in the order of parts) and error (squared distances to the
    entries, added up), one for each usable row: vectors that are null or hold null, NaN or infinity are left out. A component x
    counts as floor(1024 x), of at most 2^28. Codebooks start from the parts of the 256 rows of smallest vec_id (null last;
    rows that share one by their vectors), or of all rows if there are fewer; four rounds move each entry to the rounded down mean of
    its parts. Ties go to the lower entry. Rows that repeat a vec_id are rows of their own. All vectors must have one length, a multiple of
    four (0 as well), else the job fails. Other columns are not read. An empty table gives no rows and codebooks without entries.

    A round reads the table of the round before and writes the next, so lost executors cost their tasks only; two such tables exist at a time.
    What goes through the driver is codebooks: 256 entries for each part.
    """
    rows, path = written(_whole(vectors), "codes-vectors")
    first = [r.vector for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()]
    width = len(first[0]) if first else 0
    if width % PARTS:
        raise ValueError(f"{width} components cannot be cut into {PARTS} equal parts")
    if any(len(v) != width for v in first):
        raise ValueError("vectors differ in length")
    book = np.array(first, dtype=np.int64).reshape(len(first), PARTS, width // PARTS).transpose(1, 0, 2)
    history = [book]
    if first:
        for turn in range(ROUNDS + 1):
            before = path
            rows, path = written(_assigned(rows, np.stack(history, axis=1)), "codes-round")
            remove_folder(vectors.sparkSession, before)
            if turn < ROUNDS:
                history.append(_moved(rows, history[-1]))
    return _coded(rows, history[-1]), history[-1]


def _coded(rows: DataFrame, book: np.ndarray) -> DataFrame:
    """vec_id, label, code, error: the distances as of the last codebook, also of parts whose bounds told enough."""
    width = PARTS * book.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            parts = _matrix(batch.column("vector"), width).astype(np.int64).reshape(n, PARTS, width // PARTS)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8).reshape(n, PARTS)
            error = np.zeros(n, dtype=np.int64)
            for p in range(PARTS):
                step = parts[:, p] - book[p][code[:, p]]
                error += (step * step).sum(axis=1)
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), batch.column("code"), pa.array(error)], names=["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code binary, error long"
    if "code" not in rows.columns:
        return rows.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    return rows.select("vec_id", "label", "vector", "code").mapInArrow(run, schema)


def books_text(books: np.ndarray) -> str:
    """All components in decimal, by part, entry and place, joined by commas."""
    return ",".join(map(str, books.ravel().tolist()))
