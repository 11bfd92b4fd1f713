"""SimHash near-dedup: fingerprints of word shingles, linked by a binary trie's join with itself.

The trie holds the distinct 64-bit fingerprints. The join walks pairs of nodes from the root
down, one bit a level, adds up the bits in which the two nodes' prefixes differ, and drops a
pair as soon as that exceeds the budget. Spark deals out the top of the trie: the first
``depth`` bits name a subtree, and each pair of subtrees whose names differ within the budget
is one group. Below, numpy walks the pairs of a group depth first, in blocks of bounded size.

Equal fingerprints are one class before the walk, so copies are never paired. A group gives
the edges of a spanning forest only: no link between classes is lost, none is repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import kept
from tillmart.llm.components import components

SEED = 42
BLOCK = 1 << 16  # shingles, or pairs of nodes, that are in memory at once
LEAF_PAIRS = 64  # a pair of nodes with so few pairs of fingerprints is compared outright


def fingerprint(text: bytes, words: int) -> int:
    """SimHash of a text: bit b is 1 if it is set in over half the hashes of its shingles."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(parts) - words + 1)
    ends = (ends[-n:] - 1).tolist()
    starts = starts[:n].tolist()
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        hashes = np.fromiter(
            (digest(joined[s:e], SEED) for s, e in zip(starts[at : at + BLOCK], ends[at : at + BLOCK], strict=True)), dtype=np.uint64
        )
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row. Null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py() or b"", words) for t in batch.column("text")), dtype=np.uint64, count=batch.num_rows)
            yield pa.record_batch([batch.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def _near_pairs(a: np.ndarray, b: np.ndarray, same: bool, bit: int, distance: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two sorted arrays whose values differ in at most ``budget`` bits in all.

    The values of an array agree above ``bit``; up there the two arrays differ in ``distance``
    bits. With ``same`` both are one array, and each pair comes once.
    """
    first = np.array([[0, len(a), 0, len(b)]], dtype=np.int64)
    stack = [(first, np.array([distance], dtype=np.int8), np.array([same]), bit)]
    while stack:
        nodes, apart, own, level = stack.pop()
        if len(nodes) > BLOCK:
            stack += [(nodes[i : i + BLOCK], apart[i : i + BLOCK], own[i : i + BLOCK], level) for i in range(0, len(nodes), BLOCK)]
            continue
        width_a, width_b = nodes[:, 1] - nodes[:, 0], nodes[:, 3] - nodes[:, 2]
        leaf = (width_a * width_b <= LEAF_PAIRS) | (level < 0)
        if leaf.any():
            lo_a, lo_b, wide, total = nodes[leaf, 0], nodes[leaf, 2], width_b[leaf], (width_a * width_b)[leaf]
            which = np.repeat(np.arange(len(total)), total)
            step = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
            i, j = lo_a[which] + step // wide[which], lo_b[which] + step % wide[which]
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            near &= ~own[leaf][which] | (i < j)
            yield i[near], j[near]
        nodes, apart, own = nodes[~leaf], apart[~leaf], own[~leaf]
        if not len(nodes):
            continue
        one, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        cut_a = np.searchsorted(a, (a[nodes[:, 0]] | one) & ~below).clip(nodes[:, 0], nodes[:, 1])
        cut_b = np.searchsorted(b, (b[nodes[:, 2]] | one) & ~below).clip(nodes[:, 2], nodes[:, 3])
        a0, a1, b0, b1 = nodes.T
        children = []
        for lo_a, hi_a, lo_b, hi_b, cost in ((a0, cut_a, b0, cut_b, 0), (cut_a, a1, cut_b, b1, 0), (a0, cut_a, cut_b, b1, 1), (cut_a, a1, b0, cut_b, 1)):
            fits = (hi_a > lo_a) & (hi_b > lo_b) & (apart + cost <= budget)
            if cost and lo_a is cut_a:
                fits &= ~own  # the mirror image of the pair before
            children.append((np.stack([lo_a, hi_a, lo_b, hi_b], axis=1)[fits], (apart + cost)[fits], own[fits] & (cost == 0)))
        stack.append((*(np.concatenate(x) for x in zip(*children, strict=True)), level - 1))


class _Forest:
    """Union-find over the fingerprints of one group: which links join what was apart."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def joins(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _walk(depth: int, budget: int):
    """Edges (u, v) between the fingerprints of one pair of subtrees."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = int(rows["low"].iloc[0]), int(rows["high"].iloc[0])
        fps = np.sort(rows["fp"].to_numpy(dtype=np.int64).view(np.uint64))
        side = (fps >> np.uint64(64 - depth)).astype(np.int64) == high if depth else np.ones(len(fps), dtype=bool)
        mine = np.flatnonzero(side) if low == high else np.flatnonzero(~side)
        other = np.flatnonzero(side)
        if not len(mine) or not len(other):
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        forest, edges = _Forest(len(fps)), []
        for i, j in _near_pairs(fps[mine], fps[other], low == high, 63 - depth, (low ^ high).bit_count(), budget):
            edges += [(x, y) for x, y in zip(mine[i].tolist(), other[j].tolist(), strict=True) if forest.joins(x, y)]
        found = np.array(edges, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": fps[found[:, 0]].view(np.int64), "v": fps[found[:, 1]].view(np.int64)})

    return run


def _subtree(depth: int) -> Column:
    """The first ``depth`` bits of a fingerprint."""
    return F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")


def near_edges(classes: DataFrame, budget: int = 2, fingerprints_per_group: int = 1 << 13) -> DataFrame:
    """Edges (u, v) that tie all distinct fingerprints ``fp`` at ``budget`` or fewer differing bits together."""
    count = classes.count()
    depth = min(24, max(0, (count // fingerprints_per_group).bit_length()))
    masks = [sum(1 << b for b in bits) for k in range(budget + 1) for bits in combinations(range(depth), k)]
    own = _subtree(depth)
    dealt = classes.select("fp", own.alias("own"), F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask")).select(
        F.least("own", F.col("own").bitwiseXOR(F.col("mask"))).alias("low"),
        F.greatest("own", F.col("own").bitwiseXOR(F.col("mask"))).alias("high"),
        "fp",
    )
    return dealt.groupBy("low", "high").applyInPandas(_walk(depth, budget), "u long, v long")


def near_duplicates(docs: DataFrame, words: int = 3, budget: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (long), component_id.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z in lower case; shingles are ``words`` words,
    repeats included, or the whole sequence if there are fewer. Two rows are linked if their
    fingerprints differ in at most ``budget`` bits; component_id is the smallest doc_id that a
    row reaches over links, itself included. Null and empty texts have fingerprint 0 and are
    linked like any other. A row without doc_id is linked too, but never names a component
    unless no row of it has one (then null). Repeated rows share all values. Other columns of
    ``docs`` are not read. An empty table gives no rows.
    """
    found = kept(fingerprints(docs, words), "simhash")
    classes = kept(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = components(near_edges(classes.select("fp"), budget)).withColumnRenamed("node", "fp")
    tied = classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    names = tied.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.join(tied.join(names, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")
