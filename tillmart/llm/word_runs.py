"""Periodic runs of words: suffix-tree LCE and Lyndon roots.

A run is a stretch of words with smallest period q that neither neighbour extends. Every run has a Lyndon root: for one of
the two orders of the alphabet (a fixed one and its reverse, the end of the text coming first in both) some place of it
starts a longest Lyndon word as long as the period. The longest Lyndon word at place i ends before the next place j
whose suffix is smaller. So the candidates are the pairs (i, j) of both orders, and each is extended:

* to the right by the longest common extension of i and j, the depth of the lowest common ancestor of their leaves in
  the suffix tree of the words;
* to the left by the same in the tree of the reversed words.

Both trees are Ukkonen's. A tree is walked once by an Euler tour. Between two neighbouring leaves only the tour's lowest
point counts, so that is what is kept of it, under a sparse table of minima: an LCA costs two look-ups, and
numpy makes them for all candidates at once.

Before that, stretches that can't hold a run are left out. A run has at least 24 words and three periods, so every window of WINDOW words in
it occurs once more a period on or back, in the same run. A run therefore lies whole, its bounds included, in a stretch of
windows none of which is the only one of its kind in the document. Windows are compared by hash; equal hashes of
unlike windows only make a stretch longer.

Documents are rows of their own: nothing is shuffled. Memory follows the longest such stretch of one document, some
600 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORTEST = 24  # words of a run at least
TIMES = 3  # periods of a run at least
WINDOW = 8  # 2 q + WINDOW - 1 words are in every run of period q, so each of its windows has a twin
SLICE = 256  # rows whose texts are Python objects at once

RUNS = "array<struct<start:long,length:long,period:long>>"
_FACTOR, _SPREAD = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


class SuffixTree:
    """Ukkonen's tree of ``symbols`` (whole numbers from 1) and their end, 0, for common extensions and orders of suffixes."""

    def __init__(self, symbols: Sequence[int]) -> None:
        self._grow([*symbols, 0])
        self._tour()

    def _grow(self, s: list[int]) -> None:
        sigma = max(s) + 1
        heads, tails, links, suffix = [0], [0], [0], [-1]
        child: dict[int, int] = {}
        end = len(s)
        node = edge = length = rest = leaves = 0
        for i, c in enumerate(s):
            rest += 1
            waiting = 0  # the inner node whose suffix link is still to be set
            while rest:
                if not length:
                    edge = i
                key = node * sigma + s[edge]
                down = child.get(key)
                if down is None:
                    child[key] = len(heads)
                    heads.append(i)
                    tails.append(end)
                    links.append(0)
                    suffix.append(leaves)
                    leaves += 1
                    if waiting:
                        links[waiting] = node
                        waiting = 0
                else:
                    head = heads[down]
                    span = tails[down] - head
                    if length >= span:
                        edge += span
                        length -= span
                        node = down
                        continue
                    at = head + length
                    if s[at] == c:
                        length += 1
                        if waiting:
                            links[waiting] = node
                        break
                    split = len(heads)
                    heads += (head, i)
                    tails += (at, end)
                    links += (0, 0)
                    suffix += (-1, leaves)
                    leaves += 1
                    child[key] = split
                    child[split * sigma + c] = split + 1
                    child[split * sigma + s[at]] = down
                    heads[down] = at
                    if waiting:
                        links[waiting] = split
                    waiting = split
                rest -= 1
                if node:
                    node = links[node]
                elif length:
                    length -= 1
                    edge = i - rest + 1
        keys = np.fromiter(child.keys(), dtype=np.int64, count=len(child))
        kids = np.fromiter(child.values(), dtype=np.int64, count=len(child))
        self.parent, self.symbol = np.zeros(len(heads), dtype=np.int64), np.full(len(heads), -1, dtype=np.int64)
        self.parent[kids], self.symbol[kids] = keys // sigma, keys % sigma
        self.span = np.array(tails, dtype=np.int64) - np.array(heads, dtype=np.int64)
        self.suffix = np.array(suffix, dtype=np.int64)

    def _walk(self, by: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Nodes in the order of a tour that takes children by rising ``by``, and whether each is its parent's first."""
        kids = np.lexsort((by, self.parent))[1:] if len(self.parent) > 1 else np.zeros(0, dtype=np.int64)
        # The root is its own parent: as it has the smallest symbol, it sorts first.
        owners = self.parent[kids]
        first = np.searchsorted(owners, np.arange(len(self.parent) + 1)).tolist()
        listed = kids.tolist()
        leaf = (self.suffix >= 0).tolist()
        tour, stack = [], [0]
        while stack:
            node = stack.pop()
            tour.append(node)
            if not leaf[node]:
                stack.extend(listed[first[node] : first[node + 1]][::-1])
        is_first = np.zeros(len(self.parent), dtype=bool)
        is_first[kids[np.concatenate(([True], owners[1:] != owners[:-1]))] if len(kids) else kids] = True
        return tour, is_first

    def _tour(self) -> None:
        tour, is_first = self._walk(self.symbol)
        nodes = np.array(tour, dtype=np.int64)
        depth = [0] * len(tour)
        for node, up, span in zip(tour[1:], self.parent[nodes[1:]].tolist(), self.span[nodes[1:]].tolist(), strict=True):
            depth[node] = depth[up] + span
        self.rank = self._ranks(nodes)
        # The tour comes back to a node's parent before each child but the first: the lowest point between two leaves.
        later = nodes[1:][~is_first[nodes[1:]]]
        level = np.array(depth, dtype=np.int32)[self.parent[later]]
        self.least = [level]
        step = 1
        while 2 * step <= len(level):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def _ranks(self, nodes: np.ndarray) -> np.ndarray:
        leaves = self.suffix[nodes]
        leaves = leaves[leaves >= 0]
        rank = np.empty(len(leaves), dtype=np.int64)
        rank[leaves] = np.arange(len(leaves))
        return rank

    def reversed_ranks(self) -> np.ndarray:
        """Ranks of the suffixes when the alphabet is turned round and the end still comes first."""
        turned = np.where(self.symbol > 0, self.symbol.max() + 1 - self.symbol, self.symbol)
        return self._ranks(np.array(self._walk(turned)[0], dtype=np.int64))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common beginnings of the suffixes at ``i`` and ``j``, which differ."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level):
            some = level == k
            out[some] = np.minimum(self.least[k][low[some]], self.least[k][high[some] - (1 << int(k))])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each suffix but the last, which is the end, the next one that ranks below it."""
    ranks = rank.tolist()
    out, stack = [0] * (len(ranks) - 1), [len(ranks) - 1]
    for i in range(len(ranks) - 2, -1, -1):
        while ranks[stack[-1]] > ranks[i]:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out, dtype=np.int64)


def runs_in(symbols: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of whole numbers from 1."""
    n = len(symbols)
    listed = symbols.tolist()
    tree, back = SuffixTree(listed), SuffixTree(listed[::-1])
    places = np.arange(n)
    pairs = [np.stack((places, next_smaller(rank))) for rank in (tree.rank, tree.reversed_ranks())]
    i, j = np.concatenate(pairs, axis=1)
    short = TIMES * (j - i) <= n
    i, j = i[short], j[short]
    start = i - back.common(n - i, n - j)
    length = j + tree.common(i, j) - start
    period = j - i
    enough = length >= np.maximum(SHORTEST, TIMES * period)
    return sorted(set(zip(start[enough].tolist(), length[enough].tolist(), period[enough].tolist(), strict=True)))


def stretches(symbols: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the stretches whose windows all occur elsewhere too, as long as the shortest run at least."""
    if len(symbols) < SHORTEST:
        return []
    hashes = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(_SPREAD)
    hashes ^= hashes >> np.uint64(29)
    factor, width = _FACTOR, 1
    while width < WINDOW:
        hashes = hashes[:-width] * np.uint64(factor) + hashes[width:]
        factor, width = factor * factor % (1 << 64), 2 * width
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return []
    again = np.zeros(len(hashes) + 2, dtype=np.int8)
    again[1 + order[1:][same]] = 1
    again[1 + order[:-1][same]] = 1
    turns = np.flatnonzero(np.diff(again))
    return [(a, b + WINDOW - 1) for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True) if b - a + WINDOW - 1 >= SHORTEST]


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of words, by start, then period."""
    known: dict = {}
    symbols = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
    found = []
    for a, b in stretches(symbols):
        part = np.unique(symbols[a:b], return_inverse=True)[1] + 1
        found += [(a + start, length, period) for start, length, period in runs_in(part)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without what repeats a run's first period, joined by single spaces."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, runs (by start, then period), collapsed.

    Words are stretches of ``[^\\x20\\x09-\\x0D]``, numbered from 0. A run is a stretch of consecutive words of smallest period
    q, at least 24 words and three periods long, that no neighbouring word extends. ``collapsed`` has the words
    that no run holds after its first q, joined by single spaces. Null and empty texts have no words, no runs and an empty
    ``collapsed``. Rows that repeat a doc_id, or have none, are rows of their own. Other columns are not read. An
    empty table gives no rows. Runs of unlike periods may overlap; each is a run of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for big in batches:
            for at in range(0, big.num_rows, SLICE):
                batch = big.slice(at, SLICE)
                found, texts = [], []
                for text in batch.column("text"):
                    words = (text.as_py() or b"").split()
                    runs = runs_of(words)
                    found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                    texts.append(collapsed(words, runs))
                columns = [batch.column("doc_id"), pa.array(found, kind), pa.array(texts, pa.binary())]
                yield pa.record_batch(columns, names=["doc_id", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    out = read.mapInArrow(run, f"doc_id {kind}, runs {RUNS}, collapsed binary")
    return out.select("doc_id", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first. Null if there is none."""
    more = lambda r, best: (r["length"] * best["period"]) > (best["length"] * r["period"])
    return F.aggregate(runs, F.get(runs, 0), lambda best, r: F.when(more(r, best), r).otherwise(best))
