"""The mix: targets against the round-by-round rule, shares, caps, reruns."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import edge_rows, plain
from tillmart.llm.source_mix import mixture, schedule, targets


def brute_targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return share | fixed
        fixed |= {s: 3.0 * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 5, "c": 7, None: 50}, {"z": 3, "y": 0, "x": 10_000}, {"only": 9}, {"a": 0, "b": 0}])
def test_targets_against_rounds_of_resharing(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in targets(rows).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mixture_of_edge_rows(docs):
    rows = mixture(docs, block_words=8).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((r[0], r[3], count(r[1])) for r in edge_rows())
    taken, size, target = Counter(), Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
    assert target == pytest.approx(brute_targets(dict(size)))
    assert all(abs(taken[s] - target[s]) <= 3 * 8 + 0.02 * target[s] for s in target)
    assert plain(mixture(docs.repartition(5), block_words=8)) == sorted((tuple(r) for r in rows), key=repr)


def test_any_stretch_of_slots_has_each_source_near_its_share(spark):
    sources = targets(spark.createDataFrame([("a", 60_000), ("b", 60_000), ("c", 60_000)], "source string, size long"))
    slots = schedule(sources).where("slot BETWEEN 500 AND 1099").groupBy("source").agg(F.count("*").alias("n"))
    assert {r.source: r.n for r in slots.collect()} == pytest.approx({"a": 100, "b": 200, "c": 300}, abs=4)


def test_mixture_of_nothing(no_docs):
    assert mixture(no_docs).collect() == []
