"""Periodic runs against brute force; suffix trees against sorted suffixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, edge_rows, plain
from tillmart.llm.queries import queries
from tillmart.llm.word_runs import SuffixTree, next_smaller, periodic_runs, runs_in, runs_of, stretches


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    """By trying every period: stretches in which words a period apart are equal, unless a smaller period holds all through."""
    found = []
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(24, 3 * q):
                run = words[i : i + length]
                if not any(run[d:] == run[: length - d] for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def repetitive(rng: random.Random) -> list[int]:
    words, kinds, size = [], rng.choice([1, 2, 2, 3, 5, 20]), rng.choice([10, 40, 90, 200])
    while len(words) < size:
        words += [rng.randrange(kinds) for _ in range(rng.randint(1, 12))] * rng.choice([1, 1, 2, 3, 5, 9])
        words = words[: len(words) - rng.choice([0, 0, 1, 2])]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(seed):
    rng, found = random.Random(seed), 0
    for _ in range(150):
        words = repetitive(rng)
        want = brute_runs(words)
        found += len(want)
        assert runs_of(words) == want
        # Without the choice of stretches as well: it leaves nothing out.
        assert sorted(runs_in(np.array(words) + 1), key=lambda r: (r[0], r[2])) == want
    assert found > 50


def test_runs_of_all_short_words_of_two_letters():
    for n in range(24, 27):
        for period in range(1, 9):
            for bits in range(1 << period):
                words = [bits >> (i % period) & 1 for i in range(n)]
                assert runs_of(words) == brute_runs(words)


@pytest.mark.parametrize("kinds", [1, 2, 4, 50])
def test_suffix_tree(kinds):
    rng = random.Random(kinds)
    for n in (1, 2, 3, 17, 120):
        text = [rng.randint(1, kinds) for _ in range(n)]
        tree = SuffixTree(text)
        suffixes = [tuple(text[i:]) + (0,) for i in range(n + 1)]
        assert tree.rank.tolist() == [sorted(suffixes).index(s) for s in suffixes]
        turned = [tuple(-c if c else -kinds - 1 for c in s) for s in suffixes]
        assert tree.reversed_ranks().tolist() == [sorted(turned).index(s) for s in turned]
        i, j = np.array([(a, b) for a in range(n + 1) for b in range(n + 1) if a != b]).T
        common = [next((k for k, (x, y) in enumerate(zip(suffixes[a], suffixes[b])) if x != y)) for a, b in zip(i, j)]
        assert tree.common(i, j).tolist() == common
        want = [next(b for b in range(a + 1, n + 1) if suffixes[b] < suffixes[a]) for a in range(n)]
        assert next_smaller(tree.rank).tolist() == want


def test_stretches_hold_every_twin():
    words = np.array([1, 2, 3] * 10 + list(range(10, 50)) + [1, 2, 3] * 2)
    assert stretches(words) == [(0, 30)]
    assert stretches(np.arange(100)) == [] and stretches(np.zeros(23, dtype=int)) == []


def answer(doc_id, text) -> tuple:
    """The query's row by plain loops."""
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *told, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_against_brute_force(spark, tmp_path):
    """Edge rows, rows that the query's rule makes periodic, and texts of repeated lines."""
    rng = random.Random(3)
    rows = [(i, t, *rest) for i, t, *rest in edge_rows() if len(t or "") < 5000 or " " not in t]
    line = lambda: " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(1, 30)))
    made = [" ".join([line(), "\t".join([line()] * rng.randint(1, 6)), line()]) for _ in range(120)]
    made += [" ".join(["a"] * 500), " ".join(["a", "b"] * 300), "\n".join([line()] * 90)]
    rows += [(1000 + i, t, None, None, None, *rows[0][5:]) for i, t in enumerate(made)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["op11_word_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [answer(r[0], r[1]) for r in rows]
    assert sum(w[1] > 0 for w in want) > 30 and any(w[1] > 1 for w in want)
    assert plain(got) == sorted(want, key=repr)


def test_long_text_and_no_rows(spark, no_docs):
    """A text of 200,000 words, periodic at its end; an empty table."""
    words = [f"v{i}" for i in range(140_000)] + ["x", "y", "z"] * 20_000
    table = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = periodic_runs(table).first()
    assert [tuple(r) for r in row.runs] == [(140_000, 60_000, 3)] and row.collapsed == " ".join(words[:140_003])
    assert periodic_runs(no_docs).collect() == []
