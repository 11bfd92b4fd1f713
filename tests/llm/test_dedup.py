"""Exact and near dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import edge_rows, plain
from tillmart.llm import golomb
from tillmart.llm.components import components
from tillmart.llm.exact_dedup import exact_duplicates
from tillmart.llm.simhash_trie import _near_pairs, near_duplicates


@pytest.mark.parametrize("count,span", [(0, 10), (1, 1), (1, 1 << 60), (1000, 1 << 40), (500, 700)])
def test_golomb_round_trip(count, span):
    rng = random.Random(count)
    values = np.array(sorted(rng.sample(range(span), count) if span < 1000 else {rng.randrange(span) for _ in range(count)}), dtype=np.uint64)
    bits = golomb.rice_parameter(len(values), span)
    assert golomb.decode(golomb.encode(values, bits), len(values), bits).tolist() == values.tolist()


def test_exact_duplicates_against_brute_force(docs):
    groups: dict[str, list] = {}
    for doc_id, text, *_ in edge_rows():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id))
    want = []
    for body, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        want += [(m[2], keep, len(members), m[2] == keep, hashlib.sha256(body.encode()).hexdigest()) for m in members]
    assert plain(exact_duplicates(docs, rows_per_sender=4)) == sorted(want, key=repr)


def test_exact_duplicates_of_nothing(no_docs):
    assert exact_duplicates(no_docs).collect() == []


def brute_fingerprint(text: str | None, n: int = 3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_against_brute_force(docs):
    rows = [(r[0], brute_fingerprint(r[1])) for r in edge_rows()]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min((r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None), default=None) for g in group}
    want = [(r[0], r[1] - (1 << 64) if r[1] >> 63 else r[1], least[g]) for r, g in zip(rows, group, strict=True)]
    assert plain(near_duplicates(docs)) == sorted(want, key=repr)


def test_near_duplicates_of_nothing(no_docs):
    assert near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_trie_join_finds_all_pairs(seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(40)]
    flipped = [b ^ sum(1 << bit for bit in rng.sample(range(64), rng.randint(0, 3))) for b in base for _ in range(6)]
    values = np.array(sorted(set(base + flipped)), dtype=np.uint64)
    found = {(int(a), int(b)) for i, j in _near_pairs(values, values, True, 63, 0, 2) for a, b in zip(values[i], values[j], strict=True)}
    listed = values.tolist()
    assert found == {(a, b) for k, a in enumerate(listed) for b in listed[k + 1 :] if (a ^ b).bit_count() <= 2}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {(r.node, r.component) for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(i, 1) for i in range(2, 41)} | {(i, 100) for i in range(101, 140)}
