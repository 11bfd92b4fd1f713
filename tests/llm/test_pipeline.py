"""The pipeline on edge rows: what each stage keeps, and the encoded result."""

from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline
from tests.llm.conftest import SCHEMA, edge_rows
from tests.llm.test_dedup import brute_fingerprint
from tillmart.llm.bpe_tree import Codec, tokenizer_spec
from tillmart.llm.queries import tokenizer_path


def near_stays(rows: list[tuple]) -> list[tuple]:
    """By comparing all pairs of fingerprints: the rows with each group's smallest doc_id."""
    prints = [brute_fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    order = lambda r: (r[0] is None, r[0] or 0)
    least: dict[int, tuple] = {}
    for g, r in zip(group, rows, strict=True):
        least[g] = min(least.get(g, r), r, key=order)
    return sorted((r for g, r in zip(group, rows, strict=True) if order(r) == order(least[g])), key=repr)


def edited(words: list[str], edits: int, rng: random.Random) -> str:
    out = list(words)
    for at in rng.sample(range(len(out)), edits):
        out[at] = f"new{rng.randrange(10**9)}"
    return " ".join(out)


def test_near_dedup_against_brute_force(spark):
    """Families of texts with few words changed, a large group, chains over several links, nulls, empty and short texts."""
    rng, rows = random.Random(7), []
    for family in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(400)]
        rows += [(10 * family + k, edited(words, k // 3, rng)) for k in range(9)]
    chain = [f"c{i}" for i in range(600)]
    for k in range(60):
        chain[rng.randrange(600)] = f"x{k}"
        rows.append((1000 + k, " ".join(chain)))
    rows += [(2000 + i, " ".join(["same"] * 30)) for i in range(50)]
    rows += [(3001, "one"), (3000, "One "), (3002, None), (3003, ""), (None, "two words"), (3004, "two words"), (None, "alone here")]
    rng.shuffle(rows)
    want = near_stays(rows)
    assert 40 < len(want) < len(rows) - 60
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in corpus_pipeline.near_dedup(spark, table, "").collect()), key=repr) == want


def test_near_dedup_of_rows_that_share_a_number_and_of_none(spark, no_docs):
    """Of two texts under one number each group keeps one; an empty table stays empty."""
    rows = [(5, "one two three four"), (5, "one two three four five six"), (7, "one two three four"), (None, None), (None, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_dedup(spark, table, "").collect()
    assert sorted(r.text for r in got if r.doc_id == 5) == ["one two three four", "one two three four five six"]
    assert [r.doc_id for r in got].count(None) == 1 and len(got) == 3
    assert corpus_pipeline.near_dedup(spark, no_docs, "").collect() == []


def test_stages_in_turn(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "source_mix", "bpe"]
    now = spark.createDataFrame(stages["language_id"](spark, docs, "").collect(), SCHEMA)
    letters = Counter(r[:4] for r in edge_rows() if r[1] and re.search(r"[^\W\d_]", r[1]))
    assert now.columns == docs.columns and Counter(tuple(r)[:4] for r in now.collect()) == letters

    now = spark.createDataFrame(stages["exact_dedup"](spark, now, "").collect(), SCHEMA)
    bare = [re.sub(r"\s+", "", r.text) for r in now.collect()]
    assert now.columns == docs.columns and len(bare) == len(set(bare)) == len({re.sub(r"\s+", "", t) for _, t, *_ in letters})
    assert {3, 13, 12} <= {r.doc_id for r in now.collect()}

    want = near_stays([tuple(r) for r in now.collect()])
    now = spark.createDataFrame(stages["near_dedup"](spark, now, "").collect(), SCHEMA)
    assert now.columns == docs.columns and sorted((tuple(r) for r in now.collect()), key=repr) == want

    now = spark.createDataFrame(stages["source_mix"](spark, now, "").collect(), SCHEMA)
    assert now.columns == docs.columns and max(Counter(r.doc_id for r in now.collect()).values()) <= 3

    codec = Codec(tokenizer_spec(tokenizer_path()))
    got = Counter((r.doc_id, r.n_tokens) for r in stages["bpe"](spark, now, "").collect())
    assert got == Counter((r.doc_id, len(codec.ids(r.text))) for r in now.collect())


def test_run_over_tables(spark, tmp_path, docs, no_docs):
    for name, table in (("some", docs), ("none", no_docs)):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/some").count() > 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
