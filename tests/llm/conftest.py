from __future__ import annotations

import random

import pytest

CLASHES = ("hash", "key", "rank", "start", "row", "score", "fp", "ids", "part", "size", "range", "component", "words", "found", "salt")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
PAGES = "page_id long, url string, html string, host string, path string, salt int, votes string, text string"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    stems = ["the", "river", "stone", "and", "of", "light", "carries", "slow", "under", "bridge", "winter", "hands", "told", "again", "north"]
    return " ".join(rng.choice(stems) + rng.choice(["", "s", "ed", "ing"]) for _ in range(words))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rows = [
        (1, prose(1, 60), "en", "a"),
        (2, prose(1, 60), "en", "a"),
        (3, " " + prose(1, 60) + "\n", "en", "b"),
        (4, prose(1, 59) + " otherwise", "en", "b"),
        (5, prose(5, 40), "de", None),
        (6, None, "en", "a"),
        (7, "", None, "b"),
        (8, " \t\n", "de", "c"),
        (9, prose(9, 12_000), "en", "c"),
        (10, "x" * 70_000, None, "c"),
        (11, "é😀 ñandú STRASSE ß", "de", "a"),
        (12, "one", "en", "d"),
        (None, "row without a number", "en", "d"),
        (None, None, None, None),
        (13, prose(13, 30), "en", "a"),
        (13, prose(13, 30), "en", "a"),
        (14, "12 34 !!", "en", "a"),
    ]
    rows += [(100 + i, prose(i % 7 + 50, 80), "en" if i % 2 else "de", "a" if i % 3 else "b") for i in range(40)]
    return [(i, t, lang, s, len(t) if t is not None else None, *["clash"] * len(CLASHES)) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
