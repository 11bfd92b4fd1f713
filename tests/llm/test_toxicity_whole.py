"""Toxicity: disguises anywhere in a long token, and doubled letters."""

from __future__ import annotations

import pytest

from tests.llm.conftest import prose
from tillmart.llm import toxicity


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, f"{prose(i, 60)} idiot {prose(i + 500, 60)} stupid") for i in range(50)]
    return toxicity.CharacterModel(toxicity.trigram_counts(spark.createDataFrame(rows, "doc_id long, text string")))


@pytest.mark.parametrize("before", range(10, 26))
def test_spaced_word_across_any_place(model, before):
    """The word stands across a multiple of 40 characters for some of these."""
    spaced = " ".join("northriverstonebridgewinterlight"[:before] + "idiot" + "stonebridgenorth")
    (token,) = [t for t in toxicity.tokens_of(spaced) if len(t) > 40]
    assert any("idiot" in w for w in toxicity.words_of(token, model))


def test_doubled_letters(model):
    assert "idiot" in toxicity.words_of("iddiot", model) and "stupid" in toxicity.words_of("stuppid", model)
    assert "iddiot" in toxicity.words_of("iddiot", model)


def test_very_long_token(model):
    assert len(toxicity.restore("i.d.1.0.t." * 20_000, model)) > 20_000


def test_readings_of_a_character_are_made_once(model, monkeypatch):
    """A run of equal characters counts for as long as it is, and what was learned of a character stays."""
    model.readings.clear()
    made, readings = [], toxicity.readings
    monkeypatch.setattr(toxicity, "readings", lambda c, number: made.append(c) or readings(c, number))
    first = [toxicity.restore(w, model) for w in ("1d10t", "idiooot", "i.d.i.o.t", "stuuupid", "1d10t")]
    assert sorted(made) == sorted(set(made)) and first == ["idiot", "idiot", "idiot", "stupid", "idiot"]
    monkeypatch.setattr(toxicity, "MOST_READINGS", 2)
    model.readings.clear()
    assert [toxicity.restore(w, model) for w in ("1d10t", "idiooot", "i.d.i.o.t", "stuuupid", "1d10t")] == first
    assert len(model.readings) == 2


def test_tokens_known_or_forgotten_give_the_same_scores(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{prose(i, 40)} {w}, {prose(i + 90, 40)}") for i, w in enumerate(["idiot", "plain", "1d10t", "idiotic", "i.d.i.o.t"] * 4)], "doc_id long, text string").coalesce(1)
    counts = toxicity.trigram_counts(docs)
    found = {"idiot": toxicity.Sign(0.9, 1e-4, 1.0), "idiot~": toxicity.Sign(0.8, 1e-3, 1.0)}
    rows = [tuple(r) for r in toxicity.score(docs, counts, found, 0.1).orderBy("doc_id").collect()]
    assert [r[2] for r in rows[:5]] == [["idiot"], [], ["idiot"], ["idiotic"], ["idiot"]] and rows[1][1] == 0.1
    monkeypatch.setattr(toxicity, "WORDS", 3)
    assert [tuple(r) for r in toxicity.score(docs, counts, found, 0.1).orderBy("doc_id").collect()] == rows
