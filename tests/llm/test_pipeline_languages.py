"""Language ID in the pipeline: close languages and texts in several languages stay."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.conftest import SCHEMA, prose


def test_close_languages_stay(spark):
    """Four labels over one vocabulary: a text's score is about a quarter, whatever its length."""
    rows = [(i, prose(i, 200), "abcd"[i % 4], "s") for i in range(40)] + [(100, "12 34 !!", "a", "s"), (101, None, "a", "s"), (102, "", None, None)]
    docs = spark.createDataFrame([(*r, len(r[1] or ""), *["clash"] * (len(SCHEMA.split(",")) - 5)) for r in rows], SCHEMA)
    found = corpus_pipeline.language_id(spark, docs, "")
    assert found.columns == docs.columns and sorted(r.doc_id for r in found.collect()) == list(range(40))
