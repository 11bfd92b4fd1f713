"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every sender (a block of the input) keeps one 64-bit hash of each of its texts.
2. It sorts its distinct hashes, cuts them into the ranges of their owners and sends each
   owner one Golomb-coded message; a hash costs about ``log2(2^64 / n) + 1.5`` bits.
3. An owner decodes what it got, finds the hashes that more than one sender has, and answers
   each message with a bitmap: bit i says that the sender's i-th hash is elsewhere too.
4. Rows whose hash is marked, or repeats within its sender, are suspects. Only their texts
   are shuffled, and grouped by the bytes themselves: equal hashes prove nothing.

Grouping by the bytes is partial before the shuffle, so a text that a third of all rows have
leaves each task once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm import golomb
from tillmart.llm.common import kept, without_spaces

MESSAGE = "sender long, owner int, base long, count int, bits int, local binary, message binary"
ANSWER = "sender long, owner int, bitmap binary"


def _messages(owners: int):
    """Messages of one sender: for each owner its hashes, coded, and which of them repeat here."""
    span = -(-(1 << 64) // owners)

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = np.unique(rows["hash"].to_numpy(dtype=np.int64).view(np.uint64), return_counts=True)
        edges = np.array([min(o * span, (1 << 64) - 1) for o in range(owners)], dtype=np.uint64)
        cuts = [*np.searchsorted(hashes, edges), len(hashes)]
        out = []
        for owner in range(owners):
            part = hashes[cuts[owner] : cuts[owner + 1]]
            if len(part):
                bits = golomb.rice_parameter(len(part), span)
                local = np.packbits(counts[cuts[owner] : cuts[owner + 1]] > 1).tobytes()
                out.append((key[0], owner, int(cuts[owner]), len(part), bits, local, golomb.encode(part - edges[owner], bits)))
        return pd.DataFrame(out, columns=["sender", "owner", "base", "count", "bits", "local", "message"])

    return build


def _answers(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Bitmaps of one owner, a message each."""
    parts = [golomb.decode(m, n, b) for m, n, b in zip(rows["message"], rows["count"], rows["bits"], strict=True)]
    found, counts = np.unique(np.concatenate(parts), return_counts=True)
    shared = found[counts > 1]
    out = []
    for sender, part, local, n in zip(rows["sender"], parts, rows["local"], rows["count"], strict=True):
        here = np.unpackbits(np.frombuffer(local, dtype=np.uint8), count=n).astype(bool)
        out.append((sender, key[0], np.packbits(np.isin(part, shared) | here).tobytes()))
    return pd.DataFrame(out, columns=["sender", "owner", "bitmap"])


def _marked(key: tuple, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """The hashes of one sender that its bitmaps mark."""
    hashes = np.unique(rows["hash"].to_numpy(dtype=np.int64).view(np.uint64))
    bits, at = np.zeros(len(hashes), dtype=bool), 0
    for bitmap, n in zip(answers.sort_values("owner")["bitmap"], answers.sort_values("owner")["count"], strict=True):
        bits[at : at + n] = np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8), count=n)
        at += n
    return pd.DataFrame({"hash": hashes[bits].view(np.int64)})


def suspect_hashes(sketch: DataFrame, owners: int) -> DataFrame:
    """Distinct hashes that several rows of ``sketch`` (sender, hash) have."""
    hashes = sketch.select("sender", "hash")
    messages = kept(hashes.groupBy("sender").applyInPandas(_messages(owners), MESSAGE), "dedup-messages")
    answers = messages.select("sender", "owner", "count", "bits", "local", "message").groupBy("owner").applyInPandas(_answers, ANSWER)
    answers = answers.join(messages.select("sender", "owner", "count"), ["sender", "owner"])
    return hashes.groupBy("sender").cogroup(answers.groupBy("sender")).applyInPandas(_marked, "hash long").distinct()


def exact_duplicates(docs: DataFrame, hashes_per_owner: int = 1 << 20, rows_per_sender: int = 1 << 16) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after all white space ``[\\x20\\x09-\\x0D]`` is deleted. Of
    equal texts the row with the most code points in its original text stays, then the smallest
    doc_id (null last). Null and empty texts are equal to each other. Rows that repeat a doc_id
    in one group all carry the same answer, as nothing tells them apart; each counts in
    ``group_size``. Other columns of ``docs`` are not read. An empty table gives no rows.

    ``hashes_per_owner`` sets the number of hash ranges (32 at least), ``rows_per_sender`` the most
    rows whose hashes travel in one set of messages. Both bear on memory and speed only.
    """
    spaceless = without_spaces(F.col("text"))
    read = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"), spaceless.alias("body"))
    sketch = kept(
        read.select(
            "doc_id",
            "n_chars",
            F.xxhash64("body").alias("hash"),
            F.sha2("body", 256).alias("text_sha256"),
            F.floor(F.monotonically_increasing_id() / rows_per_sender).cast("long").alias("sender"),
        ),
        "dedup-sketch",
    )
    owners = max(32, sketch.count() // hashes_per_owner)
    suspects = kept(suspect_hashes(sketch, owners), "dedup-suspects")
    groups = (
        read.withColumn("hash", F.xxhash64("body"))
        .join(suspects, "hash", "left_semi")
        .groupBy("body")
        .agg(
            F.count(F.lit(1)).alias("group_size"),
            F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"))).alias("best"),
        )
        .select(F.sha2("body", 256).alias("text_sha256"), "group_size", F.col("best.id").alias("keep_id"))
    )
    found = sketch.join(groups, "text_sha256", "left")
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )
