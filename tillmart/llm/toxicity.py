"""Toxicity of restored texts: a noisy channel is undone first, then words are scored.

Writers hide words by digits and signs for letters (``1d10t``), by spacing (``i d i o t``, ``i.d.i.o.t``) and by
repeating letters (``idiooot``). A stretch that may be so disguised is a lattice: each character may stand for
some letters, for nothing, or for itself. The Viterbi path under a character trigram model, counted over
all texts, is the restored word; it is added to the words as written. A word of plain letters, none of them twice in a row, has one path, itself.

The classifier learns from a bounded sample of labelled rows which words and beginnings of words
tell: those that toxic texts have more often than chance allows, counted on the texts that no stronger one explains.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.common import kept

# Letters that the character model tells apart; 0 is whatever ends a word, the last number any other letter.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß"
OTHER = len(LETTERS) + 1
STATES = OTHER + 1
# What signs may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou", "#": "aeiou", "%": "aeiou",
}
GAPS = frozenset(" .-_*,'`~^/\\|:;+=#%")  # characters that may stand for nothing between letters
# Nats: for a sign read as a letter, as any vowel, a gap left out, one read as a word's end, one of the
# signs for any vowel left out, and a letter left out that is repeated thrice or more, or twice.
SIGN, VOWEL, GAP, END, NO_VOWEL, REPEAT, DOUBLE = 0.7, 1.0, 0.4, 0.8, 2.0, 0.2, 3.0
EDGE = ".,;:!?\"'()[]{}<>«»“”…—–"
BOTH_ENDS = EDGE.replace("!", "").replace("(", "")
NO_LETTERS = re.compile(r"[\W\d_]+")
SPACED = re.compile(r"(?<!\S)[^\W_](?:[ \t.\-_*]{1,3}[^\W_\s]|[ \t.\-_*]{1,3}[@$!|+€]){2,}(?!\S)")
TWICE = re.compile(r"(.)\1", re.S)
PREFIXES = (4, 5)  # letters at a word's beginning that are features, besides the word

SAMPLE = 20_000  # labelled rows that the classifier is fitted on
ROUNDS = 12
FOLLOWERS = 0.25  # of a round's strongest evidence that a feature needs to be taken in the same round
LEAST_SHARE = 0.3  # of a feature's texts that are toxic, for it to tell
WORDS = 1 << 18  # distinct tokens that a task holds, or those of one text if it has more
MOST_READINGS = 4096  # characters whose readings a task holds


def letter_numbers() -> np.ndarray:
    """By code point below 1024, a letter's number in the character model."""
    out = np.array([OTHER if chr(i).isalpha() else 0 for i in range(1024)], dtype=np.int64)
    for n, letter in enumerate(LETTERS, 1):
        out[ord(letter)] = n
    return out


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of three letters in a row over all texts. Their number is fixed by the alphabet."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, total = letter_numbers(), np.zeros(STATES**3, dtype=np.int64)
        for batch in batches:
            for value in batch.column("text"):
                codes = np.frombuffer(f" {(value.as_py() or '').lower()} ".encode("utf-32-le"), dtype="<u4")
                for at in range(0, len(codes), 1 << 20):  # blocks overlap by the two characters that a trigram reaches over
                    part = codes[at : at + (1 << 20) + 2]
                    n = np.where(part < 1024, numbers[np.minimum(part, 1023)], OTHER)
                    total += np.bincount((n[:-2] * STATES + n[1:-1]) * STATES + n[2:], minlength=STATES**3)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["trigram", "n"])

    sums = docs.select("text").mapInArrow(count, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(STATES**3)
    out[sums["trigram"].to_numpy(dtype=np.int64)] = sums["n"].to_numpy(dtype=float)
    return out.reshape(STATES, STATES, STATES)


class CharacterModel:
    """Log probability of a letter after two others, interpolated with shorter contexts; 0 begins and ends a word."""

    def __init__(self, counts: np.ndarray):
        two, one = counts.sum(axis=0), counts.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + STATES)
        p2 = (two + p1) / (two.sum(axis=1, keepdims=True) + 1)
        p3 = (counts + p2) / (counts.sum(axis=2, keepdims=True) + 1)
        p3[:, 0, :] = p2[0]  # what came before a word does not bear on it
        self.log = np.log(p3).tolist()
        self.number = {letter: n for n, letter in enumerate(LETTERS, 1)}
        self.readings: dict[str, tuple[list[Read], float | None]] = {}


Read = tuple[str, int, float]  # letter (a space ends a word), its number, and what it costs


def readings(c: str, number: dict[str, int]) -> tuple[list[Read], float | None]:
    """What a character may stand for, and what it costs that it stands for nothing; None if it can't."""
    reads: list[tuple[str, float]] = []
    if c.isalpha():
        reads.append((c, 0.0))
    letters = LEET.get(c, "")
    reads += [(letter, VOWEL if len(letters) > 2 else SIGN) for letter in letters]
    skip = None
    if c in GAPS or not reads:
        skip = NO_VOWEL if letters else GAP
        if not letters:
            reads.append((" ", END))
    return [(letter, 0 if letter == " " else number.get(letter, OTHER), cost) for letter, cost in reads], skip


def restore(span: str, model: CharacterModel) -> str:
    """The most likely letters and word ends behind a stretch of text of any length, by Viterbi over its lattice.

    A path is a chain of (rest of the path, letter), which paths with the same beginning share.
    """
    log, known = model.log, model.readings
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    start = end = 0  # of the run of equal characters
    for i, c in enumerate(span):
        told = known.get(c)
        if told is None:
            told = readings(c, model.number)
            if len(known) < MOST_READINGS:
                known[c] = told
        reads, skip = told
        if i == end:
            start, end = i, i + 1
            while end < len(span) and span[end] == c:
                end += 1
        if skip is None and i > start:
            skip = REPEAT if end - start > 2 else DOUBLE
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, path) in best.items():
            if skip is not None:
                held = after.get((a, b))
                if held is None or score - skip > held[0]:
                    after[a, b] = (score - skip, path)
            row = log[a][b]
            for letter, n, cost in reads:
                found = score + row[n] - cost
                held = after.get((b, n))
                if held is None or found > held[0]:
                    after[b, n] = (found, (path, letter))
        best = after
    path = max(((score + log[a][b][0], path) for (a, b), (score, path) in best.items()), key=lambda x: x[0], default=(0.0, None))[1]
    letters = []
    while path:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


def disguised(token: str) -> str:
    """The part of a token that may be a disguised word, or nothing.

    Signs at its end, and quotes at its start, are punctuation unless a single sign could be a letter.
    """
    bare = token.strip(BOTH_ENDS).rstrip(EDGE)
    ends = bare.rstrip("$*#%&+|@~^=-_/\\")
    if len(bare) - len(ends) != 1 or bare[-1:] not in "$@+":
        bare = ends
    bare = bare.lstrip("*#%&~^=-_/\\+.,")
    if len(bare) < 3 or not any(c.isalpha() for c in bare):
        return ""
    if bare.isalpha():
        return bare if TWICE.search(bare) else ""
    return bare


def words_of(token: str, model: CharacterModel) -> list[str]:
    """The words of letters in a token as written, and what is behind it."""
    if token.isalpha() and not TWICE.search(token):
        return [token]
    out = [w for w in NO_LETTERS.split(token) if w]
    if hidden := disguised(token):
        out += restore(hidden, model).split()
    return out


def tokens_of(text: str) -> set[str]:
    """Tokens between white space, in lower case, and stretches of spaced letters as one token each."""
    low = text.lower()
    out = set(low.split())
    for m in SPACED.finditer(low):
        out.add(re.sub(r"\s+", ".", m[0]))
    return out


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}~" for n in PREFIXES if len(word) > n)]


class Sign(NamedTuple):
    """What a feature tells: how often toxic texts have it, how often a word of other texts is it by chance, and
    the log odds of toxic to other texts where it was learned (after the features of earlier rounds were taken out)."""

    often: float
    chance: float
    odds: float


def fit(docs: DataFrame, labels: DataFrame, counts: np.ndarray, sample: int = SAMPLE) -> tuple[dict[str, Sign], float]:
    """Features that tell, and the share of toxic texts where none is found.

    ``labels`` (doc_id, toxic) says what may be learned from. Of its rows, the ``sample`` with the smallest hashes of
    their doc_id are used; all that is gathered is bounded by them.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(counts)
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    chosen = kept(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "toxic-sample")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = CharacterModel(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words = [{w for t in tokens_of(x or "") for w in words_of(t, model)} for x in part.column("text").to_pylist()]
                found = [sorted({f for w in x for f in features_of(w)}) for x in words]
                yield pa.record_batch([part.column("toxic"), pa.array(map(len, words), pa.int64()), pa.array(found, pa.list_(pa.string()))], names=["toxic", "words", "features"])

    # Copies of a text say nothing new.
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy(F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    rows = kept(texts.select("toxic", "text").mapInArrow(features, "toxic boolean, words long, features array<string>"), "toxic-features")

    def sizes(rows: DataFrame):
        return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("toxic").alias("bad"), F.sum(F.when(~F.col("toxic"), F.col("words"))).alias("words")).first()

    rest, found = rows, {}
    for _ in range(ROUNDS):
        size = sizes(rest)
        if not size["bad"] or size["bad"] == size["n"] or not size["words"]:
            break
        each = rest.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(F.count_if("toxic").alias("bad"), F.count(F.lit(1)).alias("n"))
        tested = each.count()
        base = size["bad"] / size["n"]
        weighed = {}
        for r in each.where(F.col("bad") >= 3).where(F.col("bad") > F.col("n") * max(LEAST_SHARE, base)).toLocalIterator():
            good = r["n"] - r["bad"]
            evidence = 2 * (r["bad"] * math.log(r["bad"] / (r["n"] * base)) + (good * math.log(good / (r["n"] * (1 - base))) if good else 0.0))
            if evidence >= 2 * math.log(2 * tested):  # fewer than one feature in all passes by chance
                weighed[r["feature"]] = evidence, Sign(r["bad"] / size["bad"], (good + 0.5) / size["words"], math.log(base / (1 - base)))
        if not weighed:
            break
        # Words that only come along with a telling one, as in copies of a toxic text, tell nothing once its texts are out.
        least = FOLLOWERS * max(evidence for evidence, _ in weighed.values())
        told = {f: sign for f, (evidence, sign) in weighed.items() if evidence >= least}
        # A beginning that tells no more than one of its words does stands for that word only.
        told = {f: sign for f, sign in told.items() if not (f.endswith("~") and any(g != f and g.startswith(f[:-1]) and weighed[g][0] >= 0.95 * weighed[f][0] for g in told))}
        found = told | found
        rest = kept(_without(rest, set(told)), "toxic-rest")
    size = sizes(rest)
    return found, min(0.49, (size["bad"] + 0.01) / (size["n"] + 1))


def chance_of(signs: dict[str, Sign], words: int) -> float:
    """That a text with these telling words among ``words`` words is toxic.

    A word that toxic texts often have can stand in a long text by chance; the odds rise by how much oftener it is theirs.
    """
    odds = max(s.odds for s in signs.values())
    for sign in signs.values():
        by_chance = 1.0 - math.exp(-words * sign.chance)
        odds += math.log((sign.often + (1 - sign.often) * by_chance) / by_chance)
    return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, odds))))


def _without(rows: DataFrame, told: set[str]) -> DataFrame:
    """Rows that have none of the features."""
    shared = rows.sparkSession.sparkContext.broadcast(told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                batch = big.slice(at, 256)
                yield batch.filter(pa.array([shared.value.isdisjoint(x) for x in batch.column("features").to_pylist()], pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def score(docs: DataFrame, counts: np.ndarray, found: dict[str, Sign], otherwise: float) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, words (restored words that tell, as evidence).

    The score is ``chance_of`` the text's telling words. Null and empty
    texts, and texts without a telling word, score ``otherwise``. Only ``text`` bears on it. Repeated
    rows get the same score. Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((counts, {f: tuple(sign) for f, sign in found.items()}))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("words", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, plain = shared.value
        weights = {f: Sign(*sign) for f, sign in plain.items()}
        model = CharacterModel(table)
        beginnings = {f[:-1] for f in weights if f.endswith("~")}
        known: set[str] = set()
        telling: dict[str, tuple[tuple[str, Sign], ...]] = {}  # of the known tokens, those that tell
        for batch in batches:
            scores, words = [], []
            for text in batch.column("text").to_pylist():
                told: dict[str, Sign] = {}
                tokens = tokens_of(text or "")
                fresh = tokens - known
                if known and len(known) + len(fresh) > WORDS:
                    known.clear()
                    telling.clear()
                    fresh = tokens
                for token in fresh:
                    maybe = [w for w in words_of(token, model) if w in weights or not beginnings.isdisjoint([w[:n] for n in PREFIXES])]
                    signs = ((w, [weights[f] for f in features_of(w) if f in weights]) for w in maybe)
                    if hits := tuple((w, max(x, key=lambda s: s.often / s.chance)) for w, x in signs if x):
                        telling[token] = hits
                known |= fresh
                for token in telling.keys() & tokens:
                    for word, sign in telling[token]:
                        told[word] = sign
                scores.append(chance_of(dict(sorted(told.items())), len(tokens)) if told else otherwise)
                words.append(sorted(told))
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(words, pa.list_(pa.string()))], names=["doc_id", "score", "words"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``score`` of all rows of ``docs``, learned from those that ``labels`` (doc_id, toxic) has."""
    counts = trigram_counts(docs)
    found, otherwise = fit(docs, labels, counts, sample)
    return score(docs, counts, found, otherwise)
