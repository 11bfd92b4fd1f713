"""Language ID by unigram pieces of a fixed public vocabulary, summed over all segmentations.

A word can be cut into pieces of the vocabulary in many ways. Its probability in a language is
the sum over all of them of the product of the pieces' probabilities there; the forward
algorithm adds them up from left to right. Training weighs each piece by its expected count over
all segmentations (forward and backward sums), from the counts of words by language over the
whole training text.

Words recur, so a task works on distinct words, many at once: numpy goes over positions and
lengths of pieces, not over words. Words are whole, however long, and pieces may have any length that the vocabulary has. Sums over
long words, which would run out of the range of numbers, are carried as ratios of one prefix to the next.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDETERMINED = "und"
START = "▁"  # begins a word in the vocabulary
PLAIN = 32  # characters up to which a word's sums stay within the range of numbers as they are
PARTS = 1_000_000  # an expected count is a whole number of these
FLOOR = 1e-7  # probability of a character that no piece covers
WORDS = 1 << 18  # distinct words that a task holds


_BASE = np.uint64(0x100000001B3)


class Pieces:
    """The vocabulary as hashes of its pieces, by length. Pieces that no word of lower-case letters can hold are never found."""

    def __init__(self, pieces: list[str]):
        usable: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            letters = piece.removeprefix(START)
            if piece == START or (letters.isalpha() and letters == letters.lower()):
                usable.setdefault(len(piece), []).append(i)
        self.by_length = {}
        for n, listed in sorted(usable.items()):
            ids = np.array(listed, dtype=np.int64)
            codes = np.array([[ord(c) for c in pieces[i]] for i in listed], dtype=np.uint64)
            keys = np.zeros(len(ids), dtype=np.uint64)
            for k in range(n):
                keys = keys * _BASE + codes[:, k] + np.uint64(1)
            order = np.argsort(keys)
            self.by_length[n] = (keys[order], ids[order])
        self.size = len(pieces)

    def found(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Of each row of ``codes`` (words by characters): for each length, at each start, the piece of that length that lies there, or -1."""
        width = codes.shape[1]
        spans = np.zeros(codes.shape, dtype=np.uint64)
        for n in range(1, min(width, max(self.by_length, default=1)) + 1):
            spans = spans[:, : width - n + 1] * _BASE + codes[:, n - 1 :] + np.uint64(1)
            if n in self.by_length:
                keys, ids = self.by_length[n]
                at = np.searchsorted(keys, spans).clip(max=len(keys) - 1)
                yield n, np.where(keys[at] == spans, ids[at], -1)
            elif n == 1:
                yield n, np.full(spans.shape, -1)


def letters_only(token: str) -> list[str]:
    """Words of letters in a token, in lower case, START before each."""
    words = [token] if token.isalpha() else "".join(c if c.isalpha() else " " for c in token).split()
    return [START + word for word in words]


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of words of one length, and their characters; blocks of bounded size."""
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        rows = max(1, (1 << 18) // int(n))
        for k in range(0, len(at), rows):
            part = at[k : k + rows]
            text = "".join(words[i] for i in part)
            yield part, np.frombuffer(text.encode("utf-32-le"), dtype="<u4").reshape(len(part), n).astype(np.uint64)


Edges = dict[int, np.ndarray]


def _edges(pieces: Pieces, codes: np.ndarray, probability: np.ndarray) -> tuple[Edges, Edges]:
    """Of each length that is there: probabilities (languages, words, starts) of the pieces that lie there, and their numbers. A lone
    character without a piece has FLOOR."""
    chances, numbers = {}, {}
    for n, found in pieces.found(codes):
        here = found >= 0
        if n > 1 and not here.any():
            continue
        value = np.full((len(probability), *found.shape), FLOOR if n == 1 else 0.0)
        value[:, here] = probability[:, found[here]]
        chances[n], numbers[n] = value, found
    return chances, numbers


def forward(edges: Edges, width: int) -> np.ndarray:
    """Sums over all segmentations of each prefix: (width + 1, languages, words)."""
    total = np.zeros((width + 1, *edges[1].shape[:2]))
    total[0] = 1.0
    for end in range(1, width + 1):
        for n, chance in edges.items():
            if n <= end:
                total[end] += total[end - n] * chance[:, :, end - n]
    return total


def log_forward(edges: Edges, width: int) -> np.ndarray:
    """Logarithms of ``forward``, for words of any length.

    What is carried is by how much a prefix exceeds the one before. ``back[n]`` is the sum of the prefix n characters back, over that
    of the last one; numbers stay as close to 1 as a few pieces are.
    """
    longest = max(edges)
    logs = np.zeros((width + 1, *edges[1].shape[:2]))
    back = [np.ones(edges[1].shape[:2])]
    for end in range(1, width + 1):
        ratio = sum(back[n - 1] * chance[:, :, end - n] for n, chance in edges.items() if n <= end)
        logs[end] = logs[end - 1] + np.log(ratio)
        back = [np.ones_like(ratio), *(b / ratio for b in back[: longest - 1])]
    return logs


def word_scores(pieces: Pieces, words: list[str], probability: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language: (words, languages)."""
    out = np.zeros((len(words), probability.shape[0]))
    for at, codes in _by_length(words):
        edges, width = _edges(pieces, codes, probability)[0], codes.shape[1]
        out[at] = (np.log(forward(edges, width)[-1]) if width <= PLAIN else log_forward(edges, width)[-1]).T
    return out


def expected_counts(pieces: Pieces, words: list[str], counts: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """Expected number of each piece over all segmentations of words that occur ``counts`` times, in whole PARTS.

    Each word's expectation is rounded by itself, so sums do not depend on which words are looked at together.
    """
    out = np.zeros(pieces.size, dtype=np.int64)
    for at, codes in _by_length(words):
        width = codes.shape[1]
        edges, numbers = _edges(pieces, codes, probability[None, :])
        turned = {n: chance[:, :, ::-1] for n, chance in edges.items()}
        sums = (lambda e: np.log(forward(e, width))) if width <= PLAIN else (lambda e: log_forward(e, width))
        ahead, behind = sums(edges)[:, 0], sums(turned)[::-1, 0]
        for n, found in numbers.items():
            word, start = np.nonzero(found >= 0)
            log_share = ahead[start, word] + np.log(edges[n][0, word, start]) + behind[start + n, word] - ahead[width, word]
            share = np.rint(np.exp(log_share) * PARTS).astype(np.int64)
            np.add.at(out, found[word, start], share * counts[at][word])
    return out


def vocabulary(model: str) -> list[str]:
    """Pieces of a public sentencepiece model. Only its list of pieces is used, not its scores."""
    import sentencepiece

    read = sentencepiece.SentencePieceProcessor(model_file=model)
    return [read.id_to_piece(i) if not (read.is_control(i) or read.is_byte(i) or read.is_unknown(i)) else "" for i in range(read.get_piece_size())]


def train(labelled: DataFrame, pieces: list[str]) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities from all rows of ``labelled`` (text, lang).

    What reaches the driver is one number for each language and piece of the fixed vocabulary.
    """
    shared = labelled.sparkSession.sparkContext.broadcast(pieces)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Pieces(shared.value)
        uniform = np.full(table.size, 1.0 / table.size)
        held: dict[str, Counter] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                split: Counter = Counter()
                for token, n in words.items():
                    for word in letters_only(token):
                        split[word] += n
                if split:
                    expected = expected_counts(table, list(split), np.array(list(split.values()), dtype=np.int64), uniform)
                    at = np.flatnonzero(expected)
                    yield pa.record_batch([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(expected[at])], names=["lang", "piece", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.setdefault(lang, Counter()).update(text.lower().split())
                if sum(map(len, held.values())) > WORDS:
                    yield from flushed()
        yield from flushed()

    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    # Whole numbers, word by word: sums depend neither on the order of tasks nor on how rows are dealt out.
    sums = rows.mapInArrow(count, "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    found = sums.toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(languages), len(pieces)))
    counts[found["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=int), found["piece"].to_numpy(dtype=int)] = found["n"] / PARTS
    counts += 0.01  # pieces a language was not seen with
    return languages, counts / counts.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, languages: list[str], probability: np.ndarray, pieces: list[str], carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: document, lang_pred, score; ``document`` has the columns named in ``carry``.

    The score is the share of the language among all, for the text's mean word: 1 over the number of
    languages if they are alike. ``und`` with score 0 is given to texts that are null or have no
    letter, and to all if nothing was learned. Only ``text`` bears on it. Repeated rows get the same
    answer. As carried columns are nested, their names can't clash. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((languages, probability, pieces))
    carry = list(carry)
    read = list(dict.fromkeys([*carry, "text"]))
    schema = T.StructType([T.StructField("document", T.StructType([docs.schema[c] for c in carry])), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, model, listed = shared.value
        table = Pieces(listed)
        known: dict[str, int] = {}
        scores = np.zeros((0, len(names)))
        sizes = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                tokens = [(t or "").lower().split() for t in part.column("text").to_pylist()]
                fresh = list(set(chain.from_iterable(tokens)) - known.keys())
                if len(known) + len(fresh) > WORDS:
                    known.clear()
                    scores, sizes = scores[:0], sizes[:0]
                    fresh = list(set(chain.from_iterable(tokens)))
                words = [letters_only(t) for t in fresh]
                flat = list(chain.from_iterable(words))
                each = word_scores(table, flat, model) if names else np.zeros((len(flat), 0))
                of = np.repeat(np.arange(len(fresh)), [len(w) for w in words])
                sums = np.zeros((len(fresh), len(names)))
                np.add.at(sums, of, each)
                known.update(zip(fresh, range(len(known), len(known) + len(fresh)), strict=True))
                scores = np.concatenate([scores, sums])
                sizes = np.concatenate([sizes, np.array([len(w) for w in words], dtype=np.int64)])
                preds, values = [], []
                for row in tokens:
                    ids = np.fromiter((known[t] for t in row), dtype=np.int64, count=len(row))
                    n = int(sizes[ids].sum())
                    if not n or not names:
                        preds.append(UNDETERMINED)
                        values.append(0.0)
                        continue
                    mean = scores[ids].sum(axis=0) / n
                    share = np.exp(mean - mean.max())
                    preds.append(names[int(mean.argmax())])
                    values.append(float(share.max() / share.sum()))
                document = pa.StructArray.from_arrays([part.column(c) for c in carry], fields=[part.schema.field(c) for c in carry])
                yield pa.record_batch([document, pa.array(preds, pa.string()), pa.array(values, pa.float64())], names=["document", "lang_pred", "score"])

    return docs.select(*read).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from; a null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identify(docs: DataFrame, model: str, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Learns from the rows of ``docs`` that are not held out and have a lang; then ``predict`` for all rows."""
    pieces = vocabulary(model)
    languages, probability = train(docs.where(~held_out(F.col("doc_id"))), pieces)
    return predict(docs, languages, probability, pieces, carry)
