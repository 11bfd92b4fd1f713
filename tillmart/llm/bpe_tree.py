"""BPE encoding and decoding of whole texts, long ones by tree concatenation.

A long text is halved again and again, wherever its middle falls, its parts are encoded in parallel, and
neighbours are joined two by two. Where two halves meet, their encodings say too little about each
other, so a window of tokens around the join is encoded again. It grows until both sides agree: its tokens up to the last white space
before the join are the left half's, and those from the first white space after it the right half's. The
tokenizer never joins two words, so what lies beyond the two white spaces does not change what lies between.

A word that is longer than a part, such as encoded data, has no white space to agree at. It is taken out, cut into its pre-tokens, and
these are halved anywhere. There a window grows until its first token is the left half's token there, and its
last the right half's. Then every two neighbours in the spliced row are
neighbours in the encoding of some text, and a row of tokens of which this holds is the
encoding of the whole: in BPE, the first merge across a token's edge depends on the two tokens at it alone.

Tokenizer files are read where Spark puts them: their path is added to the session's files.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import SPACES

LONG = 1 << 15  # code points from which a text or word, and bytes from which a pre-token, is halved
CACHE = 1 << 17  # words, and as many pre-tokens, whose encodings a worker holds, besides as many from before
ROWS = 256  # rows in a batch of output
PART_ROWS = 32  # parts in one, each with its ids and where they start

# Fixed value: the pattern by which word_bpe_49k.json cuts text into pre-tokens, and what it comes to for ASCII in lower case.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")

CONTROL = re.compile(rb"[\x00-\x20\x7f]")  # other characters of ASCII are themselves as byte symbols

SPACE, WORD = re.compile(r"[\x20\x09-\x0D]"), re.compile(r"[^\x20\x09-\x0D]+")

# What a part is: text between long words, part of a pre-token of a long word, or the id of an added token.
TEXT, PRETOKEN, ADDED = range(3)
PARTS = "part int, piece int, kind int, last boolean, body string"


class Stretch(NamedTuple):
    """A stretch of text and its encoding; ``starts`` are the places in it at which its tokens, or their words, start."""

    text: str
    ids: np.ndarray
    starts: np.ndarray


class Codec:
    """Encodes and decodes with one tokenizer of the ``tokenizers`` library, in one process."""

    def __init__(self, spec: str):
        # Spark has a task on every core already; threads of the library would only take memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(spec)
        self.whole.no_truncation()
        self.whole.no_padding()
        form = json.loads(spec)
        self.vocab, self.merges = form["model"]["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in form["model"]["merges"]]
        self.suffix = form["model"].get("end_of_word_suffix") or ""
        self.plain = self._cuts_ascii(form)
        self.added = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        self.joins = self.widened = 0  # joins of texts, and those whose first window did not do
        # When there are too many, they become those from before; what is not met again until the next turn is forgotten.
        self.words: dict[bytes, bytes] = {}
        self.words_before: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.pieces_before: dict[str, bytes] = {}

    def _cuts_ascii(self, form: dict) -> bool:
        """Whether ASCII_SPLIT of the lower-case text gives the pre-tokens of a word in ASCII."""
        steps = (form.get("normalizer") or {}).get("normalizers", [])
        cuts = (form.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
        bytes_only = {"add_prefix_space": False, "use_regex": False}
        return (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": r"\s+"}
            and len(cuts) == 2
            and cuts[0] == split
            and cuts[1]["type"] == "ByteLevel"
            and bytes_only.items() <= cuts[1].items()
        )

    @cached_property
    def texts(self) -> dict[int, str]:
        return {i: t for t, i in self.vocab.items()}

    def _bpe(self, **more: str):
        from tokenizers.models import BPE

        return BPE(vocab=self.vocab, merges=self.merges, **more)

    @cached_property
    def inner(self):
        """The model for a part that another part follows."""
        return self._bpe()

    @cached_property
    def final(self):
        """The model for the last part of a pre-token."""
        return self._bpe(end_of_word_suffix=self.suffix) if self.suffix else self.inner

    def require_word_ends(self) -> None:
        """Words must not reach over white space, or they could not be encoded one by one."""
        one, two = self.ids("ab cd"), self.ids("ab") + self.ids("cd")
        if one != two or self.ids("ab \t\r\n\x0b\x0c cd") != two:
            raise ValueError("this tokenizer joins words over white space")

    def ids(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def stretch(self, text: str) -> Stretch:
        if self.plain:
            # Words recur here too; their tokens all get the place of the word.
            each = self._each(text.encode().split())
            starts = np.fromiter((word.start() for word in WORD.finditer(text)), dtype="<u4", count=len(each))
            return Stretch(text, np.frombuffer(b"".join(each), dtype="<u4"), np.repeat(starts, [len(word) >> 2 for word in each]))
        found = self.whole.encode(text, add_special_tokens=False)
        return Stretch(text, np.array(found.ids, dtype="<u4"), np.array([a for a, _ in found.offsets], dtype="<u4"))

    def packed(self, text: bytes) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(self._each(text.split()))

    def _each(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word. Words recur, so those that do are encoded once."""
        known = self.words
        missing = set(words).difference(known)
        if len(known) + len(missing) > CACHE:
            self.words_before, self.words = known, (known := {})
            missing = set(words)
        slow, before = [], self.words_before
        for word in missing:
            # Names of added tokens have a "<"; they and other scripts are the library's business.
            if word in before:
                known[word] = before[word]
            elif self.plain and word.isascii() and b"<" not in word and not CONTROL.search(word):
                known[word] = b"".join(map(self._pretoken, ASCII_SPLIT.findall(word.decode("ascii").lower())))
            else:
                slow.append(word)
        if slow:
            found = self.whole.encode_batch_fast([w.decode() for w in slow], add_special_tokens=False)
            for word, encoding in zip(slow, found, strict=True):
                known[word] = np.array(encoding.ids, dtype="<u4").tobytes()
        return list(map(known.__getitem__, words))

    def _pretoken(self, piece: str) -> bytes:
        """Ids of a whole pre-token in ASCII, where characters and bytes are the same."""
        packed = self.pieces.get(piece)
        if packed is None:
            if len(self.pieces) >= CACHE:
                self.pieces_before, self.pieces = self.pieces, {}
            packed = self.pieces_before.get(piece)
            if packed is None:
                packed = b"".join([t.id.to_bytes(4, "little") for t in self.final.tokenize(piece)])
            self.pieces[piece] = packed
        return packed

    def decode(self, packed: bytes) -> str:
        return self.whole.decode(np.frombuffer(packed, dtype="<u4").tolist(), skip_special_tokens=False)

    def pretokens(self, word: str) -> list[str | int]:
        """A word's pre-tokens, and the ids of added tokens between them."""
        out: list[str | int] = []
        names = sorted(self.added, key=len, reverse=True)
        for bit in re.split("(" + "|".join(map(re.escape, names)) + ")", word) if names else [word]:
            if bit in self.added:
                out.append(self.added[bit])
            elif bit:
                normal = self.whole.normalizer.normalize_str(bit) if self.whole.normalizer else bit
                out += [p for p, _ in self.whole.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def piece(self, symbols: str, last: bool) -> list[int]:
        """Ids of part of a pre-token; ``last`` if it ends the pre-token."""
        return [t.id for t in (self.final if last else self.inner).tokenize(symbols)]

    def symbols(self, ids: list[int]) -> str:
        return "".join(self.texts[i].removesuffix(self.suffix) if self.suffix else self.texts[i] for i in ids)

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """The encoding of two neighbouring parts of a pre-token out of the encodings of each."""
        width = 2
        while True:
            a, b = left[-width:], right[:width]
            whole_a, whole_b = len(a) == len(left), len(b) == len(right)
            window = self.piece(self.symbols(a + b), last and whole_b)
            if (whole_a or window[0] == a[0]) and (whole_b or window[-1] == b[-1]):
                return left[: len(left) - len(a)] + window + right[len(b) :]
            width *= 2

    def join_all(self, parts: list[list[int]], ends: bool) -> list[int]:
        """Neighbours are joined two by two until one is left."""
        while len(parts) > 1:
            pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
            parts = [p[0] if len(p) == 1 else self.join(p[0], p[1], ends and k == len(pairs) - 1) for k, p in enumerate(pairs)]
        return parts[0] if parts else []

    def join_texts(self, left: Stretch, right: Stretch) -> Stretch:
        """The encoding of two neighbouring stretches of text out of the encodings of each."""
        text, cut = left.text + right.text, len(left.text)
        right_starts = right.starts + cut
        self.joins += 1
        width = 2
        while True:
            first, after = max(len(left.ids) - width, 0), min(width, len(right.ids))
            # Tokens that start at the same place are in the window together.
            first = int(np.searchsorted(left.starts, left.starts[first])) if first else 0
            after = int(np.searchsorted(right.starts, right.starts[after - 1], side="right")) if after else 0
            begin = int(left.starts[first]) if first else 0
            end = int(right_starts[after]) if after < len(right.ids) else len(text)
            window = self.stretch(text[begin:end])
            starts = window.starts + begin
            # The white spaces nearest the join; a side that is in the window as a whole needs none.
            low = max(text.rfind(space, begin, cut) for space in SPACES) if first else 0
            found = SPACE.search(text, cut, end) if after < len(right.ids) else None
            high = found.start() if found else end if after == len(right.ids) else -1
            if low >= 0 and high >= 0:
                left_kept = first + int((left.starts[first:] < low).sum())
                right_left_out = int((right_starts[:after] < high).sum())
                head, tail = int((starts < low).sum()), int((starts < high).sum())
                same_left = not first or (head and np.array_equal(window.ids[:head], left.ids[first:left_kept]))
                same_right = after == len(right.ids) or (tail < len(starts) and np.array_equal(window.ids[tail:], right.ids[right_left_out:after]))
                if same_left and same_right:
                    break
            if width == 2:
                self.widened += 1
            width *= 2
        pick = [(left.ids, left.starts, slice(left_kept)), (window.ids, starts, slice(head, tail)), (right.ids, right_starts, slice(right_left_out, None))]
        return Stretch(text, np.concatenate([i[at] for i, _, at in pick]), np.concatenate([s[at] for _, s, at in pick]).astype("<u4"))

    def join_all_texts(self, parts: list[Stretch]) -> Stretch:
        while len(parts) > 1:
            parts = [self.join_texts(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]


_codecs: dict[str, Codec] = {}


def codec_of(spec: str) -> Codec:
    """The codec of this process. Spark gives a worker one task after the other: were one made for each, the
    memory that is left between what a task frees would grow with the number of tasks."""
    if spec not in _codecs:
        _codecs.clear()
        _codecs[spec] = Codec(spec)
    return _codecs[spec]


def halves(text: str, most: int) -> list[str]:
    """The text cut in two, its parts likewise, until none is longer than ``most``."""
    if len(text) <= most:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], most) + halves(text[middle:], most)


def cut(codec: Codec, text: str, most: int) -> Iterator[tuple[int, int, bool, str]]:
    """The parts of a text: (piece, kind, last, body). Parts to be joined share a piece number;
    an added token's body is its id."""
    piece = done = 0
    for start, end in [*(w.span() for w in WORD.finditer(text) if w.end() - w.start() > most), (len(text), len(text))]:
        found = [(TEXT, text[done:start])] if start > done else []
        found += [(ADDED, str(p)) if isinstance(p, int) else (PRETOKEN, p) for p in codec.pretokens(text[start:end])] if end > start else []
        for kind, body in found:
            bits = [body] if kind == ADDED else halves(body, most)
            for k, bit in enumerate(bits):
                yield piece, kind, k == len(bits) - 1, bit
            piece += 1
        done = end


def encoded_part(codec: Codec, kind: int, last: bool, body: str) -> tuple[bytes, bytes | None]:
    """The ids of one part, and for text the places at which they start."""
    if kind == TEXT:
        found = codec.stretch(body)
        return found.ids.tobytes(), found.starts.tobytes()
    ids = [int(body)] if kind == ADDED else codec.piece(body, last)
    return np.array(ids, dtype="<u4").tobytes(), None


def joined_ids(codec: Codec, parts: Iterable[tuple[int, int, str | None, bytes, bytes | None]]) -> bytes:
    """The ids of a text out of its parts in order: (piece, kind, body, ids, starts)."""
    out = []
    for _, group in groupby(parts, key=lambda p: p[0]):
        rows = list(group)
        if rows[0][1] == TEXT:
            found = codec.join_all_texts([Stretch(body, np.frombuffer(ids, dtype="<u4"), np.frombuffer(starts, dtype="<u4")) for _, _, body, ids, starts in rows])
            out.append(found.ids.tobytes())
        else:
            found = codec.join_all([np.frombuffer(ids, dtype="<u4").tolist() for _, _, _, ids, _ in rows], True)
            out.append(np.array(found, dtype="<u4").tobytes())
    return b"".join(out)


def tokenizer_spec(path: str) -> str:
    """The tokenizer file's content; it goes to the tasks as a broadcast value (its size is the vocabulary's)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_decode(docs: DataFrame, tokenizer: str, long: int = LONG) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (binary: little-endian unsigned 32-bit), decoded.

    The ids are those of the ``tokenizers`` library with the file ``tokenizer`` and no special
    tokens added, for the whole text; ``decoded`` is its decoding of them with special tokens
    kept. Null and empty texts have no ids and decode to an empty text. Repeated rows each get
    a row; doc_id may be null. Other columns of ``docs`` are not read. Texts of over ``long``
    code points are encoded in parts; the result does not depend on it. A tokenizer that
    joins words over white space is refused. An empty table gives no rows.
    """
    spark = docs.sparkSession
    spec = tokenizer_spec(tokenizer)
    Codec(spec).require_word_ends()
    shared = spark.sparkContext.broadcast(spec)
    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.length("text") > long

    def in_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for big in batches:
            for at in range(0, big.num_rows, ROWS):
                batch = big.slice(at, ROWS)
                packed = [codec.packed(t.as_py()) for t in batch.column("text")]
                decoded = [codec.decode(p) for p in packed]
                yield pa.record_batch([batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                found = list(cut(codec, row["text"], long))
                columns = [[row["doc_id"]] * len(found), [row["key"]] * len(found), [row["copies"]] * len(found), list(range(len(found))), *zip(*found, strict=True)]
                yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, part_schema, strict=True)], schema=part_schema)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for big in batches:
            for at in range(0, big.num_rows, PART_ROWS):
                batch = big.slice(at, PART_ROWS)
                rows = batch.select(["kind", "last", "body"]).to_pylist()
                ids, starts = zip(*(encoded_part(codec, **row) for row in rows), strict=True)
                # Only text is looked at again.
                bodies = [row["body"] if row["kind"] == TEXT else None for row in rows]
                names = ["doc_id", "key", "copies", "part", "piece", "kind"]
                made = [pa.array(bodies, pa.string()), pa.array(ids, pa.binary()), pa.array(starts, pa.binary())]
                yield pa.record_batch([*(batch.column(n) for n in names), *made], names=[*names, "body", "ids", "starts"])

    def joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        codec = codec_of(shared.value)
        rows = rows.sort_values("part")
        ids = joined_ids(codec, rows[["piece", "kind", "body", "ids", "starts"]].itertuples(index=False, name=None))
        return pd.DataFrame({"doc_id": [rows["doc_id"].iloc[0]], "copies": [rows["copies"].iloc[0]], "ids": [ids], "decoded": [codec.decode(ids)]})

    id_type = docs.limit(0).select("doc_id").toArrow().schema.field(0).type
    part_schema = pa.schema(
        [("doc_id", id_type), ("key", pa.string()), ("copies", pa.int64()), ("part", pa.int32()), ("piece", pa.int32()), ("kind", pa.int32()), ("last", pa.bool_()), ("body", pa.string())]
    )
    short = read.where(~is_long).select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(in_place, f"doc_id {kind}, ids binary, decoded string")
    # The same long text under the same doc_id is encoded once.
    whole = read.where(is_long).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies")).withColumn("key", F.md5("text"))
    dealt = whole.mapInArrow(parts, f"doc_id {kind}, key string, copies long, {PARTS}").repartition("doc_id", "key", "part")
    coded = dealt.mapInArrow(encoded, f"doc_id {kind}, key string, copies long, part int, piece int, kind int, body string, ids binary, starts binary")
    long_rows = coded.groupBy("doc_id", "key").applyInPandas(joined, f"doc_id {kind}, copies long, ids binary, decoded string")
    long_rows = long_rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return short.unionByName(long_rows.select("doc_id", "ids", "decoded"))
