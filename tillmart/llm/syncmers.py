"""Document fingerprints from closed syncmers. DataFrame and SQL functions only.

A text is read in units: its words, but single characters where words are not told apart by white
space (scripts written without it, and words of over ``LONGEST`` code points). A k-mer is ``k`` units in a row;
its inner substrings are its single units, ordered by hash. The k-mer is chosen if the smallest of
them is its first or its last. That depends on nothing but the k-mer itself: the same passage gives
the same anchors wherever it stands, at about 2 / k of its places, and no gap between two anchors is
longer than k units unless the text repeats itself. Texts of up to ``SHORT`` code points, in which few
k-mers of words are whole after an edit, have anchors over their characters besides.

Anchors are matched by position: one counts as found in another text if that has it at the same distance
from the same anchor before it. What was moved as a whole still matches, the same words in other places don't.

An anchor is one long integer: its distance from the anchor before (the first: from the text's start) in the
upper half, its hash in the lower.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import SPACE_CLASS, kept

K = 5
HASH_BITS = 32
LONGEST = 32
SHORT = 256
MOST_RANGES = 1 << 14

# Thai, Lao, Tibetan, Burmese, Khmer, kana, Han: scripts without spaces between words.
UNSPACED = "฀-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff"
_OTHER = f"[^{SPACE_CLASS}{UNSPACED}]"
UNIT = f"{_OTHER}{{1,{LONGEST}}}+(?!{_OTHER})|[^{SPACE_CLASS}]"
CHARACTER = f"[^{SPACE_CLASS}]"


def unit_hashes(text: Column, unit: str = UNIT) -> Column:
    """Hashes of the units in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(unit), F.lit(0)), lambda u: F.xxhash64(u))


def _chosen(hashes: Column, k: int) -> Column:
    """Numbers of the units at which chosen k-mers start. Texts of fewer than ``k`` units are one k-mer, those without units have none."""

    def smallest_at_edge(i: Column) -> Column:
        inner = F.least(*[F.get(hashes, i + j) for j in range(1, k - 1)]) if k > 3 else F.get(hashes, i + 1)
        return F.least(F.get(hashes, i), F.get(hashes, i + (k - 1))) <= inner

    size = F.size(hashes)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(size - k, F.lit(0))), smallest_at_edge)
    return F.when(size >= k, starts).when(size > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))


def _packed(hashes: Column, starts: Column, k: int) -> Column:
    def anchor(start: Column, i: Column) -> Column:
        gap = start - F.coalesce(F.get(starts, i - 1), F.lit(0))
        kmer = F.xxhash64(*[F.get(hashes, start + j) for j in range(k)])
        return F.shiftleft(gap.cast("long"), HASH_BITS).bitwiseOR(F.shiftrightunsigned(kmer, 64 - HASH_BITS))

    return F.transform(starts, anchor)


def with_anchors(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """``df`` with ``name``, a struct of the anchors of the column ``text`` over ``units`` and, in short texts, over ``characters``."""
    short = F.when(F.length(text) <= SHORT, F.col(text)).otherwise(F.lit(""))
    made = df.withColumns({"_units": unit_hashes(F.col(text)), "_characters": unit_hashes(short, CHARACTER)})
    made = made.withColumns({"_unit_starts": _chosen(F.col("_units"), k), "_character_starts": _chosen(F.col("_characters"), k)})
    units = _packed(F.col("_units"), F.col("_unit_starts"), k).alias("units")
    characters = _packed(F.col("_characters"), F.col("_character_starts"), k).alias("characters")
    return made.withColumn(name, F.struct(units, characters)).drop("_units", "_characters", "_unit_starts", "_character_starts")


def as_text(anchors: Column) -> Column:
    """Anchors in the order of the text, each as eight hex digits, ``+`` and its distance in decimal; those over characters after a ``|``."""

    def shown(a: Column) -> Column:
        digits = F.lower(F.lpad(F.hex(a.bitwiseAND((1 << HASH_BITS) - 1)), HASH_BITS // 4, "0"))
        return F.concat(digits, F.lit("+"), F.shiftright(a, HASH_BITS).cast("string"))

    units, characters = (F.array_join(F.transform(anchors[part], shown), " ") for part in ("units", "characters"))
    return F.when(F.size(anchors["characters"]) > 0, F.concat(units, F.lit("|"), characters)).otherwise(units)


def links(anchors: Column) -> Column:
    """Anchors with the anchor before: what two texts must have in common for an anchor to match in its place."""
    units, characters = anchors["units"], anchors["characters"]

    def link(part: Column, salt: int):
        return lambda a, i: F.xxhash64(F.lit(salt), F.get(part, i - 1).bitwiseAND((1 << HASH_BITS) - 1), a)

    return F.array_distinct(F.concat(F.transform(units, link(units, 0)), F.transform(characters, link(characters, 1))))


def likeness(one: Column, two: Column) -> Column:
    """Share of two texts' distinct ``links`` that both have (Dice): 0 to 1. Two texts without anchors are alike."""
    total = F.size(one) + F.size(two)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(one, two)) / total)


def _ranges(docs: DataFrame, rows_per_range: int) -> Column:
    """The range of each row in the order by descending doc_id, nulls last, then hash: cut at quantiles of doc_id. A doc_id that
    several quantiles fall on, and null, are cut finer by hash. There are at most ``MOST_RANGES`` ranges of each kind."""
    n, numbered = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()  # two numbers
    parts = min(max(1, numbered // rows_per_range), MOST_RANGES)
    unnumbered = min(max(1, (n - numbered) // rows_per_range), MOST_RANGES)
    at = [(parts - i) / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", at, 10 * MOST_RANGES)).first()[0] if at else None
    falling = found or []  # MOST_RANGES numbers at most
    step = max(1, int(len(falling) ** 0.5))

    def numbers(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")

    def how_many(test) -> Column:
        """How many of the falling quantiles pass the test, which the first ones do: whole steps, then within a step."""
        steps = F.size(F.filter(numbers(falling[step - 1 :: step]), test))
        return steps * step + F.size(F.filter(F.slice(numbers(falling), steps * step + 1, step), test))

    top = F.shiftright("hash", 32) + (1 << 31)  # 0 to 2^32 - 1, in the order of the hash
    greater = how_many(lambda q: q > F.col("doc_id"))
    equal = how_many(lambda q: q >= F.col("doc_id")) - greater
    known = greater + F.shiftright(top * equal, 32)
    return F.when(F.col("doc_id").isNotNull(), known).otherwise(F.shiftright(top * unnumbered, 32) + len(falling) + 1).cast("long")


def with_next(docs: DataFrame, rows_per_range: int) -> DataFrame:
    """``docs`` (doc_id, text, hash and others) with ``next``, a struct of the others of the row after it by descending doc_id; after the last, the first.

    Null doc_ids come after all others; rows that share a doc_id go by their hash. Ranges of rows are put in order one by one, and texts
    are shuffled once for it. What a range's last row needs is the first row of the next range; these are looked up.
    """
    if docs.schema["doc_id"].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError("doc_id must be a whole number")
    ranged = docs.withColumn("range", _ranges(docs.select("doc_id", "hash"), rows_per_range))
    rest = F.struct(*[c for c in docs.columns if c not in ("doc_id", "hash")])
    # ~x turns the order of numbers round.
    firsts = ranged.groupBy("range").agg(F.min(F.struct(F.bitwise_not("doc_id").isNull().alias("unnumbered"), F.bitwise_not("doc_id").alias("turned"), "hash")).alias("first"))
    by_range = Window.orderBy("range")  # one row a range
    whole = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = firsts.select(F.col("range").alias("before"), F.coalesce(F.lead("first").over(by_range), F.first("first").over(whole)).alias("head"))
    # Written, so that their number is known when the texts are searched for them.
    heads = kept(heads.select("before", F.bitwise_not("head.turned").alias("id"), F.col("head.hash").alias("h")), "syncmer-heads")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h"))
    looked_up = kept(docs.join(heads, same).groupBy("before").agg(F.first(rest).alias("head")), "syncmer-first-rows")
    within = Window.partitionBy("range").orderBy(F.col("doc_id").desc_nulls_last(), F.col("hash").asc())
    followed = ranged.withColumn("following", F.lead(rest).over(within))
    joined = followed.join(looked_up, (F.col("range") == F.col("before")) & F.col("following").isNull(), "left")
    return joined.select(*docs.columns, F.coalesce("following", "head").alias("next"))


def edited_fingerprints(docs: DataFrame, k: int = K, rows_per_range: int = 8192) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_text, anchors, edited_anchors, near_edited, near_next.

    The edited text is the text with its last ``floor(n_chars / 2)`` code points replaced by as many (or
    all there are) from the start of the next document by descending doc_id; after the last comes
    the first. Null texts count as empty. Repeated rows follow each other in that order; an only
    document is its own next. doc_id is a whole number or null; other types are refused. Other columns
    of ``docs`` are not read. An empty table gives no rows.
    """
    body = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", body.alias("text"), F.xxhash64(body).alias("hash"))
    half = F.floor(F.length("text") / 2).cast("int")
    paired = with_next(read, rows_per_range)
    paired = paired.withColumn("edited_text", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(F.col("next.text"), F.lit(1), half)))
    paired = paired.withColumn("next_text", F.col("next.text"))
    for name, source in (("anchors", "text"), ("edited_anchors", "edited_text"), ("next_anchors", "next_text")):
        paired = with_anchors(paired, source, name, k)
    linked = paired.withColumns({f"_{name}": links(F.col(name)) for name in ("anchors", "edited_anchors", "next_anchors")})
    return linked.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "edited_text",
        "anchors",
        "edited_anchors",
        likeness(F.col("_anchors"), F.col("_edited_anchors")).alias("near_edited"),
        likeness(F.col("_anchors"), F.col("_next_anchors")).alias("near_next"),
    )
