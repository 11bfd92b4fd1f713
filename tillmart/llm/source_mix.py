"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame and SQL functions only.

1. Each source gets a target number of words (``targets``).
2. A source's documents, in an order shuffled by a hash of doc_id, form one stream of words,
   cut into blocks of equal size (to a word).
3. The mix has slots 0, 1, 2, …. Slot i maps the point ``frac(i * golden ratio)`` through the
   sources' cumulative slot weights to a source. Such points spread so evenly that any
   run of slots has each source close to its share.
4. The r-th slot of a source takes its block ``r mod blocks``; after the last block, the stream starts anew.

Ranks and running sums of a source come from sums over ranges (of slots, of hashes) and a small
table of range totals, so a source with most of the rows is not in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import SPACE_CLASS, kept

WEIGHTS = (1, 2, 3)  # of the sources by code point, null last, repeating
POINTS = 1 << 31  # points are whole multiples of 1 / POINTS
GOLDEN = 1327217885  # POINTS over the golden ratio, odd, so that POINTS slots have as many points
CELLS = 1 << 12  # equal parts of the unit interval by which slots find their source
SLOT_RANGE = 1 << 16  # slots that are ranked together
HASH_DIGITS = 3  # hex digits of the shuffling hash that name a range of documents


def words_in(text: Column) -> Column:
    """Number of runs of characters that aren't white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE_CLASS}]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target) from ``sizes`` (source, size).

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share the sum of all sizes.
    No target exceeds ``max_epochs`` times its source's size; what is over is shared again by
    weight. That ends where each target is the lesser of its cap and weight times one common
    level; sorted by cap over weight, the level follows from running sums.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (rank % len(WEIGHTS) + 1).cast("int")).cast("double"))
    by_cap = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    levels = (
        weighed.withColumn("cap", F.col("source_size").cast("double") * max_epochs)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("capped", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.sum("source_size").over(whole) - F.col("capped")) / F.col("open"))
        .withColumn("common", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole))
    )
    return levels.select("source", "source_size", F.least("cap", F.col("weight") * F.coalesce("common", "ratio")).alias("target"))


def _plan(sources: DataFrame, block_words: int) -> DataFrame:
    """Blocks of each source and its part of the points: [low, high) of POINTS, and the slots in all."""
    order = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    return (
        sources.where("source_size > 0")
        .withColumn("blocks", F.greatest(F.lit(1), F.round(F.col("source_size") / block_words)).cast("long"))
        .withColumn("due", F.col("target") * F.col("blocks") / F.col("source_size"))
        .withColumn("slots", F.ceil(F.sum("due").over(whole)).cast("long"))
        .withColumn("high", F.round(F.sum("due").over(order) / F.sum("due").over(whole) * POINTS).cast("long"))
        .withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy(F.col("source").asc_nulls_last())), F.lit(0)))
        .select("source", "source_size", "target", "blocks", "slots", "low", "high")
    )


def schedule(sources: DataFrame, block_words: int = 64, max_epochs: int = 3) -> DataFrame:
    """(slot, source, block, epoch): what each slot of the mix takes, from ``targets``' rows."""
    plan = kept(_plan(sources, block_words), "mix-plan")
    slots = (plan.agg(F.max("slots")).first()[0]) or 0  # one number
    points = sources.sparkSession.range(slots).select(F.col("id").alias("slot"), ((F.col("id") % POINTS * GOLDEN) % POINTS).alias("point"))
    width = POINTS // CELLS
    cells = plan.where("high > low").select(
        "source", "blocks", "low", "high", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell")
    )
    drawn = points.withColumn("cell", F.floor(F.col("point") / width)).join(cells, "cell").where("point >= low and point < high")
    # Ranks among the slots of a source: within ranges of slots, then on top of the ranges before.
    ranged = drawn.withColumn("range", F.floor(F.col("slot") / SLOT_RANGE))
    counts = ranged.groupBy("source", "range").agg(F.count(F.lit(1)).alias("here"))
    before = counts.select(
        F.col("source").alias("of"),
        F.col("range").alias("in"),
        (F.sum("here").over(Window.partitionBy("source").orderBy("range")) - F.col("here")).alias("before"),
    )
    rank = F.row_number().over(Window.partitionBy("source", "range").orderBy("slot")) - 1
    ranked = ranged.withColumn("rank", rank).join(before, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in")))
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    return ranked.select(
        "slot", "source", (F.col("rank") % F.col("blocks")).alias("block"), F.floor(F.col("rank") / F.col("blocks")).alias("epoch")
    ).where(F.col("epoch") < max_epochs)


def streams(sized: DataFrame, seed: int = 42) -> DataFrame:
    """``sized`` (doc_id, source, size) with ``start``: the words before a document in its source's shuffled stream."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = sized.withColumn("key", key).withColumn("range", F.substring("key", 1, HASH_DIGITS))
    within = Window.partitionBy("source", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = keyed.groupBy("source", "range").agg(F.sum("size").alias("here"))
    offsets = sums.select(
        F.col("source").alias("of"),
        F.col("range").alias("in"),
        (F.sum("here").over(Window.partitionBy("source").orderBy("range")) - F.col("here")).alias("before"),
    )
    placed = keyed.withColumn("within", F.sum("size").over(within) - F.col("size"))
    placed = placed.join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in")))
    return placed.withColumn("start", F.col("within") + F.col("before")).drop("key", "range", "within", "of", "in", "before")


def mixture(docs: DataFrame, block_words: int = 64, max_epochs: int = 3, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken.

    ``size`` is the number of words (runs of ``[^\\x20\\x09-\\x0D]``, null text: 0), ``taken`` how many of them the mix
    takes, repeats counted; it never exceeds ``max_epochs`` times the size. A null source is a source
    of its own. Rows without words take nothing; if no row has any, all targets are 0. Rows that
    repeat a doc_id are rows of their own next to each other in the stream. Reruns give the same
    rows. Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    sized = kept(docs.select("doc_id", "source", words_in(F.col("text")).alias("size")), "mix-sizes")
    sources = kept(targets(sized, max_epochs), "mix-sources")
    plan = _plan(sources, block_words).select(F.col("source").alias("of"), "source_size", "blocks")
    drawn = schedule(sources, block_words, max_epochs).groupBy("source", "block").agg(F.count(F.lit(1)).alias("times"))
    placed = streams(sized.withColumn("row", F.monotonically_increasing_id()), seed)
    # Block b of a source has the words from floor(b * size / blocks) on; a document meets those its words lie in.
    met = placed.where("size > 0").join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "row",
        "source",
        "size",
        "start",
        "source_size",
        "blocks",
        F.explode(
            F.sequence(
                F.expr("(start * blocks) div source_size"),
                F.expr("least(blocks - 1, ((start + size) * blocks) div source_size)"),
            )
        ).alias("block"),
    )
    part = F.expr(
        "least(start + size, ((block + 1) * source_size) div blocks) - greatest(start, (block * source_size) div blocks)"
    )
    taken = (
        met.withColumn("part", part)
        .where("part > 0")
        .join(drawn.select(F.col("source").alias("from"), F.col("block").alias("b"), "times"), F.col("source").eqNullSafe(F.col("from")) & (F.col("block") == F.col("b")))
        .groupBy("row")
        .agg(F.sum(F.col("part") * F.col("times")).alias("taken"))
    )
    by_source = sources.select(F.col("source").alias("of"), "source_size", "target")
    return (
        placed.join(taken, "row", "left")
        .join(by_source, F.col("source").eqNullSafe(F.col("of")))
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )
