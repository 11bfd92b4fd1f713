"""Secret scans over a trigram inverted index. DataFrame and SQL functions only.

1. From each rule's regular expression follows a Boolean query over trigrams: what three characters
   in a row a matching text must contain, in lower case.
2. The index holds, for every trigram that some query names, the documents with it.
3. Postings are joined with the queries' clauses; a document that has all trigrams of a clause is a
   candidate for its rule.
4. Candidates only are read again and matched. A rule whose expression demands no trigram is
   matched against all texts in the scan that makes the index.
"""

from __future__ import annotations

from re import _constants as sre
from re import _parser as sre_parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import kept

MOST_STRINGS = 64  # alternatives that are followed together before they become trigrams


class Rule(NamedTuple):
    """Matches of ``pattern``, leftmost and non-overlapping, whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base rules.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # The runs of [0-9a-f]+ of 24 or more are what this finds: a shorter run is followed by another character.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Published forms of keys and tokens.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

Query = frozenset[frozenset[str]]  # any of the sets of trigrams, all of it; one empty set: everything
ANY: Query = frozenset([frozenset()])


def _both(a: Query, b: Query) -> Query:
    return _least(frozenset(x | y for x in a for y in b))


def _least(query: Query) -> Query:
    """Without clauses that another one implies."""
    return frozenset(c for c in query if not any(d < c for d in query))


def _demands(strings: set[str]) -> Query:
    """What a text must contain if it has one of these strings."""
    return _least(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _strings(op, value) -> set[str] | None:
    """The strings that one item of an expression stands for, if they are few."""
    if op is sre.LITERAL:
        return {chr(value).lower()}
    if op is sre.IN and all(o is sre.LITERAL for o, _ in value):
        return {chr(v).lower() for _, v in value}
    if op is sre.SUBPATTERN:
        return _all_strings(value[-1])
    if op is sre.BRANCH:
        parts = [_all_strings(x) for x in value[1]]
        return set().union(*parts) if all(p is not None for p in parts) else None
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[1] <= 1:
        inner = _all_strings(value[2])
        return inner if inner is None or value[0] else inner | {""}
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] == value[1] <= 8:
        inner = _all_strings(value[2])
        return {next(iter(inner)) * value[0]} if inner and len(inner) == 1 else None
    return None


def _all_strings(items) -> set[str] | None:
    found = {""}
    for op, value in items:
        here = _strings(op, value)
        if here is None or len(found) * len(here) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in here}
    return found


def trigram_query(items) -> Query:
    """The query of a parsed expression: what strings in a row demand, and what its parts demand."""
    query, run = ANY, {""}
    for op, value in items:
        here = _strings(op, value)
        if here is not None and len(run) * len(here) <= MOST_STRINGS:
            run = {a + b for a in run for b in here}
            continue
        query, run = _both(query, _demands(run)), {""}
        if here is not None:
            run = here
        elif op is sre.SUBPATTERN:
            query = _both(query, trigram_query(value[-1]))
        elif op is sre.BRANCH:
            query = _both(query, _least(frozenset().union(*[trigram_query(x) for x in value[1]])))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0]:
            query = _both(query, trigram_query(value[2]))
    return _both(query, _demands(run))


def query_of(rule: Rule) -> Query:
    return trigram_query(sre_parser.parse(rule.pattern))


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def spans(text: str, rule: Rule, number: int) -> Column:
    """The rule's matches in column ``text``: an array of (start, kind, end), code points, end exclusive.

    Between the matches lie the parts that splitting gives, so both lengths add up to places.
    """
    pattern = _quoted(rule.pattern)
    return F.expr(
        f"""
        CASE WHEN {text} RLIKE '{pattern}' THEN
          aggregate(
            zip_with(
              zip_with(slice(split({text}, '{pattern}', -1), 1, size(regexp_extract_all({text}, '{pattern}', 0))),
                regexp_extract_all({text}, '{pattern}', 0), (part, whole) -> struct(length(part) AS gap, length(whole) AS size)),
              regexp_extract_all({text}, '{pattern}', {rule.group}), (m, own) -> struct(m.gap AS gap, m.size AS size, length(own) >= {rule.least} AS fits)),
            struct(0 AS at, CAST(array() AS array<struct<start:int,kind:int,end:int>>) AS found),
            (acc, m) -> struct(
              acc.at + m.gap + m.size AS at,
              IF(m.fits, array_append(acc.found, struct(acc.at + m.gap AS start, {number} AS kind, acc.at + m.gap + m.size AS end)), acc.found) AS found),
            acc -> acc.found)
        ELSE CAST(array() AS array<struct<start:int,kind:int,end:int>>) END
        """
    )


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """One row per row of ``docs``: doc_id, found: (start, kind, end) by start, then kind.

    ``kind`` is the rule's number in ``rules``; places are code points, end exclusive. Each rule's
    matches are leftmost and non-overlapping, those of different rules may overlap. Null texts
    count as empty. Repeated rows each get a row with the same answer; doc_id may be null. Other
    columns of ``docs`` are not read. An empty table gives no rows.
    """
    queries = {n: query_of(rule) for n, rule in enumerate(rules)}
    indexed = {n: q for n, q in queries.items() if q != ANY}
    scanned = [n for n in queries if n not in indexed]
    trigrams = sorted({t for q in indexed.values() for clause in q for t in clause})

    body = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", body.alias("text"), F.xxhash64(body).alias("hash"))
    holds = [F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in trigrams]
    scan = kept(
        keyed.withColumn("low", F.lower("text")).select(
            "doc_id",
            "hash",
            F.concat(F.array().cast("array<struct<start:int,kind:int,end:int>>"), *[spans("text", rules[n], n) for n in scanned]).alias("scanned"),
            F.array_compact(F.array(*holds)).alias("trigrams") if holds else F.array().cast("array<string>").alias("trigrams"),
        ),
        "secret-index",
    )
    clauses = [(n, c, t, len(clause)) for n, q in indexed.items() for c, clause in enumerate(sorted(map(sorted, q))) for t in clause]
    if not clauses:
        return scan.select("doc_id", F.array_sort("scanned").alias("found"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    listed = [F.struct(F.lit(n).alias("rule"), F.lit(c).alias("clause"), F.lit(t).alias("trigram"), F.lit(needs).alias("needs")) for n, c, t, needs in clauses]
    asked = docs.sparkSession.range(1).select(F.inline(F.array(*listed)))  # as large as the rules
    postings = scan.select("doc_id", "hash", F.explode("trigrams").alias("trigram"))
    met = postings.join(F.broadcast(asked), "trigram").groupBy("doc_id", "hash", "rule", "clause", "needs").agg(F.count_distinct("trigram").alias("has"))
    candidates = met.where("has = needs").groupBy("doc_id", "hash").agg(F.collect_set("rule").alias("rules"))
    wanted = candidates.select(F.col("doc_id").alias("id"), F.col("hash").alias("h"), "rules")
    verified = (
        keyed.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h")))
        .select("id", "h", F.concat(none, *[F.when(F.array_contains("rules", n), spans("text", rules[n], n)).otherwise(none) for n in indexed]).alias("verified"))
        .dropDuplicates(["id", "h"])
    )
    return scan.join(verified, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h")), "left").select(
        "doc_id", F.array_sort(F.concat("scanned", F.coalesce("verified", none))).alias("found")
    )


def digest(found: Column, rules: tuple[Rule, ...]) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
