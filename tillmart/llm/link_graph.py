"""URL filters: rules by host and path, and trust and distrust carried over links between hosts.

Rules decide the pages they fit. For all other pages the link graph decides, per host:

* Trust starts at hosts whose pages rules allow and follows links: who is linked to by trusted hosts is trusted.
* Distrust starts at hosts whose pages rules block and follows links backwards: who links to blocked hosts is distrusted.

Both are personalised PageRanks over host edges, each round a join in Spark. A host is blocked if what
reaches it from other hosts is more distrust than trust; without links there is no evidence, and
it is allowed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import ascii_lower, kept, written
from tillmart.plans.warehouse import remove_folder

ALLOW, BLOCK = "allow", "block"


class UrlRule(NamedTuple):
    """Fits ``host`` and all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


# The rules of the registered query.
RULES = (
    UrlRule(ALLOW, "com", "/"),
    UrlRule(BLOCK, "example.com", "/en/"),
    UrlRule(ALLOW, "www.example.com", "/en/"),
    UrlRule(BLOCK, "net", "/es/"),
    UrlRule(BLOCK, "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """The longest rule that fits, as (rule, verdict); of equally long ones the first. Null if none fits."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): the share of a host's links to other hosts that goes to each of them."""
    address = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""
    links = pages.select("host", F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(address), F.lit(1))).alias("link"))
    # A link without a scheme takes the page's.
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    counted = links.select(F.col("host").alias("src"), host_of(full).alias("dst")).where("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    sums = counted.groupBy("src").agg(F.sum("n").alias("all"))
    return counted.join(sums, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("weight"))


def reversed_edges(edges: DataFrame) -> DataFrame:
    """Edges turned round, each host's shares summing to 1 again."""
    sums = edges.groupBy("dst").agg(F.sum("weight").alias("all"))
    return edges.join(sums, "dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), (F.col("weight") / F.col("all")).alias("weight"))


def propagated(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, enough: float = 1e-9) -> DataFrame:
    """(host, score): personalised PageRank of ``seeds`` (host, seed), without what hosts get as seeds themselves.

    The walk restarts at the seeds, and at hosts that link nowhere it ends. It stops when a round moves no more than ``enough`` of
    the whole: after log(enough) / log(damping) rounds at the latest, 128 as they stand, as each keeps at most ``damping`` of
    the one before. A round is one written table, and the one before goes.
    """
    spark = edges.sparkSession
    edges = kept(edges, "host-edges")
    total = seeds.agg(F.sum("seed")).first()[0] or 0.0  # one number
    zero = F.lit(0.0)
    now, path = written(seeds.where("seed > 0").select("host", (F.col("seed") / (total or 1.0)).alias("flow"), zero.alias("score")), "host-flow")
    while (now.agg(F.sum("flow")).first()[0] or 0.0) > enough:
        moving = now.where("flow > 0").select(F.col("host").alias("src"), "flow")
        # What arrives after one more link; all rounds together are the PageRank's power series.
        arriving = edges.join(moving, "src").groupBy("dst").agg((F.sum(F.col("weight") * F.col("flow")) * damping).alias("flow"))
        both = now.select("host", zero.alias("flow"), "score").unionAll(arriving.select("dst", "flow", F.col("flow").alias("score")))
        before = path
        now, path = written(both.groupBy("host").agg(F.sum("flow").alias("flow"), F.sum("score").alias("score")), "host-flow")
        remove_folder(spark, before)
    return now.where("score > 0").select("host", (F.col("score") * (1 - damping)).alias("score"))


def judge(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, damping: float = 0.85, salts: int = 16, enough: float = 1e-9) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    A url that is null or has no ``://`` has an empty host and path, fits no rule and is allowed.
    ``rule`` is null where none fits; the verdict then is the link graph's for the host. Null html has
    no links. Repeated rows each get a row. Other columns of ``pages`` are not read. An empty table gives no rows.
    ``salts``: in so many parts the rows of one host are dealt out when they get its verdict. ``enough``: see ``propagated``.
    """
    read = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    found = read.withColumn("found", ruled(F.col("host"), F.col("path"), rules))
    hosts = found.groupBy("host").agg(
        F.count_if(F.col("found.verdict") == ALLOW).alias("allowed"), F.count_if(F.col("found.verdict") == BLOCK).alias("blocked"), F.count(F.lit(1)).alias("pages")
    )
    hosts = kept(hosts, "hosts")
    edges = kept(host_edges(read), "links")
    trust = propagated(edges, hosts.select("host", (F.col("allowed") / F.col("pages")).alias("seed")), damping, enough)
    distrust = propagated(reversed_edges(edges), hosts.select("host", (F.col("blocked") / F.col("pages")).alias("seed")), damping, enough)
    score = distrust.select("host", (-F.col("score")).alias("score")).unionAll(trust).groupBy("host").agg(F.sum("score").alias("score"))
    bad = score.where("score < 0").select("host", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = found.drop("html").withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(salts)).cast("int"))
    judged = salted.join(bad.withColumn("distrusted", F.lit(True)), ["host", "salt"], "left")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("distrusted"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))).alias("verdict"),
    )
