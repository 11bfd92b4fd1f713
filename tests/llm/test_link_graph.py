"""Trust and distrust over made-up links, against PageRank by plain loops."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from tests.llm.conftest import plain
from tillmart.llm.link_graph import ALLOW, BLOCK, UrlRule, judge

RULES = (UrlRule(ALLOW, "good.org", "/"), UrlRule(BLOCK, "bad.net", "/"), UrlRule(BLOCK, "mixed.com", "/x/"))
DAMPING, ENOUGH = 0.85, 1e-3


def rank(shares: dict, seeds: dict) -> dict:
    total = sum(seeds.values())
    flow = {h: s / total for h, s in seeds.items() if s}
    score: dict = defaultdict(float)
    while sum(flow.values()) > ENOUGH:
        after: dict = defaultdict(float)
        for src, s in flow.items():
            for dst, w in shares.get(src, {}).items():
                after[dst] += DAMPING * s * w
        for h, s in after.items():
            score[h] += (1 - DAMPING) * s
        flow = after
    return score


def shared(links: dict) -> dict:
    return {src: {dst: n / sum(to.values()) for dst, n in to.items()} for src, to in links.items() if to}


def brute(rows: list[tuple]) -> list[tuple]:
    parsed, links, seen = [], defaultdict(Counter), defaultdict(Counter)
    for page_id, url, to in rows:
        rest = url.split("://", 1)[1]
        host, path = rest[: rest.index("/")].lower(), rest[rest.index("/") :]
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.host + r.path), default=None)
        parsed.append((page_id, host, path, best))
        seen[host][best.verdict if best else None] += 1
        links[host].update(t for t in to if t != host)
    forward = shared(links)
    turned: dict = defaultdict(dict)
    for src, to in forward.items():
        for dst, w in to.items():
            turned[dst][src] = w
    backward = {dst: {src: w / sum(to.values()) for src, w in to.items()} for dst, to in turned.items()}
    seeds = lambda verdict: {h: c[verdict] / sum(c.values()) for h, c in seen.items()}
    trust, distrust = rank(forward, seeds(ALLOW)), rank(backward, seeds(BLOCK))
    out = []
    for page_id, host, path, best in parsed:
        score = trust.get(host, 0.0) - distrust.get(host, 0.0)
        out.append((page_id, host, path, best and best.host + best.path, best.verdict if best else BLOCK if score < 0 else ALLOW))
    return sorted(out, key=repr)


def test_judge_against_plain_loops(spark):
    """A hundred hosts with random links, one hub, and a chain of forty hosts that ends at a blocked one."""
    rng = random.Random(4)
    hosts = [f"h{i}.example" for i in range(100)] + ["a.good.org", "bad.net", "mixed.com"]
    chain = [f"c{i}.example" for i in range(40)] + ["bad.net"]
    rows = []
    for host in hosts:
        for k in range(rng.randint(1, 3)):
            to = rng.sample(hosts, rng.randint(0, 4)) + ["hub.example"] * rng.randint(0, 2)
            rows.append((len(rows), f"https://{host}/{rng.choice(['x', 'y'])}/{k}", to))
    rows += [(len(rows) + i, f"http://{a}/", [b]) for i, (a, b) in enumerate(zip(chain, chain[1:]))]
    rows.append((len(rows), "http://HUB.example/", rng.sample(hosts, 60)))
    want = brute(rows)
    by_host = {r[1]: r[4] for r in want if r[3] is None}
    assert by_host["c0.example"] == BLOCK and 20 < sum(v == BLOCK for v in by_host.values()) < len(by_host) - 20
    html = lambda to: "".join(f'<p><a class=l href="http://{t}/p?q">x</a>' for t in to)
    table = spark.createDataFrame([(i, url, html(to)) for i, url, to in rows], "page_id long, url string, html string").repartition(3)
    assert plain(judge(table, RULES, DAMPING, enough=ENOUGH)) == want
