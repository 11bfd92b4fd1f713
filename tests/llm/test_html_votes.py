"""Pages whose article is spread over containers, adverts within articles, and the whole query against votes by plain loops."""

from __future__ import annotations

import random
from collections import defaultdict
from fractions import Fraction

from tests.llm.conftest import plain, prose
from tillmart.llm.html_paths import Page, best_text, candidates, extract, key_of


def text_of(spark, *htmls: str) -> list[str]:
    rows = [(i, f"http://h{i}.example/", html) for i, html in enumerate(htmls)]
    found = extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return [r.text for r in sorted(found.collect(), key=lambda r: r.page_id)]


def test_article_over_sibling_containers(spark):
    lead, rest, more = prose(1, 60), prose(2, 40), prose(3, 50)
    nested = f"<div class=page><div class=lead>{lead}</div><div class=rest>{rest}</div></div>"
    three = f"<div><div class=a><p>{lead}</p></div><div class=b><div class=c><p>{rest}</p></div></div><div class=d>{more}</div></div>"
    strips = f"<div class=wrap><div class=top>{prose(4, 4)}</div><div class=middle>{lead}</div><div class=low>{prose(5, 3)}</div></div>"
    assert text_of(spark, nested, three, strips, f"<body>{nested}<ul class=menu><li>x</li></ul></body>") == [
        f"{lead}\n\n{rest}", f"{lead}\n\n{rest}\n\n{more}", lead, f"{lead}\n\n{rest}"
    ]


def test_named_article_is_not_widened(spark):
    story, other = prose(6, 60), prose(7, 50)
    assert text_of(spark, f"<div class=wrap><div class=story>{story}</div><div class=x>{other}</div></div>", f"<article><p>{story}</p></article><div>{other}</div>") == [story, story]


def test_adverts_within_an_article_go_however_long(spark):
    story, advert = prose(8, 30), prose(9, 300)
    inside = f"<article><h1>Title here</h1><p>{story}</p><div class=promo>{advert}</div></article>"
    main = f"<main><p>{story}</p><section class='ad wide'><p>{advert}</p></section></main>"
    # A wrapper with the title in it, and one beside which there is nothing, are the article.
    headed = f"<article><div class='entry has-sidebar'><h1>Title here</h1><p>{story}</p></div></article>"
    alone = f"<article><div class='text share-enabled'><p>{story}</p></div></article>"
    assert text_of(spark, inside, main, headed, alone) == [f"Title here\n\n{story}", story, f"Title here\n\n{story}", story]


TEMPLATES = (
    lambda t, r: f"<body><div class=nav><a href=/>home</a></div><article><h1>{t[0]}</h1><p>{t[1]}</p><p>{t[2]}</p></article><footer>f</footer></body>",
    lambda t, r: f"<body><div class='col{r % 3}'><div class=lead>{t[1]}</div><div class=rest>{t[2]}</div></div><div class=side{r % 2}>{t[0]}</div></body>",
    lambda t, r: f"<body><div id=page><div class=content><h2>{t[0]}</h2>{t[1]}<p>{t[2]}</div><div class=comments>{t[0]}</div></div></body>",
    lambda t, r: f"<body>{t[1]}<div class=box><a href=/x>{t[0]}</a></div><p>{t[2]}</body>",
    lambda t, r: f"<table><tr><td>{t[0]}</td><td><div class='x y{r}'>{t[1]}</div></td></tr><tr><td>{t[2]}</td></tr></table>",
)


def brute(rows: list[tuple]) -> list[tuple]:
    """Every distinct page of a host votes once for each path; a page is read at the path of its own that is worth most."""
    cast = {}
    for _, url, html in rows:
        host = url.split("://", 1)[1].split("/")[0].lower() if url and "://" in url else ""
        cast.setdefault((host, html or ""), candidates(Page(html or "")))
    copies = defaultdict(int)
    for _, url, html in rows:
        host = url.split("://", 1)[1].split("/")[0].lower() if url and "://" in url else ""
        copies[host, html or ""] += 1
    votes, pages = defaultdict(int), defaultdict(int)
    for (host, html), found in cast.items():
        for (path, own), share in found.items():
            votes[host, path, own] += copies[host, html] * round(share * 1e6)
            pages[host, path, own] += copies[host, html]
    out = []
    for page_id, url, html in rows:
        host = url.split("://", 1)[1].split("/")[0].lower() if url and "://" in url else ""
        found = cast[host, html or ""]
        worth = lambda p: (Fraction(votes[host, *p], pages[host, *p] + 1), round(found[p] * 1e6), -len(p[0]), key_of(host, *p))  # noqa: B023, E731
        best = max(found, key=worth, default=None)
        out.append((page_id, url, best_text(Page(html or ""), [best[0]] if best else [])))
    return sorted(out, key=repr)


def test_query_against_votes_by_plain_loops(spark):
    """Two hundred and more pages of five templates on six hosts, copies, empty and broken ones."""
    rng, rows = random.Random(6), []
    for i in range(220):
        texts = [prose(1000 + 3 * i + k, n) for k, n in enumerate((rng.randint(1, 9), rng.randint(5, 60), rng.randint(1, 60)))]
        html = rng.choice(TEMPLATES[: rng.choice([1, 3, 5])])(texts, rng.randrange(6))
        rows.append((i, rng.choice(["http://a.example/x", "http://B.example/", "https://c.example/1", "http://d.example", None, "no scheme"]), html))
    rows += [(300 + i, "http://a.example/copy", rows[4][2]) for i in range(9)] + [(400, "http://e.example/", None), (401, "http://e.example/", "<div"), (None, None, "")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert plain(extract(table)) == brute(rows)
