"""HTML extraction: rare templates of a host."""

from __future__ import annotations

import pytest

from tests.llm.conftest import PAGES, prose
from tillmart.llm import html_paths


def texts(spark, pages: list[tuple[str, str]]) -> list[str]:
    rows = [(i, url, html, "a", "b", 1, "c", "d") for i, (url, html) in enumerate(pages)]
    return [r.text for r in sorted(html_paths.extract(spark.createDataFrame(rows, PAGES).repartition(3)).collect(), key=lambda r: r.page_id)]


def test_rare_templates_of_a_host(spark):
    """Twelve templates of three pages and many of one; a parent and a small container are on all pages. All without url are one host."""
    names = [chr(97 + i) for i in range(12)]
    pages = [(None, f"<div class=main>{'<p>' + prose(i, 60)}</div><div class=foot>Written by hand, all rights kept</div>") for i in range(30)]
    pages += [(None, f"<div class=t{n}><p>{prose(100 + 10 * ord(n) + k, 60)}</div><div class=foot>Written by hand, all rights kept</div>") for n in names for k in range(3)]
    want = [prose(i, 60) for i in range(30)] + [prose(100 + 10 * ord(n) + k, 60) for n in names for k in range(3)]
    assert texts(spark, pages) == want


def test_text_right_in_body_on_other_pages(spark):
    plain = [("http://h/", f"<body><p>{prose(i, 60)}</body>") for i in range(20)]
    rare = [("http://h/", f"<body><div class=story><p>{prose(50 + i, 60)}</div><div class=x><p>Some more of the site</div></body>") for i in range(2)]
    assert texts(spark, plain + rare) == [prose(i, 60) for i in range(20)] + [prose(50 + i, 60) for i in range(2)]


REST = "<div class=sidebar><p>Beside it</p></div><section id=comments><p>nice</p></section>"


@pytest.mark.parametrize(
    "html",
    [
        "<div class='has-sidebar'><div class=c><h1>T</h1><p>{}</p></div>{}</div>", "<div class='page no-sidebar'><p>{}</p>{}</div>", "<main class='comments-open'><p>{}</p>{}</main>",
        "<div class='post search-result'><article><p>{}</p></article>{}</div>", "<article class='article share-enabled'><p>{}</p>{}</article>", "<div class=has-header><p>{}</p></div>{}",
        "<app-root class=no-sidebar><p>{}</p>{}</app-root>", "<table><tr><td class=with-menu><p>{}</p></td></tr></table>{}",
    ],
)
def test_wrappers_labelled_as_boilerplate_stay(html):
    text = html_paths.best_text(html_paths.Page(html.format(prose(1, 80), REST)), [])
    assert text.endswith(prose(1, 80)) and "nice" not in text and "Beside" not in text


def test_long_comments_go():
    page = f"<div class=c><h1>T</h1><p>{prose(1, 40)}</p></div><div class=comments><p>{prose(2, 80)}</p></div>"
    assert html_paths.best_text(html_paths.Page(page), []) == f"T\n\n{prose(1, 40)}"


def test_paths_of_pages_are_not_broadcast(spark):
    """The table of paths gets a row for each salt, which Spark does not count when it looks at its size."""
    rows = [(i, "http://h/", f"<p>{prose(i, 20)}", "a", "b", 1, "c", "d") for i in range(6)]
    found = html_paths.extract(spark.createDataFrame(rows, PAGES))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.page_id: r.text for r in found.collect()} == {i: prose(i, 20) for i in range(6)}
