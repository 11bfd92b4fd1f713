"""Language ID, toxicity, HTML extraction and the link graph: sums, restored words, held-out rows, rules."""

from __future__ import annotations

import itertools
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.conftest import PAGES, plain, prose
from tillmart.llm import html_paths, language_id, toxicity
from tillmart.llm.link_graph import judge
from tillmart.llm.queries import tokenizer_path


def all_segmentations(word: str):
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        out = [word[0]]
        for c, letter in zip(cuts, word[1:], strict=True):
            out[-1:] = [out[-1], letter] if c else [out[-1] + letter]
        yield out


def test_forward_sums_all_segmentations():
    names = ["▁", "a", "b", "ab", "▁a", "ba", "aba", "▁ab"]
    pieces = language_id.Pieces(names)
    p = np.random.default_rng(1).dirichlet(np.ones(len(names)), size=2)
    words = ["▁abab", "▁ba", "▁", "▁cab"]
    got = language_id.word_scores(pieces, words, p)
    for i, word in enumerate(words):
        for lang in range(2):
            chance = lambda s: p[lang, names.index(s)] if s in names else language_id.FLOOR if len(s) == 1 else 0.0  # noqa: B023, E731
            want = sum(np.prod([chance(s) for s in seg]) for seg in all_segmentations(word))
            assert got[i, lang] == pytest.approx(np.log(want))
    counts = language_id.expected_counts(pieces, ["▁abab"], np.array([3]), p[0]) / language_id.PARTS
    total = {s: 0.0 for s in names}
    whole = 0.0
    for seg in all_segmentations("▁abab"):
        weight = np.prod([p[0, names.index(s)] if s in names else 0.0 for s in seg])
        whole += weight
        for s in seg:
            if s in names:
                total[s] += weight
    assert counts == pytest.approx([3 * total[s] / whole for s in names], abs=1e-5)


def log_sum(word: str, chance: dict[str, float]) -> float:
    """Log of the sum over all segmentations of a prefix of any length, by plain loops in exact fractions."""
    total = [Fraction(1)]
    for end in range(1, len(word) + 1):
        pieces = {word[start:end] for start in range(max(0, end - 16), end)}
        sizes = {len(s): Fraction(chance.get(s, language_id.FLOOR if len(s) == 1 else 0.0)) for s in pieces}
        total.append(sum((total[end - n] * c for n, c in sizes.items()), Fraction(0)))
    last = total[-1]
    return math.log(last.numerator) - math.log(last.denominator)


@pytest.mark.parametrize("length", [24, 25, 32, 33, 60, 150])
def test_whole_words_and_long_pieces(length):
    """Words beyond any cut, and pieces of up to sixteen characters, as plain sums and as ratios."""
    rng = random.Random(length)
    names = ["▁", *"abc", "ab", "▁a", "bca", "abcabcabca", "cabcabcabcabcabc", "▁abcabcab", "bb"]
    pieces = language_id.Pieces(names)
    p = np.random.default_rng(length).dirichlet(np.ones(len(names)), size=3)
    words = ["▁" + ("abc" * length)[: length - 1]] + ["▁" + "".join(rng.choice("abcd") for _ in range(length - 1)) for _ in range(4)]
    got = language_id.word_scores(pieces, words, p)
    for i, word in enumerate(words):
        for lang in range(3):
            assert got[i, lang] == pytest.approx(log_sum(word, dict(zip(names, p[lang]))), rel=1e-9)
    codes = next(language_id._by_length(words))[1]
    edges = language_id._edges(pieces, codes, p)[0]
    if length <= 60:
        assert np.allclose(np.log(language_id.forward(edges, length)), language_id.log_forward(edges, length))


def test_expected_counts_of_a_long_word():
    """Every letter is in exactly one piece of each segmentation; counts of words add up, however they are dealt out."""
    names = ["▁", *"abc", "ab", "▁a", "bca", "abcabcabca"]
    pieces = language_id.Pieces(names)
    p = np.random.default_rng(3).dirichlet(np.ones(len(names)))
    words = ["▁" + "abc" * 100, "▁abcab", "▁cab"]
    each = [language_id.expected_counts(pieces, [w], np.array([n]), p) for w, n in zip(words, (1, 5, 7))]
    together = language_id.expected_counts(pieces, words, np.array([1, 5, 7]), p)
    assert (sum(each) == together).all()
    letters = sum(n * len(name) for n, name in zip(each[0] / language_id.PARTS, names))
    assert letters == pytest.approx(len(words[0]), abs=0.01)


def test_very_long_word(spark):
    """A word of 50,000 letters is scored whole."""
    text = " ".join(["xyz"] * 20)
    rows = [(1, text, "aa"), (2, "qwv " * 20, "bb"), (3, "xyz" * 16_667, None)]
    model = tokenizer_path("piece_bpe_32k.model")
    learned = [r for r in range(4, 60)]
    rows += [(i, text if i % 2 else "qwv " * 20, "aa" if i % 2 else "bb") for i in learned]
    found = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()
    assert next(r for r in found if r.document.doc_id == 3).lang_pred == "aa"


def test_language_of_edge_rows(docs, no_docs):
    model = tokenizer_path("piece_bpe_32k.model")
    rows = {r.document.doc_id: r for r in language_id.identify(docs, model).collect() if r.document.doc_id is not None}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (6, 7, 8, 14))
    assert all(r.lang_pred in ("en", "de") and 0.25 <= r.score <= 1 for i, r in rows.items() if i not in (6, 7, 8, 14))
    assert language_id.identify(no_docs, model).collect() == []
    assert language_id.identify(docs, model, docs.columns).select("document.*").columns == docs.columns


def test_language_held_out(spark):
    rng = random.Random(2)
    parts = {"en": ["th", "ing", "er", "on", "the", "ly"], "fr": ["eau", "é", "que", "oi", "les", "tion"], "de": ["sch", "ung", "ü", "keit", "der", "ein"]}
    rows = [(i, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(12)), lang) for i, lang in enumerate(list(parts) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.identify(docs, tokenizer_path("piece_bpe_32k.model"), ["doc_id", "lang"])
    held = found.where(language_id.held_out(found["document.doc_id"])).select("document.lang", "lang_pred").collect()
    assert len(held) > 10 and all(r.lang == r.lang_pred for r in held)


BAD = ["idiot", "moron", "worthless"]
DISGUISED = ["1d10t", "i.d.i.o.t", "m0r0n", "moooron", "w0rthl3ss", "!d!ot", "m o r o n"]


@pytest.fixture(scope="module")
def toxic(spark):
    rng = random.Random(4)
    rows = [(i, f"{prose(i, 30)} {rng.choice(BAD) if i % 5 == 0 else ''} {prose(i + 1000, 20)}", int(i % 5 == 0)) for i in range(300)]
    rows += [(1000 + i, f"{prose(2000 + i, 20)} {word} {prose(3000 + i, 10)}", None) for i, word in enumerate(DISGUISED)]
    rows += [(2000, None, None), (2001, "", None), (None, "nothing", None), (3000, prose(5000, 30) + " a i o y 10 100%", None), (3001, "£££ *** " * 20_000, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if y is not None and i % 4] + [(None, 1, 1), (5, 1, None), (7, 0, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_toxicity_plain_and_disguised(toxic):
    docs, labels = toxic
    rows = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(rows) == docs.count()
    held = [i for i in range(300) if i % 4 == 0]
    assert all((rows[i].score >= 0.5) == (i % 5 == 0) for i in held)
    assert all(rows[1000 + i].score >= 0.5 for i in range(len(DISGUISED))), [rows[1000 + i] for i in range(len(DISGUISED))]
    assert all(0 <= rows[i].score < 0.5 for i in (2000, 2001, None, 3000, 3001))


def test_toxicity_without_labels_or_rows(toxic):
    docs, labels = toxic
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.01}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


PAGE = (
    "<html><head><title>T</title><style>p{}</style></head><body class=home><header><h1>Site</h1></header><nav>menu</nav><div id='cookie-notice'>We use</div>"
    "<div class='wrap'><aside>side</aside><article class=post-12><header><h1>A &amp; B</h1></header><p>One <b>two<br>three<p>Four <a href=x>five</a>\n six"
    "<ul><li>a<li>b</ul><form><input><p>no</form><div class=\"ad-slot\">ad</div><table><tr><td>c1<td>c2</table><!-- x --><script>if(a<b)'</p>'</script>"
    "<pre>x  y</pre>tail<section id=comments><p>nice</p></section></article><div class=sidebar>zz</div></div><footer>f</footer>"
)
TEXT = "A & B\n\nOne two three\n\nFour five six\n\na\n\nb\n\nc1\n\nc2\n\nx y\n\ntail"


@pytest.mark.parametrize(
    "html,want",
    [
        ("", ""), ("<", "<"), ("plain", "plain"), ("<p>a", "a"), ("<div>a<div>b", "a\n\nb"), ("</p></div>x", "x"), ("<p title='>'>q</p>", "q"),
        ("<p>&lt;b&gt; &nbsp; x&#65;</p>", "<b> xA"), ("<a " * 500, ""), ("<div>" * 3000 + "x", "x"), ("<p class=it's>one</p><p>it's two</p>", "one\n\nit's two"), (PAGE, TEXT),
    ],
)
def test_page_by_itself(html, want):
    assert html_paths.best_text(html_paths.Page(html), []) == want


def test_hosts_agree_on_paths(spark):
    """A page with little text in the article and much beside it is read as its host's other pages are."""
    good = [(i, f"http://h.org/{i}", f"<div class=c{i}><p>{prose(i, 60)}</p></div><div class=x><p>short</p></div>") for i in range(9)]
    odd = (9, "http://h.org/9", f"<div class=c9><p>few words</p></div><div class=x><p>{prose(1, 90)}</p></div>")
    edge = [(10, None, None), (10, None, None), (11, "x", ""), (None, "http://h.org/", "<p>" + "long " * 50_000)]
    pages = spark.createDataFrame([(*r, "a", "b", 1, "c", "d") for r in [*good, odd, *edge]], PAGES)
    rows = plain(html_paths.extract(pages))
    texts = {r[0]: r[2] for r in rows}
    assert len(rows) == 14 and texts[9] == "few words" and texts[3] == prose(3, 60) and texts[10] == texts[11] == "" and len(texts[None]) == 249_999
    assert html_paths.extract(pages.limit(0)).collect() == []


def test_link_graph(spark):
    link = lambda *hosts: " ".join(f'<a class=x href="{h}">' for h in hosts)
    rows = [
        (1, None, None), (2, "", ""), (3, "abc/def", None), (4, "HTTP://WWW.Example.COM/en/x?y#z", ""), (5, "http://x.example.com/en/", "<p>"), (6, "http://example.com?en/#://a", ""),
        (7, "http://spam.org/de/1", link("http://bad.net/es/1", "//BAD.net/fr/")), (8, "http://bad.net/es/1", ""), (9, "http://bad.net/de/1", ""), (10, "http://good.org/1", ""),
        (11, "http://a.com/1", link("https://good.org/z")), (12, "http://spam.org/de/2", link("/local")), (12, "http://spam.org/de/2", link("/local")), (None, "http://a.network/es/", ""),
    ]
    pages = spark.createDataFrame([(*r, "a", "b", 1, "c", "d") for r in rows], PAGES)
    want = [
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        (5, "x.example.com", "/en/", "example.com/en/", "block"), (6, "example.com", "", None, "allow"), (7, "spam.org", "/de/1", None, "block"), (8, "bad.net", "/es/1", "net/es/", "block"),
        (9, "bad.net", "/de/1", None, "allow"), (10, "good.org", "/1", None, "allow"), (11, "a.com", "/1", "com/", "allow"), (12, "spam.org", "/de/2", None, "block"),
        (12, "spam.org", "/de/2", None, "block"), (None, "a.network", "/es/", None, "allow"),
    ]
    assert plain(judge(pages)) == sorted(want, key=repr)
    assert judge(pages.limit(0)).collect() == []
