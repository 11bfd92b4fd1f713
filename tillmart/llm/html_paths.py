"""HTML extraction by consensus paths of hosts.

1. Every page's containers are scored by the text of the blocks right in them, less what is
   in links, and half of it goes on to the container around (``score_page``).
2. A container's path is the tags and classes from the root down to it, with digits generalised, so that pages of
   one template share it. Spark sums the scores by host and path.
3. Every page is extracted again from the containers on that one of its own paths which is worth most
   over its host. A page without any falls back on its own best container.

What is never text, wherever it stands: scripts, styles, forms, menus, headers and footers of
the site, sidebars, notices, adverts and reader comments, told by tag, role or class. A word of a class may also
name what a wrapper has or allows (``has-sidebar``, ``comments-open``): a container that holds much of the page's
unlinked text stays (``Page._decide``), and so do article and main.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.common import kept

# Elements that have no end tag.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
# Elements whose content is not markup.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp")
# Elements that are never part of an article.
DROPPED = frozenset(("aside", "button", "canvas", "dialog", "fieldset", "footer", "form", "head", "label", "legend", "map", "menu", "nav", "object", "option", "select", "svg", *RAW))
# Elements that a new one of the same kind, or another block, closes.
BLOCKS = frozenset(("address", "blockquote", "caption", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "li", "p", "pre", "summary", "td", "th"))
CONTAINERS = frozenset(("article", "body", "center", "details", "div", "dl", "figure", "header", "hgroup", "html", "main", "ol", "section", "table", "tbody", "tfoot", "thead", "tr", "ul"))
CLOSED_BY_BLOCK = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6"))
CLOSES_ITSELF = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table", "tbody", "thead", "tfoot"), "option": ("select",)}
# Words of a class, id or role that tell what is not the article.
BOILERPLATE = frozenset(
    (
        "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "contentinfo",
        "cookie", "cookies", "disqus", "footer", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification",
        "outbrain", "pager", "pagination", "popup", "promo", "promoted", "promotion", "related", "replies", "respond", "search", "share", "sharing", "sidebar",
        "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "taboola", "teaser", "toolbar", "widget", "alert", "disclaimer", "gdpr",
    )
)
SPREAD = 1.25  # times its best container's text that one around it has over which an article is spread
ARTICLE = frozenset(("article", "articlebody", "body", "content", "entry", "main", "post", "story", "text"))

# Text; a tag (a quote counts as one only after an equals sign); a comment; CDATA; a declaration or a tag without an end; a stray "<".
TOKEN = re.compile(
    r"([^<]+)|<(/?)([a-zA-Z][^\s/>\x00]*)((?>[^>=]+|=\s*+(?:\"[^\"]*\"|'[^']*')?)*+)>|<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|</?[!?a-zA-Z][^>]*(?:>|\Z)|(<)", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)
DIGITS = re.compile(r"\d+")
RAW_END = {name: re.compile(rf"</{name}\s*(?:/\s*)?>|\Z", re.I) for name in RAW}


NO_WORDS: frozenset[str] = frozenset()


def _labels(attributes: str) -> tuple[str, frozenset[str]]:
    """The class attribute, and the words of class, id and role."""
    found = {k.lower(): unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
    if not found:
        return "", NO_WORDS
    names = re.sub(r"([a-z])([A-Z])", r"\1 \2", " ".join(found.get(k, "") for k in ("class", "id", "role")))
    return found.get("class", ""), frozenset(re.split(r"[^a-z]+", names.lower()))


class Block:
    """A run of text within one block element: its place in the tree, its text, and how much of it is in links."""

    __slots__ = ("path", "tag", "pieces", "linked", "labels")

    def __init__(self, path: tuple[tuple[int, str], ...], tag: str, labels: tuple[int, ...]):
        self.path, self.tag, self.pieces, self.linked, self.labels = path, tag, [], 0, labels

    def text(self) -> str:
        """White space as one space, none at the ends."""
        return " ".join("".join(self.pieces).split())


ROOT = (0, "")


class Page:
    """Blocks of a page in order. A path holds the (number, step) of each container around the block, outermost first."""

    def __init__(self, html: str):
        self.blocks: list[Block] = []
        self.count = 0
        # Open elements: tag, whether it starts what is dropped, (number, step) of a container, and the number of one labelled as no article.
        self.open: list[tuple[str, bool, tuple[int, str] | None, int | None]] = []
        self.headed: list[bool] = []  # by number of a labelled container: whether a title, article or main is in it
        self.within: list[bool] = []  # and whether it is in an article or main itself
        self.dropping = self.links = 0
        self.block: Block | None = None
        self._read(html)
        if self.headed:
            self._decide()

    def _decide(self) -> None:
        """Drops the blocks in labelled containers, but for wrappers: those that hold over a quarter of the page's unlinked text and a
        title, article or main, or over three quarters of it. What is labelled within an article without a title is no wrapper, however
        long it is beside the article, unless there is nothing else."""
        inside, total = [0] * len(self.headed), 0
        for block in self.blocks:
            size = max(0, len(block.text()) - block.linked)
            total += size
            for label in block.labels:
                inside[label] += size
        wraps = [4 * size > (total if headed else 3 * total) for size, headed in zip(inside, self.headed, strict=True)]
        outer = [wrap and (headed or not within) for wrap, headed, within in zip(wraps, self.headed, self.within, strict=True)]
        left = [b for b in self.blocks if all(outer[label] for label in b.labels)]
        self.blocks = left if any(b.text() for b in left) else [b for b in self.blocks if all(wraps[label] for label in b.labels)]

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            m = TOKEN.match(html, at)
            if m is None:  # a tag that never ends
                break
            at = m.end()
            if m[1] or m[6]:
                if not self.dropping:
                    self._text(unescape(m[1] or m[6]))
            elif m[5]:
                if not self.dropping:
                    self._text(m[5])
            elif m[3]:
                tag = m[3].lower()
                if m[2]:
                    self._close(tag)
                else:
                    self._start(tag, m[4])
                    if tag in RAW_END and not m[4].endswith("/"):
                        stop = RAW_END[tag].search(html, at)
                        at = stop.end()
                        self._close(tag)

    def _text(self, text: str) -> None:
        if self.block is None:
            if text.isspace():
                return
            tag = next((x[0] for x in reversed(self.open) if x[0] in BLOCKS or x[2]), "")
            self.block = Block((ROOT, *(x[2] for x in self.open if x[2])), tag, tuple(x[3] for x in self.open if x[3] is not None))
            self.blocks.append(self.block)
        self.block.pieces.append(text)
        if self.links:
            self.block.linked += len(text)

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag == "hr":
            if self.block is not None:
                self.block.pieces.append(" ")
        if tag in VOID:
            return
        if tag in BLOCKS or tag in CONTAINERS:
            while self.open and self.open[-1][0] not in CONTAINERS and any(x[0] in CLOSED_BY_BLOCK for x in self.open):
                if not self._pop_to_paragraph():
                    break
            if tag in CLOSES_ITSELF:
                self._close_sibling(tag, CLOSES_ITSELF[tag])
            self.block = None
        css, words = _labels(attributes)
        told = not words.isdisjoint(BOILERPLATE) or ("header" in words and not any(x[0] == "article" for x in self.open))
        told &= tag not in ("html", "body", "article", "main")
        apart = tag in CONTAINERS or tag in BLOCKS or "-" in tag  # no text runs on over its edges
        drop = tag in DROPPED or (told and not apart)
        if not drop and tag == "header":
            drop = told or not any(x[0] == "article" for x in self.open)  # the site's, not the article's
        step = label = None
        if not drop and not self.dropping:
            if tag in ("h1", "article", "main") and words.isdisjoint(BOILERPLATE):
                for x in self.open:
                    if x[3] is not None:
                        self.headed[x[3]] = True
            if told:
                label = len(self.headed)
                self.headed.append(False)
                self.within.append(any(x[0] in ("article", "main") for x in self.open))
                self.block = None
        if tag in CONTAINERS:
            self.count += 1
            name = ".".join([tag, *sorted(DIGITS.sub("0", c) for c in css.split())])
            step = (self.count, name)
        if attributes.rstrip().endswith("/") and tag in ("svg", "path", "iframe"):
            return
        self.open.append((tag, drop, step, label))
        self.dropping += drop
        self.links += tag == "a"

    def _pop(self) -> None:
        tag, drop, _, label = self.open.pop()
        self.dropping -= drop
        self.links -= tag == "a"
        if tag in BLOCKS or tag in CONTAINERS or label is not None:
            self.block = None

    def _pop_to_paragraph(self) -> bool:
        """Closes the innermost open paragraph or heading, unless a container or cell is in between."""
        for k in range(len(self.open) - 1, -1, -1):
            tag = self.open[k][0]
            if tag in CLOSED_BY_BLOCK:
                while len(self.open) > k:
                    self._pop()
                return True
            if tag in CONTAINERS or tag in BLOCKS or self.open[k][1]:
                return False
        return False

    def _close_sibling(self, tag: str, within: tuple[str, ...]) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            here = self.open[k][0]
            if here == tag or (tag in ("dt", "dd") and here in ("dt", "dd")) or (tag in ("td", "th") and here in ("td", "th")):
                while len(self.open) > k:
                    self._pop()
                return
            if here in within:
                return

    def _close(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            here = self.open[k][0]
            if here == tag:
                while len(self.open) > k:
                    self._pop()
                return
            # An end tag without a start within its container is nothing; that of a container closes what is in it.
            if here in CONTAINERS and tag not in CONTAINERS and tag not in DROPPED:
                return


def steps(path: tuple[tuple[int, str], ...]) -> str:
    """The generalised path: from the root down, the way into each container."""
    return ">".join(step for _, step in path)


def _likely(step: str) -> bool:
    tag, _, css = step.partition(".")
    return tag in ("article", "main") or not ARTICLE.isdisjoint(re.split(r"[^a-z]+", css.lower()))


def score_page(page: Page) -> dict[int, tuple[str, float]]:
    """Per container that holds text: its path and score.

    A block counts for the container it is in, half for the one around that, and in full for an article
    element around it. A container around the best that adds the page's title and little else comes before it; so does one, below
    body, over which the article is spread: that has a quarter more unlinked text than the best, whose name does not say
    that it is the article.
    """
    scores: dict[int, list] = {}
    sizes: dict[int, int] = {}
    unlinked: dict[int, float] = {}
    titles: set[int] = set()
    for block in page.blocks:
        size = len(block.text())
        if not size:
            continue
        path = block.path
        own = max(0.0, size - 2.0 * block.linked)
        for number, _ in path:
            sizes[number] = sizes.get(number, 0) + size
            unlinked[number] = unlinked.get(number, 0.0) + own
            if block.tag == "h1":
                titles.add(number)
        shares = {len(path) - 1: 1.0}
        if len(path) > 1:
            shares[len(path) - 2] = 0.5
        for at in range(len(path) - 1, 0, -1):
            if path[at][1].partition(".")[0] == "article":
                shares[at] = 1.0
                break
        for at, share in shares.items():
            entry = scores.setdefault(path[at][0], [path[: at + 1], 0.0])
            entry[1] += own * share
    out = {n: (steps(part), score * (2.0 if _likely(part[-1][1]) else 1.0)) for n, (part, score) in scores.items()}
    first = lambda: min(out, key=lambda n: (-out[n][1], len(out[n][0]), out[n][0]))
    while out:
        best = first()
        part = scores[best][0]
        if len(part) < 3 or any(_likely(step) and not step.startswith("body") for _, step in part) or part[-2][1].partition(".")[0] in ("html", "body"):
            break
        around = part[-2][0]
        if unlinked[around] < SPREAD * unlinked[best]:
            break
        scores.setdefault(around, [part[:-1], 0.0])
        out[around] = (steps(part[:-1]), out[best][1] * 1.01)
    if titles and out:
        best = first()
        above = scores[best][0][:-1]
        if best not in titles:
            for at in range(len(above) - 1, max(-1, len(above) - 3), -1):
                number = above[at][0]
                if number in titles and sizes[number] <= 1.3 * sizes[best]:
                    out[number] = (steps(above[: at + 1]), out[best][1] * 1.01)
                    break
    return out


def text_at(page: Page, path: str) -> str:
    """The blocks in the containers on that path, joined by two line feeds."""
    depth = path.count(">") + 1
    inside: dict[int, bool] = {}
    found = []
    for block in page.blocks:
        if len(block.path) >= depth:
            number = block.path[depth - 1][0]
            if number not in inside:
                inside[number] = steps(block.path[:depth]) == path
            if inside[number] and (text := block.text()):
                found.append(text)
    return "\n\n".join(found)


def best_text(page: Page, paths: list[str]) -> str:
    """Text at the first of the paths that has any; else at the page's own best container."""
    for path in paths:
        if text := text_at(page, path):
            return text
    own = sorted(score_page(page).values(), key=lambda x: (-x[1], len(x[0]), x[0]))
    return text_at(page, own[0][0]) if own else ""


def candidates(page: Page) -> dict[tuple[str, bool], float]:
    """Of each path at which the page has text in favour, and whether most of it is right there: its share of the best score.

    A container that holds its text itself and one that has it from containers inside are told apart, so that body where a
    template writes right into it bears nothing on a page whose article is further down.
    """
    direct: dict[int, int] = {}
    sizes: dict[int, int] = {}
    for block in page.blocks:
        size = len(block.text())
        direct[block.path[-1][0]] = direct.get(block.path[-1][0], 0) + size
        for number, _ in block.path:
            sizes[number] = sizes.get(number, 0) + size
    scored = score_page(page)
    top = max((s for _, s in scored.values()), default=0.0)
    best: dict[str, tuple[float, bool]] = {}
    for number, (path, score) in scored.items():
        best[path] = max(best.get(path, (0.0, False)), (score, 2 * direct.get(number, 0) >= sizes[number]))
    return {(path, own): score / top for path, (score, own) in best.items() if score > 0}


def key_of(host: str, path: str, own: bool) -> int:
    """One number for a path of a host."""
    return xxhash.xxh64_intdigest(f"{host}\n{path}\n{own:d}", 42) - (1 << 63)


def chosen_paths(pages: DataFrame) -> DataFrame:
    """(page, key): of each distinct page (``page`` names its host and html) the best of its own paths.

    Every path counts: a page gives its best container one vote and others the share of its score that they reach, and a
    path's worth is the sum of votes over one more than the pages that have it. So a path that is the best wherever it stands wins
    over one that every page has and few favour, however rare its template, and one that a single page has over little else.
    """

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                batch = big.slice(at, 256)
                rows = [
                    (page, key_of(host, path, own), round(share * 1e6), len(path))
                    for page, host, html in zip(*(batch.column(c).to_pylist() for c in ("page", "host", "html")), strict=True)
                    for (path, own), share in candidates(Page(html)).items()
                ]
                columns = zip(*rows, strict=True) if rows else ((), (), (), ())
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["page", "key", "vote", "size"])

    # Votes are whole millionths, summed in any order. Paths are numbers by now.
    cast = kept(pages.select("page", "host", "html").mapInArrow(votes, "page long, key long, vote long, size long"), "path-votes")
    worth = cast.groupBy("key").agg((F.sum("vote") / (F.count(F.lit(1)) + F.lit(1))).alias("worth"))
    ranked = cast.join(worth, "key").groupBy("page").agg(F.max_by("key", F.struct("worth", "vote", (-F.col("size")).alias("size"), "key")).alias("key"))
    return ranked


def extract(pages: DataFrame, salts: int = 32) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text (empty if none).

    The host is what follows ``://`` in the url; pages without one count as one host. Null, empty and
    broken html is read as far as it goes. Repeated rows vote and are extracted like others. Other
    columns of ``pages`` are not read. An empty table gives no rows. ``salts``: in so many parts the
    copies of one page are dealt out when they get its path.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))
    read = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host")).withColumn("page", F.xxhash64("host", "html"))
    # Never broadcast: Spark takes the size of the table before every page's row is there once for each salt.
    winning = kept(chosen_paths(read), "host-paths").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    salted = read.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    joined = salted.join(winning, ["page", "salt"], "left").select("page_id", "url", "html", "host", "key")
    schema = T.StructType([pages.schema["page_id"], T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])

    def text_of(host: str, html: str, key: int | None) -> str:
        page = Page(html)
        return best_text(page, [path for path, own in candidates(page) if key_of(host, path, own) == key] if key is not None else [])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                batch = big.slice(at, 256)
                found = [text_of(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "key")), strict=True)]
                yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())], names=["page_id", "url", "text"])

    return joined.mapInArrow(texts, schema)
