"""HTML extraction with a site style tree.

Pages of one host are merged into a style tree: a node stands for all
elements with the same path of tags and classes.  For each node two figures
are gathered over the host's pages:

* presentation importance: the entropy of the child-tag sequences (styles)
  that the node's elements have, in units of the number of pages;
* content importance: one minus the mean entropy of the texts that stand in
  it (a text that every page repeats scores 0, one that one page has scores 1).

A node's importance blends the two as in the style-tree literature, with the
content below it weighted by ``DECAY`` to the number of styles.  Entropies of a
few pages say little, so the figure is a weighted mean of the importance and a
prior: the importance counts as pages - 1 observations, the prior as
``PRIOR_PAGES``.  Inside an article or main element, and for what holds one, the
prior is 1, elsewhere ``PRIOR``.  Branches of low figures are removed from each
page, highest node first, but only where the text around them differs between
pages (``own`` of the article or main element, else of the whole host): an
article or a page that several pages of a host repeat is kept whole.

Semantic markup is decided before: navigation, headers, footers, asides, forms,
scripts and elements that are named as advert, notice, menu or comments are
removed, and the article or main element itself is not.  A name, a role or a
form says nothing about an element that holds an article or main element: that
is a wrapper of the layout, and left to the tree.

The tree never exists in one place: (host, node, style or text) counts are
shuffled and aggregated as rows, and only the removed nodes come back.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrflow.llm.common import staged
from cdrflow.llm.url_filters import url_host

DECAY = 0.9
LOW = 0.2
PRIOR = 0.5
PRIOR_PAGES = 1.0
MAX_DEPTH = 256  # elements nested deeper belong to the node at this depth; their text is kept

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)"""
    r"|[^<]+|<",
    re.S,
)
# Names with their values, so that no word of a value is read as a name.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
_DROPPED = frozenset(
    "head script style noscript template iframe object svg math canvas audio video map form button select "
    "textarea input label fieldset option datalist nav footer aside dialog menu title".split()
)
_KEPT = frozenset(("article", "main"))
_FRAME = frozenset(("html", "body"))
_WRAPPING = frozenset(("form", "fieldset"))  # dropped unless they hold an article or main element
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
# An opening tag that ends an open element of the same list, up to the given boundaries.
_SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select", "datalist")),
}
_NAMED = re.compile(
    r"(?!(?:no|has|with|without)[-_]|related[-_]works?$)(?:^|.*?[-_])(?:ads?|advert(?:s|isements?|ising)?|adsense|banner|sponsor(?:ed|s)?|promo(?:s|tions?)?|"
    r"nav(?:bar|igation)?|menus?|breadcrumbs?|sidebars?|masthead|topbar|footer|bottombar|"
    r"cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|"
    r"comments?|disqus|replies|share|sharing|social|related|recommended|widgets?|"
    r"skip|pagination|pager|toolbar|copyright|disclaimer|search(?:box|form)?)(?:$|[-_\d])",
    re.I,
)
_NAMED_HEADER = re.compile(r"(?!(?:no|has|with|without)[-_])(?:^|.*?[-_])header(?:$|[-_\d])", re.I)  # only outside the article
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)


class _Element:
    __slots__ = ("tag", "node", "noise", "kept", "styles", "path", "doubt")

    def __init__(self, tag: str, node: int, noise: bool, kept: int, path: tuple[int, ...]):
        self.tag, self.node, self.noise, self.kept, self.path = tag, node, noise, kept, path
        self.styles = 0
        self.doubt: tuple | None = None  # the page as it was before, which comes back if it holds no article


def _is_noise(tag: str, attributes: str, inside_kept: bool) -> str:
    """"always", "unless it holds an article" or the empty text."""
    noise = ""
    if tag in _WRAPPING:
        noise = "unless it holds an article"
    elif tag in _DROPPED:
        return "always"
    if tag == "header" and not inside_kept:
        return "always"
    if not attributes:
        return noise
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden":
            return "always"
        if name == "role" and value.lower() in _ROLES:
            noise = "unless it holds an article"
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            if any(map(_NAMED.match, value.split())):
                noise = "unless it holds an article"
            if not inside_kept and any(map(_NAMED_HEADER.match, value.split())):
                noise = "unless it holds an article"
    return noise


def _signature(tag: str, attributes: str) -> str:
    """What makes elements the same node: tag and class names without digits."""
    if "class" not in attributes:
        return tag
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() == "class":
            return tag + "." + ".".join(sorted(set(re.sub(r"\d+", "", value.strip("\"'")).split())))
    return tag


class Page:
    """Blocks of a page: (path of nodes, decoded text), without the branches that the priors remove.

    ``styles`` has (path, style) of every element outside those branches, and
    ``kept`` the depth of the innermost article or main element on a path, 0 without one.
    """

    def __init__(self, html: str | None, removed: frozenset[int] = frozenset()):
        self.blocks: list[tuple[tuple[int, ...], str]] = []
        self.styles: list[tuple[tuple[int, ...], int]] = []
        self.kept: dict[tuple[int, ...], int] = {}
        self._text: list[str] = []
        self._at: tuple[int, ...] = ()
        if html:
            self._read(html, removed)

    def _flush(self) -> None:
        if self._text:
            words = "".join(self._text).split()
            if words:
                self.blocks.append((self._at, " ".join(words)))
            self._text.clear()

    def _read(self, html: str, removed: frozenset[int]) -> None:
        root = _Element("#root", 0, False, 0, ())
        stack = [root]
        hidden = 0  # open elements that are removed
        raw = ""

        def close(k: int) -> None:
            nonlocal hidden
            while len(stack) > k:
                gone = stack.pop()
                if gone.noise:
                    hidden -= 1
                elif gone.doubt is not None:
                    blocks, styles, self._text, self._at = gone.doubt
                    del self.blocks[blocks:], self.styles[styles:]
                elif not hidden:
                    self.styles.append((gone.path, gone.styles))

        for m in _TOKEN.finditer(html):
            piece = m[0]
            if raw:
                if m[1] and m[1].lower() == raw:
                    raw = ""
                else:
                    continue
            if m[1]:
                tag = m[1].lower()
                if tag == "p" and not any(e.tag == "p" for e in stack):
                    if not hidden:
                        self._flush()
                    continue
                if tag not in _INLINE and not hidden:
                    self._flush()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        close(k)
                        break
                    if tag in _INLINE and stack[k].tag not in _INLINE:
                        break  # an inline end tag does not close blocks
            elif m[2]:
                tag, attributes = m[2].lower(), m[3] or ""
                if tag not in _INLINE and not hidden:
                    self._flush()
                if tag == "br":
                    if not hidden:
                        self._text.append(" ")
                    continue
                if tag in _CLOSES_P:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k].tag == "p":
                            close(k)
                            break
                        if stack[k].tag not in _INLINE:
                            break
                if tag in _SIBLINGS:
                    ends, bounds = _SIBLINGS[tag]
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k].tag in bounds:
                            break
                        if stack[k].tag in ends:
                            close(k)
                            break
                if tag == "body" and any(e.tag == "head" for e in stack):
                    close(next(k for k, e in enumerate(stack) if e.tag == "head"))
                up = stack[-1]
                if tag in _INLINE:
                    if tag not in _VOID and not attributes:
                        stack.append(_Element(tag, up.node, False, up.kept, up.path))
                        continue
                    if tag in _VOID:
                        continue
                node = crc32(_signature(tag, attributes).encode(), up.node)
                path = up.path if tag in _INLINE or len(up.path) >= MAX_DEPTH else (*up.path, node)
                kept = len(path) if tag in _KEPT and path is not up.path else up.kept
                self.kept[path] = kept
                named = "" if hidden else _is_noise(tag, attributes, up.kept > 0)
                noise = named == "always" or (
                    hidden == 0 and node in removed and tag not in _KEPT and tag not in _FRAME
                )
                if tag in _KEPT and not hidden and not noise:
                    for e in stack:
                        e.doubt = None
                up.styles = crc32(tag.encode(), up.styles)
                if tag in _RAW and not attributes.endswith("/"):
                    raw = tag
                if tag in _VOID:
                    continue
                if attributes.endswith("/") and tag not in ("p", "div", "article", "main", "section", "body"):
                    continue
                stack.append(_Element(tag, path[-1] if path else node, noise, kept, path))
                if noise:
                    hidden += 1
                elif named and tag not in _KEPT:
                    stack[-1].doubt = len(self.blocks), len(self.styles), list(self._text), self._at
            elif piece[0] != "<" or piece == "<":
                if not hidden:
                    if not self._text:
                        self._at = stack[-1].path
                    self._text.append(html_lib.unescape(piece) if "&" in piece else piece)
        if not hidden:
            self._flush()
        close(1)

    @property
    def text(self) -> str:
        return "\n".join(t for _, t in self.blocks)


def _signed(x: int) -> int:
    return x - (1 << 31)


_ROWS = "array<struct<path:array<int>,feature:int,content:boolean,chars:int,kept:int>>"


def style_rows(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """(host, path, feature, content, chars, kept, n): how often each style (content
    false) and each text (content true, with its length) stands at each node of
    the host's tree; ``kept`` as in ``Page``.

    Texts and styles are hashed to 32 bits: a collision shifts an entropy by
    one count, it removes nothing by itself.
    """

    def rows(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in series:
            out = []
            for h in pages_:
                page = Page(h)
                found = {(p, s, False): 0 for p, s in page.styles if p}
                found |= {(p, crc32(t.encode()), True): len(t) for p, t in page.blocks if p}
                out.append([
                    {"path": [_signed(x) for x in p], "feature": _signed(f), "content": c, "chars": n, "kept": page.kept.get(p, 0)}
                    for (p, f, c), n in found.items()
                ])
            yield pd.Series(out, dtype=object)

    made = F.pandas_udf(rows, _ROWS)(F.col(html))
    return (
        pages.select(host, F.explode(made).alias("r"))
        .select(host, "r.*")
        .groupBy(host, "path", "feature", "content")
        .agg(F.max("chars").alias("chars"), F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    )


def removed_nodes(pages: DataFrame, low: float = LOW) -> DataFrame:
    """(host, removed): nodes of low importance, for hosts that have any.

    ``pages``: (host, html).
    """
    # One page has no entropy: its importance has the weight 0, and no prior is low.
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") > 1)
    rows = staged(style_rows(pages), "style-rows")
    m = F.log(F.col("pages").cast("double"))
    # Entropy of styles within a node: H = log N - sum(n log n) / N, in units of log(pages).
    n = F.col("n").cast("double")
    shape = (
        rows.filter(~F.col("content"))
        .groupBy("host", "path")
        .agg(
            F.sum(n).alias("total"),
            F.sum(n * F.log(n)).alias("nlogn"),
            F.count(F.lit(1)).alias("styles"),
            F.max("kept").alias("kept"),
        )
    )
    # A text that n pages repeat is spread evenly over them: entropy log n.
    sums = ("spread", "texts", "char_spread", "chars")
    texts = (
        rows.filter("content")
        .groupBy("host", "path")
        .agg(
            F.sum(n * F.log(n)).alias("spread"),
            F.sum(n).alias("texts"),
            F.sum(F.col("chars") * n * F.log(n)).alias("char_spread"),
            F.sum(F.col("chars") * n).alias("chars"),
            F.max("kept").alias("below"),
        )
    )
    # At every node above a text and, as the empty path, over the whole host.
    spread = (
        texts.select("*", F.explode(F.sequence(F.lit(0), F.size("path"))).alias("d"))
        .groupBy("host", F.slice("path", F.lit(1), F.col("d")).alias("path"))
        .agg(*(F.sum(c).alias(c) for c in sums), F.max("below").alias("below"))
    )
    spread = staged(spread, "style-spread")
    depth = F.size("path")
    nodes = shape.join(spread, ["host", "path"]).join(sizes, "host").filter(F.col("kept") < depth)
    presentation = (F.log("total") - F.col("nlogn") / F.col("total")) / m
    content = 1 - F.col("spread") / F.col("texts") / m
    below = F.pow(F.lit(DECAY), F.col("styles"))
    importance = (1 - below) * presentation + below * content
    holds = F.col("below") >= depth
    prior = F.when(holds | (F.col("kept") > 0), 1.0).otherwise(PRIOR)
    seen = F.col("pages") - 1
    figure = (seen * importance + PRIOR_PAGES * prior) / (seen + PRIOR_PAGES)
    around = spread.select(
        "host",
        F.col("path").alias("around"),
        F.col("below").alias("host_kept"),
        F.col("char_spread"),
        F.col("chars"),
    )
    low_nodes = nodes.filter(figure < low).select(
        "host", "path", "pages", "kept", holds.alias("holds"), F.slice("path", F.lit(1), F.col("kept")).alias("around")
    )
    # The share of the text around, by characters, that is not spread over pages.
    own = 1 - F.col("char_spread") / F.col("chars") / m
    article_beside = (F.col("kept") == 0) & (F.col("host_kept") > 0) & ~F.col("holds")
    return (
        low_nodes.join(around, ["host", "around"])
        .filter((own >= low) | article_beside)
        .groupBy("host")
        .agg(F.collect_set(F.element_at("path", -1)).alias("removed"))
    )


def extract_pages(pages: DataFrame, low: float = LOW) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    Null and empty html and pages without text give the empty text.  Pages
    without a host are not merged with others.  Repeated rows are extracted
    one by one.  Other columns are ignored.  An empty table gives an empty result.
    """
    read = pages.select("page_id", "url", "html", url_host(F.col("url")).alias("host"))
    removed = staged(removed_nodes(read.filter("host <> ''").select("host", "html"), low), "removed-nodes")

    def texts(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for html, gone in series:
            yield pd.Series(
                [
                    Page(h, frozenset(int(x) + (1 << 31) for x in g) if g is not None else frozenset()).text
                    for h, g in zip(html, gone)
                ],
                dtype=object,
            )

    # The removed nodes were written, so the planner knows their size: a few
    # are broadcast and the pages stay where they are; many are joined by a
    # shuffle on the host, where a hot host is split at run time.
    return (
        read.join(removed, "host", "left")
        .select("page_id", "url", F.pandas_udf(texts, "string")("html", "removed").alias("text"))
        .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    )
