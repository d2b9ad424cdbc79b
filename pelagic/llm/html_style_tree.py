"""HTML extraction by a site style tree.

Each page is parsed to a tree of elements.  A *style node* is an element's place
in the site's layout: the chain of tag names, each with the class and the
position of its run of like siblings.  Pages of one host are merged into one
style tree by counting, in Spark, per (host, style node): over m distinct pages,
the entropy of its layouts (sequences of children) and of its contents, both
divided by log m.  With l kinds of children the importance of a node is

    (1 - 0.9 ** l) * layout entropy + 0.9 ** l * content entropy

so a branch that looks and reads the same on every page has importance near 0.
Branches below ``threshold`` are cut from each page.  Nodes seen on fewer than
``min_pages`` distinct pages can't be told and stay.  Pages with the same text
count once, so copies do not make an article look like furniture.

What markup says outright needs no statistics: menus, headers, footers, forms,
scripts, hidden parts, and elements whose class, id or role names an advert,
notice, sidebar or reader comments go; if the page marks its article (or main
part), text outside of it goes.  Nodes inside are judged like all others, but
the mark-up speaks for them: their importance is at least their content entropy,
and they are cut below ``threshold`` / ``MARKED_CREDIT`` only.

Text: character references decoded, white space inside a block made one space,
trimmed, blocks joined by \\n in page order; ``<br>`` counts as white space.
Null or empty html gives an empty text; a null url belongs to the empty host.
Texts of any length are read whole.  Repeated rows get equal answers.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagic.llm.common import checkpointed, small_broadcast, text_batches
from pelagic.llm.url_glob import host_of

# Element and class names of HTML practice.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROP_TAGS = {"head", "script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "template", "svg", "math",
             "object", "nav", "footer", "aside", "form", "button", "select", "option", "datalist", "dialog", "menu", "canvas", "audio",
             "video", "map"}
DROP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu",
              "menubar", "toolbar", "status"}
DROP_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
              "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "footer", "sidebar", "sidebars", "aside",
              "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "notifications", "alert", "popup", "modal",
              "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related",
              "recommended", "recommendations", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "widget",
              "widgets", "search", "pagination", "pager", "masthead", "toolbar", "skip", "skiplink"}
SITE_WORDS = {"site", "page", "top", "global", "main", "masthead"}
STATE_WORDS = {"has", "with", "no", "not", "is", "show", "without"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
         "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"}
CELLS = {"td", "th"}
CONTENT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "table", "tbody", "thead",
           "tr", "td", "th", "figure", "figcaption", "article", "main", "body", "html"}
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
        "option": ({"option"}, {"select"})}
MARKED_CREDIT = 4
P_SCOPE = {"td", "th", "caption", "button", "html", "table"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
DIGITS = re.compile(r"\d{3,}")  # numbers of single pages, not of layout
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Element:
    tag: str
    node: str
    dropped: bool
    article: int
    children: list[str] = field(default_factory=list)
    run: int = 0


@dataclass
class Block:
    nodes: tuple[str, ...]
    text: str
    article: int  # 2: inside an article, 1: inside main, 0: neither
    protected: bool


def attributes(raw: str) -> dict[str, str]:
    out = {}
    for name, value in ATTR.findall(raw):
        out.setdefault(name.lower(), entities.unescape(value.strip("\"'")) if value else "")
    return out


def names_furniture(label: str) -> bool:
    """Whether one class or id names an advert, notice, sidebar, menu, comments or the site's header."""
    parts = [p.lower() for p in NAME_PART.findall(label)]
    if not parts or parts[0] in STATE_WORDS:
        return False
    if "header" in parts:
        return len(parts) == 1 or bool(SITE_WORDS & set(parts))
    return bool(DROP_WORDS & set(parts))


def is_dropped(tag: str, at: dict[str, str], in_article: bool) -> bool:
    if tag in DROP_TAGS or tag == "header" and not in_article:
        return True
    if "hidden" in at or HIDDEN.search(at.get("style", "")) or at.get("role", "").lower() in DROP_ROLES:
        return True
    if tag in ("html", "body", "main"):
        return False
    labels = [*at.get("class", "").split(), *at.get("id", "").split()]
    if tag == "article":
        return any({"comment", "comments", "ad", "advert", "related", "promo", "sponsored"} & {p.lower() for p in NAME_PART.findall(x)}
                   for x in labels if names_furniture(x))
    if in_article and tag == "header":
        return False
    return any(names_furniture(x) for x in labels)


class Page:
    """Blocks and layouts of one page."""

    def __init__(self, source: str | None):
        self.blocks: list[Block] = []
        self.layouts: dict[str, list[str]] = {}
        self.stack = [Element("", "", False, 0)]
        self.buffer: list[str] = []
        self.had_article = self.had_main = False
        if source:
            self._parse(source)

    def _flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer = []
            if text:
                chain = [e for e in self.stack if e.tag in BLOCK or not e.tag]
                self.blocks.append(Block(tuple(e.node for e in chain), text, self.stack[-1].article,
                                         chain[-1].article > 0 and chain[-1].tag in CONTENT))

    def _text(self, text: str) -> None:
        if not self.stack[-1].dropped:
            self.buffer.append(entities.unescape(text) if "&" in text else text)

    def _pop_to(self, k: int) -> None:
        """Close the elements from place ``k`` on."""
        if any(e.tag in BLOCK for e in self.stack[k:]):
            self._flush()
        elif any(e.tag in CELLS for e in self.stack[k:]):
            self.buffer.append(" ")
        for e in self.stack[k:]:
            if not e.dropped and e.tag in BLOCK:
                self.layouts.setdefault(e.node, []).extend(e.children)
        del self.stack[k:]

    def _close_implied(self, tag: str) -> None:
        if tag in BLOCK:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag == "p":
                    self._pop_to(k)
                    break
                if self.stack[k].tag in P_SCOPE:
                    break
        ends, scope = ENDS.get(tag, ((), ()))
        if ends:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in scope:
                    break
                if self.stack[k].tag in ends:
                    self._pop_to(k)

    def _open(self, tag: str, raw: str) -> None:
        self._close_implied(tag)
        top = self.stack[-1]
        if tag == "br":
            self._text(" ")
            return
        if tag in BLOCK:
            self._flush()
        elif tag in CELLS:
            self.buffer.append(" ")
        at = attributes(raw) if raw and not top.dropped else {}
        sig = tag
        if at.get("class"):
            sig += "." + DIGITS.sub("", ".".join(sorted(at["class"].split())))
        if tag in BLOCK and not top.dropped:
            # the style tree holds block elements: their parent is the nearest open block
            parent = next(e for e in reversed(self.stack) if e.tag in BLOCK or not e.tag)
            if not parent.children or parent.children[-1] != sig:
                parent.run += 1
                parent.children.append(sig)
            node = f"{parent.node}/{sig}[{parent.run}]"
        else:
            node = top.node
        if tag in VOID:
            return
        dropped = top.dropped or is_dropped(tag, at, top.article > 0)
        article = 2 if tag == "article" else max(top.article, tag == "main" or at.get("role") == "main")
        article = max(article, top.article)
        if not dropped:
            self.had_article |= article == 2
            self.had_main |= article == 1
        self.stack.append(Element(tag, node, dropped, int(article)))

    def _close(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            e = self.stack[k]
            if e.tag == tag:
                if tag in BLOCK or tag in CELLS or e.dropped or k == len(self.stack) - 1:
                    self._pop_to(k)
                else:
                    del self.stack[k]  # misnested inline end tag: what it holds stays open
                return
            if tag not in BLOCK and (e.tag in CELLS or e.tag in ("table", "ul", "ol", "div", "article", "section")):
                return

    def _parse(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            m = TOKEN.search(source, at)
            if m is None:
                self._text(source[at:])
                break
            if m.start() > at:
                self._text(source[at:m.start()])
            at = m.end()
            close, tag, raw, tag2, raw2 = m.groups()
            if close:
                self._close(close.lower())
                continue
            tag, raw = (tag, raw) if tag else (tag2, raw2)
            if not tag:
                continue
            tag = tag.lower()
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
                at = n if end is None else end.start()
                if tag in VOID or end is None:
                    continue
                tail = source.find(">", at)
                at = n if tail < 0 else tail + 1
                continue
            self._open(tag, raw or "")
        self._pop_to(1)
        self._flush()
        if self.stack[0].children:
            self.layouts.setdefault("", []).extend(self.stack[0].children)

    def main_blocks(self) -> list[Block]:
        """Blocks of the marked article, else of the marked main part, else all."""
        least = 2 if self.had_article else 1 if self.had_main else 0
        return [b for b in self.blocks if b.article >= least]


def digest(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >= 1 << 63 else h


def style_rows(page: Page) -> list[tuple[int, int, int, int, int, bool]]:
    """(page text, node, kinds of children, layout, content, marked as content) of each style node that holds text."""
    blocks = page.main_blocks()
    whole = digest("\n".join(b.text for b in blocks))
    under: dict[str, list[str]] = {}
    marked: set[str] = set()
    for b in blocks:
        for k, node in enumerate(b.nodes):
            under.setdefault(node, []).append(b.text)
        if b.protected:
            marked.update(b.nodes)
    return [(whole, digest(node), len(set(page.layouts.get(node, ()))), digest(" ".join(page.layouts.get(node, ()))), digest("\n".join(texts)),
             node in marked) for node, texts in under.items()]


def main_text(source: str | None, low: set[int]) -> str:
    """Main text of a page without the branches in ``low`` (digests of style nodes)."""
    page = Page(source)
    keep = [b for b in page.main_blocks() if not low or not any(digest(n) in low for n in b.nodes)]
    return "\n".join(b.text for b in keep)


def style_tree(pages: DataFrame, *, host: Column, html: Column) -> DataFrame:
    """(host, node, pages, importance, marked) of the merged style trees."""
    text_batches(pages.sparkSession)
    schema = "array<struct<page:long,node:long,kinds:long,layout:long,content:long,marked:boolean>>"

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ["page", "node", "kinds", "layout", "content", "marked"]
        for sources in batches:
            yield pd.Series([[dict(zip(names, r)) for r in style_rows(Page(s))] for s in sources], dtype=object)

    rows = pages.select(host.alias("host"), F.explode(run.asNondeterministic()(html)).alias("r")).select("host", "r.*").distinct()
    rows = checkpointed(rows)

    def entropy(by: str) -> DataFrame:
        c = rows.groupBy("host", "node", by).agg(F.count("*").alias("c"), F.max("kinds").alias("kinds"), F.max("marked").alias("marked"))
        return c.groupBy("host", "node").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.log(F.col("c").cast("double"))).alias("s"),
                                             F.max("kinds").alias("kinds"), F.max("marked").alias("marked"))

    def spread(m: Column, s: Column) -> Column:
        return F.when(m > 1, (F.log(m.cast("double")) - s / m) / F.log(m.cast("double"))).otherwise(F.lit(1.0))

    layout, content = entropy("layout"), entropy("content").select("host", "node", F.col("s").alias("sc"))
    share = F.pow(F.lit(0.9), F.col("kinds"))
    told = spread(F.col("m"), F.col("sc"))
    importance = (1 - share) * spread(F.col("m"), F.col("s")) + share * told
    return layout.join(content, ["host", "node"]).select(
        "host", "node", F.col("m").alias("pages"),
        F.when(F.col("marked"), F.greatest(importance, told)).otherwise(importance).alias("importance"), "marked")


def extract_text(pages: DataFrame, *, html: str = "html", url: str = "url", into: str = "main_text", min_pages: int = 4,
                 threshold: float = 0.2, broadcast_hosts: int = 100_000) -> DataFrame:
    """``pages`` with the column ``into``: the main text of each page."""
    tree = style_tree(pages.select(F.col(url).alias("__url"), F.col(html).alias("__html")), host=host_of(F.col("__url")), html=F.col("__html"))
    limit = F.when(F.col("marked"), F.lit(threshold / MARKED_CREDIT)).otherwise(F.lit(threshold))
    low = checkpointed(tree.filter((F.col("pages") >= min_pages) & (F.col("importance") < limit))
                       .groupBy(F.col("host").alias("__host")).agg(F.sort_array(F.collect_set("node")).alias("__low")))
    nodes = low.agg(F.sum(F.size("__low"))).first()[0] or 0

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, cut in batches:
            yield pd.Series([main_text(s, set(c) if c is not None else set()) for s, c in zip(sources, cut)], dtype=object)

    text_batches(pages.sparkSession)
    at = pages.withColumn("__host", host_of(F.col(url)))
    if nodes:  # beyond the bound Spark joins by shuffle and splits the hot hosts
        at = at.join(small_broadcast(low, nodes, broadcast_hosts), "__host", "left")
    else:
        at = at.withColumn("__low", F.lit(None).cast("array<long>"))
    return at.withColumn(into, run.asNondeterministic()(F.col(html), F.col("__low"))).drop("__host", "__low")
