"""HTML extraction: the maximum-scoring run of words and tags, with weights learned from marked pages.

A page is read as a sequence of blocks of text with the tags between them. Words score +1, tags score
negative; the contiguous run with the largest sum, found by one linear scan, is the content region.
Inside it, blocks of elements that are boilerplate by their nature (menus, asides, forms, comments,
notices, adverts) are left out.

Tag weights are learned from labelled pages, those that mark their content themselves with exactly one
article or main element: a tag that hardly occurs inside the content costs much, one that mostly
occurs there costs next to nothing. The counts are one distributed aggregation (a row per tag reaches
the driver, at most MAX_TAGS); extraction is one scan without a shuffle.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import small_batches

MAX_TAGS = 2_000
# a tag that occurs only outside of content costs this many words at most, and every tag costs a little
HEAVY, LIGHT = 60.0, 0.05
UNKNOWN = 4.0

# fixed values: element names with a given role
SILENT = {"script", "style", "noscript", "template", "head", "svg", "iframe", "canvas", "select", "textarea"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
          "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "object",
          "math", "mi", "mo", "mn", "ms", "mtext", "mrow", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup", "munder", "mover"}
BOILER = {"nav", "aside", "form", "footer", "dialog", "menu", "button", "fieldset"}
CONTENT = {"article", "main"}
BOILER_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disclaimer|footer|header|masthead|menu|"
    r"modal|nav|navbar|navigation|newsletter|notice|popup|promo\w*|related|replies|share|sharing|sidebar|skip|social|"
    r"sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)

# a quote counts only behind an equals sign and if it is closed before a space, a slash or the tag's end; any
# other tag ends at the next >, or with the page
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?>(?:=\s*\"[^\"]*\"(?=[\s/>])|=\s*'[^']*'(?=[\s/>])|[^>])*))(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
SPACE = re.compile(r"\s+")


def key(closing: str, name: str, marked: bool) -> str:
    """What a weight belongs to: the tag, and whether its class, id or role names boilerplate."""
    return f"{closing}{name}{'.boiler' if marked and not closing else ''}"


class Page:
    """Blocks of one page in order: text, tags passed before it, whether boilerplate or marked content."""

    def __init__(self, source: str) -> None:
        self.blocks: list[tuple[str, list[str], bool, bool]] = []
        self.words = 0
        self._text: list[str] = []
        self._tags: list[str] = []
        self._stack: list[tuple[str, bool, bool]] = []
        self._boiler = self._content = 0
        self.marks = 0
        self._parse(source)
        self._cut()
        self.tail = self._tags

    def _cut(self) -> None:
        text = SPACE.sub(" ", entities.unescape("".join(self._text))).strip()
        self._text = []
        if text:
            self.blocks.append((text, self._tags, self._boiler > 0, self._content > 0))
            self._tags = []

    def _parse(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            m = MARKUP.search(source, at)
            if m is None:
                self._text.append(source[at:])
                break
            self._text.append(source[at:m.start()])
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    self._text.append(entities.unescape(m[0][9:].removesuffix("]]>")).replace("&", "&amp;"))
                continue
            closing, name = m[1], m[2].lower()
            if not closing and name in RAW | SILENT and not m[3].endswith("/"):
                self._cut()
                close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                if close is not None or name in RAW:
                    at = close.end() if close is not None else end
                continue
            self._tag(closing, name, m[3])

    def _tag(self, closing: str, name: str, attributes: str) -> None:
        """Pass a tag; those that open, close or lie inside a boilerplate element carry no weight."""
        if name == "br":
            self._text.append(" ")
        elif name not in INLINE:
            self._cut()
        marked = not closing and any(BOILER_WORDS.search(v.strip("\"'")) for v in ATTRIBUTE.findall(attributes))
        outside = not self._boiler
        if closing:
            self._close(name)
        elif name not in VOID and not attributes.endswith("/"):
            self._open(name, marked)
        if outside and not self._boiler:
            self._tags.append(key(closing, name, marked))

    def _close(self, name: str) -> None:
        if any(name == open_name for open_name, _, _ in self._stack):
            while True:
                open_name, boiler, content = self._stack.pop()
                self._boiler -= boiler
                self._content -= content
                if open_name == name:
                    return

    def _open(self, name: str, marked: bool) -> None:
        if name in ("p", "li", "b", "i", "em", "strong") and self._stack and self._stack[-1][0] == name:
            _, boiler, _ = self._stack.pop()  # these do not nest; an open one ends here
            self._boiler -= boiler
        content = name in CONTENT
        header = name == "header" and not self._content
        boiler = name in BOILER or header or (marked and name not in INLINE and name not in ("html", "body") and not content)
        self.marks += content and not self._content
        self._boiler += boiler
        self._content += content
        self._stack.append((name, boiler, content))


def count_tags(source: str) -> Counter | None:
    """(tag key, inside marked content) counts of a page that marks its content once; else None."""
    page = Page(source)
    if page.marks != 1:
        return None
    out: Counter = Counter()
    inside = False
    for _, tags, _, now in page.blocks:
        # tags between two blocks belong to the content only if both blocks do
        for t in tags:
            out[t, inside and now] += 1
        inside = now
    for t in page.tail:
        out[t, False] += 1
    return out


def learn(pages: DataFrame, html: str = "html") -> dict[str, float]:
    """The (positive) cost of each tag key, from the pages that mark their content."""
    small_batches(pages.sparkSession)

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for b in batches:
            for source in b["html"]:
                total.update(count_tags(source) or {})
        yield pd.DataFrame([(t, n if i else 0, 0 if i else n) for (t, i), n in total.items()],
                           columns=["tag", "inside", "outside"]).astype({"tag": "object"})

    rows = (pages.select(F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"))
            .mapInPandas(counts, "tag string, inside long, outside long")
            .groupBy("tag").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
            .orderBy(F.desc(F.col("inside") + F.col("outside")), "tag").limit(MAX_TAGS).collect())
    # a few more places inside are supposed, so rare tags cost little
    return {r.tag: LIGHT + HEAVY * (r.outside / (r.inside + r.outside + 4.0)) ** 2 for r in rows}


def content(source: str, costs: dict[str, float]) -> str:
    """The main text of one page: one linear scan for the best run of blocks."""
    page = Page(source)
    best = total = 0.0
    start = first = last = 0
    for i, (text, tags, boiler, _) in enumerate(page.blocks):
        total -= sum(costs.get(t, UNKNOWN) for t in tags)
        if total <= 0:
            total, start = 0.0, i
        total += 0.0 if boiler else 1.0 + text.count(" ")
        if total > best:
            best, first, last = total, start, i + 1
    return "\n".join(text for text, _, boiler, _ in page.blocks[first:last] if not boiler)


def main_text(pages: DataFrame, costs: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages.

    A null or empty html gives an empty text; null ids and urls are kept, repeated rows are treated
    each. Without any page that marks its content every tag costs UNKNOWN words.
    """
    if costs is None:
        costs = learn(pages)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [content(h, costs) for h in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": found, "n_chars": list(map(len, found))})

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
            .mapInPandas(extract, "page_id long, url string, text string, n_chars long"))
