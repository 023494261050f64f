"""Text and links of HTML pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html import unescape as unescape_html
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "col", "dd", "div", "dl", "dt", "fieldset", "form", "h1", "h2", "h3", "h4", "h5", "h6", "legend", "li", "optgroup", "option", "p", "pre", "table", "td", "textarea", "tfoot", "th", "thead", "tr", "ul", "nav", "header", "footer", "main", "section"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Classes and ids under which a page's main part is looked for, and regions that are never text.
MAIN, CHROME = {"main", "main-content", "mainContent", "MainContent", "wrapper"}, {"header", "footer", "navigation"}


class _Text(HTMLParser):
    """Collects text nodes with the element path they stand under."""

    def __init__(self, skip: set[str]):
        super().__init__(convert_charrefs=True)
        self.skip, self.path, self.nodes = skip, [], []

    def handle_starttag(self, tag, attrs):
        if tag not in VOID:
            self.path.append((tag, dict(attrs)))

    def handle_endtag(self, tag):
        for k in range(len(self.path) - 1, -1, -1):
            if self.path[k][0] == tag:
                del self.path[k:]
                break

    def handle_data(self, data):
        if data.strip() and not any(t in self.skip for t, _ in self.path):
            self.nodes.append((" ".join(data.split()), [(t, a.get("class") or "", a.get("id") or "", a.get("role") or "") for t, a in self.path]))


class _Paragraphs(HTMLParser):
    """Text cut at block elements, with the characters that stand in links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.parts, self.linked, self.links, self.hidden, self.select, self.heading, self.headed = [], [], 0, 0, 0, 0, 0, False

    def _cut(self):
        text = " ".join(" ".join(self.parts).split())
        if text:
            self.out.append({"text": text, "link_chars": min(self.linked, len(text)), "in_select": self.select > 0, "heading": self.headed})
        self.parts, self.linked, self.headed = [], 0, False

    def handle_starttag(self, tag, attrs):
        self._tag(tag, 1)

    def handle_endtag(self, tag):
        self._tag(tag, -1)

    def _tag(self, tag, by):
        if tag in BLOCKS:
            self._cut()
        if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            self.heading = max(0, self.heading + by)
        if tag in ("script", "style", "head"):
            self.hidden = max(0, self.hidden + by)
        elif tag == "a":
            self.links = max(0, self.links + by)
        elif tag == "select":
            self.select = max(0, self.select + by)

    def handle_data(self, data):
        if data.strip() and not self.hidden:
            self.parts.append(data.strip())
            self.headed |= self.heading > 0
            self.linked += len(" ".join(data.split())) if self.links else 0


def _fed(parser: HTMLParser, html: str) -> HTMLParser:
    try:
        parser.feed(html)
        parser.close()
    except Exception:  # malformed declarations: what was read so far counts
        pass
    return parser


def _clever(html: str) -> str:
    nodes = _fed(_Text({"script", "style"}), html).nodes
    mains = {tuple(path[: k + 1]) for _, path in nodes for k, (_, cls, id_, role) in enumerate(path) if role == "main" or MAIN & set(cls.split()) or id_ in MAIN}
    tops = {m for m in mains if not any(m[:k] in mains for k in range(1, len(m)))}
    if len(tops) == 1:
        (top,) = tops
        return " ".join(t for t, path in nodes if tuple(path[: len(top)]) == top)
    return " ".join(t for t, path in nodes if not any(tag in CHROME or CHROME & set(cls.split()) or id_ in CHROME for tag, cls, id_, _ in path))


@F.pandas_udf(StringType())
def clever_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The one main part's text if there is exactly one, else all but headers, footers and navigation."""
    for html in pages:
        yield html.map(_clever, na_action="ignore")


@F.pandas_udf(ArrayType(StructType([StructField("text", StringType()), StructField("link_chars", IntegerType()), StructField("in_select", BooleanType()), StructField("heading", BooleanType())])))
def paragraphs(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for html in pages:
        yield pd.Series([None if h is None else _fed(p := _Paragraphs(), h)._cut() or p.out for h in html], dtype=object)


#: Entities that need no Python.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&copy;": "©", "&middot;": "·", "&nbsp;": "\u00a0", "&amp;": "&"}
_OTHERS = "&(?!(?:" + "|".join(e[1:] for e in ENTITIES) + "))#?[a-zA-Z0-9]+"


@F.pandas_udf(StringType())
def _unescaped(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(unescape_html, na_action="ignore")


def unescape(text: Column) -> Column:
    """Entities as characters; only texts with rare ones leave the JVM."""
    return F.coalesce(_unescaped(F.when(text.rlike(_OTHERS), text)), _common(text))


def _common(text: Column) -> Column:
    for name, by in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(by))
    return text


def plain_text(html: Column) -> Column:
    """Text without scripts, styles and forms, pieces joined by a space: expressions only."""
    body = F.regexp_replace(html, r"(?is)<(script|style|form)\b.*?</\1\s*>|<!--.*?-->|<!doctype[^>]*>", " ")
    return F.btrim(F.regexp_replace(unescape(F.regexp_replace(body, r"(?s)<[^>]*>", " ")), r"[\s\x{A0}]+", " "))


def classify(p: Column, stop_words: list[str] = (), low: float = 0.30, high: float = 0.32) -> Column:
    """good, neargood, short or bad, for a paragraph struct by itself; without a stop list every text is dense enough."""
    n = F.length(p["text"])
    bad = (p["link_chars"] / F.greatest(n, F.lit(1)) > 0.2) | F.contains(p["text"], F.lit("©")) | p["in_select"]
    words = F.split(p["text"], " ")
    dense = F.size(F.filter(words, lambda w: F.lower(w).isin(list(stop_words)))) / F.size(words) if stop_words else F.lit(1.0)
    own = F.when(dense >= high, F.when(n > 200, "good").otherwise("neargood")).when(dense >= low, "neargood").otherwise("bad")
    return F.when(bad, "bad").when(n < 70, F.when(p["link_chars"] > 0, "bad").otherwise("short")).otherwise(own)


def _revised(own: list[str], headings: list[bool], lengths: list[int], most: int = 200) -> list[str]:
    """Classes of paragraphs in the context of their neighbours, from their own classes."""
    out, n = list(own), len(own)

    def headed(k: int) -> bool:
        """A good paragraph follows within reach."""
        far = 0
        for j in range(k + 1, n):
            if far > most:
                return False
            if out[j] == "good":
                return True
            far += lengths[j]
        return False

    def neighbour(k: int, step: int, near: bool) -> str:
        j = k + step
        while 0 <= j < n:
            if out[j] in ("good", "bad") or near and out[j] == "neargood":
                return out[j]
            j += step
        return "bad"

    for k in range(n):
        if headings[k] and out[k] == "short" and headed(k):
            out[k] = "neargood"
    short = {}
    for k in (k for k in range(n) if out[k] == "short"):
        sides = [neighbour(k, step, False) for step in (-1, 1)]
        beside = any(side == "bad" and neighbour(k, step, True) == "neargood" for side, step in zip(sides, (-1, 1), strict=True))
        short[k] = "good" if sides == ["good", "good"] or set(sides) == {"good", "bad"} and beside else "bad"
    for k, c in short.items():
        out[k] = c
    for k in range(n):
        if out[k] == "neargood":
            out[k] = "bad" if neighbour(k, -1, False) == neighbour(k, 1, False) == "bad" else "good"
    for k in range(n):
        if headings[k] and out[k] == "bad" and own[k] != "bad" and headed(k):
            out[k] = "good"
    return out


@F.pandas_udf(ArrayType(StringType()))
def in_context(own: pd.Series, headings: pd.Series, lengths: pd.Series) -> pd.Series:
    """Classes of a page's paragraphs by their neighbours: arrays of own classes, of headings and of lengths."""
    return pd.Series([None if a is None else _revised(list(a), list(b), list(c)) for a, b, c in zip(own, headings, lengths, strict=True)], dtype=object)


def paragraph_text(html: Column, keep_bad: bool = False, stop_words: list[str] = ()) -> Column:
    """Kept paragraphs, a line each: all, or those that are good or nearly so by themselves."""
    kept = paragraphs(html) if keep_bad else F.filter(paragraphs(html), lambda p: F.contains(classify(p, stop_words), F.lit("good")))
    return F.array_join(F.transform(kept, lambda p: p["text"]), "\n")


def hrefs(html: Column) -> Column:
    """Targets of all anchors, in order."""
    found = F.regexp_extract_all(html, F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)')"""), F.lit(0))
    return F.transform(found, lambda a: _common(F.regexp_extract(a, r"""(?is)href\s*=\s*["']([^"']*)["']$""", 1)))


def crawl(pages: DataFrame, url: str = "url", html: str = "html", content_type: str | None = None, failed: str | None = None, text: Callable[[Column], Column] = paragraph_text) -> DataFrame:
    """(url, text, hrefs, error): what a visit gives, errors by class.

    A column ``failed`` holds the class of error that a fetch ended with (null for none); a ``content_type`` that isn't
    of text, a page without content and one without any element or text have classes of their own.
    """
    page = F.col(html)
    bare = F.btrim(F.regexp_replace(page, r"(?is)<!--.*?-->|<!doctype[^>]*>|[\x{FEFF}\s]", ""))
    error = F.when(page.isNull() | (F.btrim(F.regexp_replace(page, r"[\x{FEFF}\s]", "")) == ""), "EmptyDocumentError").when(bare == "", "ParagraphError")
    if content_type:
        error = F.when(~F.coalesce(F.lower(F.col(content_type)).rlike("html|text/plain"), F.lit(False)), "CtypeError").otherwise(error)
    if failed:
        error = F.coalesce(F.col(failed), error)
    return pages.select(F.col(url).alias("url"), F.when(error.isNull(), text(page)).alias("text"), F.when(error.isNull(), hrefs(page)).alias("hrefs"), error.alias("error"))
