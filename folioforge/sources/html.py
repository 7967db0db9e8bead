"""Text, links and titles of web pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tags that part lines, tags without content for readers, tags without an end, classes and ids left out (fixed values).
BLOCK = frozenset("p div br li ul ol dl dd dt tr table blockquote pre section article hr center poem h1 h2 h3 h4 h5 h6".split())
SILENT = frozenset("script style noscript head template svg math nav footer button".split())
VOID = frozenset("br img hr meta link input wbr source area base col embed param track".split())
DROPPED_CLASSES = frozenset(
    "mw-editsection reference references noprint navbox ws-noexport mw-cite-backlink catlinks printfooter licenseContainer mw-jump-link toc mw-heading-anchor ws-header".split()
)
DROPPED_PARTS, DROPPED_IDS = ("tooltip",), frozenset({"headerContainer"})


class _Reader(HTMLParser):
    """Keeps the open tags and the depths at which silence and the wanted root began."""

    def __init__(self, root: str | None):
        super().__init__(convert_charrefs=True)
        self.root, self.root_seen = root, root is None
        self.open: list[str] = []
        self.silent_from = self.root_from = 0
        self.out: list[str] = []
        self.links: list[str] = []

    def _hears(self) -> bool:
        return not self.silent_from and (self.root is None or self.root_from > 0)

    def _silences(self, tag: str, attrs: dict[str, str | None]) -> bool:
        names = (attrs.get("class") or "").split()
        style = re.sub(r"\s", "", attrs.get("style") or "").lower()
        return tag in SILENT or "display:none" in style or attrs.get("id") in DROPPED_IDS or any(n in DROPPED_CLASSES or any(p in n for p in DROPPED_PARTS) for n in names)

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in VOID:
            if tag in BLOCK and self._hears():
                self.out.append("\n")
            return
        self.open.append(tag)
        depth = len(self.open)
        if not self.root_from and self.root is not None and self.root in (a.get("class") or "").split():
            self.root_from, self.root_seen = depth, True
        if not self.silent_from and self._silences(tag, a):
            self.silent_from = depth
        if self._hears():
            if tag in BLOCK:
                self.out.append("\n")
            if tag == "a" and a.get("href"):
                self.links.append(a["href"])

    def handle_endtag(self, tag):
        if tag in VOID or tag not in self.open:
            return
        heard = self._hears()
        depth = len(self.open) - self.open[::-1].index(tag)
        del self.open[depth - 1 :]
        if self.silent_from >= depth:
            self.silent_from = 0
        if self.root_from >= depth:
            self.root_from = 0
        if heard and tag in BLOCK:
            self.out.append("\n")

    def handle_data(self, data):
        if self._hears():
            self.out.append(data)


def html_to_text(markup: str | None, root: str | None = None) -> tuple[str | None, list[str]]:
    """(text, links) of a page; of the elements of class ``root`` alone where the page has any. Null gives null."""
    if markup is None:
        return None, []
    r = _Reader(root)
    r.feed(markup)
    r.close()
    if not r.root_seen:
        return html_to_text(markup)
    lines = (re.sub(r"[ \t ]+", " ", x).strip() for x in "".join(r.out).replace("\r", "").split("\n"))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip() + "\n", list(dict.fromkeys(r.links))


def page_texts(df: DataFrame, key: str, markup: str, root: str | None = None) -> DataFrame:
    """key, text, links (ordered, distinct)."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [html_to_text(m, root) for m in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.list_(pa.string()))], names=[key, "text", "links"])

    return df.select(key, F.col(markup).alias("__m")).mapInArrow(run, f"`{key}` {kind}, text string, links array<string>")


def page_title(markup: Column) -> Column:
    """The text of a page's first title element, white space in one kind; null where there is none. Stays in the JVM."""
    raw = F.regexp_extract(markup, r"(?is)<title[^>]*>(.*?)</title\s*>", 1)
    for name, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("nbsp", " "), ("amp", "&")):
        raw = F.replace(raw, F.lit(f"&{name};"), F.lit(sign))
    plain = F.trim(F.regexp_replace(raw, r"\s+", " "))
    return F.when(plain != "", plain)
