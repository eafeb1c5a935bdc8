"""Main text of an article page: the one Arrow UDF of the package.

The parsing helper handles one page; Spark partitions the pages. No page is
cut short and none is fetched.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements without an end tag, and text that is never visible.
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
_HIDDEN = {"script", "style", "template"}
# Container preference; a class of None means the tag alone.
CONTAINERS = [
    ("article", None), ("main", None), ("div", "article-body"), ("div", "story"),
    ("div", "content"), ("body", None),
]
CONTAINERS_SHORT = [c for c in CONTAINERS if c != ("div", "content")]


class _Page(HTMLParser):
    """Streams one page; keeps paragraph texts per first container and all visible strings."""

    def __init__(self, containers):
        super().__init__(convert_charrefs=True)
        self.containers = containers
        self.stack: list[str] = []
        self.open_depth = [None] * len(containers)  # stack depth of the open container
        self.seen = [False] * len(containers)
        self.paragraphs: list[list[list[str]]] = [[] for _ in containers]
        self.all_paragraphs: list[list[str]] = []
        self.open_ps: list[tuple[int, list[str]]] = []
        self.visible: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        self.stack.append(tag)
        classes = (dict(attrs).get("class") or "").split()
        for i, (name, cls) in enumerate(self.containers):
            if not self.seen[i] and tag == name and (cls is None or cls in classes):
                self.seen[i] = True
                self.open_depth[i] = len(self.stack)
        if tag == "p":
            parts: list[str] = []
            self.open_ps.append((len(self.stack), parts))
            self.all_paragraphs.append(parts)
            for i, depth in enumerate(self.open_depth):
                if depth is not None:
                    self.paragraphs[i].append(parts)

    def handle_startendtag(self, tag, attrs):
        if tag not in _VOID:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in self.stack:
            return
        while self.stack:
            closed = self.stack.pop()
            depth = len(self.stack)
            self.open_ps = [p for p in self.open_ps if p[0] <= depth]
            self.open_depth = [d if d is not None and d <= depth else None for d in self.open_depth]
            if closed == tag:
                break

    def handle_data(self, data):
        text = data.strip()
        if not text or (self.stack and self.stack[-1] in _HIDDEN):
            return
        self.visible.append(text)
        for _, parts in self.open_ps:
            parts.append(text)


def main_text(html: str | None, containers=CONTAINERS, visible_fallback: bool = True) -> str:
    """Paragraphs of the first container that has any, else all paragraphs, else visible text."""
    if not html:
        return ""
    page = _Page(containers)
    page.feed(html)
    page.close()
    for group in (*page.paragraphs, page.all_paragraphs):
        texts = ["".join(parts) for parts in group]
        texts = [t for t in texts if t]
        if texts:
            return " ".join(texts).strip()
    return " ".join(page.visible).strip() if visible_fallback else ""


@F.arrow_udf(T.StringType())
def article_text(html: pa.Array) -> pa.Array:
    """Six containers and the visible-text fallback."""
    return pa.array((main_text(h.as_py()) for h in html), pa.string())


@F.arrow_udf(T.StringType())
def article_text_short(html: pa.Array) -> pa.Array:
    """Five containers (no ``div.content``), no visible-text fallback."""
    return pa.array((main_text(h.as_py(), CONTAINERS_SHORT, visible_fallback=False) for h in html), pa.string())


def bounded_pages(df: DataFrame) -> DataFrame:
    """The same rows; from here on the session hands pages to Python in batches of a few MB, whatever their number."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return df
