"""HTML to text, as Arrow-batched column functions over a small tag walker."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed tag lists.
DROPPED_TAGS = {"script", "style", "noscript", "meta", "img", "head", "title"}
DROPPED_XBRL = {"xbrli:context", "xbrli:unit", "xbrl"}
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE_TAGS = {"a", "b", "strong", "i", "em", "u", "font", "span", "sub", "sup", "small"}

_HIDDEN = re.compile(r"display:\s*none|visibility:\s*hidden", re.IGNORECASE)
# An opening tag of the key closes an open element of the listed kinds.
_CLOSED_BY = {
    "p": {"p"},
    "div": {"p"},
    "table": {"p"},
    "ul": {"p"},
    "ol": {"p"},
    "h1": {"p"},
    "h2": {"p"},
    "h3": {"p"},
    "body": {"head"},
    "li": {"li"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
}
_SCOPE = {"table", "ul", "ol", "div", "body"}


class _Walker(HTMLParser):
    """Collects text pieces outside dropped elements; tables are dropped or kept as rows of cells."""

    def __init__(self, keep_tables: bool):
        super().__init__(convert_charrefs=True)
        self.keep_tables = keep_tables
        self.open: list[tuple[str, bool]] = []
        self.muted = 0
        self.piece: list[str] = []
        self.pieces: list[str] = []
        self.row: list[str] | None = None

    def _flush(self) -> None:
        text = "".join(self.piece).replace("\xa0", " ").strip()
        self.piece.clear()
        if not text:
            return
        if self.row is not None:
            self.row[-1:] = [f"{self.row[-1]} {text}".strip()] if self.row else [text]
        else:
            self.pieces.append(text)

    def _mutes(self, tag: str, attrs: list) -> bool:
        if tag.startswith("ix:"):
            return False
        if tag in DROPPED_TAGS or tag in DROPPED_XBRL or (tag == "table" and not self.keep_tables):
            return True
        return any(name == "style" and value and _HIDDEN.search(value) for name, value in attrs)

    def _pop(self) -> None:
        tag, muting = self.open.pop()
        self.muted -= muting
        if tag == "tr" and self.row is not None and not self.muted:
            if any(self.row):
                self.pieces.append(" | ".join(self.row))
            self.row = None

    def handle_starttag(self, tag, attrs):
        if self.keep_tables and tag in INLINE_TAGS:
            return
        self._flush()
        while self.open and self.open[-1][0] in _CLOSED_BY.get(tag, ()):
            self._pop()
        if tag in VOID_TAGS:
            return
        muting = self._mutes(tag, attrs)
        self.open.append((tag, muting))
        self.muted += muting
        if self.keep_tables and not self.muted:
            if tag == "tr":
                self.row = []
            elif tag in ("td", "th") and self.row is not None:
                self.row.append("")

    def handle_startendtag(self, tag, attrs):
        self._flush()

    def handle_endtag(self, tag):
        if self.keep_tables and tag in INLINE_TAGS:
            return
        self._flush()
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.open[depth][0]
            if name == tag:
                while len(self.open) > depth:
                    self._pop()
                return
            if name in _SCOPE and tag not in _SCOPE:
                return

    def handle_comment(self, data):
        self._flush()

    def handle_data(self, data):
        if not self.muted:
            self.piece.append(data)

    def finish(self, text: str) -> list[str]:
        self.feed(text)
        self.close()
        self._flush()
        while self.open:
            self._pop()
        return self.pieces


@F.pandas_udf(T.StringType())
def html_to_text(pages: pd.Series) -> pd.Series:
    """Visible text of filing HTML, one line per text node; scripts, hidden parts and tables are left out."""
    return pages.map(lambda page: "\n".join(_Walker(False).finish(page)) if page else "")


@F.pandas_udf(T.StringType())
def html_to_blocks(pages: pd.Series) -> pd.Series:
    """Readable text of section HTML: each block or table row once, in document order, an empty line between."""
    return pages.map(lambda page: "\n\n".join(_Walker(True).finish(page)) if page else "")
