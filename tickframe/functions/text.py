"""Text cleaning.

Patterns use ``(?U)`` so that blanks, words and digits are Unicode-aware and ``(?d)`` so that only a line feed
ends a line. Only HTML unescape and NFKC leave the JVM, in one Arrow-batched helper.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLANK = r"[\s\x1c-\x1f]"

# Fixed set: every character that counts as a blank at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Runs of spaces and tabs. They become one space; a single space, which is one already, is left alone.
BLANK_RUN = r"\t[ \t]*| [ \t]+"

# Fixed noise patterns, in the order they are applied: (pattern that must occur, pattern, replacement). The
# first entry is a cheap test that spares most texts the costly scan; empty means none.
NOISE = [
    (r"(?i)\.(?:htm|xml)", r"(?Ui)\b\w+[-_]*\w*\.(?:htm|html|xml)\b", " "),
    ("", r"(?i)Table of Contents", " "),
    (r"\.{5}", rf"(?Umd)^.*?\.{{5,}}.*?[\dF-]+{_BLANK}*$", ""),
    ("F", rf"(?U)\bF{_BLANK}*-{_BLANK}*\d+\b", " "),
    ("-", rf"(?U)-{_BLANK}*\d+{_BLANK}*-", " "),
    ("", rf"(?Umd)^{_BLANK}*\d+{_BLANK}*$", ""),
    ("", BLANK_RUN, " "),
    ("\n", rf"(?U)\n{_BLANK}*\n{_BLANK}*", "\n\n"),
    ("\n", r"(?<!\n)\n(?!\n)", " "),
]


def strip(text: Column) -> Column:
    """Trim every kind of blank, not just spaces."""
    return F.btrim(text, F.lit(BLANKS))


def _single_blanks(text: Column) -> Column:
    """One blank per run of spaces and tabs; a text with neither a tab nor two spaces together has no run."""
    return F.when(text.contains("\t") | text.contains("  "), F.regexp_replace(text, BLANK_RUN, " ")).otherwise(text)


def normalize_whitespace(text: Column) -> Column:
    """Trim, one blank per run of spaces and tabs, at most one empty line between paragraphs."""
    spaced = _single_blanks(strip(text))
    return strip(F.regexp_replace(spaced, rf"(?U)\n{_BLANK}*\n{_BLANK}*\n{_BLANK}*", "\n\n"))


def _plain(text: str | None) -> str:
    if not text:
        return ""
    if "&" in text:
        text = html.unescape(text)
    return text if text.isascii() else unicodedata.normalize("NFKC", text)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _unescape_nfkc(arrays: pd.Series) -> pd.Series:
    return arrays.map(lambda texts: None if texts is None else [_plain(text) for text in texts])


def _needs_python(text: Column) -> Column:
    return text.contains("&") | text.rlike(r"[^\x00-\x7f]")


def unescape_nfkc_all(texts: Column) -> Column:
    """Entities resolved, then compatibility-composed, for each text of an array; null gives the empty string.

    Arrays of plain ASCII without an ampersand are unchanged by both, so they are not sent to Python.
    """
    needed = F.exists(texts, lambda text: F.coalesce(_needs_python(text), F.lit(True)))
    return F.coalesce(_unescape_nfkc(F.when(needed, texts)), texts)


def _step(guard: str, pattern: str, replacement: str):
    if pattern == BLANK_RUN:
        return _single_blanks

    def apply(text: Column) -> Column:
        replaced = F.regexp_replace(text, pattern, replacement)
        return F.when(text.rlike(guard), replaced).otherwise(text) if guard else replaced

    return apply


def drop_noise_all(texts: Column) -> Column:
    """For each text of an array: remove file names, contents lines and page marks, join paragraph lines, trim."""
    for guard, pattern, replacement in NOISE:
        texts = F.transform(texts, _step(guard, pattern, replacement))
    return F.transform(texts, strip)


def deep_clean(text: Column) -> Column:
    """Unescape, normalise and remove layout noise from filing text; null gives the empty string."""
    return F.get(drop_noise_all(unescape_nfkc_all(F.array(text))), F.lit(0))


def long_enough(text: Column, minimum: int) -> Column:
    """Trimmed length strictly above ``minimum``."""
    return F.length(strip(text)) > minimum
