"""Cut filing text into item sections, row by row, without moving a row.

Headings are replaced by marks with one ``regexp_replace``, which scans left to right exactly once, and the text
is split at the marks. Each document stays one row until its sections are exploded; only HTML unescape and NFKC
run in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe import fixed
from tickframe.functions import text as tx
from tickframe.functions.filing import form_family

# Noncharacters, never part of interchanged text; removed from the input all the same.
_MARK = "\ufdd0"
_CODE_END = "\ufdd1"

_B = r"[\s\x1c-\x1f]"
_SEPARATOR = r"[\s\x1c-\x1f.:\-–—]"

# Fixed heading patterns.
ANNUAL_HEADING = (
    rf"(?Uimd)^{_B}{{0,15}}(?:PART{_B}+[IVX]+{_B}*[,.\-]?{_B}*)?ITEM{_B}*(\d{{1,2}}[A-Z]?){_SEPARATOR}{_B}*"
)
CURRENT_HEADING = rf"(?Uimd)^{_B}{{0,15}}ITEM{_B}*(\d\.\d{{2}}){_SEPARATOR}*{_B}*"
BODY_START = rf"(?Uimd)^{_B}*(?:PART{_B}+I|ITEM{_B}+1)\b"
PART_TWO = rf"(?Uimd)^{_B}*PART{_B}+II\b"
SIGNATURES = rf"(?Uid)\n{_B}*SIGNATURES{_B}*\n"


def _unmarked(text: Column) -> Column:
    # Not ``translate``, which looks up every character.
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit(_MARK), F.lit("")), F.lit(_CODE_END), F.lit(""))


def _start_pieces(clean: Column) -> Column:
    return F.split(F.regexp_replace(clean, BODY_START, _MARK + "$0"), _MARK)


def _from_start(pieces: Column, family: Column) -> Column:
    headings = F.size(pieces) - 1
    in_contents = (headings > 1) & (F.length(F.get(pieces, F.lit(1))) < fixed.CONTENTS_DISTANCE)
    skipped = F.when(~family.isin("10-K", "10-Q"), 0).when(in_contents, 2).when(headings >= 1, 1).otherwise(0)
    return F.array_join(F.slice(pieces, F.coalesce(skipped, F.lit(0)) + 1, F.size(pieces)), "")


def with_body(df: DataFrame, text: str, form: str, out: str = "body", whole: Column | None = None) -> DataFrame:
    """Add the text from the start of the body on.

    Annual and quarterly reports start at the second ``PART I`` / ``Item 1`` line when that follows the first
    within 5,000 characters (the first is then a contents list), else at the first; other forms start at 0, and so do
    rows where ``whole`` holds, whose start isn't looked for.
    """
    family = F.coalesce(form_family(F.col(form)), F.lit(""))
    sought = family.isin("10-K", "10-Q")
    pieces = F.when(sought if whole is None else sought & ~whole, _start_pieces(_unmarked(F.col(text)))).otherwise(
        F.array(_unmarked(F.col(text)))
    )
    return df.withColumn("_pieces", pieces).withColumn(out, _from_start(F.col("_pieces"), family)).drop("_pieces")


def _before_signatures(text: Column) -> Column:
    return F.get(F.split(text, SIGNATURES, 2), F.lit(0))


def _marked(body: Column, family: Column) -> Column:
    """Body with every heading of its form replaced by a mark and the item number; null for other forms."""
    return F.when(
        family.isin("10-K", "10-Q"), F.regexp_replace(body, ANNUAL_HEADING, f"{_MARK}$1{_CODE_END}")
    ).when(family == "8-K", F.regexp_replace(body, CURRENT_HEADING, f"{_MARK}$1{_CODE_END}"))


def _merged(keys: Column, kept: Column) -> Column:
    """Array of (section, text) in order of first appearance, repeats joined by the continuation mark."""
    return F.transform(
        keys,
        lambda key: F.struct(
            key.alias("section"),
            F.array_join(
                F.transform(F.filter(kept, lambda s: s["section"] == key), lambda s: s["text"]), fixed.CONTINUED
            ).alias("text"),
        ),
    )


def with_parts(filings: DataFrame, text: str = "text", form: str = "form_type") -> DataFrame:
    """Quarterly reports in their two parts, one row each with ``part`` (1, 2); other filings one row, ``part`` null.

    Part II starts at its first heading after the start of the body; item numbers begin anew there. A report
    without that heading is all Part I. A report without any item heading stays one row with ``part`` null, since there
    is nothing to tell its parts' items apart by; if only one part has none, that part stays a row too.
    """
    quarterly = F.coalesce(form_family(F.col(form)) == "10-Q", F.lit(False))
    told = filings.withColumn("_whole", F.when(quarterly, F.col(text)))
    halves = F.when(quarterly, F.split(F.regexp_replace("_body", PART_TWO, _MARK + "$0"), _MARK, 2))
    body = with_body(told, "_whole", form, "_body", ~quarterly).withColumn("_halves", halves)
    first = F.struct(F.lit(1).alias("part"), F.get("_halves", F.lit(0)).alias("text"))
    second = F.struct(F.lit(2).alias("part"), F.replace(F.get("_halves", F.lit(1)), F.lit(_MARK), F.lit("")).alias("text"))
    whole = F.struct(F.lit(None).cast("int").alias("part"), F.col(text).alias("text"))
    split = F.when(quarterly, F.filter(F.array(first, second), lambda p: p["text"].isNotNull())).otherwise(F.array(whole))
    # Told here, while the text is at hand, so that no row is read again.
    kept = F.when(F.exists("_split", lambda p: p["part"].isNull() | p["text"].rlike(ANNUAL_HEADING)), F.col("_split")).otherwise(F.array(whole))
    rows = body.withColumn("_split", split).withColumn("_part", F.explode(kept))
    return rows.withColumn(text, F.col("_part.text")).withColumn("part", F.col("_part.part")).drop("_part", "_split", "_body", "_halves", "_whole")


def segment_by_parts(filings: DataFrame, text: str = "text", form: str = "form_type") -> DataFrame:
    """:func:`segment_filings` with quarterly reports cut in their parts first, and ``part``; no text is lost.

    Reports and parts without item headings give their whole text as one section. Parts and other rows go through together, so
    that each text is read once.
    """
    return segment_filings(with_parts(filings, text, form), text, form, minimum=F.when(F.col("part").isNotNull(), 1))


def segment_filings(
    filings: DataFrame, text: str = "text", form: str = "form_type", minimum: int | Column | None = None
) -> DataFrame:
    """One row per (filing, section) with ``position``, ``section``, ``text``; other columns are kept.

    A filing with fewer headings than its form needs, or of another form, gives its whole cleaned text up to the
    signature line as one section. Empty sections are dropped. Every step is a column of the same row; steps used
    more than once are columns of their own, so that none is computed twice. ``minimum`` stands in for the form's own
    number of headings, for parts of filings, whose text already starts with the body; as a column it does so where it
    isn't null.
    """
    keep = [name for name in filings.columns if name != text]
    family = F.col("_family")
    least = minimum if isinstance(minimum, Column) else F.lit(minimum).cast("int")
    needed = F.lit(None).cast("int")
    for name, own in fixed.MIN_HEADINGS.items():
        needed = F.when(family == name, F.coalesce(least, F.lit(own))).otherwise(needed)
    segmented = F.col("_segmented")
    none = F.array().cast("array<string>")
    # A found piece is the item number, the end mark and the text up to the next heading.
    number = F.transform("_found", lambda piece: F.substring_index(piece, _CODE_END, 1))
    tails = F.transform("_found", lambda piece: F.substring_index(piece, _CODE_END, -1))
    named = filings.withColumn("_family", form_family(F.col(form)))
    cut = (
        with_body(named, text, form, "_body", None if minimum is None else least.isNotNull())
        .withColumn("_split", F.split(_marked(F.col("_body"), family), _MARK))
        .withColumn("_found", F.coalesce(F.slice("_split", 2, F.size("_split")), none))
        .withColumn("_segmented", F.coalesce(F.size("_found") >= needed, F.lit(False)))
        .withColumn("_numbers", F.when(segmented, number).otherwise(none))
        .withColumn("_tails", F.when(segmented, tails).otherwise(none))
        .withColumn(
            "_raw",
            F.when(
                segmented,
                F.transform(
                    "_tails",
                    lambda tail, i: F.when(i == F.size("_tails") - 1, _before_signatures(tail)).otherwise(tail),
                ),
            ).otherwise(F.array("_body")),
        )
        .withColumn("_plain", tx.unescape_nfkc_all(F.col("_raw")))
        .withColumn("_clean", tx.drop_noise_all(F.col("_plain")))
        .withColumn(
            "_kept",
            F.filter(
                F.transform(
                    "_numbers",
                    lambda n, i: F.struct(
                        F.concat(F.lit("Item_"), F.upper(n)).alias("section"), F.get("_clean", i).alias("text")
                    ),
                ),
                lambda s: F.length(s["text"]) > fixed.MIN_SECTION_CHARS,
            ),
        )
        .withColumn("_keys", F.array_distinct(F.transform("_kept", lambda s: s["section"])))
    )
    whole = tx.strip(_before_signatures(F.get("_clean", F.lit(0))))
    fallback = F.array(F.struct(F.lit(fixed.FULL_DOCUMENT).alias("section"), whole.alias("text")))
    sections = F.when(segmented, _merged(F.col("_keys"), F.col("_kept"))).otherwise(fallback)
    return (
        cut.select(*keep, F.posexplode(sections).alias("position", "_section"))
        .select(*keep, "position", "_section.section", "_section.text")
        .filter(F.col("text") != "")
    )
