"""Scalar expressions on filing metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickframe import fixed
from tickframe.functions.conform import nonempty


def form_family(form: Column) -> Column:
    """First of 10-K, 10-Q, 8-K contained in the upper-cased form."""
    upper = F.upper(F.coalesce(form, F.lit("")))
    family = F.lit(None).cast("string")
    for name in reversed(fixed.FORM_FAMILIES):
        family = F.when(upper.contains(name), F.lit(name)).otherwise(family)
    return family


def is_amendment(form: Column) -> Column:
    return F.upper(F.coalesce(form, F.lit(""))).contains("/A")


def form_suffix(form: Column) -> Column:
    """``_NT`` for late-filing notices, ``_A`` for amendments, a notice wins."""
    text = F.coalesce(form, F.lit(""))
    return F.when(text.startswith("NT"), "_NT").when(text.endswith("/A"), "_A").otherwise("")


def source_url(details: Column, html: Column) -> Column:
    """First non-empty link; null means the filing is dropped."""
    return F.coalesce(nonempty(details), nonempty(html))


def padded_cik(text: Column) -> Column:
    """Left-padded to ten digits; longer input is kept whole."""
    return F.when(F.length(text) < fixed.CIK_DIGITS, F.lpad(text, fixed.CIK_DIGITS, "0")).otherwise(text)


def normalize_cik(raw: Column) -> Column:
    """Struct (cik_clean, cik_unpadded, cik_padded, needs_lookup) of a raw CIK cell."""
    clean = F.regexp_replace(F.coalesce(raw, F.lit(fixed.NOT_FOUND)), r"\.0$", "")
    numeric = clean.rlike(r"\A[0-9]+\z")
    missing = F.lit(fixed.NOT_FOUND)
    return F.struct(
        clean.alias("cik_clean"),
        F.when(numeric, F.ltrim(clean, F.lit("0"))).otherwise(missing).alias("cik_unpadded"),
        F.when(numeric, padded_cik(clean)).otherwise(missing).alias("cik_padded"),
        (~numeric).alias("needs_lookup"),
    )


def integer_cik(raw: Column) -> Column:
    """CIK as an unpadded integer string; unreadable gives null."""
    return raw.try_cast("bigint").cast("string")


def sic_for(entities: Column, cik: Column) -> Column:
    """SIC of the first entity whose padded CIK equals ``cik``."""
    return F.get(F.filter(entities, lambda e: padded_cik(e["cik"]) == cik), F.lit(0))["sic"]


def _section_array(sections: list[tuple[str, str]]) -> Column:
    return F.array(
        *[F.struct(F.lit(code).alias("code"), F.lit(name).alias("section_id")) for code, name in sections]
    )


def applicable_sections(form: Column, items: Column, leading_code: bool = False) -> Column:
    """Sections to take from a filing, as an array of (code, section_id).

    Annual and quarterly forms take their whole list. Current reports take the reported items whose text,
    without ``Item `` and trimmed, is exactly a known code; ``leading_code`` also accepts a title after the code.
    """
    known = F.create_map(*[F.lit(part) for pair in fixed.EIGHT_K_SECTIONS for part in pair])
    cleaned = F.transform(
        F.coalesce(items, F.array().cast("array<string>")),
        lambda item: F.regexp_replace(F.replace(item, F.lit("Item "), F.lit("")), r"(?U)\A\s+|\s+\z", ""),
    )
    if leading_code:
        cleaned = F.transform(
            cleaned, lambda item: F.coalesce(nonempty(F.regexp_extract(item, r"\A(\d\.\d{2})", 1)), item)
        )
    reported = F.transform(
        F.filter(F.array_distinct(cleaned), lambda code: F.map_contains_key(known, code)),
        lambda code: F.struct(
            F.replace(code, F.lit("."), F.lit("-")).alias("code"), F.element_at(known, code).alias("section_id")
        ),
    )
    family = form_family(form)
    return (
        F.when(family == "10-K", _section_array(fixed.TEN_K_SECTIONS))
        .when(family == "10-Q", _section_array(fixed.TEN_Q_SECTIONS))
        .when(family == "8-K", reported)
        .otherwise(F.array().cast("array<struct<code:string,section_id:string>>"))
    )


def section_rank(section_id: Column) -> Column:
    """Place of a section in the consolidation order; unknown sections go last."""
    ordered = [name for _, name in fixed.TEN_K_SECTIONS + fixed.TEN_Q_SECTIONS + fixed.EIGHT_K_SECTIONS]
    ranks = F.create_map(*[F.lit(part) for rank, name in enumerate(ordered) for part in (name, rank)])
    return F.coalesce(F.try_element_at(ranks, F.coalesce(section_id, F.lit(""))), F.lit(fixed.UNKNOWN_SECTION_RANK))


def section_title(section_id: Column) -> Column:
    """Readable section name: blanks for underscores, part prefixes spelled out."""
    name = F.replace(F.coalesce(section_id, F.lit("Unknown Section")), F.lit("_"), F.lit(" "))
    return (
        F.when(name.startswith("P1 "), F.concat(F.lit("Part I, "), F.substr(name, F.lit(4))))
        .when(name.startswith("P2 "), F.concat(F.lit("Part II, "), F.substr(name, F.lit(4))))
        .otherwise(name)
    )


def address_line(address: Column) -> Column:
    """One line of the four address parts, absent and empty ones skipped."""
    parts = [nonempty(address[name]) for name in ("address1", "city", "state", "postal_code")]
    return F.when(address.isNotNull(), F.concat_ws(", ", *parts))
