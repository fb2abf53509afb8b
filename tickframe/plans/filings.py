"""Queries over filings and their text, with the SQL they must agree with."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe import fixed
from tickframe.functions import filing as fx
from tickframe.functions import text as tx
from tickframe.functions.html import html_to_blocks, html_to_text
from tickframe.functions.instants import date_part, iso_utc
from tickframe.operators import consolidate as con
from tickframe.operators import filings as fil
from tickframe.operators import segment as seg
from tickframe.plans import bindings as bd
from tickframe.session import new_scratch

SCOPE_DATE = dt.date(2033, 7, 1)
_FIXED_NOW = "2024-01-31 00:00:00"


def _now():
    return F.lit(_FIXED_NOW).cast("timestamp")


def filing_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bd.filings(spark, sf_dir).select(
        F.col("accessionNo").alias("accession"),
        fx.form_family(F.col("formType")).alias("family"),
        fx.is_amendment(F.col("formType")).alias("is_amendment"),
        fx.form_suffix(F.col("formType")).alias("suffix"),
        date_part(F.col("filedAt")).alias("filing_date"),
        fx.source_url(F.col("linkToFilingDetails"), F.col("linkToHtml")).alias("source_url"),
    )


def filings_in_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fil.in_scope(bd.filings(spark, sf_dir), SCOPE_DATE)
    return kept.select(F.col("accessionNo").alias("accession"), "formType")


def filed_at_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filing instants in UTC; every seventh is unreadable, every fifth already in UTC."""
    raw = (
        F.when(F.col("doc_id") % 7 == 0, "soon")
        .when(F.col("doc_id") % 5 == 0, F.replace("filedAt", F.lit("-05:00"), F.lit("Z")))
        .otherwise(F.col("filedAt"))
    )
    return bd.filings(spark, sf_dir, "doc_id").select("doc_id", iso_utc(raw).alias("filed_at_utc"))


def sic_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bd.filings(spark, sf_dir, "doc_id").select("doc_id", fx.sic_for(F.col("entities"), F.col("cik")).alias("sic_code"))


def base_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fil.base_records(bd.filings(spark, sf_dir), _now())
    return base.withColumn("items_reported", F.array_join("items_reported", "|"))


def filing_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = fil.filing_sections(fil.base_records(bd.filings(spark, sf_dir), _now()))
    return wanted.select("accession_number", "section_code", "section_id")


def dedupe_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each filing with an older copy, a copy under another ticker and one without accession."""
    found = bd.filings(spark, sf_dir)
    older = found.withColumns({"filedAt": F.lit("2000-01-01T00:00:00Z"), "companyName": F.lit("old")})
    other = found.withColumns({"ticker": F.lit("OTHER"), "companyName": F.lit("other")})
    blank = found.withColumn("accessionNo", F.lit(""))
    copies = older.unionByName(found).unionByName(other).unionByName(blank)
    return fil.dedupe_filings(copies, ["companyName"]).select("accessionNo", "ticker", "companyName", "filedAt")


def attached_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings with the supplier tickers that follow their company."""
    targets = bd.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("ticker"), F.expr("lpad(CAST(s_suppkey AS STRING), 10, '0')").alias("cik")
    )
    found = fil.attach_targets(bd.filings(spark, sf_dir).drop("ticker"), targets)
    return found.select("accessionNo", "ticker", "cik")


def missing_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered filings without a stored counterpart; labelled documents count as stored."""
    found = bd.filings(spark, sf_dir, "doc_id")
    stored = fil.download_candidates(found.join(bd.table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi"))
    return fil.missing_filings(fil.download_candidates(found), stored)


def _line_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of a document, dealt in turn to the sections of its form: line i belongs to section i modulo their number."""
    codes = {
        "10-K": [code for code, _ in fixed.TEN_K_SECTIONS],
        "10-Q": [code for code, _ in fixed.TEN_Q_SECTIONS],
        "8-K": [code.replace(".", "-") for code, _ in fixed.EIGHT_K_SECTIONS],
    }
    family = fx.form_family(F.expr(bd.FORM))
    listed = F.lit(None).cast("array<string>")
    for name, names in codes.items():
        listed = F.when(family == name, F.array(*[F.lit(code) for code in names])).otherwise(listed)
    docs = bd.texts(spark, sf_dir, "documents", "doc_id", "source", "text").select(
        F.expr(bd.ACCESSION).alias("accession_number"),
        F.col("source").alias("ticker"),
        listed.alias("_codes"),
        F.split("text", "\n").alias("_lines"),
    )
    dealt = F.transform(
        "_codes",
        lambda code, k: F.struct(
            code.alias("section_code"),
            F.array_join(F.filter("_lines", lambda _, i: i % F.size("_codes") == k), "\n").alias("text"),
        ),
    )
    return docs.select("accession_number", "ticker", F.explode(dealt).alias("_part")).select("accession_number", "ticker", "_part.*")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = fil.dedupe_filings(bd.filings(spark, sf_dir), ["linkToTxt"])
    wanted = fil.filing_sections(fil.base_records(once, _now()))
    return fil.section_records(wanted, _line_texts(spark, sf_dir))


def section_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select(
        "accession_number", "ticker", "form_type", "section_id", "text", "filing_timestamp_utc", "sic_code"
    )


def _quarterly_text() -> Column:
    """The lines of a document once in each part, under the part's own numbers."""
    lines = F.split("text", "\n")
    one = F.transform(lines, lambda line, i: F.concat(F.lit("Item "), i % 4 + 1, F.lit(". "), line))
    two = F.transform(lines, lambda line, i: F.concat(F.lit("Item 1"), F.get(F.array(F.lit(""), F.lit("A")), i % 2), F.lit(". "), line))
    return F.concat(
        F.lit("PART I\n"), F.array_join(one, "\n"), F.lit("\nPART II\n"), F.array_join(two, "\n"), F.lit("\n\nSIGNATURES\n\nSigned.")
    )


def _parted_text() -> Column:
    """Texts of :func:`_headed`; quarterly ones hold their lines once in each part.

    One expression over one scan: a union of two would deal the texts by key twice, and Spark may take such a union for dealt by
    that key in the join that follows, while adaptive execution has given its sides different numbers of partitions.
    """
    return F.when(fx.form_family(F.expr(bd.FORM)) == "10-Q", _quarterly_text()).otherwise(_headed_text())


def _documents_with(spark: SparkSession, sf_dir: str, text: Column) -> DataFrame:
    """Documents under ``text``, with form, accession number and ticker."""
    docs = bd.texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.expr(bd.FORM).alias("form_type"), text.alias("text"))
    return docs.join(bd.filings(spark, sf_dir, "doc_id").select("doc_id", F.col("accessionNo").alias("accession_number"), "ticker"), "doc_id")


def segmented_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section records whose texts come from the segmenter, quarterly reports by their parts."""
    documents = _documents_with(spark, sf_dir, _parted_text())
    texts = fil.texts_from_segments(seg.segment_by_parts(documents))
    once = fil.dedupe_filings(bd.filings(spark, sf_dir), ["linkToTxt"])
    found = fil.section_records(fil.filing_sections(fil.base_records(once, _now())), texts)
    return found.select("accession_number", "section_id", "text")


def _partly_headed_text() -> Column:
    """Texts of :func:`_parted_text`; of the quarterly ones every fourth has no headings, and every fourth none in Part II."""
    lines = F.split("text", "\n")
    items = F.array_join(F.transform(lines, lambda line, i: F.concat(F.lit("Item "), i % 4 + 1, F.lit(". "), line)), "\n")
    notes = F.array_join(F.transform(lines, lambda line: F.concat(F.lit("Note. "), line)), "\n")
    first = F.when(F.col("doc_id") % 12 == 1, notes).otherwise(items)
    text = F.concat(F.lit("PART I\n"), first, F.lit("\nPART II\n"), notes, F.lit("\n\nSIGNATURES\n\nSigned."))
    return F.when(F.col("doc_id") % 6 == 1, text).otherwise(_parted_text())


def segmented_wholes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section records with, as records of their own, the texts of filings and parts that have no or too few headings.

    Both read the segments, which are stored so that the texts are segmented once.
    """
    path = new_scratch(spark, "segments")
    seg.segment_by_parts(_documents_with(spark, sf_dir, _partly_headed_text())).write.parquet(path)
    segments = spark.read.parquet(path)
    base = fil.base_records(fil.dedupe_filings(bd.filings(spark, sf_dir), ["linkToTxt"]), _now())
    found = fil.section_records(fil.filing_sections(base), fil.texts_from_segments(segments))
    return found.unionByName(fil.whole_records(base, segments)).select("accession_number", "section_id", "text")


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that can be stored per year, and the number that cannot; every seventh filing has no readable time."""
    found = bd.filings(spark, sf_dir, "doc_id")
    found = found.withColumn("filedAt", F.when(F.col("doc_id") % 7 > 0, F.col("filedAt")).otherwise("unknown"))
    good, bad = fil.storable(fil.base_records(found.drop("doc_id"), _now()))
    counted = good.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    return counted.unionByName(bad.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit("none").alias("year"), "n"))


def normalize_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.replace(F.replace("text", F.lit(" "), F.lit("  \t")), F.lit("\n"), F.lit("\n \n\t\n"))
    docs = bd.texts(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", F.concat(F.lit(" \n"), noisy, F.lit("\t")).alias("text")
    )
    kept = docs.filter(tx.long_enough(F.col("text"), fixed.MIN_SECTION_CHARS))
    return kept.select("doc_id", tx.normalize_whitespace(F.col("text")).alias("text"))


def deep_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents wrapped in the noise of a filing: contents list, file name, page marks, entities."""
    noisy = F.concat(
        F.lit("Table of Contents\nRisk Factors ........ 12\n"),
        F.replace("text", F.lit(" the "), F.lit(" &amp; ")),
        F.lit("\nEnd\nform_10k.htm\n- 12 -\nF-3\n 17 \n\n\n"),
        F.col("text"),
    )
    docs = bd.texts(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", tx.deep_clean(noisy).alias("text"))


#: Markup that no reader sees, and a table.
_UNSEEN = (
    '<div style="display: none">hidden<p>deep</div><p style="color:red;visibility:hidden">x</p>'
    "<xbrli:context><b>c</b></xbrli:context><noscript>n</noscript><!-- note -->"
)
_TABLE = "<table><tr><th>cell</th><td><b>t</b>wo</td></tr><tr><td></td></tr></table>"


def _marked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a table and unseen parts at the start of their body."""
    return bd.texts(spark, sf_dir, "pages", "page_id", "html").select(
        "page_id", F.replace("html", F.lit("<body>"), F.lit(f"<body>{_UNSEEN}{_TABLE}")).alias("html")
    )


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked_pages(spark, sf_dir).select("page_id", html_to_text("html").alias("text"))


def html_readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked_pages(spark, sf_dir).select("page_id", html_to_blocks("html").alias("text"))


def doc_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document after a contents line and again after the heading the contents points to."""
    text = F.concat(F.lit("PART I\n"), "text", F.lit("\nItem 1\n"), "text")
    docs = bd.texts(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", F.expr(bd.FORM).alias("form"), text.alias("text")
    )
    body = seg.with_body(docs, "text", "form")
    return body.select(
        "doc_id",
        (F.length("text") - F.length("body")).alias("body_offset"),
        F.length("body").alias("body_chars"),
    )


def _headed_text() -> Column:
    """A document's text with an item heading before every line, numbered in a cycle, and a signature block."""
    family = fx.form_family(F.expr(bd.FORM))
    body = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.when(
            family == "8-K", F.concat(F.lit("Item "), i % 8 + 1, F.lit(".0"), i % 2 + 1, F.lit(" "), line)
        ).otherwise(F.concat(F.lit("ITEM "), i % 30 + 2, F.lit(". "), line)),
    )
    return F.concat(F.array_join(body, "\n"), F.lit("\n\nSIGNATURES\n\nSigned by the company."))


def _headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bd.texts(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", F.expr(bd.FORM).alias("form_type"), _headed_text().alias("text"))


def segment_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seg.segment_filings(_headed(spark, sf_dir)).select("doc_id", "position", "section", "text")


def segment_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of an unhandled form: one section with the whole text."""
    docs = _headed(spark, sf_dir).withColumn("form_type", F.lit("S-1"))
    return seg.segment_filings(docs).select("doc_id", "section", "text")


def consolidated_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.consolidated_blocks(bd.section_texts(spark, sf_dir))


def merged_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.merged_blocks(bd.section_texts(spark, sf_dir))


def marked_sections(records: DataFrame) -> DataFrame:
    """Section texts as HTML: a paragraph in part bold, unseen parts and a table."""
    return records.withColumn("text", F.concat(F.lit("<p><b></b>"), "text", F.lit(f"</p>{_UNSEEN}{_TABLE}")))


def formatted_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.formatted_blocks(marked_sections(bd.section_texts(spark, sf_dir)))


def html_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.html_blocks(bd.section_texts(spark, sf_dir), "h1 { color: navy }")


def queries() -> dict:
    names = (
        filing_flags, filings_in_scope, filed_at_utc, sic_lookup, base_records, filing_sections, dedupe_filings,
        attached_targets, missing_filings, section_records, segmented_records, segmented_wholes, ingest_counts, normalize_ws, deep_clean, html_text,
        html_readable, doc_start, segment_filing, segment_fallback, consolidated_doc, merged_doc, formatted_doc,
        html_doc,
    )
    return {function.__name__: function for function in names}


_FILED = "(TIMESTAMP '2023-06-01' + to_hours(CAST(doc_id % 50000 AS INTEGER)))"
FILED_UTC = f"({_FILED} + INTERVAL 5 HOUR)"
_RAW_FILED = f"concat(strftime({_FILED}, '%Y-%m-%dT%H:%M:%S'), '-05:00')"
_URL = f"coalesce(nullif({bd.DETAILS_LINK}, ''), nullif({bd.HTML_LINK}, ''))"
_FAMILY = "CASE doc_id % 6 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' WHEN 2 THEN '8-K' WHEN 3 THEN '10-K' WHEN 4 THEN '10-Q' END"
_SUFFIX = "CASE doc_id % 6 WHEN 3 THEN '_A' WHEN 4 THEN '_NT' ELSE '' END"
_ISO_UTC = f"strftime({FILED_UTC}, '%Y-%m-%dT%H:%M:%SZ')"
_SIC = (
    "CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 96 = doc_id % 97 THEN concat('A', doc_id % 13) "
    "ELSE concat('B', doc_id % 13) END"
)
_ITEMS = (
    "CASE doc_id % 4 WHEN 0 THEN ['Item 1.01', 'Item 9.01'] WHEN 1 THEN [' Item 8.01 '] "
    "WHEN 2 THEN ['Item 2.02', 'Item 7.01', 'Item 2.02', 'Item 5.02 Departure'] ELSE CAST([] AS VARCHAR[]) END"
)
_PERIOD = "CASE WHEN {0} % 11 > 0 THEN strftime(DATE '2023-12-31' - CAST({0} % 8 * 91 AS INTEGER), '%Y-%m-%d') END"


def _section_values() -> str:
    rows = []
    for family, pairs in (("10-K", fixed.TEN_K_SECTIONS), ("10-Q", fixed.TEN_Q_SECTIONS), ("8-K", fixed.EIGHT_K_SECTIONS)):
        for place, (code, name) in enumerate(pairs):
            rows.append(f"('{family}', {place}, '{code}', '{name}')")
    return f"map(family, place, code, section_id) AS (VALUES {', '.join(rows)})"


_WANTED = f"""{_section_values()},
f AS (SELECT *, {_FAMILY} AS family, {bd.ACCESSION} AS accession_number, {_ITEMS} AS items FROM documents WHERE {_URL} IS NOT NULL),
wanted AS (
  SELECT f.*, CASE WHEN f.family = '8-K' THEN replace(code, '.', '-') ELSE code END AS section_code, section_id, place
  FROM f JOIN map ON f.family = map.family
  WHERE f.family <> '8-K' OR list_contains(list_transform(items, lambda x: trim(replace(x, 'Item ', ''))), code))"""

_KEPT_TEXT = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


_SECTION_TEXT = _KEPT_TEXT.format(
    "array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: (i - 1) % CASE family WHEN '10-K' THEN 8 ELSE 6 END = place), chr(10))"
)


def records_sql(columns: str) -> str:
    """Section records with the given columns."""
    return f"WITH {_WANTED} SELECT {columns} FROM wanted WHERE length({_SECTION_TEXT}) > 50"


def _segment_sql() -> str:
    line = "regexp_replace(line, '^[\\s.:\\-–—]+', '')"
    return f"""WITH d AS (SELECT doc_id, {_FAMILY} AS family, {bd.FORM} AS form, string_split(text, chr(10)) AS lines FROM documents),
e AS (
  SELECT doc_id, family, lines, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM d),
h AS (
  SELECT doc_id, family, len(lines) AS n, i, line,
    CASE WHEN family = '8-K' THEN concat('Item ', i % 8 + 1, '.0', i % 2 + 1, ' ', line) ELSE concat('ITEM ', i % 30 + 2, '. ', line) END AS headed,
    CASE WHEN family = '8-K' THEN concat('Item_', i % 8 + 1, '.0', i % 2 + 1) ELSE concat('Item_', i % 30 + 2) END AS section,
    {_KEPT_TEXT.format(f"CASE WHEN family = '8-K' THEN {line} ELSE line END")} AS cleaned
  FROM e),
s AS (
  SELECT doc_id, section, min(i) AS first_i, string_agg(cleaned, concat(chr(10), chr(10), '[SECTION CONTINUED]', chr(10), chr(10)) ORDER BY i) AS text
  FROM h WHERE n >= CASE family WHEN '10-K' THEN 4 WHEN '10-Q' THEN 3 WHEN '8-K' THEN 1 END AND length(cleaned) > 50
  GROUP BY doc_id, section),
w AS (
  SELECT doc_id, 'Full_Document_Text' AS section, {_KEPT_TEXT.format("string_agg(headed, ' ' ORDER BY i)")} AS text
  FROM h WHERE coalesce(n < CASE family WHEN '10-K' THEN 4 WHEN '10-Q' THEN 3 WHEN '8-K' THEN 1 END, TRUE) GROUP BY doc_id),
a AS (
  SELECT doc_id, {_KEPT_TEXT.format("string_agg(headed, ' ' ORDER BY i)")} AS text FROM h GROUP BY doc_id)"""


_SECTION = "CASE turn WHEN 0 THEN 'Item_1_Business' WHEN 1 THEN 'P2_Item_1A_Risk_Factors' WHEN 2 THEN 'Other_Part' WHEN 3 THEN 'P1_Item_2_MDandA' ELSE 'Item_8_01_Other_Events' END"
_R = f"""r AS (
  SELECT lpad(CAST(conv_id AS VARCHAR), 12, '0') AS accession, TIMESTAMP '2023-06-01' + to_hours(CAST(conv_id % 50000 AS INTEGER)) AS ts,
    strftime(TIMESTAMP '2023-06-01' + to_hours(CAST(conv_id % 50000 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS filed,
    {_PERIOD.format('conv_id')} AS period, lpad(CAST(conv_id % 97 AS VARCHAR), 10, '0') AS cik, concat('T', conv_id % 7) AS ticker,
    concat('Company ', conv_id % 7) AS company, CASE conv_id % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' ELSE '8-K' END AS form,
    {_SECTION} AS section_id,
    CASE turn WHEN 0 THEN 0 WHEN 1 THEN 13 WHEN 2 THEN 9999 WHEN 3 THEN 9 ELSE 19 END AS section_rank,
    CASE turn WHEN 0 THEN 'Item 1 Business' WHEN 1 THEN 'Part II, Item 1A Risk Factors' WHEN 2 THEN 'Other Part'
      WHEN 3 THEN 'Part I, Item 2 MDandA' ELSE 'Item 8 01 Other Events' END AS title,
    text, conv_id * 1000 + turn AS ordinal
  FROM conversations)"""
_NL = "chr(10)"
_RULE = "repeat('=', 80)"
_THIN = "repeat('-', 80)"

_CONSOLIDATED_SQL = f"""WITH {_R},
heads AS (
  SELECT DISTINCT ticker, filed, accession, concat({_NL}, {_RULE}, {_NL}, '## Filing: ', form, {_NL}, {_NL},
    '- **Date Filed:** ', strftime(ts, '%B %d, %Y'), ' (UTC: ', filed, ')', {_NL},
    CASE WHEN period IS NOT NULL THEN concat('- **Period End:** ', period, {_NL}) ELSE '' END,
    CASE WHEN form = '8-K' THEN concat('- **Items Reported (8-K):** [''Item 1.01'', ''Item 8.01'']', {_NL}) ELSE '' END,
    '- **Accession:** ', accession, {_NL}, '- **CIK:** ', cik, {_NL}, {_NL}, {_RULE}, {_NL}, {_NL}) AS block FROM r)
SELECT ticker, 0 AS is_body, '' AS filed, '' AS accession, 0 AS kind, -1 AS section_rank, CAST(-1 AS BIGINT) AS ordinal,
  concat('# ', ticker, ' Consolidated SEC Filings', {_NL}, {_NL}) AS block FROM (SELECT DISTINCT ticker FROM r)
UNION ALL SELECT ticker, 1, filed, accession, 1, -1, -1, block FROM heads
UNION ALL SELECT ticker, 1, filed, accession, 2, section_rank, ordinal,
  concat({_THIN}, {_NL}, '### ', title, {_NL}, {_THIN}, {_NL}, {_NL}, text, {_NL}, {_NL}, {_NL}) FROM r"""

_MERGED_SQL = f"""WITH {_R} SELECT ticker, ordinal, concat({_NL}, {_NL}, '--- FILING: ', ticker, ' | FORM: ', form, ' | PERIOD: ',
  coalesce(period, 'N/A'), ' | SECTION: ', section_id, ' ---', {_NL}, {_NL}, text) AS block FROM r"""

_ASSEMBLED = f"""{_R},
g AS (
  SELECT ticker, accession, min(ordinal) AS first_ordinal, arg_min(company, ordinal) AS company, arg_min(form, ordinal) AS form,
    max(period) AS period, CAST(coalesce(-date_diff('day', DATE '1970-01-01', CAST(max(period) AS DATE)), 2147483647) AS INTEGER) AS period_place
  FROM r GROUP BY ticker, accession),
o AS (SELECT *, lag(accession) OVER (PARTITION BY ticker ORDER BY period_place, first_ordinal, accession) AS prev FROM g)"""
_PLACED = "r.ticker, 1 AS part, period_place, first_ordinal, r.accession AS accession_number, 2 AS kind, ordinal"

_FORMATTED_SQL = f"""WITH {_ASSEMBLED}
SELECT ticker, 1 AS part, period_place, first_ordinal, accession AS accession_number, 1 AS kind, CAST(-1 AS BIGINT) AS ordinal,
  concat({_RULE}, {_NL}, 'COMPANY: ', company, ' (', ticker, ')', {_NL}, 'FORM TYPE: ', form, {_NL}, 'PERIOD END DATE: ', coalesce(period, 'None'),
    {_NL}, {_RULE}, {_NL}, {_NL}) AS block FROM o
UNION ALL SELECT {_PLACED}, concat('Section: ', section_id, {_NL}, {_NL}, {_KEPT_TEXT.format('text')}, {_NL}, {_NL}, 'cell | two', {_NL}, {_NL})
FROM r JOIN o ON r.ticker = o.ticker AND r.accession = o.accession"""


def _page_sql(inline: str, between: str) -> str:
    """Text between tags outside the head; ``inline`` tags do not part a text."""
    cut = "regexp_replace(html, '(?is)<head>.*?</head>|<script>.*?</script>|<!--.*?-->', chr(1), 'g')"
    if inline:
        cut = f"regexp_replace({cut}, '(?i)</?({inline})( [^>]*)?>', '', 'g')"
    text = f"regexp_replace({cut}, '<[^>]*>', chr(1), 'g')"
    for entity, sign in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')):
        text = f"replace({text}, '{entity}', '{sign}')"
    text = f"regexp_replace({text}, '&amp;?', '&', 'g')"
    pieces = f"list_filter(list_transform(string_split({text}, chr(1)), lambda x: {_KEPT_TEXT.format('x')}), lambda x: x <> '')"
    return f"SELECT page_id, array_to_string({pieces}, {between}) AS text FROM pages"


def _html_sql() -> str:
    head = "<html><head><style>h1 { color: navy }</style></head><body>"
    ends = f"""SELECT ticker, {{part}} AS part, 0 AS period_place, CAST(-1 AS BIGINT) AS first_ordinal, '' AS accession_number,
  {{kind}} AS kind, CAST(-1 AS BIGINT) AS ordinal, '{{block}}' AS block FROM (SELECT DISTINCT ticker FROM r)"""
    return f"""WITH {_ASSEMBLED}
{ends.format(part=0, kind=0, block=head)} UNION ALL {ends.format(part=2, kind=3, block='</body></html>')}
UNION ALL SELECT ticker, 1, period_place, first_ordinal, accession, 0, -1, '<div class="filing-divider"></div>' FROM o WHERE prev IS NOT NULL
UNION ALL SELECT ticker, 1, period_place, first_ordinal, accession, 1, -1,
  concat('<h2>COMPANY: ', company, ' (', ticker, ')</h2><h3>FORM TYPE: ', form,
    ' | PERIOD END DATE: ', coalesce(period, 'None'), '</h3><p><b>Accession Number:</b> ', accession, '</p><hr>') FROM o
UNION ALL SELECT {_PLACED}, concat('<h1>Section: ', section_id, '</h1>', {_NL}, text, {_NL})
FROM r JOIN o ON r.ticker = o.ticker AND r.accession = o.accession"""


CANDIDATES = f"""c AS (SELECT doc_id, source AS ticker, {bd.FORM} AS form_type, {_FAMILY} AS base_form, {_SUFFIX} AS suffix,
  strftime({_FILED}, '%Y-%m-%d') AS filing_date, {_RAW_FILED} AS filing_timestamp, {bd.TXT_LINK} AS download_url FROM documents
  WHERE {_FAMILY} IS NOT NULL AND {bd.TXT_LINK} <> '')"""
TARGET_PATH = "concat(ticker, '_', base_form, '/', ticker, '_', base_form, suffix, '_', filing_date, '.txt') AS target_path"


def oracle_sql() -> dict[str, str]:
    ws = "regexp_replace(replace(replace(text, ' ', concat('  ', chr(9))), chr(10), concat(chr(10), ' ', chr(10), chr(9), chr(10))), '[ \\t]+', ' ', 'g')"
    return {
        "filing_flags": f"""SELECT {bd.ACCESSION} AS accession, {_FAMILY} AS family, doc_id % 6 = 3 AS is_amendment, {_SUFFIX} AS suffix,
  strftime({_FILED}, '%Y-%m-%d') AS filing_date, {_URL} AS source_url FROM documents""",
        "filings_in_scope": f"""SELECT {bd.ACCESSION} AS accession, {bd.FORM} AS formType FROM documents WHERE doc_id % 6 IN (0, 1, 2, 3)
  AND CAST({FILED_UTC} AS DATE) BETWEEN DATE '2023-07-01' AND DATE '2033-07-01'""",
        "filed_at_utc": f"SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN strftime({_FILED}, '%Y-%m-%dT%H:%M:%SZ') ELSE {_ISO_UTC} END AS filed_at_utc FROM documents",
        "sic_lookup": f"SELECT doc_id, {_SIC} AS sic_code FROM documents",
        "base_records": f"""SELECT {bd.ACCESSION} AS accession_number, {_ISO_UTC} AS filing_timestamp_utc, {_PERIOD.format('doc_id')} AS period_end_date,
  {bd.CIK} AS cik, source AS ticker, concat('Company ', source) AS company_name, upper({bd.FORM}) AS form_type, doc_id % 6 = 3 AS is_amendment,
  {_SIC} AS sic_code, array_to_string({_ITEMS}, '|') AS items_reported, {_URL} AS source_url, 'local_segmenter_v1' AS extraction_method,
  '2024-01-31T00:00:00Z' AS processing_timestamp_utc FROM documents WHERE {_URL} IS NOT NULL""",
        "filing_sections": f"WITH {_WANTED} SELECT accession_number, section_code, section_id FROM wanted",
        "dedupe_filings": f"""SELECT {bd.ACCESSION} AS accessionNo, source AS ticker, concat('Company ', source) AS companyName, {_RAW_FILED} AS filedAt FROM documents
UNION ALL SELECT {bd.ACCESSION}, 'OTHER', 'other', {_RAW_FILED} FROM documents""",
        "attached_targets": f"""SELECT {bd.ACCESSION} AS accessionNo, concat('S', s_suppkey) AS ticker, {bd.CIK} AS cik
FROM documents JOIN supplier ON doc_id % 97 = s_suppkey""",
        "missing_filings": f"""WITH {CANDIDATES}, stored AS (SELECT DISTINCT ticker, base_form, suffix, filing_date FROM c WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT ticker, form_type, base_form, suffix, filing_date, filing_timestamp, download_url,
  {TARGET_PATH}
FROM c WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.ticker = c.ticker AND s.base_form = c.base_form AND s.suffix = c.suffix AND s.filing_date = c.filing_date)""",
        "section_records": records_sql(
            f"accession_number, source AS ticker, upper({bd.FORM}) AS form_type, section_id, {_SECTION_TEXT} AS text, "
            f"{_ISO_UTC} AS filing_timestamp_utc, {_SIC} AS sic_code"
        ),
        "segmented_records": f"{_segment_sql()}, {_WANTED} SELECT accession_number, section_id, s.text FROM wanted w JOIN s ON s.doc_id = w.doc_id "
        "AND s.section = concat('Item_', replace(w.section_code, '-', '.')) WHERE w.family <> '10-Q'"
        + f""" UNION ALL SELECT accession_number, section_id, string_agg(cleaned, concat(chr(10), chr(10), '[SECTION CONTINUED]', chr(10), chr(10)) ORDER BY i) AS text
FROM (SELECT doc_id, i, {_KEPT_TEXT.format("line")} AS cleaned, unnest([concat('part1item', i % 4 + 1), CASE i % 2 WHEN 0 THEN 'part2item1' ELSE 'part2item1a' END]) AS code
  FROM h WHERE family = '10-Q') q JOIN wanted w ON w.doc_id = q.doc_id AND w.section_code = q.code
WHERE length(cleaned) > 50 GROUP BY accession_number, section_id""",
        "segmented_wholes": f"""{_segment_sql()}, {_WANTED},
u AS (SELECT doc_id, {_KEPT_TEXT.format("concat('PART I ', string_agg(concat('Note. ', line), ' ' ORDER BY i), ' PART II ', string_agg(concat('Note. ', line), ' ' ORDER BY i))")} AS whole_text,
  {_KEPT_TEXT.format("concat('PART II ', string_agg(concat('Note. ', line), ' ' ORDER BY i))")} AS second FROM h GROUP BY doc_id)
SELECT accession_number, section_id, s.text FROM wanted w JOIN s ON s.doc_id = w.doc_id
  AND s.section = concat('Item_', replace(w.section_code, '-', '.')) WHERE w.family <> '10-Q'
UNION ALL SELECT accession_number, section_id, string_agg(cleaned, concat(chr(10), chr(10), '[SECTION CONTINUED]', chr(10), chr(10)) ORDER BY i) AS text
FROM (SELECT doc_id, i, {_KEPT_TEXT.format("line")} AS cleaned, unnest([concat('part1item', i % 4 + 1), CASE i % 2 WHEN 0 THEN 'part2item1' ELSE 'part2item1a' END]) AS code
  FROM h WHERE family = '10-Q') q JOIN wanted w ON w.doc_id = q.doc_id AND w.section_code = q.code
WHERE length(cleaned) > 50 AND q.doc_id % 12 <> 1 AND (q.doc_id % 12 <> 7 OR code LIKE 'part1%') GROUP BY accession_number, section_id
UNION ALL SELECT accession_number, section, w.text FROM w JOIN f USING (doc_id) WHERE coalesce(family, '') <> '10-Q'
UNION ALL SELECT accession_number, 'Full_Document_Text', whole_text FROM u JOIN f USING (doc_id) WHERE doc_id % 12 = 1
UNION ALL SELECT accession_number, 'P2_Full_Document_Text', second FROM u JOIN f USING (doc_id) WHERE doc_id % 12 = 7""",
        "ingest_counts": f"""SELECT CASE WHEN doc_id % 7 > 0 THEN strftime({FILED_UTC}, '%Y') ELSE 'none' END AS year, CAST(count(*) AS BIGINT) AS n
FROM documents WHERE {_URL} IS NOT NULL GROUP BY 1""",
        "normalize_ws": f"""SELECT doc_id, {_KEPT_TEXT.format(f"regexp_replace({ws}, '(\\n\\s*)(\\n\\s*)(\\n\\s*)+', concat(chr(10), chr(10)), 'g')")} AS text
FROM documents WHERE length({_KEPT_TEXT.format("replace(replace(text, ' ', concat('  ', chr(9))), chr(10), concat(chr(10), ' ', chr(10), chr(9), chr(10)))")}) > 50""",
        "deep_clean": f"""SELECT doc_id, {_KEPT_TEXT.format("concat(replace(replace(text, ' the ', ' & '), chr(10), ' '), ' End', chr(10), chr(10), replace(text, chr(10), ' '))")} AS text FROM documents""",
        "html_text": _page_sql("", "chr(10)"),
        "html_readable": f"SELECT page_id, concat('cell | two', chr(10), chr(10), text) AS text FROM ({_page_sql('a|b', 'concat(chr(10), chr(10))')})",
        "doc_start": f"""SELECT doc_id, CAST(CASE WHEN {_FAMILY} IN ('10-K', '10-Q') AND 8 + length(text) < 5000 THEN 8 + length(text) ELSE 0 END AS INTEGER) AS body_offset,
  CAST(15 + 2 * length(text) - CASE WHEN {_FAMILY} IN ('10-K', '10-Q') AND 8 + length(text) < 5000 THEN 8 + length(text) ELSE 0 END AS INTEGER) AS body_chars FROM documents""",
        "segment_filing": _segment_sql()
        + """ SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first_i) - 1 AS INTEGER) AS position, section, text FROM s
UNION ALL SELECT doc_id, 0, section, text FROM w""",
        "segment_fallback": _segment_sql() + " SELECT doc_id, 'Full_Document_Text' AS section, text FROM a",
        "consolidated_doc": _CONSOLIDATED_SQL,
        "merged_doc": _MERGED_SQL,
        "formatted_doc": _FORMATTED_SQL,
        "html_doc": _html_sql(),
    }
