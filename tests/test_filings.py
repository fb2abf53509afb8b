import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickframe import fixed
from tickframe.functions import text as tx
from tickframe.functions.html import html_to_blocks, html_to_text
from tickframe.operators import consolidate, filings, segment
from tickframe.plans import filings as plans

LONG = "x" * 60


def test_normalize_whitespace(values):
    rows = [("  a \t\t b\r\n",), ("a\n \n\t\n\nb",), ("a\n\nb",), ("a\n\n \n",), ("",), (None,)]
    assert values(rows, "t string", tx.normalize_whitespace(F.col("t"))) == ["a b", "a\n\nb", "a\n\nb", "a", "", None]


def test_length_limit_is_strict(values):
    rows = [("x" * 50,), ("x" * 51,), (" " + "x" * 50 + "\n",)]
    assert values(rows, "t string", tx.long_enough(F.col("t"), fixed.MIN_SECTION_CHARS)) == [False, True, False]


@pytest.mark.parametrize(
    "raw, clean",
    [
        (None, ""),
        ("", ""),
        ("AT&amp;T &#8211; café ﬁne", "AT&T – café fine"),
        ("see d123_ex-10.htm now", "see now"),
        ("see form.HTML and a_b.xml.", "see and ."),
        ("TABLE OF CONTENTS\nreal text", "real text"),
        ("Risk ........ 12\nkeep this\nItem ..... F-3\nend", "keep this\n\nend"),
        ("before F-12 after F - 3 done", "before after done"),
        ("page - 12 - next -3- end", "page next end"),
        ("first\n 17 \nsecond", "first\n\nsecond"),
        ("one\ntwo\n\n\n \nthree\nfour", "one two\n\nthree four"),
        ("tabs\t\tand   blanks", "tabs and blanks"),
        (" nbsp ends ", "nbsp ends"),
        ("plain ascii", "plain ascii"),
    ],
)
def test_deep_clean(values, raw, clean):
    assert values([(raw,)], "t string", tx.deep_clean(F.col("t"))) == [clean]


def test_html_to_text(values):
    page = (
        "<html><head><title>no</title></head><body><style>p{}</style><p>Item&nbsp;<b>1</b>. Business"
        "<p>Second<div style='DISPLAY: none'>hidden <div>deep</div> still</div><ix:nonNumeric>Kept <i>text</i></ix:nonNumeric>"
        "<table><tr><td>cell<table><tr><td>inner</td></tr></table></td></tr></table><xbrli:context>ctx</xbrli:context>"
        "<script>var t='</p>';</script><!-- note -->A &lt; B<br>after</body></html>"
    )
    want = "Item\n1\n. Business\nSecond\nKept\ntext\nA < B\nafter"
    assert values([(page,), (None,), ("no tags",)], "h string", html_to_text(F.col("h"))) == [want, "", "no tags"]


def test_html_to_blocks_emits_each_text_once(values):
    page = "<div>Intro <b>bold</b> text<p>Para</p>tail</div><table><tr><th>A</th><th>B</th></tr><tr><td>1<td>2</table>"
    want = "Intro bold text\n\nPara\n\ntail\n\nA | B\n\n1 | 2"
    assert values([(page,), ("plain\ntext",)], "h string", html_to_blocks(F.col("h"))) == [want, "plain\ntext"]


def body(spark, text, form):
    df = spark.createDataFrame([(text, form)], "text string, form string")
    return segment.with_body(df, "text", "form").first().body


def test_body_start(spark):
    near = "PART I\ncontents\n  PART I\nbody"
    assert body(spark, near, "10-K") == "  PART I\nbody"
    assert body(spark, near, "8-K") == near
    assert body(spark, near, None) == near
    far = "x\nItem 1\n" + "y" * 5000 + "\nItem 1\nbody"
    assert body(spark, far, "10-Q/A") == far[2:]
    edge = "Item 1\n" + "y" * 4991 + "\nItem 1\nbody"
    assert body(spark, edge, "10-K") == "Item 1\nbody"
    assert body(spark, "intro\nPART II\nItem 1A\nItem 10", "10-K") == "intro\nPART II\nItem 1A\nItem 10"
    assert body(spark, "intro\npart i\nrest", "10-K") == "part i\nrest"


def sections(spark, text, form):
    df = spark.createDataFrame([(1, text, form)], "id int, text string, form_type string")
    return [(r.section, r.text) for r in segment.segment_filings(df).orderBy("position").collect()]


def test_segments_of_an_annual_report(spark):
    text = (
        f"cover\nITEM 1. Business {LONG}\n  Part I, Item 1a - Risk {LONG}\nITEM 2: short\nItem 3\n{LONG}\n"
        f"item 1A. More {LONG}\nSIGNATURES\nignored {LONG}"
    )
    assert sections(spark, text, "10-K/A") == [
        # The contents rule skips the first "Item 1" line, since the "Part I" line follows closely.
        ("Item_1A", f"- Risk {LONG}{fixed.CONTINUED}More {LONG}"),
        ("Item_3", LONG),
    ]


def test_headings_are_found_left_to_right(spark):
    # The first heading takes the blanks after it, so an indented heading right below is not at a line start.
    text = f"ITEM 1.\n   ITEM 2. {LONG}\nITEM 3. {LONG}\nITEM 4. {LONG}\nITEM 5. {LONG}"
    assert [name for name, _ in sections(spark, text, "10-K")] == ["Item_1", "Item_3", "Item_4", "Item_5"]
    text = f"see ITEM 7. inline {LONG}\nITEMS 1. no\nITEM 123. no\n{LONG}"
    assert [name for name, _ in sections(spark, text, "10-Q")] == ["Full_Document_Text"]


def test_section_length_limit(spark):
    text = "\n".join(f"ITEM {i}. " + "x" * n for i, n in enumerate((50, 51, 60, 70), 1))
    assert [name for name, _ in sections(spark, text, "10-K")] == ["Item_2", "Item_3", "Item_4"]


def test_too_few_headings_give_the_whole_text(spark):
    text = f"ITEM 1. a {LONG}\nITEM 2. b\n\nSIGNATURES\n\nsigned"
    assert sections(spark, text, "10-Q") == [("Full_Document_Text", f"ITEM 1. a {LONG} ITEM 2. b")]
    assert sections(spark, "some\ntext", "S-1") == [("Full_Document_Text", "some text")]
    assert sections(spark, "no paragraph\nSIGNATURES\nsigned", "S-1") == [("Full_Document_Text", "no paragraph SIGNATURES signed")]
    assert sections(spark, "", "S-1") == []
    assert sections(spark, None, "10-K") == []


def test_segments_of_a_current_report(spark):
    text = f"Item 1.01 Entry {LONG}\nITEM 8.01: Other {LONG}\n\nSIGNATURES\n\nend"
    assert sections(spark, text, "8-K") == [("Item_1.01", f"Entry {LONG}"), ("Item_8.01", f"Other {LONG}")]
    found = spark.createDataFrame([("a", "t", "8-K", "Item_1.01", "x"), ("a", "t", "10-K", "Item_1A", "y"), ("a", "t", "10-Q", "Item_1", "z")],
                                  "accession_number string, ticker string, form_type string, section string, text string")
    assert sorted(r.section_code for r in filings.texts_from_segments(found).collect()) == ["1-01", "1A"]


def test_quarterly_parts_keep_all_text(spark):
    """No heading at all, none in one part, none of Part II, another form: every text comes back."""
    rows = [
        (1, "10-Q", f"PART I\nno items {LONG}\nPART II\nnone here {LONG}\n\nSIGNATURES\n\nsigned"),
        (2, "10-Q", f"PART I\nITEM 1. own {LONG}\nPART II\nonly prose {LONG}"),
        (3, "10-Q", f"PART I\nprose first {LONG}\nPART II\nITEM 1A. risks {LONG}"),
        (4, "10-Q", f"ITEM 1. all {LONG}\nITEM 2. of it {LONG}\nITEM 3. here {LONG}"),
        (5, "S-1", f"PART I\nother {LONG}\nPART II\nform"),
        (6, "10-Q", None),
    ]
    df = spark.createDataFrame(rows, "id int, form_type string, text string")
    got = sorted((r.id, r.part or 0, r.section, r.text) for r in segment.segment_by_parts(df).collect())
    assert got == [
        (1, 0, "Full_Document_Text", f"PART I no items {LONG} PART II none here {LONG}"),
        (2, 1, "Item_1", f"own {LONG}"),
        (2, 2, "Full_Document_Text", f"PART II only prose {LONG}"),
        (3, 1, "Full_Document_Text", f"PART I prose first {LONG}"),
        (3, 2, "Item_1A", f"risks {LONG}"),
        (4, 1, "Item_1", f"all {LONG}"),
        (4, 1, "Item_2", f"of it {LONG}"),
        (4, 1, "Item_3", f"here {LONG}"),
        (5, 0, "Full_Document_Text", f"PART I other {LONG} PART II form"),
    ]


META = "accessionNo string, ticker string, filedAt string, name string"


def test_dedupe(spark):
    rows = [
        ("1", "A", "2024-01-01", "old"),
        ("1", "A", "2024-02-01", "new"),
        ("1", "A", None, "none"),
        ("1", "B", "2024-01-01", "other"),
        ("", "A", "2024-01-01", "blank"),
        (None, "A", "2024-01-01", "null"),
    ]
    once = filings.dedupe_filings(spark.createDataFrame(rows, META))
    assert sorted(tuple(r) for r in once.collect()) == [("1", "A", "2024-02-01", "new"), ("1", "B", "2024-01-01", "other")]
    assert sorted(filings.dedupe_filings(once).collect()) == sorted(once.collect())


def test_dedupe_combines_before_the_shuffle(spark):
    copies = spark.range(1000).select(F.lit("1").alias("accessionNo"), F.lit("A").alias("ticker"), F.col("id").cast("string").alias("filedAt"), F.lit("n").alias("name"))
    plan = filings.dedupe_filings(copies)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_scope(spark):
    rows = [("10-K", "2024-06-30T23:00:00-05:00"), ("10-K", "2024-06-30T10:00:00Z"), ("10-K", "2014-06-30T00:00:00Z"), ("10-K", "2014-06-29T23:59:59Z"), ("S-1", "2024-01-01T00:00:00Z"), ("10-K", "bad")]
    df = spark.createDataFrame(rows, "formType string, filedAt string")
    assert sorted(r.filedAt for r in filings.in_scope(df, dt.date(2024, 6, 30)).collect()) == ["2014-06-30T00:00:00Z", "2024-06-30T10:00:00Z"]


RECORD = (
    "ticker string, accession_number string, filing_timestamp_utc string, period_end_date string, items_reported array<string>, "
    "cik string, company_name string, form_type string, section_id string, text string, ordinal bigint"
)


def record(ticker, accession, filed, section, ordinal, text="body", period="2023-12-31", items=None, form="10-K"):
    return (ticker, accession, filed, period, items or [], "0000000001", "Co", form, section, text, ordinal)


def document(blocks, order):
    return "".join(r.block for r in blocks.orderBy(*order).collect())


def test_consolidated_document(spark):
    rows = [
        record("A", "2", "2024-03-01T00:00:00Z", "Item_2_Properties", 1),
        record("A", "2", "2024-03-01T00:00:00Z", "Item_1_Business", 2),
        record("A", "1", "2024-01-05T10:00:00Z", "Item_8_01_Other_Events", 3, items=["Item 8.01"], form="8-K", period=None),
        record("A", "3", None, "Odd_One", 4),
        record("A", "2", "2024-03-02T00:00:00Z", "Item_1_Business", 5, text="again"),
    ]
    blocks = consolidate.consolidated_blocks(spark.createDataFrame(rows, RECORD))
    rule, thin = "=" * 80, "-" * 80

    def header(form, lines):
        return f"\n{rule}\n## Filing: {form}\n\n" + "".join(f"- **{a}:** {b}\n" for a, b in lines) + f"\n{rule}\n\n"

    def part(title, text="body"):
        return f"{thin}\n### {title}\n{thin}\n\n{text}\n\n\n"

    tail = [("CIK", "0000000001")]
    want = (
        "# A Consolidated SEC Filings\n\n"
        + header("10-K", [("Period End", "2023-12-31"), ("Accession", "3"), *tail])
        + part("Odd One")
        + header("8-K", [("Date Filed", "January 05, 2024 (UTC: 2024-01-05T10:00:00Z)"), ("Items Reported (8-K)", "['Item 8.01']"), ("Accession", "1"), *tail])
        + part("Item 8 01 Other Events")
        + header("10-K", [("Date Filed", "March 01, 2024 (UTC: 2024-03-01T00:00:00Z)"), ("Period End", "2023-12-31"), ("Accession", "2"), *tail])
        + part("Item 1 Business")
        + part("Item 2 Properties")
        + part("Item 1 Business", "again")
    )
    assert document(blocks, consolidate.CONSOLIDATED_ORDER) == want


def test_merged_document(spark):
    rows = [record("A", "1", None, "S2", 2, "two"), record("A", "1", None, None, 1, "one", period=None)]
    got = document(consolidate.merged_blocks(spark.createDataFrame(rows, RECORD)), consolidate.MERGED_ORDER)
    assert got == (
        "\n\n--- FILING: A | FORM: 10-K | PERIOD: N/A | SECTION: N/A ---\n\none"
        "\n\n--- FILING: A | FORM: 10-K | PERIOD: 2023-12-31 | SECTION: S2 ---\n\ntwo"
    )


def test_formatted_and_html_documents(spark):
    rows = [
        record("A", "old", None, "S1", 1, "<p>one</p>", period="2022-12-31"),
        record("A", "new", None, "S2", 2, "<table><tr><td>a</td><td>b</td></tr></table>", period="2023-12-31"),
        record("A", "none", None, "S3", 3, "three", period=None),
        record("A", "", None, "S4", 4),
        record("A", "new", None, "S5", 5, "five", period="1999-01-01"),
    ]
    df = spark.createDataFrame(rows, RECORD)
    text = document(consolidate.formatted_blocks(df), consolidate.ASSEMBLED_ORDER)
    assert [line for line in text.splitlines() if line.startswith("PERIOD")] == [
        "PERIOD END DATE: 2023-12-31",
        "PERIOD END DATE: 2022-12-31",
        "PERIOD END DATE: None",
    ]
    assert "Section: S2\n\na | b\n\nSection: S5\n\nfive\n\n" in text and "S4" not in text
    page = document(consolidate.html_blocks(df), consolidate.ASSEMBLED_ORDER)
    assert page.startswith("<html><head>") and page.endswith("</body></html>")
    assert page.count("filing-divider\"") == 2
    assert page.index("<h2>") < page.index('<div class="filing-divider">')
    assert page.index("S2") < page.index("S5") < page.index("S1") < page.index("S3")


def test_texts_to_segment_are_dealt_and_cut_once(spark):
    """No union under the join by document, which Spark may take for dealt by that key, and none of two segmentations."""
    found = plans.segmented_records(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("ArrowEvalPython") == 1


def test_wholes_and_sections_share_one_segmentation(spark):
    found = plans.segmented_wholes(spark, "/root/testdata/sf0.001")
    assert "ArrowEvalPython" not in found._jdf.queryExecution().optimizedPlan().toString()
