import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickframe import schemas
from tickframe.functions import fidelity, filing, instants
from tickframe.functions.conform import conform, numeric_or

NS = 10**9


def ns(text: str) -> int:
    """Nanoseconds of UTC text, whose fraction may have nine digits."""
    head, _, fraction = text.partition(".")
    seconds = int((dt.datetime.fromisoformat(head) - dt.datetime(1970, 1, 1)).total_seconds())
    return seconds * NS + int(fraction.ljust(9, "0") or 0)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("tick", (1, "tick")),
        (" Day ", (1, "day")),
        ("15 minute", (15, "minute")),
        ("15-minute", (None, None)),
        ("5 foo", (5, "foo")),
        ("5 foo bar", (None, None)),
        ("week", (None, None)),
        ("", (None, None)),
        (None, (None, None)),
    ],
)
def test_historical_fidelity(values, text, expected):
    assert tuple(values([(text,)], "x string", fidelity.historical(F.col("x")))[0]) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("week", (1, "week")),
        ("5-day", (5, "day")),
        ("5-", (5, "")),
        ("5 day", (None, None)),
        ("1-2-3", (None, None)),
        ("tick", (None, None)),
        (None, (None, None)),
    ],
)
def test_technical_fidelity(values, text, expected):
    assert tuple(values([(text,)], "x string", fidelity.technical(F.col("x")))[0]) == expected


def test_history_file_name(values):
    name = fidelity.history_file_name(F.col("t"), F.col("f"), F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date"))
    assert values([("A", "15 minute"), ("A", "day"), ("A", "2 day")], "t string, f string", name) == [
        "A_15-minute_2024-01-01_to_2024-01-31.parquet",
        "A_day_2024-01-01_to_2024-01-31.csv",
        "A_2-day_2024-01-01_to_2024-01-31.csv",
    ]


def test_cik(values):
    raw = [(None,), ("NOT_FOUND",), ("320193.0",), ("0000320193",), ("0",), ("12345678901",)]
    got = [tuple(row) for row in values(raw, "x string", filing.normalize_cik(F.col("x")))]
    assert got == [
        ("NOT_FOUND", "NOT_FOUND", "NOT_FOUND", True),
        ("NOT_FOUND", "NOT_FOUND", "NOT_FOUND", True),
        ("320193", "320193", "0000320193", False),
        ("0000320193", "320193", "0000320193", False),
        ("0", "", "0000000000", False),
        ("12345678901", "12345678901", "12345678901", False),
    ]
    assert values([("0000320193",), ("x",)], "x string", filing.integer_cik(F.col("x"))) == ["320193", None]


def test_forms(values):
    forms = [("10-k/a",), ("NT 10-Q",), ("NT 10-K/A",), ("8-K",), ("S-1",), (None,)]
    assert values(forms, "x string", filing.form_family(F.col("x"))) == ["10-K", "10-Q", "10-K", "8-K", None, None]
    assert values(forms, "x string", filing.form_suffix(F.col("x"))) == ["", "_NT", "_NT", "", "", ""]
    assert values(forms, "x string", filing.is_amendment(F.col("x"))) == [True, False, True, False, False, False]


def test_iso_utc(values):
    rows = [("2024-01-05T16:05:00-05:00",), ("2024-01-05T16:05:00Z",), ("soon",), (None,)]
    assert values(rows, "x string", instants.iso_utc(F.col("x"))) == [
        "2024-01-05T21:05:00Z",
        "2024-01-05T16:05:00Z",
        None,
        None,
    ]
    rows = [("2024-01-05T16:05:00Z",), ("2024-01-05",), (None,)]
    assert values(rows, "x string", instants.date_part(F.col("x"))) == ["2024-01-05", "2024-01-05", "N/A"]


def test_sources_and_entities(values):
    rows = [("a", "b"), ("", "b"), (None, "b"), ("", ""), (None, None)]
    assert values(rows, "d string, h string", filing.source_url(F.col("d"), F.col("h"))) == ["a", "b", "b", None, None]
    rows = [([("7", "x"), ("42", "y"), ("0000000042", "z")],), ([],), ([("7", "x")],), (None,)]
    sic = filing.sic_for(F.col("e"), F.lit("0000000042"))
    assert values(rows, "e array<struct<cik:string,sic:string>>", sic) == ["y", None, None, None]


def test_applicable_sections(values):
    rows = [("8-K", ["Item 1.01", " Item 8.01 ", "Item 9.99", "Item 5.02 Departure", "Item 1.01"]), ("8-K", None), ("S-1", ["Item 1.01"])]
    schema = "f string, i array<string>"
    codes = F.transform(filing.applicable_sections(F.col("f"), F.col("i")), lambda s: s["code"])
    assert values(rows, schema, codes) == [["1-01", "8-01"], [], []]
    leading = F.transform(filing.applicable_sections(F.col("f"), F.col("i"), True), lambda s: s["code"])
    assert values(rows[:1], schema, leading) == [["1-01", "8-01", "5-02"]]
    sizes = F.size(filing.applicable_sections(F.col("f"), F.col("i")))
    assert values([("10-K/A", []), ("10-Q", [])], schema, sizes) == [8, 6]


def test_section_names(values):
    rows = [("Item_1A_Risk_Factors",), ("P1_Item_2_MDandA",), ("P2_Item_1A_Risk_Factors",), ("Odd",), (None,)]
    assert values(rows, "x string", filing.section_rank(F.col("x"))) == [1, 9, 13, 9999, 9999]
    assert values(rows, "x string", filing.section_title(F.col("x"))) == [
        "Item 1A Risk Factors",
        "Part I, Item 2 MDandA",
        "Part II, Item 1A Risk Factors",
        "Odd",
        "Unknown Section",
    ]


def test_address(values):
    rows = [(("1 Main", "Town", "", "99"),), ((None, None, None, None),), (None,)]
    schema = "a struct<address1:string,city:string,state:string,postal_code:string>"
    assert values(rows, schema, filing.address_line(F.col("a"))) == ["1 Main, Town, 99", "", None]


def test_trading_hours_and_daylight_saving(values):
    winter = [
        ("2024-03-08T14:29:59.999999999", False),
        ("2024-03-08T14:30:00", True),
        ("2024-03-08T21:00:00", True),
        ("2024-03-08T21:00:00.000000001", False),
        ("2024-03-08T21:00:00.000001", False),
    ]
    summer = [("2024-03-11T13:29:59.999999", False), ("2024-03-11T13:30:00", True), ("2024-03-11T20:00:00", True), ("2024-03-11T20:00:01", False)]
    rows = [(ns(text),) for text, _ in winter + summer]
    assert values(rows, "t bigint", instants.in_trading_hours(F.col("t"))) == [kept for _, kept in winter + summer]
    rows = [(ns("2024-03-08T04:59:59"),), (ns("2024-03-08T05:00:00"),), (ns("2024-03-11T04:00:00"),)]
    assert values(rows, "t bigint", instants.local_date(F.col("t"))) == [
        dt.date(2024, 3, 7),
        dt.date(2024, 3, 8),
        dt.date(2024, 3, 11),
    ]


def test_floor_before_epoch(values):
    assert values([(-1,), (0,), (-NS,)], "t bigint", instants.utc_date(F.col("t"))) == [
        dt.date(1969, 12, 31),
        dt.date(1970, 1, 1),
        dt.date(1969, 12, 31),
    ]


def test_window_start_clamps(values):
    start = instants.window_start(dt.date(2024, 3, 31), F.col("m"))
    assert values([(1,), (0,), (13,)], "m int", start) == [dt.date(2024, 2, 29), dt.date(2024, 3, 31), dt.date(2023, 2, 28)]


def test_standardize_timestamp(spark):
    def texts(df, rule="row"):
        out = instants.standardize_timestamp(df, "t", rule)
        return [r.s for r in out.select("i", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("s")).orderBy("i").collect()]

    numbers = spark.createDataFrame([(0, 1704067200000), (1, 5), (2, None)], "i int, t bigint")
    assert texts(numbers) == ["2024-01-01 00:00:00", None, None]
    assert texts(numbers, "column") == ["2024-01-01 00:00:00", "1970-01-01 00:00:00", None]
    assert texts(numbers.filter("i = 1"), "column") == [None]
    words = spark.createDataFrame([(0, "2024-01-02"), (1, "bad"), (2, None)], "i int, t string")
    assert texts(words) == ["2024-01-02 00:00:00", None, None]
    kept = words.select("i", F.to_timestamp(F.lit("2024-05-06 07:08:09")).alias("t"))
    assert texts(kept) == ["2024-05-06 07:08:09"] * 3


def test_conform(spark):
    df = spark.createDataFrame([("7", 1.5, "x")], "size string, price double, unknown string")
    out = conform(df, schemas.TRADES)
    assert out.schema.names == schemas.TRADES.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.TRADES]
    row = out.first()
    assert (row["size"], row["price"], row["id"]) == (7, 1.5, None)


def test_numeric_or(values):
    assert values([("1.005",), ("x",), (None,)], "x string", numeric_or(F.col("x"), 99, 2)) == [1.01, 99.0, 99.0]
    assert values([("2.345",), (None,)], "x string", numeric_or(F.col("x"), None, 1)) == [2.3, None]
