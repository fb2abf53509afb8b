import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickframe.operators import history, refdata, targets
from tickframe.sources import landed
from tickframe.sources.catalogue import DATASETS, scan

AS_OF = dt.date(2024, 3, 15)


def dates(df, *names):
    return [tuple(str(row[n]) for n in names) for row in df.orderBy(*names).collect()]


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2024-01-15", "2024-03-10", [("2024-01-15", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-10")]),
        ("2024-01-05", "2024-01-20", [("2024-01-05", "2024-01-20")]),
        ("2024-01-31", "2024-02-29", [("2024-01-31", "2024-01-31"), ("2024-02-01", "2024-02-29")]),
        ("2024-02-29", "2024-02-29", [("2024-02-29", "2024-02-29")]),
        ("2024-02-02", "2024-02-01", []),
    ],
)
def test_month_chunks(spark, start, end, expected):
    jobs = spark.createDataFrame([(start, end)], "s string, e string").select(
        F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e")
    )
    assert dates(history.month_chunks(jobs, "s", "e"), "chunk_start", "chunk_end") == expected


def test_missing_months(spark):
    files = spark.createDataFrame(
        [("A", "tick", "2023-12-10"), ("A", "tick", "2024-02-01"), ("B", "day", "2030-01-01")],
        "ticker string, fidelity string, start string",
    )
    missing = history.missing_months(files, ["ticker", "fidelity"], "start", AS_OF)
    assert dates(missing, "ticker", "chunk_start", "chunk_end", "is_partial") == [
        ("A", "2024-01-01", "2024-01-31", "False"),
        ("A", "2024-03-01", "2024-03-15", "True"),
        ("B", "2024-03-15", "2024-03-15", "True"),
    ]
    expected = history.expected_months(files, ["ticker", "fidelity"], "start", AS_OF)
    present = expected.count() - missing.count()
    assert present == 2


def test_neighbours(spark):
    rows = [("A", i, size) for i, size in enumerate([80, 100, 80, 100])]
    rows += [("EDGE", 0, 79), ("EDGE", 1, 100), ("EDGE", 2, 79), ("ONE", 0, 1), ("ZERO", 0, 0), ("ZERO", 1, 0)]
    df = spark.createDataFrame(rows, "k string, i int, size bigint")
    got = history.neighbour_anomalies(df, ["k"], ["i"], "size").orderBy("k", "i").collect()
    assert [(r.k, r.i, r.neighbor_avg, r.percent_smaller) for r in got] == [("EDGE", 0, 100.0, 21.0), ("EDGE", 2, 100.0, 21.0)]
    loose = history.neighbour_anomalies(df, ["k"], ["i"], "size", 19.99)
    assert loose.filter("k = 'A'").count() == 2


def test_inventory_of_files(spark, tmp_path):
    folder = tmp_path / "hist" / "A_B" / "15-minute"
    folder.mkdir(parents=True)
    for name, size in (
        ("A_B_15-minute_2024-01-05_to_2024-01-31.parquet", 2048),
        ("A_B_15-minute_2024-02-01_to_2024-02-29.parquet", 1024),
        ("A_B_15-minute_DEBUG.csv", 10),
    ):
        (folder / name).write_bytes(b"x" * size)
    inventory = landed.history_inventory(spark, str(tmp_path / "hist"))
    got = dates(inventory, "ticker", "fidelity", "start_date", "end_date", "extension", "size")
    assert got == [
        ("A_B", "15 minute", "2024-01-05", "2024-01-31", "parquet", "2048"),
        ("A_B", "15 minute", "2024-02-01", "2024-02-29", "parquet", "1024"),
    ]
    report = history.anomaly_report(inventory).first()
    assert (report.file_size_kb, report.neighbor_avg_size_kb, report.percent_smaller) == (1.0, 2.0, 50.0)
    assert report.reason == "File is 50.0% smaller than its neighbors."
    assert landed.tick_universe(inventory).count() == 0
    assert [r.ticker for r in landed.history_universe(inventory).collect()] == ["A_B"]


def test_targets(spark):
    rows = [
        ("A", "tick", "12"),
        (None, "tick", "12"),
        ("B", "", "12"),
        ("C", "tick", None),
        ("D", "tick", "0"),
        ("E", "tick", "soon"),
        ("F", "tick", "NaN"),
        ("G", "5-day", "3"),
        ("H", "day", "1.5"),
    ]
    df = spark.createDataFrame(rows, "ticker string, ticker_fidelity string, ticker_duration_months string")
    jobs, rejected = targets.history_jobs(df, AS_OF)
    assert {r.ticker: r.reject_reason for r in rejected.collect()} == {
        None: "missing ticker",
        "B": "missing fidelity",
        "C": "missing duration",
        "D": "missing duration",
        "E": "invalid duration",
        "F": "invalid duration",
        "G": "unreadable fidelity",
    }
    assert dates(jobs.filter("ticker = 'H'"), "chunk_start", "chunk_end") == [("2024-02-15", "2024-02-29"), ("2024-03-01", "2024-03-15")]
    assert targets.valid_targets(df).count() + targets.rejected_targets(df).count() == len(rows)


def test_fan_out_and_range_scan(spark):
    jobs = spark.createDataFrame([("A", "2024-01-01", "2024-01-31")], "ticker string, start_date string, end_date string")
    assert targets.fan_out(jobs, ["x", "y"]).count() == 2
    data = spark.createDataFrame(
        [("A", "2023-12-31"), ("A", "2024-01-01"), ("A", "2024-01-31"), ("A", "2024-02-01"), ("B", "2024-01-05")],
        "ticker string, date string",
    )
    assert dates(targets.range_scan(data, jobs, "date"), "date") == [("2024-01-01",), ("2024-01-31",)]


def test_catalogue_scan_is_half_open_and_pushed(spark, tmp_path):
    day = 86_400 * 10**9
    path = str(tmp_path / "t")
    spark.createDataFrame([("A", 0), ("A", day - 1), ("A", day), ("B", 0)], "ticker string, sip_timestamp bigint").write.parquet(path)
    found = scan(spark.read.parquet(path), DATASETS["trades"], "A", dt.date(1970, 1, 1), dt.date(1970, 1, 1))
    assert found.count() == 2
    plan = found._jdf.queryExecution().toString()
    assert "LessThan(sip_timestamp,86400000000000)" in plan and "EqualTo(ticker,A)" in plan
    assert len(DATASETS) == 29


def test_overviews_and_related(spark):
    df = spark.createDataFrame(
        [("A", ("1 Main", None, "", "9"), "logo"), ("B", None, "logo")],
        "ticker string, address struct<address1:string,city:string,state:string,postal_code:string>, branding string",
    )
    assert [tuple(r) for r in refdata.clean_overview(df).orderBy("ticker").collect()] == [("A", "1 Main, 9"), ("B", None)]
    plain = spark.createDataFrame([("A", "street")], "ticker string, address string")
    assert refdata.clean_overview(plain).first().address == "street"
    answers = spark.createDataFrame([("A", [("B",), (None,), ("C",)]), ("D", [])], "ticker string, results array<struct<ticker:string>>")
    assert sorted(tuple(r) for r in refdata.related_edges(answers).collect()) == [("A", "B"), ("A", "C")]
    tickers = spark.createDataFrame([("A",), ("Z",)], "ticker string")
    assert [r.ticker for r in refdata.per_ticker(tickers, df, refdata.clean_overview).collect()] == ["A"]


def test_cik_resolution(spark):
    tickers = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "ticker string")
    primary = spark.createDataFrame([("a", "", 1), ("a", "11", 2), ("a", "12", 3), ("c", None, 1)], "ticker string, cik string, o int")
    fallback = spark.createDataFrame([("A", 9, 1), ("B", 22, 2), ("B", 23, 3), ("C", 33, 1)], "ticker string, cik_str bigint, o int")
    got = refdata.resolve_cik(tickers, primary, fallback, "o", "o")
    assert dict(got.collect()) == {"a": "11", "b": "0000000022", "c": "0000000033", "d": "NOT_FOUND"}
    good, bad = refdata.usable_targets(got)
    assert (good.count(), bad.count()) == (3, 1)


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("C", 2), (None, 2)], "ticker string, snap int")
    newest = refdata.latest_snapshot(df, "snap")
    assert sorted(r.ticker for r in refdata.unique_tickers(newest).collect()) == ["B", "C"]
    assert refdata.latest_snapshot(df.limit(0), "snap").count() == 0


def test_range_scan_gives_a_row_once(spark):
    jobs = spark.createDataFrame(
        [("A", "2024-01-01", "2024-01-31"), ("A", "2024-01-01", "2024-01-31"), ("A", "2024-01-20", "2024-02-02"), ("A", "2024-03-01", "2024-03-02")],
        "ticker string, start_date string, end_date string",
    )
    data = spark.createDataFrame([("A", "2024-01-25"), ("A", "2024-02-02"), ("A", "2024-02-10"), ("A", "2024-03-01")], "ticker string, date string")
    got = sorted((r.date, r.start_date, r.end_date) for r in targets.range_scan(data, jobs, "date").collect())
    assert got == [
        ("2024-01-25", "2024-01-01", "2024-02-02"), ("2024-02-02", "2024-01-01", "2024-02-02"), ("2024-03-01", "2024-03-01", "2024-03-02"),
    ]
