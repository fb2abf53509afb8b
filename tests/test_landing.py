import datetime as dt
import json

import duckdb
import oracle
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe import schemas, session
from tickframe.operators import consolidate
from tickframe.operators.segment import segment_filings  # noqa: F401
from tickframe.plans import landing
from tickframe.sinks import documents, tables
from tickframe.sources import landed
from tickframe.streaming import ingest

TRADE = {"sip_timestamp": 1_704_900_000_000_000_001, "id": "1", "price": 2.5, "size": 3}


def land(folder, name, *pages):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(page) if not isinstance(page, str) else page for page in pages))


def test_pages(spark, tmp_path):
    land(tmp_path / "p", "a.json", {"results": [TRADE, {"id": "2", "novel": 1}], "next_url": "x"}, {"results": []}, {"status": "OK"}, {"results": None})
    land(tmp_path / "p", "b.json", {"results": [{"id": "3", "conditions": [1, 2]}]}, "[]", "7")
    rows = landed.read_pages(spark, str(tmp_path / "p"), schemas.TRADES).orderBy("id").collect()
    assert [(r.id, r.price, r.conditions) for r in rows] == [("1", 2.5, None), ("2", None, None), ("3", None, [1, 2])]
    land(tmp_path / "v", "a.json", {"results": {"values": [{"timestamp": 1, "value": 2.0}]}}, {"results": {}})
    rows = landed.read_pages(spark, str(tmp_path / "v"), schemas.INDICATOR_VALUES, "results", "values").collect()
    assert [(r.timestamp, r.value, r.signal) for r in rows] == [(1, 2.0, None)]


def test_json_lines(spark, tmp_path):
    land(tmp_path / "j", "b.jsonl", {"a": "3"}, "{broken", {"other": 1}, "")
    land(tmp_path / "j", "a.jsonl", {"a": "1"}, {"a": "2"}, '["x"]')
    land(tmp_path / "j", "empty.jsonl", "")
    good, bad = landed.read_json_lines(spark, str(tmp_path / "j"), T.StructType([T.StructField("a", T.StringType())]))
    assert [r.a for r in good.orderBy("ordinal").collect()] == ["1", "2", "3", None]
    assert sorted((r.file_name, r.raw) for r in bad.collect()) == [("a.jsonl", '["x"]'), ("b.jsonl", "{broken")]


def test_targets_file(spark, tmp_path):
    assert landed.read_targets(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "c.csv").write_text("ticker,CIK\nA,0000320193\nB,\n")
    assert [tuple(r) for r in landed.read_cik_targets(spark, str(tmp_path / "c.csv")).collect()] == [("A", "0000320193"), ("B", None)]


def test_latest_file(spark, tmp_path):
    import os

    for i, name in enumerate(("new.csv", "old.csv")):
        (tmp_path / name).write_text(f"ticker\n{name}\n")
        os.utime(tmp_path / name, (1_700_000_000 - i * 100,) * 2)
    assert [r.ticker for r in landed.latest_file(spark, str(tmp_path / "*.csv")).collect()] == ["new.csv"]


def test_empty_input_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "t bigint, v string")
    assert tables.write_csv(empty, str(tmp_path / "c")) == 0
    assert tables.write_parquet(empty, str(tmp_path / "p")) == 0
    assert not (tmp_path / "c").exists() and not (tmp_path / "p").exists()
    assert tables.write_run(empty, str(tmp_path / "r"), dt.date(2024, 1, 1)) == -1


def test_parquet_standardises_the_timestamp(spark, tmp_path):
    df = spark.createDataFrame([(1_704_067_200_000, "a")], "t bigint, v string")
    assert tables.write_parquet(df, str(tmp_path / "p")) == 1
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.select(F.date_format("timestamp", "yyyy-MM-dd")).first()[0] == "2024-01-01" and "t" not in back.columns


def test_runs_are_never_overwritten(spark, tmp_path):
    df = spark.createDataFrame([("A",), ("A",), (None,)], "ticker string")
    root = str(tmp_path / "lists" / "asset_class=stocks")
    day = dt.date(2024, 1, 2)
    assert [tables.write_run(df, root, day) for _ in range(3)] == [0, 1, 2]
    assert tables.write_run(df, root, dt.date(2024, 1, 1)) == 0
    assert [r.ticker for r in landed.latest_ticker_list(spark, str(tmp_path / "lists"), "stocks").collect()] == ["A"]
    assert landed.latest_ticker_list(spark, str(tmp_path / "lists"), "fx").count() == 0


def test_replace_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("A", 1, 10), ("A", 2, 20), ("B", 1, 30)], "ticker string, month int, v int")
    tables.replace_partitions(df, path, ["ticker", "month"])
    tables.replace_partitions(spark.createDataFrame([("A", 1, 11)], "ticker string, month int, v int"), path, ["ticker", "month"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [11, 20, 30]


def test_documents_are_ordered_part_files(spark, tmp_path):
    rows = [("A", i, f"line {i}\n\n" if i % 2 else f"\nline {i}") for i in range(300)] + [("B", 0, "only")]
    blocks = spark.createDataFrame(rows, "ticker string, ordinal bigint, block string").repartition(7)
    documents.write_documents(blocks, consolidate.MERGED_ORDER, str(tmp_path / "d"), parts=5)
    parts = sorted((tmp_path / "d" / "ticker=A").glob("part-*"))
    assert len(parts) > 1
    text = "".join(p.read_text() for p in parts)
    assert [line for line in text.splitlines() if line] == [f"line {i}" for i in range(300)]


def stream_rows(spark, tmp_path, extra=""):
    return ingest.with_event_time(ingest.page_stream(spark, str(tmp_path / "pages"), extra=extra))


def test_stream_resumes_and_tolerates_odd_pages(spark, tmp_path):
    land(tmp_path / "pages", "1.json", {"results": [TRADE, {"id": "2", "sip_timestamp": 5, "novel": 1}]}, {"results": []}, {"status": "x"})
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    ingest.append_parquet(stream_rows(spark, tmp_path), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    land(tmp_path / "pages", "2.json", {"results": [TRADE]}, {"results": [{"id": "3", "sip_timestamp": 7}]})
    ingest.append_parquet(stream_rows(spark, tmp_path), out, state).awaitTermination()
    stored = spark.read.parquet(out)
    assert sorted(r.id for r in stored.collect()) == ["1", "1", "2", "3"]
    once = ingest.without_repeats(stored, ["id", "sip_timestamp"], ["timestamp"])
    assert sorted(r.id for r in once.collect()) == ["1", "2", "3"]
    batch = landed.read_pages(spark, str(tmp_path / "pages"), schemas.TRADES)
    assert sorted(r.id for r in batch.collect()) == sorted(r.id for r in stored.collect())


def test_stream_drops_repeats_within_the_delay(spark, tmp_path):
    land(tmp_path / "pages", "1.json", {"results": [TRADE, TRADE]}, {"results": [TRADE]})
    rows = ingest.drop_repeats(stream_rows(spark, tmp_path), ["id", "sip_timestamp"], "1 hour")
    ingest.append_parquet(rows, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_debug_sample_is_written_once(spark, tmp_path):
    land(tmp_path / "pages", "1.json", {"results": [{"id": str(i), "sip_timestamp": i} for i in range(10)]})
    rows = stream_rows(spark, tmp_path).select("id", "sip_timestamp")
    args = (["sip_timestamp"], str(tmp_path / "sample"), str(tmp_path / "state"), 4)
    ingest.save_debug_sample(rows, *args).awaitTermination()
    land(tmp_path / "pages", "2.json", {"results": [{"id": "z", "sip_timestamp": -1}]})
    ingest.save_debug_sample(stream_rows(spark, tmp_path).select("id", "sip_timestamp"), *args).awaitTermination()
    assert sorted(r.id for r in spark.read.option("header", True).csv(str(tmp_path / "sample")).collect()) == ["0", "1", "2", "3"]


def test_scratch_follows_the_session_setting(spark):
    assert session.new_scratch(spark, "x") != session.new_scratch(spark, "x")
    spark.conf.set("spark.checkpoint.dir", "/shared/folder/") if spark.conf.isModifiable("spark.checkpoint.dir") else None
    root = session.scratch_root(spark)
    assert root and not root.endswith("/")


def test_scratch(spark):
    path = session.new_scratch(spark, "once")
    spark.range(3).write.parquet(path)
    session.drop_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError, match="no scratch path"):
        session.drop_scratch(spark, "/elsewhere")


@pytest.mark.parametrize("name", ["api_pages", "tolerant_jsonl"])
def test_rows_survive_a_small_fixture(name):
    import __spark_entry__ as entry

    assert name in entry.queries()


def test_json_lines_keep_folder_columns(spark, tmp_path):
    land(tmp_path / "j" / "ticker=A" / "year=2024", "a.jsonl", {"accession_number": "1"}, {"accession_number": "2"})
    land(tmp_path / "j" / "ticker=B" / "year=2024", "b.jsonl", {"accession_number": "1"})
    kind = T.StructType([T.StructField("accession_number", T.StringType()), T.StructField("ticker", T.StringType())])
    good, _ = landed.read_json_lines(spark, str(tmp_path / "j"), kind)
    assert sorted((r.accession_number, r.ticker, r.year) for r in good.collect()) == [("1", "A", 2024), ("1", "B", 2024), ("2", "A", 2024)]


def test_newest_files_are_read_alone(spark, tmp_path):
    import os

    for i, text in enumerate(("name,ticker\nApple,A\n", "ticker,name\nA,Apple\n")):
        (tmp_path / f"{i}.csv").write_text(text)
        os.utime(tmp_path / f"{i}.csv", (1_700_000_000 + i,) * 2)
    assert [(r.ticker, r.name) for r in landed.latest_file(spark, str(tmp_path / "*.csv")).collect()] == [("A", "Apple")]
    day = dt.date(2024, 1, 2)
    tables.write_run(spark.createDataFrame([("Apple", "A")], "name string, ticker string"), str(tmp_path / "l/asset_class=stocks"), day)
    tables.write_run(spark.createDataFrame([("O", 1)], "ticker string, n int"), str(tmp_path / "l/asset_class=options"), day)
    assert [r.ticker for r in landed.latest_ticker_list(spark, str(tmp_path / "l"), "stocks").collect()] == ["A"]


def test_targets_by_name_with_further_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text("note,ticker_fidelity,ticker\nx,day,A\n")
    got = landed.read_targets(spark, str(tmp_path / "t.csv")).collect()
    assert [(r.ticker, r.ticker_fidelity, r.ticker_duration_months) for r in got] == [("A", "day", None)]


def test_answers_of_every_shape(spark, tmp_path):
    row = T.StructType([T.StructField("a", T.LongType())])
    land(tmp_path / "o" / "ticker=X", "1.json", {"results": {"a": 1, "b": 2}}, "{broken", {"status": "none"})
    rows, rejects = landed.read_answers(spark, str(tmp_path / "o"), row, "object")
    assert [(r.ticker, r.a) for r in rows.collect()] == [("X", 1)] and rejects.count() == 2
    land(tmp_path / "r", "1.json", '[{"a": 1}, {"a": 2}]', "nonsense")
    rows, rejects = landed.read_answers(spark, str(tmp_path / "r"), row, "root_array")
    assert sorted(r.a for r in rows.collect()) == [1, 2] and rejects.count() == 1
    land(tmp_path / "n", "1.json", {"results": {"values": [{"a": 5}, None]}})
    rows, rejects = landed.read_answers(spark, str(tmp_path / "n"), row, "array", ("results", "values"))
    assert [r.a for r in rows.collect()] == [5] and rejects.count() == 0


def test_a_job_whose_reload_is_empty_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("A", 1, 10), ("A", 2, 20), ("B", 1, 30)], "ticker string, month int, v int")
    tables.replace_partitions(df, path, ["ticker", "month"])
    again = spark.createDataFrame([("A", 1, 11)], "ticker string, month int, v int")
    tables.replace_job(again, df.filter("ticker = 'A'"), path, ["ticker", "month"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [11, 30]


def test_late_rows_are_kept_apart_across_restarts(spark, tmp_path):
    """Repeats within a batch, across batches and across a restart; late rows and rows without a time are marked."""
    second = 1_000_000_000
    row = lambda i, at: {"id": i, "sip_timestamp": None if at is None else at * second}
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        marked = ingest.marked_late(stream_rows(spark, tmp_path), ["id"], "10 seconds", groups=3)
        ingest.append_parquet(marked, out, state, ["late"]).awaitTermination()

    land(tmp_path / "pages", "1.json", {"results": [row("a", 100), row("a", 100), row("b", 95)]}, {"results": [row("c", 120), row("n", None)]})
    run()
    land(tmp_path / "pages", "2.json", {"results": [row("c", 120), row("d", 110), row("e", 109), row("b", 95), row("f", 300), row("f", 300)]})
    run()
    run()
    land(tmp_path / "pages", "3.json", {"results": [row("f", 300), row("g", 289), row("g", 290)]})
    run()
    stored = sorted((r.id, r.sip_timestamp and r.sip_timestamp // second, r.late) for r in spark.read.parquet(out).withColumn("late", F.col("late").cast("boolean")).collect())
    assert stored == [
        ("a", 100, False), ("b", 95, False), ("b", 95, True), ("c", 120, False), ("d", 110, False), ("e", 109, True),
        ("f", 300, False), ("g", 289, True), ("g", 290, False), ("n", None, True),
    ]


def test_keyed_answers_by_stream(spark, tmp_path):
    """The key is in the folder only; broken answers go to the error table; a batch that is run again replaces itself."""
    answers = tmp_path / "answers"
    land(answers / "ticker=A", "1.json", {"results": [TRADE]}, "{broken", {"status": "no rows"}, "")
    land(answers / "ticker=B", "1.json", {"results": [{"id": "2"}, None]})
    places = [str(tmp_path / name) for name in ("rows", "errors", "state")]
    logged = F.lit("2024-01-01 00:00:00").cast("timestamp")

    def run():
        ingest.ingest_answers(ingest.answer_stream(spark, str(answers), "ticker string"), schemas.TRADES, ["ticker"], *places, logged).awaitTermination()

    run()
    land(answers / "ticker=C", "9.json", "[1]", {"results": [{"id": "3"}]})
    run()
    run()
    rows = spark.read.parquet(places[0])
    assert sorted((r.ticker, r.id, r.batch) for r in rows.collect()) == [("A", "1", 0), ("B", "2", 0), ("C", "3", 1)]
    errors = sorted((r.ticker, r.reason, r.log_timestamp_utc) for r in spark.read.parquet(places[1]).collect())
    assert [e[:2] for e in errors] == [("A", 'unreadable answer: {"status": "no rows"}'), ("A", "unreadable answer: {broken"), ("C", "unreadable answer: [1]")]
    tables.write_batch(spark.createDataFrame([("C", "3")], "ticker string, id string"), places[0], 1)
    assert spark.read.parquet(places[0]).filter("batch = 1").count() == 1


def test_a_batch_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("A", 1, "x"), ("A", 1, "x"), ("B", 2, None)], "ticker string, v int, w string")
    assert tables.append_once(rows, path, "b1", ["ticker"]) == 3
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part-*")}
    assert tables.append_once(rows.repartition(3), path, "b1", ["ticker"]) == 0
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part-*")} == before
    assert tables.append_once(rows.limit(0), path, "none", ["ticker"]) == 0
    assert tables.append_once(rows.filter("v = 2"), path, "b2", ["ticker"]) == 1
    for other in (rows.filter("v = 1"), rows.withColumn("w", F.lit("y")), rows.distinct()):
        with pytest.raises(ValueError, match="other content"):
            tables.append_once(other, path, "b1", ["ticker"])
    with pytest.raises(ValueError, match="batch name"):
        tables.append_once(rows, path, "../x")
    stored = spark.read.json(path)
    assert sorted((r.batch, r.ticker, r.v) for r in stored.collect()) == [("b1", "A", 1), ("b1", "A", 1), ("b1", "B", 2), ("b2", "B", 2)]
    assert sorted(map(tuple, tables.published(spark, path).collect())) == [("b1", 3), ("b2", 1), ("none", 0)]


def test_a_run_that_stopped_before_its_entry_is_repeated(spark, tmp_path):
    """Left over: a half-written staging folder, and a published folder that the ledger doesn't have."""
    path = tmp_path / "t"
    rows = spark.createDataFrame([("A", 1)], "ticker string, v int")
    tables.append_once(rows, str(path), "b1", ["ticker"])
    (path / "_runs" / "b1").unlink()
    (path / "batch=b1" / "ticker=A" / "part-old.json").write_text('{"v": 9}\n')
    (path / "_staged" / "b1" / "ticker=A").mkdir(parents=True)
    (path / "_staged" / "b1" / "ticker=A" / "part-half.json").write_text('{"v"')
    assert tables.append_once(rows, str(path), "b1", ["ticker"]) == 1
    assert [r.v for r in spark.read.json(str(path)).collect()] == [1]


def test_manifest_restores_documents(spark, tmp_path):
    """A hot ticker in several files, names that need escaping, no name at all; order doesn't hang on the files' names."""
    path = str(tmp_path / "d")
    rows = [("A", i, f"line {i}\n") for i in range(900)] + [("B/1+ %=x", i, f"{i}\n") for i in range(7)] + [(None, 0, "none"), ("0012", 0, "zeros")]
    blocks = spark.createDataFrame(rows, "ticker string, ordinal bigint, block string").repartition(5)
    documents.write_documents(blocks, consolidate.MERGED_ORDER, path, parts=6)
    manifest = documents.write_manifest(spark, path).orderBy("ticker", "sequence").collect()
    hot = [r for r in manifest if r.ticker == "A"]
    assert [r.sequence for r in hot] == list(range(1, len(hot) + 1)) and len(hot) > 3
    assert [r.before for r in hot] == [sum(x.bytes for x in hot[:i]) for i in range(len(hot))]
    assert sum(r.bytes for r in hot) == sum(len(f"line {i}\n") for i in range(900))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        got = documents.read_documents(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    lines = {}
    for r in sorted(got, key=lambda r: r.line_no):
        lines.setdefault(r.ticker, []).append((r.line_no, r.line))
    assert lines == {
        "A": [(i + 1, f"line {i}") for i in range(900)], "B/1+ %=x": [(i + 1, str(i)) for i in range(7)], None: [(1, "none")], "0012": [(1, "zeros")]
    }


def test_targets_prune_partitions(spark, tmp_path):
    """Files of tickers and months that no target names are not opened: they hold no Parquet."""
    from tickframe.sources import catalogue

    folder = tmp_path / catalogue.DATASETS["bars"].folder
    day = 86_400_000
    rows = [(t, f"2024-{m:02d}", (dt.date(2024, m, d) - dt.date(1970, 1, 1)).days * day + 5, float(d)) for t in "ABC" for m in (1, 2, 3, 5) for d in (1, 15, 28)]
    spark.createDataFrame(rows, "ticker string, month string, t bigint, c double").write.partitionBy("ticker", "month").parquet(str(folder))
    for part in folder.rglob("part-*.parquet"):
        if part.parent.parent.name == "ticker=C" or part.parent.name == "month=2024-05":
            part.write_bytes(b"no parquet at all")
    targets = spark.createDataFrame(
        [("A", dt.date(2024, 1, 15), dt.date(2024, 2, 1)), ("A", dt.date(2024, 1, 20), dt.date(2024, 2, 15)), ("B", dt.date(2024, 3, 28), dt.date(2024, 3, 28)),
         ("B", dt.date(2024, 3, 2), dt.date(2024, 3, 1)), ("Z", dt.date(2024, 1, 1), dt.date(2024, 4, 30))],
        "ticker string, start_date date, end_date date",
    )
    found = catalogue.target_scan(spark, str(tmp_path), "bars", targets)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert found.columns == ["t", "c", "ticker", "month"]
    assert sorted((r.ticker, r.month, r.c) for r in found.collect()) == [("A", "2024-01", 15.0), ("A", "2024-01", 28.0), ("A", "2024-02", 1.0), ("A", "2024-02", 15.0), ("B", "2024-03", 28.0)]
    with pytest.raises(ValueError):
        catalogue.target_scan(spark, str(tmp_path), "inflation", targets)


def test_state_rows_stay_small_whatever_the_groups(spark, tmp_path):
    """A group's keys are no single state row, which would grow with the batch."""
    land(tmp_path / "pages", "1.json", {"results": [{"id": str(i), "sip_timestamp": i} for i in range(20000)] * 2})
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    marked = ingest.marked_late(stream_rows(spark, tmp_path), ["id"], "10 seconds", groups=1)
    ingest.append_parquet(marked, out, state, ["late"]).awaitTermination()
    assert spark.read.parquet(out).count() == 20000
    sizes = [r.n for r in spark.read.format("statestore").load(state).select(F.size("value.groupState.keys").alias("n")).collect()]
    assert sum(sizes) == 20000 and max(sizes) < 100


def test_many_small_files_are_dealt_to_all_partitions_and_listed_once(spark, tmp_path):
    """Adaptive execution merges small partitions by size, which leaves many small files to a task or two."""
    rows = spark.range(400).select((F.col("id") % 200).alias("k"), F.col("id").alias("v"))
    assert tables.spread_by(rows, ["k"], many_files=True).select(F.spark_partition_id()).distinct().count() > 4
    tables.spread_by(rows, ["k"], many_files=True).write.partitionBy("k").parquet(str(tmp_path / "files"))
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    files = landed.stored_listing(spark, str(tmp_path / "files"), "part-*", str(tmp_path / "list"))
    assert files.count() == 200 and files.filter("length > 0").count() == 200
    assert spark.conf.get("spark.sql.files.openCostInBytes") == cost


def test_history_tickers_are_of_all_customers(spark, tmp_path):
    """No customer is left out by its number or for want of a date; an order without a customer has no ticker."""
    orders = [(i, i % 60, dt.datetime(1996, 1 + i % 3, 5), 1.5) for i in range(120)] + [(900, 70, None, 1.0), (901, None, dt.datetime(1996, 1, 5), 1.0), (902, -7, dt.datetime(1996, 1, 5), 1.0)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    found = landing.history_tickers(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    assert oracle.compare(found, con, landing.oracle_sql()["history_tickers"]) is None
    assert sorted(r.ticker for r in found.collect()) == sorted(f"C{k}" for k in [*range(60), 70, -7])


def test_named_files_hold_their_rows_once_whatever_runs_again(spark, tmp_path):
    """One file per name, also where its rows come in many batches; a second run writes the same files again."""
    root = str(tmp_path / "named")
    rows = spark.range(45000).select(F.when(F.col("id") < 40000, "big/tick/a b%.parquet").otherwise(F.concat(F.lit("s/"), (F.col("id") % 500).cast("string"), F.lit(".parquet"))).alias("file"), F.col("id").alias("v"), F.lit(None).cast("string").alias("none"))
    for _ in range(2):
        assert tables.write_named(rows, root, "file") == 501
    files = [p for p in (tmp_path / "named").rglob("*") if p.is_file()]
    assert len(files) == 501 and not [p for p in files if p.name.startswith(".")]
    stored = spark.read.parquet(root + "/*", root + "/big/tick").select("v", "none", F.regexp_extract(F.col("_metadata.file_path"), "/named/(.*)$", 1).alias("file"))
    assert stored.columns == ["v", "none", "file"] and stored.count() == 45000 and stored.filter("none IS NOT NULL").count() == 0
    small = rows.filter("v >= 40000").select("file", "v")
    assert small.exceptAll(stored.select("file", "v")).isEmpty()
    assert stored.filter("file LIKE 'big/%'").agg(F.count_distinct("v"), F.max("v")).first()[:] == (40000, 39999)
    with pytest.raises(Exception, match="a row without file"):
        tables.write_named(rows.withColumn("file", F.when(F.col("v") > 5, F.col("file"))), str(tmp_path / "null"), "file")


def test_listing_is_made_below_folders_and_leaves_hidden_names_out(spark, tmp_path, monkeypatch):
    for name in ("a/tick/1.parquet", "a/tick/.2.parquet-draft", "a/tick/_3.parquet", ".b/4.parquet", "_c/5.parquet", "d/e/f/g 6%.parquet", "7.parquet", "a/8.csv"):
        (tmp_path / "tree" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "tree" / name).write_bytes(b"x" * len(name))
    monkeypatch.setattr(landed, "_LISTED_AT_ONCE", 1)
    want = [(f"{tmp_path}/tree/{n}", len(n)) for n in ("7.parquet", "a/tick/1.parquet", "d/e/f/g 6%.parquet")]
    for i, prefix in enumerate(("", "file:", "file://")):
        found = landed.stored_listing(spark, f"{prefix}{tmp_path}/tree/", "*.parquet", str(tmp_path / f"list{i}"))
        assert sorted((r.path, r.length) for r in found.collect()) == [(prefix + path, n) for path, n in want]
    (tmp_path / "none").mkdir()
    assert landed.stored_listing(spark, str(tmp_path / "none"), "*.parquet", str(tmp_path / "list")).count() == 0


def test_history_is_stored_under_the_names_of_its_layout(spark, tmp_path, monkeypatch):
    """The files themselves bear the names that the inventory parses, each with the orders of its month."""
    monkeypatch.setattr(landing, "new_scratch", lambda _, name: str(tmp_path / name))
    orders = [(1, 7, dt.datetime(1996, 2, 1), 1.5), (2, 7, dt.datetime(1996, 2, 29, 23, 59), 2.5), (3, 7, dt.datetime(1996, 3, 1), 4.5), (4, 8, None, 8.5)]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_totalprice double"
    spark.createDataFrame(orders, schema).write.parquet(str(tmp_path / "orders.parquet"))
    assert sorted(r.ticker for r in landing.history_tickers(spark, str(tmp_path)).collect()) == ["C7", "C8"]
    stored = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "history"))
    held = stored.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.sum("o_totalprice").alias("s")).collect()
    assert {r.f: r.s for r in held} == {"C7_tick_1996-02-01_to_1996-02-29.parquet": 4.0, "C7_tick_1996-03-01_to_1996-03-31.parquet": 4.5, "C8_tick_0000-00-00_to_0000-00-00.parquet": 8.5}
    inventory = landed.history_inventory(spark, str(tmp_path / "history"))
    assert sorted((r.ticker, r.fidelity, str(r.start_date), str(r.end_date)) for r in inventory.collect()) == [
        ("C7", "tick", "1996-02-01", "1996-02-29"), ("C7", "tick", "1996-03-01", "1996-03-31"), ("C8", "tick", "None", "None")]


def test_history_of_no_orders(spark, tmp_path):
    spark.createDataFrame([], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    assert landing.history_tickers(spark, str(tmp_path)).count() == 0
