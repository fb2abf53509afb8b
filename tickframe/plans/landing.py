"""Queries that go through files: each writes what it derives from the tables to the scratch folder and reads it back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe import schemas
from tickframe.functions.fidelity import history_file_name
from tickframe.functions.filing import integer_cik
from tickframe.functions.instants import standardize_timestamp
from tickframe.operators import bars as br
from tickframe.operators import consolidate as con
from tickframe.operators import filings as fil
from tickframe.operators import refdata as ref
from tickframe.operators import targets as tgt
from tickframe.operators.history import parse_inventory
from tickframe.plans import bindings as bd
from tickframe.plans import filings as fp
from tickframe.session import new_scratch
from tickframe.sinks import documents, tables
from tickframe.sources import landed
from tickframe.sources.catalogue import DATASETS, landed_pages, range_scan, target_scan
from tickframe.streaming import ingest

_TRADE_FIELDS = ("ticker", "sip_timestamp", "id", "sequence_number", "price", "size")


def _land_pages(spark: SparkSession, sf_dir: str, path: str, copies: int = 1) -> None:
    """Every trade as an API page, with a field the schema does not know; every tenth is followed by an empty page.

    Pages of one trade need no grouping, so a key that holds much of the table costs nothing here.
    """
    trade = F.struct(*_TRADE_FIELDS, F.lit("x").alias("unknown_field"))
    trades = bd.trades(spark, sf_dir)
    full = trades.select(F.array(trade).alias("results"), F.concat(F.lit("/next/"), "id").alias("next_url"))
    empty = trades.filter(F.col("sequence_number") % 10 == 0).select(
        F.filter(F.array(trade), lambda _: F.lit(False)).alias("results"), F.lit(None).cast("string").alias("next_url")
    )
    pages = full.unionByName(empty)
    for _ in range(copies):
        pages.write.mode("append").json(path)


_LANDED_TRADE = T.StructType(schemas.TRADES.fields + [T.StructField("ticker", T.StringType())])


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch(spark, "pages")
    _land_pages(spark, sf_dir, path)
    return landed.read_pages(spark, path, _LANDED_TRADE).select(*_TRADE_FIELDS, "exchange")


def indicator_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily closes landed as indicator answers, whose rows lie one level deeper."""
    path = new_scratch(spark, "indicators")
    daily = br.bars(bd.trades(spark, sf_dir), 1, "day")
    value = F.struct(F.col("t").alias("timestamp"), F.col("c").alias("value"))
    daily.select(F.struct(F.array(value).alias("values")).alias("results")).write.json(path)
    return landed.read_pages(spark, path, schemas.INDICATOR_VALUES, "results", "values").select("timestamp", "value")


def tolerant_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as JSON lines, every tenth cut short: readable records and, as warnings, the other lines."""
    path = new_scratch(spark, "jsonl")
    whole = F.to_json(F.struct(F.col("c_name").alias("ticker"), F.col("c_mktsegment").alias("section_id")))
    line = F.when(F.col("c_custkey") % 10 == 0, F.left(whole, F.lit(20))).otherwise(whole)
    bd.table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    good, bad = landed.read_json_lines(spark, path, T.StructType.fromDDL("ticker string, section_id string"))
    return good.select(F.lit("record").alias("kind"), F.concat_ws("/", "ticker", "section_id").alias("content")).unionByName(
        bad.select(F.lit("warning").alias("kind"), F.col("raw").alias("content"))
    )


def page_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed twice, ingested by stream under the trades schema, then read once per trade."""
    root = new_scratch(spark, "stream")
    _land_pages(spark, sf_dir, f"{root}/pages", copies=2)
    rows = ingest.with_event_time(ingest.page_stream(spark, f"{root}/pages", extra="ticker string"))
    ingest.append_parquet(rows, f"{root}/trades", f"{root}/checkpoint").awaitTermination()
    stored = ingest.without_repeats(spark.read.parquet(f"{root}/trades"), ["id", "sip_timestamp"], ["sequence_number"])
    seen = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp")
    return stored.select("ticker", "id", "sip_timestamp", seen, "price", "size", "exchange")


#: The first run of the resumed stream ends here; rows may be three days late.
_STOP, _DELAY_DAYS = dt.datetime(2024, 1, 20), 3


def _land_trades(trades: DataFrame, path: str) -> None:
    """Each trade as a page of its own."""
    trades.select(F.array(F.struct(*_TRADE_FIELDS)).alias("results")).write.mode("append").json(path)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that stops, while more pages land, and resumes: rows once, and the late ones apart.

    The first run sees nine tenths of the trades before a day. The second gets all since, the tenth that was held back (in
    part too late by then), repeats from within the delay, and repeats from long before, which count as late.
    """
    root = new_scratch(spark, "resume")
    trades = bd.trades(spark, sf_dir)
    at, held = F.timestamp_micros(F.call_function("div", F.col("sip_timestamp"), F.lit(1000))), F.col("sequence_number") % 10 == 7
    stop, day = F.lit(_STOP.isoformat(" ")).cast("timestamp"), F.expr("INTERVAL 1 DAY")
    early = at < stop

    def run() -> None:
        rows = ingest.with_event_time(ingest.page_stream(spark, f"{root}/pages", extra="ticker string"))
        marked = ingest.marked_late(rows, ["id", "sip_timestamp"], f"{_DELAY_DAYS} days", groups=8)
        ingest.append_parquet(marked, f"{root}/trades", f"{root}/checkpoint", ["late"]).awaitTermination()

    _land_trades(trades.filter(early & ~held), f"{root}/pages")
    run()
    recent = ~held & early & (at >= stop - 2 * day) & (F.col("sequence_number") % 5 == 0)
    ancient = ~held & (at < stop - 6 * day) & (F.col("sequence_number") % 11 == 3)
    _land_trades(trades.filter(~early | held | recent | ancient), f"{root}/pages")
    run()
    stored = spark.read.parquet(f"{root}/trades")
    return stored.select(F.when(F.col("late").cast("boolean"), "late").otherwise("kept").alias("kind"), "ticker", "id", "sip_timestamp", "price")


def page_stream_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers under the folder of their ticker, every tenth cut short, streamed in two runs: rows and, by ticker, the errors."""
    root = new_scratch(spark, "keyed")
    trades = bd.trades(spark, sf_dir)
    answer = F.to_json(F.struct(F.array(F.struct(*_TRADE_FIELDS[1:])).alias("results"), F.lit("OK").alias("status")))
    line = F.when(F.col("sequence_number") % 10 == 0, F.left(answer, F.lit(40))).otherwise(answer)
    for odd in (0, 1):
        landed_now = trades.filter(F.col("sequence_number") % 2 == odd).select("ticker", line.alias("value"))
        tables.spread_by(landed_now, ["ticker"]).write.mode("append").partitionBy("ticker").text(f"{root}/answers")
        lines = ingest.answer_stream(spark, f"{root}/answers", "ticker string")
        ingest.ingest_answers(
            lines, schemas.TRADES, ["ticker"], f"{root}/rows", f"{root}/errors", f"{root}/checkpoint", F.lit("2024-01-31 00:00:00").cast("timestamp")
        ).awaitTermination()
    rows = spark.read.parquet(f"{root}/rows").select(F.lit("row").alias("kind"), "ticker", "id", "sip_timestamp", "price")
    errors = spark.read.parquet(f"{root}/errors").groupBy("ticker").agg(F.count(F.lit(1)).alias("sip_timestamp"))
    return rows.unionByName(
        errors.select(F.lit("errors").alias("kind"), "ticker", F.lit(None).cast("string").alias("id"), "sip_timestamp", F.lit(None).cast("double").alias("price"))
    )


def debug_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first thousand trades of the first batch, as the one-time sample keeps them."""
    root = new_scratch(spark, "debug")
    _land_pages(spark, sf_dir, f"{root}/pages")
    rows = ingest.page_stream(spark, f"{root}/pages", extra="ticker string").drop("conditions")
    ingest.save_debug_sample(rows, ["sip_timestamp"], f"{root}/sample", f"{root}/checkpoint").awaitTermination()
    sample = spark.read.schema("sip_timestamp bigint, participant_timestamp bigint, trf_timestamp bigint, id string, "
                               "sequence_number bigint, exchange bigint, price double, size bigint, tape bigint, trf_id bigint, "
                               "ticker string").option("header", True).csv(f"{root}/sample")
    return sample.select("ticker", "id", "price", "size")


def append_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records appended by ticker and year, the whole run twice; a reader keeps one row per filing, ticker and section."""
    path = new_scratch(spark, "sections")
    records, _ = fil.storable(fp.records(spark, sf_dir))
    for _ in range(2):
        tables.append_filing_sections(records, path)
    stored = spark.read.schema("accession_number string, section_id string, form_type string, text string, ticker string, year string").json(path)
    once = fil.first_wins(stored, ["accession_number", "ticker", "section_id"], ["text"])
    return once.select("accession_number", "section_id", "ticker", "year", "form_type")


def append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records sent in two batches, each of them twice, and read as they lie on disk; the ledger beside them is counted."""
    path = new_scratch(spark, "once")
    records, _ = fil.storable(fp.records(spark, sf_dir))
    odd = F.pmod(F.crc32(F.col("accession_number").cast("binary")), F.lit(2)) == 1
    for _ in range(2):
        tables.append_once(records.filter(odd), path, "2024-01-30", ["ticker", "year"])
        tables.append_once(records.filter(~odd), path, "2024-01-31", ["ticker", "year"])
    stored = spark.read.schema("accession_number string, section_id string, form_type string, ticker string, year string").json(path)
    batches = tables.published(spark, path).agg(F.sum("rows").cast("string").alias("year"))
    total = batches.select(*(F.lit(None).cast("string").alias(n) for n in ("accession_number", "section_id", "ticker")), "year", F.lit("ledger").alias("form_type"))
    return stored.select("accession_number", "section_id", "ticker", "year", "form_type").unionByName(total)


def document_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidated documents written as part files and restored in order by their manifest: every line with its number."""
    path = new_scratch(spark, "manifest")
    documents.write_documents(con.consolidated_blocks(bd.section_texts(spark, sf_dir)), con.CONSOLIDATED_ORDER, path)
    documents.write_manifest(spark, path)
    return documents.read_documents(spark, path)


def replace_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority and year; 1996 and 1997 are reloaded with doubled prices, and 1998, whose reload is empty."""
    path = new_scratch(spark, "replace")
    orders = bd.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.left("o_orderpriority", F.lit(1)).alias("ticker"), F.year("o_orderdate").alias("year")
    )
    tables.spread_by(orders, ["ticker", "year"]).write.partitionBy("ticker", "year").parquet(path)
    again = orders.filter(F.col("year").isin(1996, 1997)).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    job = orders.filter(F.col("year").isin(1996, 1997, 1998))
    tables.replace_job(again, job, path, ["ticker", "year"])
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", F.col("year").cast("int").alias("year"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch(spark, "targets")
    tables.write_csv(bd.targets(spark, sf_dir), path)
    return landed.read_targets(spark, path)


def dataset_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars written under the history layout and read back whole."""
    root = new_scratch(spark, "lake")
    bars = br.bars(bd.trades(spark, sf_dir), 1, "hour").withColumns(
        {"fidelity": F.lit("1-hour"), "month": F.date_format(F.timestamp_millis("t"), "yyyy-MM")}
    )
    tables.write_dataset(bars, root, "trading_history")
    return landed.read_ticks(spark, f"{root}/trading_history", "ticker", "fidelity", "month", "t", "o", "c", "n")


def macro_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily series kept as Parquet, with a standard time stamp, and as CSV, as it came."""
    root = new_scratch(spark, "macro")
    series = (
        bd.table(spark, sf_dir, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
        .agg(F.count(F.lit(1)).alias("value"))
    )
    tables.write_both(series, f"{root}/orders.parquet", f"{root}/orders.csv")
    parquet = spark.read.parquet(f"{root}/orders.parquet").select(
        F.lit("parquet").alias("kind"), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("at"), "value"
    )
    csv = landed.read_csv(spark, f"{root}/orders.csv", T.StructType.fromDDL("date string, value bigint"))
    return parquet.unionByName(csv.select(F.lit("csv").alias("kind"), F.col("date").alias("at"), "value"))


def report_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker lists of one asset class written twice on one day and once the day before; the newest run is read."""
    root = new_scratch(spark, "lists")
    customers = bd.table(spark, sf_dir, "customer").select(F.col("c_name").alias("ticker"), "c_custkey")
    path = f"{root}/asset_class=stocks"
    tables.write_run(customers, path, dt.date(2024, 1, 31))
    tables.write_run(customers.filter(F.col("c_custkey") > 9), path, dt.date(2024, 1, 31))
    tables.write_run(customers.filter(F.col("c_custkey") > 99), path, dt.date(2024, 1, 30))
    return landed.latest_ticker_list(spark, root, "stocks")


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected targets of two sources in the one error table."""
    path = new_scratch(spark, "errors")
    rejected = tgt.rejected_targets(bd.targets(spark, sf_dir))
    rows = tables.error_rows(
        rejected,
        "targets",
        F.lit("2024-01-31 00:00:00").cast("timestamp"),
        ticker=F.col("ticker"),
        fidelity=F.col("ticker_fidelity"),
        reason=F.col("reject_reason"),
    )
    tables.append_errors(rows, path, "trading_history")
    tables.append_errors(rows.filter(F.col("reason") == "invalid duration"), path, "filings")
    stored = spark.read.parquet(path)
    return stored.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the consolidated documents as written per ticker."""
    path = new_scratch(spark, "documents")
    documents.write_documents(con.consolidated_blocks(bd.section_texts(spark, sf_dir)), con.CONSOLIDATED_ORDER, path)
    return spark.read.text(path).select("ticker", F.col("value").alias("line"))


def _stored_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section records stored as JSON by ticker and year, each filing also under a second ticker, read back tolerantly."""
    path = new_scratch(spark, "records")
    records = bd.section_texts(spark, sf_dir).drop("ordinal")
    records = records.unionByName(records.withColumn("ticker", F.concat(F.lit("U"), "ticker")))
    tables.append_filing_sections(records.withColumn("year", F.substring("filing_timestamp_utc", 1, 4)), path)
    good, _ = landed.read_json_lines(spark, path, records.schema)
    return good


def stored_formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the readable documents as written per ticker, from stored records."""
    path = new_scratch(spark, "formatted")
    documents.write_documents(con.formatted_blocks(fp.marked_sections(_stored_sections(spark, sf_dir))), con.ASSEMBLED_ORDER, path)
    return spark.read.text(path).select("ticker", F.col("value").alias("line"))


def stored_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged and consolidated blocks of stored records, counted."""
    stored = _stored_sections(spark, sf_dir)
    merged = con.merged_blocks(stored).groupBy("ticker").agg(F.count(F.lit(1)).alias("merged"))
    whole = con.consolidated_blocks(stored).groupBy("ticker").agg(F.count(F.lit(1)).alias("consolidated"))
    return merged.join(whole, "ticker")


def _customer_answers(spark: SparkSession, sf_dir: str, path: str, answer) -> None:
    """One answer per customer under the folder of the nation that asked; every tenth is cut short."""
    line = F.when(F.col("c_custkey") % 10 == 0, F.left(answer, F.lit(12))).otherwise(answer)
    customers = bd.table(spark, sf_dir, "customer").select(F.concat(F.lit("N"), "c_nationkey").alias("ticker"), line.alias("value"))
    tables.spread_by(customers, ["ticker"]).write.partitionBy("ticker").text(path)


_CUSTOMER = T.StructType([T.StructField("name", T.StringType()), T.StructField("cik", T.LongType())])


def overview_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overviews, whose answer is one object, with the key that was asked for; unreadable answers are counted."""
    path = new_scratch(spark, "overviews")
    record = F.struct(F.col("c_name").alias("name"), F.col("c_custkey").alias("cik"), F.lit("x").alias("unknown"))
    _customer_answers(spark, sf_dir, path, F.to_json(F.struct(record.alias("results"), F.lit("OK").alias("status"))))
    rows, rejects = landed_pages(spark, path, "stock_overviews", _CUSTOMER)
    return rows.select("ticker", "name", "cik").unionByName(
        rejects.groupBy().agg(F.count(F.lit(1)).alias("cik")).select(F.lit("rejects").alias("ticker"), F.lit(None).cast("string").alias("name"), "cik")
    )


def cik_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CIK answers, each a top-level array of two rows."""
    path = new_scratch(spark, "ciks")
    record = F.struct(F.col("c_name").alias("name"), F.col("c_custkey").alias("cik"))
    _customer_answers(spark, sf_dir, path, F.to_json(F.array(record, record)))
    rows, _ = landed_pages(spark, path, "cik_primary", _CUSTOMER)
    return rows.select("ticker", "name", "cik")


def latest_list_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest stock list beside an option list and an older stock list with other columns in another order."""
    root = new_scratch(spark, "mixed-lists")
    customers = bd.table(spark, sf_dir, "customer")
    stocks = customers.select(F.col("c_mktsegment").alias("name"), F.col("c_name").alias("ticker"))
    tables.write_run(stocks, f"{root}/asset_class=stocks", dt.date(2024, 1, 31))
    tables.write_run(customers.select(F.lit("old").alias("ticker"), "c_custkey"), f"{root}/asset_class=stocks", dt.date(2024, 1, 30))
    tables.write_run(customers.select("c_custkey", F.lit("option").alias("ticker")), f"{root}/asset_class=options", dt.date(2024, 2, 1))
    return landed.latest_ticker_list(spark, root, "stocks")


def targets_extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target list with a column more and the others in another order."""
    path = new_scratch(spark, "wide-targets")
    wide = bd.targets(spark, sf_dir).select("ticker_duration_months", F.lit("n").alias("note"), "ticker", "ticker_fidelity")
    tables.write_csv(wide, path)
    return landed.read_targets(spark, path)


def catalogue_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored dataset by catalogue name, ticker and days, in its order."""
    root = new_scratch(spark, "catalogue")
    tables.spread_by(bd.trades(spark, sf_dir), ["ticker"]).write.parquet(f"{root}/{DATASETS['trades'].folder}")
    found = range_scan(spark, root, "trades", "view", dt.date(2024, 1, 3), dt.date(2024, 1, 7), ordered=True)
    return found.select("ticker", "id", "sip_timestamp", "price")


def _wanted(trades: DataFrame) -> DataFrame:
    """Targets of two tickers of five: ranges that overlap, repeat, are empty or name a ticker that isn't stored."""
    ranges = [("view", 3, 9), ("view", 7, 12), ("view", 7, 12), ("view", 25, 26), ("purchase", 20, 27), ("click", 9, 3), ("none", 1, 30)]
    listed = F.array(*(F.struct(F.lit(t).alias("ticker"), F.lit(a).alias("a"), F.lit(b).alias("b")) for t, a, b in ranges))
    day = lambda name: F.make_date(F.lit(2024), F.lit(1), F.col(name))
    wanted = trades.select("ticker").distinct().withColumn("_w", F.explode(listed)).select("_w.*").distinct()
    return wanted.select("ticker", day("a").alias("start_date"), day("b").alias("end_date"))


def catalogue_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset stored by ticker and month, read for a table of targets: partitions that none names are not read."""
    root = new_scratch(spark, "targets-scan")
    trades = bd.trades(spark, sf_dir)
    month = F.date_format(F.timestamp_micros(F.call_function("div", F.col("sip_timestamp"), F.lit(1000))), "yyyy-MM")
    stored = tables.spread_by(trades.withColumn("month", month), ["ticker", "month"])
    stored.write.partitionBy("ticker", "month").parquet(f"{root}/{DATASETS['trades'].folder}")
    return target_scan(spark, root, "trades", _wanted(trades)).select("ticker", "id", "sip_timestamp", "price")


def cik_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CIK list as a file: targets with a number, padded and as an integer, and the cells of those without one."""
    path = new_scratch(spark, "cik-list")
    listed = bd.table(spark, sf_dir, "customer").select(F.col("c_name").alias("ticker"), F.expr(bd.RAW_CIK).alias("CIK"))
    tables.write_csv(listed, path)
    usable, rest = ref.usable_targets(landed.read_cik_targets(spark, path))
    return usable.select("ticker", "cik_padded", integer_cik(F.col("cik_clean")).alias("number")).unionByName(
        rest.select("ticker", F.col("cik_clean").alias("cik_padded"), integer_cik(F.col("cik_clean")).alias("number"))
    )


def download_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered filings as a download list, stored and read back."""
    path = new_scratch(spark, "downloads")
    tables.write_csv(fil.download_candidates(bd.filings(spark, sf_dir)), path)
    return landed.read_download_list(spark, path)


#: Folders over which the tickers of a history are spread.
_TICKER_FOLDERS = 1024


def history_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickers found in the paths of history files: one monthly file per customer and month of its orders, stored and listed.

    Orders without a date lie in a file of their customer that spans no days; orders without a customer have no ticker.
    """
    root = new_scratch(spark, "history")
    orders = bd.table(spark, sf_dir, "orders").filter(F.col("o_custkey").isNotNull())
    spans = orders.select(F.concat(F.lit("C"), "o_custkey").alias("ticker"), F.trunc("o_orderdate", "MM").alias("month"), "o_totalprice")
    dated = history_file_name(F.col("ticker"), F.lit("tick"), F.col("month"), F.last_day("month"))
    name = F.coalesce(dated, F.concat("ticker", F.lit("_tick_0000-00-00_to_0000-00-00.parquet")))
    # Tickers lie in folders of folders: no folder, and no list on the driver, holds all of them.
    group = F.pmod(F.xxhash64("ticker"), F.lit(_TICKER_FOLDERS)).cast("string")
    files = spans.select(F.concat_ws("/", group, "ticker", F.lit("tick"), name).alias("file"), "o_totalprice")
    tables.write_named(files, root, "file")
    inventory = parse_inventory(landed.stored_listing(spark, root, "*.parquet", new_scratch(spark, "listing")))
    known = landed.tick_universe(inventory).filter("bytes > 0").select("ticker")
    return landed.history_universe(inventory).join(known, "ticker", "left_semi")


def column_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a column told to be milliseconds by their greatest one, small ones with them; and a column of small ones."""
    events = bd.table(spark, sf_dir, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    mixed = events.select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_id")).otherwise(ms).alias("ms"), F.col("event_id").alias("small"))
    once = standardize_timestamp(mixed, "ms", "column").withColumnRenamed("timestamp", "from_ms")
    both = standardize_timestamp(once, "small", "column").withColumnRenamed("timestamp", "from_small")
    return both.select("event_id", *[F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSS").alias(n) for n in ("from_ms", "from_small")])


def listed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed overviews of the tickers on a list, post-processed by a hook: upper-case names of the even customers."""
    path = new_scratch(spark, "listed")
    record = F.struct(F.col("c_name").alias("name"), F.col("c_custkey").alias("cik"))
    _customer_answers(spark, sf_dir, path, F.to_json(F.struct(record.alias("results"))))
    rows, _ = landed_pages(spark, path, "stock_overviews", _CUSTOMER)
    wanted = bd.table(spark, sf_dir, "nation").filter("n_regionkey < 2").select(F.concat(F.lit("N"), "n_nationkey").alias("ticker"))
    wanted = wanted.unionByName(wanted).unionByName(wanted.limit(1).select(F.lit("absent").alias("ticker")))
    return ref.per_ticker(wanted, rows, lambda found: found.filter("cik % 2 = 0").withColumn("name", F.upper("name")))


#: Keys whose folder names have to be escaped, or that look like something else.
_ODD_KEY = "CASE c_custkey % 6 WHEN 0 THEN 'A=B' WHEN 1 THEN 'C/D' WHEN 2 THEN '0012' WHEN 4 THEN 'x y%z' WHEN 5 THEN '2024-01-05' END"


def dataset_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dataset but the history written under its own layout with odd and null keys, and read back."""
    root = new_scratch(spark, "layouts")
    rows = bd.table(spark, sf_dir, "customer").select("c_custkey", F.expr(_ODD_KEY).alias("_key"))
    found = None
    for name in sorted(tables.LAYOUT.keys() - {"trading_history"}):
        key, *others = tables.LAYOUT[name]
        written = rows.withColumnRenamed("_key", key).withColumns({other: F.lit("1") for other in others})
        tables.write_dataset(written, root, name)
        stored = landed.read_dataset(spark, root, name)
        same = stored.select(F.lit(name).alias("dataset"), F.col(key).alias("key"), F.concat_ws("/", F.lit("k"), *others).alias("others"), "c_custkey")
        found = same if found is None else found.unionByName(same)
    return found.groupBy("dataset", "key", "others").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("total"))


def queries() -> dict:
    names = (
        api_pages, indicator_pages, tolerant_jsonl, page_stream_ingest, stream_resume, page_stream_keyed, debug_sample, append_by_year, append_once, document_manifest, replace_partitions,
        csv_roundtrip, dataset_roundtrip, macro_both, report_runs, error_log, stored_documents, stored_formatted, stored_merged,
        overview_pages, cik_pages, latest_list_mixed, targets_extra_columns, catalogue_scan, catalogue_targets,
        cik_targets, download_list, history_tickers, column_timestamps, listed_answers, dataset_layouts,
    )
    return {function.__name__: function for function in names}


_TRADES = """trades AS (
  SELECT event_type AS ticker, epoch_ns(ts) AS ns, ts, event_id, value AS price, CAST(json_extract_string(props, '$.k') AS BIGINT) AS size FROM events)"""


def oracle_sql() -> dict[str, str]:
    line = """concat('{"ticker":"', c_name, '","section_id":"', c_mktsegment, '"}')"""
    daily = "ns // 86400000000000 * 86400000"
    hourly = "ns // 3600000000000 * 3600000"
    target = f"SELECT c_name AS ticker, nullif({bd.FIDELITY}, '') AS ticker_fidelity, CASE WHEN c_custkey % 10 = 9 THEN 'n/a' ELSE CAST(c_custkey % 25 AS VARCHAR) END AS ticker_duration_months FROM customer"
    reason = "CASE WHEN c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'HOUSEHOLD', 'MACHINERY') THEN 'missing fidelity' WHEN c_custkey % 10 = 9 THEN 'invalid duration' WHEN c_custkey % 25 = 0 THEN 'missing duration' END"
    return {
        "api_pages": f"WITH {_TRADES} SELECT ticker, ns AS sip_timestamp, CAST(event_id AS VARCHAR) AS id, event_id AS sequence_number, price, size, CAST(NULL AS BIGINT) AS exchange FROM trades",
        "indicator_pages": f"WITH {_TRADES} SELECT t AS timestamp, c AS value FROM (SELECT ticker, CAST({daily} AS BIGINT) AS t, arg_max(price, ns) AS c FROM trades GROUP BY 1, 2)",
        "tolerant_jsonl": f"SELECT CASE WHEN c_custkey % 10 = 0 THEN 'warning' ELSE 'record' END AS kind, CASE WHEN c_custkey % 10 = 0 THEN left({line}, 20) ELSE concat(c_name, '/', c_mktsegment) END AS content FROM customer",
        "page_stream_ingest": f"WITH {_TRADES} SELECT ticker, CAST(event_id AS VARCHAR) AS id, ns AS sip_timestamp, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, price, size, CAST(NULL AS BIGINT) AS exchange FROM trades",
        "stream_resume": f"""WITH {_TRADES}, s AS (SELECT *, ts < TIMESTAMP '{_STOP}' AS early, event_id % 10 = 7 AS held FROM trades),
w AS (SELECT epoch_ms(max(ts)) - {_DELAY_DAYS * 86_400_000} AS watermark FROM s WHERE early AND NOT held),
k AS (SELECT *, early AND epoch_ms(ts) < watermark AS behind, ts < TIMESTAMP '{_STOP}' - INTERVAL 6 DAY AND event_id % 11 = 3 AND NOT held AS again FROM s, w)
SELECT CASE WHEN held AND behind THEN 'late' ELSE 'kept' END AS kind, ticker, CAST(event_id AS VARCHAR) AS id, ns AS sip_timestamp, price FROM k
UNION ALL SELECT 'late', ticker, CAST(event_id AS VARCHAR), ns, price FROM k WHERE again""",
        "page_stream_keyed": f"""WITH {_TRADES} SELECT 'row' AS kind, ticker, CAST(event_id AS VARCHAR) AS id, ns AS sip_timestamp, price FROM trades WHERE event_id % 10 <> 0
UNION ALL SELECT 'errors', ticker, NULL, count(*), NULL FROM trades WHERE event_id % 10 = 0 GROUP BY ticker""",
        "debug_sample": f"WITH {_TRADES} SELECT ticker, CAST(event_id AS VARCHAR) AS id, price, size FROM trades ORDER BY ns LIMIT 1000",
        "append_by_year": fp.records_sql(
            f"accession_number, section_id, source AS ticker, strftime({fp.FILED_UTC}, '%Y') AS year, upper({bd.FORM}) AS form_type"
        ),
        "append_once": fp.records_sql(
            f"accession_number, section_id, source AS ticker, strftime({fp.FILED_UTC}, '%Y') AS year, upper({bd.FORM}) AS form_type"
        )
        + " UNION ALL SELECT NULL, NULL, NULL, CAST(count(*) AS VARCHAR), 'ledger' FROM ("
        + fp.records_sql("accession_number")
        + ")",
        "document_manifest": f"""WITH b AS (SELECT *, string_split(left(block, length(block) - 1), chr(10)) AS lines FROM ({fp.oracle_sql()['consolidated_doc']})),
l AS (SELECT * EXCLUDE (lines), unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM b)
SELECT ticker, row_number() OVER (PARTITION BY ticker ORDER BY is_body, filed, accession, kind, section_rank, ordinal, i) AS line_no, line FROM l""",
        "replace_partitions": "SELECT o_orderkey, o_totalprice * CASE WHEN year(o_orderdate) IN (1996, 1997) THEN 2 ELSE 1 END AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) <> 1998",
        "csv_roundtrip": target,
        "dataset_roundtrip": f"""WITH {_TRADES} SELECT ticker, '1-hour' AS fidelity, strftime(make_timestamp(t * 1000), '%Y-%m') AS month, t, o, c, n FROM (
  SELECT ticker, CAST({hourly} AS BIGINT) AS t, arg_min(price, ns) AS o, arg_max(price, ns) AS c, CAST(count(*) AS BIGINT) AS n
  FROM trades GROUP BY 1, 2)""",
        "macro_both": """WITH s AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS value FROM orders GROUP BY 1)
SELECT 'parquet' AS kind, concat(day, ' 00:00:00') AS at, value FROM s UNION ALL SELECT 'csv', day, value FROM s""",
        "report_runs": "SELECT c_name AS ticker FROM customer WHERE c_custkey > 9",
        "error_log": f"""WITH e AS (SELECT {reason} AS reason FROM customer)
SELECT 'trading_history' AS source, reason, CAST(count(*) AS BIGINT) AS n FROM e WHERE reason IS NOT NULL GROUP BY 2
UNION ALL SELECT 'filings', reason, CAST(count(*) AS BIGINT) FROM e WHERE reason = 'invalid duration' GROUP BY 2""",
        "stored_formatted": f"""WITH x AS (SELECT ticker, block FROM ({fp.oracle_sql()['formatted_doc']})),
b AS (SELECT ticker, block FROM x UNION ALL SELECT concat('U', ticker), replace(block, concat(' (', ticker, ')'), concat(' (U', ticker, ')')) FROM x)
SELECT ticker, unnest(string_split(left(block, length(block) - 1), chr(10))) AS line FROM b""",
        "stored_merged": f"""WITH m AS (SELECT ticker, count(*) AS merged FROM ({fp.oracle_sql()['merged_doc']}) GROUP BY 1),
c AS (SELECT ticker, count(*) AS consolidated FROM ({fp.oracle_sql()['consolidated_doc']}) GROUP BY 1), j AS (SELECT * FROM m JOIN c USING (ticker))
SELECT * FROM j UNION ALL SELECT concat('U', ticker), merged, consolidated FROM j""",
        "overview_pages": """SELECT concat('N', c_nationkey) AS ticker, c_name AS name, c_custkey AS cik FROM customer WHERE c_custkey % 10 <> 0
UNION ALL SELECT 'rejects', NULL, count(*) FROM customer WHERE c_custkey % 10 = 0""",
        "cik_pages": """SELECT concat('N', c_nationkey) AS ticker, c_name AS name, c_custkey AS cik FROM customer, range(2) WHERE c_custkey % 10 <> 0""",
        "latest_list_mixed": "SELECT c_name AS ticker FROM customer",
        "targets_extra_columns": target,
        "catalogue_scan": f"WITH {_TRADES} SELECT ticker, CAST(event_id AS VARCHAR) AS id, ns AS sip_timestamp, price FROM trades "
        "WHERE ticker = 'view' AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-08'",
        "cik_targets": f"""WITH r AS (SELECT c_name AS ticker, regexp_replace(coalesce({bd.RAW_CIK}, 'NOT_FOUND'), '\\.0$', '') AS x FROM customer)
SELECT ticker, CASE WHEN regexp_matches(x, '^[0-9]+$') AND length(x) < 10 THEN lpad(x, 10, '0') ELSE x END AS cik_padded, CAST(TRY_CAST(x AS BIGINT) AS VARCHAR) AS number FROM r""",
        "download_list": f"WITH {fp.CANDIDATES} SELECT ticker, form_type, filing_date, filing_timestamp, download_url, {fp.TARGET_PATH} FROM c",
        "history_tickers": "SELECT DISTINCT concat('C', o_custkey) AS ticker FROM orders WHERE o_custkey IS NOT NULL",
        "column_timestamps": """SELECT event_id, strftime(CASE WHEN event_id % 3 = 0 THEN make_timestamp(event_id * 1000) ELSE date_trunc('millisecond', ts) END, '%Y-%m-%d %H:%M:%S.%g') AS from_ms,
  CAST(NULL AS VARCHAR) AS from_small FROM events""",
        "listed_answers": """SELECT concat('N', c_nationkey) AS ticker, upper(c_name) AS name, c_custkey AS cik FROM customer
WHERE c_custkey % 10 <> 0 AND c_custkey % 2 = 0 AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2)""",
        "dataset_layouts": f"""WITH n(dataset, others) AS (VALUES ('technicals', 'k/1'), ('corporate_actions', 'k'), ('fundamentals', 'k'), ('ticker_lists', 'k/1/1'), ('macro', 'k'), ('filings', 'k/1'))
SELECT dataset, {_ODD_KEY} AS key, others, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS total FROM customer, n GROUP BY 1, 2, 3""",
        "catalogue_targets": f"""WITH {_TRADES} SELECT ticker, CAST(event_id AS VARCHAR) AS id, ns AS sip_timestamp, price FROM trades
WHERE ticker = 'view' AND (ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-13' OR ts >= TIMESTAMP '2024-01-25' AND ts < TIMESTAMP '2024-01-27')
OR ticker = 'purchase' AND ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-28'""",
        "stored_documents": f"SELECT ticker, unnest(string_split(left(block, length(block) - 1), chr(10))) AS line FROM ({fp.oracle_sql()['consolidated_doc']})",
    }
