"""Queries over targets, history files and reference lists, with the SQL they must agree with."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe import fixed
from tickframe.functions import fidelity as fid
from tickframe.functions.conform import conform
from tickframe.functions.instants import standardize_timestamp
from tickframe.operators import history as hist
from tickframe.operators import refdata as ref
from tickframe.operators import targets as tgt
from tickframe.plans import bindings as bd
from tickframe.schemas import TRADES
from tickframe.sinks.tables import error_rows
from tickframe.sources import landed
from tickframe.sources.catalogue import DATASETS, Dataset, scan

ORDERS_AS_OF = dt.date(1998, 6, 15)


def _iso(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def _monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bd.table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_suppkey", F.trunc("l_shipdate", "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("lines")
    )


def neighbor_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hist.neighbour_anomalies(_monthly_counts(spark, sf_dir), ["l_suppkey"], ["month"], "lines")
    return found.withColumn("month", _iso("month"))


def anomaly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size review of monthly files whose size is the supplier's line count of that month."""
    months = _monthly_counts(spark, sf_dir).withColumns(
        {
            "ticker": F.concat(F.lit("S"), "l_suppkey"),
            "fidelity": F.lit("15 minute"),
            "chunk_start": F.col("month"),
            "chunk_end": F.last_day("month"),
        }
    )
    files = hist.with_file_name(months).select(
        F.concat_ws("/", F.lit("/history"), "ticker", F.lit("15-minute"), "file_name").alias("path"),
        (F.col("lines") * 1000).alias("length"),
    )
    return hist.anomaly_report(hist.parse_inventory(files))


_ANOMALY_SQL = """WITH m AS (
  SELECT l_suppkey, date_trunc('month', l_shipdate) AS month, count(*) AS lines FROM lineitem GROUP BY 1, 2),
n AS (
  SELECT *, lag(lines) OVER w AS p, lead(lines) OVER w AS f FROM m WINDOW w AS (PARTITION BY l_suppkey ORDER BY month)),
a AS (SELECT *, CASE WHEN p IS NOT NULL AND f IS NOT NULL THEN (p + f) / 2.0::DOUBLE ELSE coalesce(p, f)::DOUBLE END AS avg_n FROM n),
x AS (SELECT *, (avg_n - lines) / nullif(avg_n, 0) * 100 AS pct FROM a)
"""


def _order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = bd.table(spark, sf_dir, "orders")
    return orders.select(
        F.concat(F.lit("C"), "o_custkey").alias("ticker"), F.lit("tick").alias("fidelity"), F.to_date("o_orderdate").alias("start")
    )


def job_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = hist.earliest_starts(_order_months(spark, sf_dir), ["ticker"], "start", ORDERS_AS_OF)
    return starts.withColumn("job_start", _iso("job_start"))


def _chunks(df: DataFrame) -> DataFrame:
    return hist.with_file_name(df).select(
        "ticker", *[_iso(name).alias(name) for name in ("month", "chunk_start", "chunk_end")], "is_partial", "file_name"
    )


def month_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _order_months(spark, sf_dir)
    return _chunks(hist.expected_months(files, ["ticker", "fidelity"], "start", ORDERS_AS_OF))


def missing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _order_months(spark, sf_dir)
    return _chunks(hist.missing_months(files, ["ticker", "fidelity"], "start", ORDERS_AS_OF))


_END = f"DATE '{ORDERS_AS_OF.isoformat()}'"
_CHUNK_SQL = f"""WITH j AS (
  SELECT o_custkey, least(min(CAST(o_orderdate AS DATE)), {_END}) AS s FROM orders GROUP BY 1),
m AS (
  SELECT o_custkey, s, CAST(unnest(generate_series(date_trunc('month', s)::TIMESTAMP, {_END}::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS month
  FROM j),
c AS (
  SELECT o_custkey, month, greatest(month, s) AS cs, least(last_day(month), {_END}) AS ce FROM m),
chunks AS (
  SELECT concat('C', o_custkey) AS ticker, strftime(month, '%Y-%m-%d') AS month, strftime(cs, '%Y-%m-%d') AS chunk_start,
         strftime(ce, '%Y-%m-%d') AS chunk_end, ce < last_day(month) AS is_partial,
         concat('C', o_custkey, '_tick_', strftime(cs, '%Y-%m-%d'), '_to_', strftime(ce, '%Y-%m-%d'), '.parquet') AS file_name
  FROM c)"""


def history_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of monthly files, some of them debug samples, parsed back into an inventory."""
    orders = bd.table(spark, sf_dir, "orders").withColumns(
        {
            "ticker": F.concat(F.lit("C"), "o_custkey"),
            "fidelity": F.when(F.col("o_orderkey") % 3 == 0, "day").otherwise("15 minute"),
            "chunk_start": F.to_date("o_orderdate"),
            "chunk_end": F.last_day("o_orderdate"),
        }
    )
    name = F.when(F.col("o_orderkey") % 10 == 0, F.concat("ticker", F.lit("_"), fid.folder(F.col("fidelity")), F.lit("_DEBUG.csv")))
    files = hist.with_file_name(orders).select(
        F.concat_ws("/", F.lit("/lake/history"), "ticker", fid.folder(F.col("fidelity")), F.coalesce(name, "file_name")).alias("path"),
        F.col("o_orderkey").alias("length"),
    )
    parsed = hist.parse_inventory(files)
    return parsed.select("ticker", "fidelity", _iso("start_date").alias("start_date"), _iso("end_date").alias("end_date"), "extension", "size")


def ticker_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = bd.table(spark, sf_dir, "orders")
    inventory = orders.select(
        F.concat(F.lit("C"), "o_custkey").alias("ticker"),
        F.when(F.col("o_orderkey") % 2 == 0, "tick").otherwise("day").alias("fidelity"),
        F.when(F.col("o_orderkey") % 2 == 0, "parquet").otherwise("csv").alias("extension"),
        F.col("o_orderkey").alias("size"),
    )
    return landed.tick_universe(inventory)


def valid_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = tgt.with_range(tgt.valid_targets(bd.targets(spark, sf_dir)), bd.AS_OF)
    return good.select("ticker", "ticker_fidelity", "duration_months", _iso("start_date").alias("start_date"), _iso("end_date").alias("end_date"))


def rejected_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected targets as error-log rows; the log time is fixed so that runs agree."""
    _, rejected = tgt.history_jobs(bd.targets(spark, sf_dir), bd.AS_OF)
    return error_rows(
        rejected,
        "targets",
        F.lit("2024-01-31 00:00:00").cast("timestamp"),
        ticker=F.col("ticker"),
        fidelity=F.col("ticker_fidelity"),
        reason=F.col("reject_reason"),
    )


def history_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, _ = tgt.history_jobs(bd.targets(spark, sf_dir), bd.AS_OF)
    return jobs.select("ticker", "multiplier", "timespan", _iso("chunk_start").alias("chunk_start"), _iso("chunk_end").alias("chunk_end"))


_TARGET_SQL = f"""WITH t AS (
  SELECT c_name AS ticker, {bd.FIDELITY} AS ticker_fidelity, c_custkey,
         CASE WHEN c_custkey % 10 = 9 THEN 'n/a' ELSE CAST(c_custkey % 25 AS VARCHAR) END AS raw FROM customer),
k AS (
  SELECT *, CAST(try_cast(raw AS DOUBLE) AS INTEGER) AS months,
         CASE WHEN ticker_fidelity = '' THEN 'missing fidelity' WHEN raw = '0' THEN 'missing duration'
              WHEN raw = 'n/a' THEN 'invalid duration' END AS reason FROM t)"""
_AS_OF = f"DATE '{bd.AS_OF.isoformat()}'"


def _parsed(spark: SparkSession, sf_dir: str, parser) -> DataFrame:
    rows = bd.table(spark, sf_dir, "customer").select("c_custkey", F.expr(bd.MIXED_FIDELITY).alias("fidelity"))
    return rows.withColumn("_p", parser(F.col("fidelity"))).select("c_custkey", "_p.multiplier", "_p.timespan")


def parse_fidelity_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, fid.historical)


def parse_fidelity_tech(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, fid.technical)


def _parse_sql(words: list[str], pattern: str) -> str:
    listed = ", ".join(f"'{word}'" for word in words)
    return f"""WITH f AS (SELECT c_custkey, trim(lower({bd.MIXED_FIDELITY})) AS x FROM customer)
SELECT c_custkey,
  CASE WHEN x IN ({listed}) THEN 1 WHEN regexp_matches(x, '{pattern}') THEN CAST(regexp_extract(x, '{pattern}', 1) AS BIGINT) END AS multiplier,
  CASE WHEN x IN ({listed}) THEN x WHEN regexp_matches(x, '{pattern}') THEN regexp_extract(x, '{pattern}', 2) END AS timespan FROM f"""


def target_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = fixed.CORPORATE_ACTIONS + fixed.FUNDAMENTALS + fixed.INDICATORS + fixed.FORM_FAMILIES
    return tgt.fan_out(bd.targets(spark, sf_dir).select("ticker"), names)


def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders inside each customer's target window."""
    orders = bd.table(spark, sf_dir, "orders").select(
        F.format_string("Customer#%09d", "o_custkey").alias("ticker"), "o_orderkey", F.to_date("o_orderdate").alias("date")
    )
    windows = tgt.with_range(tgt.valid_targets(bd.targets(spark, sf_dir)), ORDERS_AS_OF)
    # Every target twice, and once more as two halves that overlap: a row still comes once.
    middle = F.date_add("start_date", F.expr("CAST(datediff(end_date, start_date) div 2 AS INT)"))
    halves = windows.withColumn("end_date", middle).unionByName(windows.withColumn("start_date", F.date_sub(middle, 1)))
    found = tgt.range_scan(orders, windows.unionByName(windows).unionByName(halves), "date")
    return found.select("ticker", "o_orderkey", *[_iso(n).alias(n) for n in ("date", "start_date", "end_date")])


_DATED = Dataset("orders", "o_custkey", date="o_orderdate")


def dataset_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue scans: dated orders within two years, trades of five days, counted by their key."""
    orders = scan(bd.table(spark, sf_dir, "orders"), _DATED, None, dt.date(1996, 1, 1), dt.date(1997, 12, 31))
    trades = scan(bd.trades(spark, sf_dir), DATASETS["trades"], "view", dt.date(2024, 1, 3), dt.date(2024, 1, 7))
    by_year = orders.groupBy(F.year("o_orderdate").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    by_ticker = trades.groupBy(F.col("ticker").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return by_year.unionByName(by_ticker)


def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last day of a dated series, per priority class."""
    orders = bd.table(spark, sf_dir, "orders")
    ends = orders.groupBy("o_orderpriority").agg(F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"))
    return ends.select("o_orderpriority", _iso("first_day").alias("first_day"), _iso("last_day").alias("last_day"))


def overview_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = bd.table(spark, sf_dir, "nation").join(
        bd.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = bd.table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    overviews = customers.select(
        F.col("c_name").alias("ticker"),
        F.when(
            F.col("c_custkey") % 13 > 0,
            F.struct(
                F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("address1"),
                F.col("n_name").alias("city"),
                F.when(F.col("c_custkey") % 4 > 0, F.col("r_name")).otherwise("").alias("state"),
                F.when(F.col("c_custkey") % 5 > 0, F.col("c_nationkey").cast("string")).alias("postal_code"),
            ),
        ).alias("address"),
        F.struct(F.col("c_name").alias("logo_url")).alias("branding"),
    )
    return ref.clean_overview(overviews)


def related_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Related-company answers with two named entries, one of them null now and then, per line."""
    answers = bd.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("ticker"),
        F.array(
            F.struct(F.concat(F.lit("S"), "l_suppkey").alias("ticker")),
            F.struct(F.when(F.col("l_linenumber") % 3 > 0, F.concat(F.lit("L"), "l_linenumber")).alias("ticker")),
        ).alias("results"),
    )
    return ref.related_edges(answers)


def cik_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bd.table(spark, sf_dir, "customer").select("c_custkey", F.expr(bd.RAW_CIK).alias("CIK"))
    return ref.normalized_targets(rows).drop("CIK")


def cik_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickers of customers; suppliers are the primary mapping, a part of the customers is the fallback."""
    customers = bd.table(spark, sf_dir, "customer")
    tickers = customers.select(F.concat(F.lit("id-"), "c_custkey").alias("ticker"))
    suppliers = bd.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("id-"), "s_suppkey").alias("ticker"),
        F.when(F.col("s_suppkey") % 4 > 0, F.col("s_suppkey").cast("string")).otherwise("").alias("cik"),
        "s_suppkey",
    )
    repeated = suppliers.unionByName(suppliers.withColumns({"cik": F.lit("later"), "s_suppkey": F.col("s_suppkey") + 10**9}).filter("cik <> ''"))
    fallback = customers.filter("c_custkey % 2 = 0").select(
        F.concat(F.lit("ID-"), "c_custkey").alias("ticker"), F.col("c_custkey").alias("cik_str"), "c_custkey"
    )
    return ref.resolve_cik(tickers, repeated, fallback, "s_suppkey", "c_custkey")


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = ref.latest_snapshot(bd.table(spark, sf_dir, "orders"), "o_orderdate")
    return ref.unique_tickers(newest, "o_custkey")


def standardize_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One instant as epoch milliseconds, as text and as a small number, standardised each in turn."""
    events = bd.table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        F.when(F.col("event_id") % 7 > 0, F.date_format("ts", "yyyy-MM-dd")).otherwise("no date").alias("text"),
        F.col("event_id").alias("small"),
    )
    for name, out in (("ms", "from_ms"), ("text", "from_text"), ("small", "from_small")):
        events = standardize_timestamp(events, name).withColumnRenamed("timestamp", out)
    shown = [F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSS").alias(n) for n in ("from_ms", "from_text", "from_small")]
    return events.select("event_id", *shown)


def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = bd.trades(spark, sf_dir).withColumn("size", F.col("size").cast("string"))
    return conform(trades, TRADES).withColumn("conditions", F.to_json("conditions"))


def queries() -> dict:
    names = (
        neighbor_anomalies, anomaly_report, job_starts, month_chunks, missing_months, history_inventory,
        ticker_universe, valid_targets, rejected_targets, history_jobs, parse_fidelity_hist, parse_fidelity_tech,
        target_fanout, range_scan, dataset_scan, date_range, overview_address, related_edges, cik_normalize,
        cik_resolve, latest_snapshot, standardize_ts, conform_schema,
    )
    return {function.__name__: function for function in names}


def oracle_sql() -> dict[str, str]:
    names = fixed.CORPORATE_ACTIONS + fixed.FUNDAMENTALS + fixed.INDICATORS + fixed.FORM_FAMILIES
    listed = ", ".join(f"'{name}'" for name in names)
    iso = "strftime({0}, '%Y-%m-%d')".format
    return {
        "neighbor_anomalies": _ANOMALY_SQL
        + f"SELECT l_suppkey, {iso('month')} AS month, lines, avg_n AS neighbor_avg, round(pct, 2) AS percent_smaller FROM x WHERE pct > 20",
        "anomaly_report": _ANOMALY_SQL
        + f""", y AS (SELECT *, concat('S', l_suppkey, '_15-minute_', {iso('month')}, '_to_', {iso('last_day(month)')}, '.parquet') AS f0 FROM x WHERE pct > 20)
SELECT concat('S', l_suppkey) AS ticker, '15 minute' AS fidelity, f0 AS file_name, round(lines * 1000 / 1024::DOUBLE, 2) AS file_size_kb,
  round(avg_n * 1000 / 1024, 2) AS neighbor_avg_size_kb, round(pct, 2) AS percent_smaller,
  concat('File is ', CAST(round(pct, 2) AS VARCHAR), '% smaller than its neighbors.') AS reason,
  concat('/history/S', l_suppkey, '/15-minute/', f0) AS full_path, '' AS ignore FROM y""",
        "job_starts": f"SELECT concat('C', o_custkey) AS ticker, {iso(f'least(min(CAST(o_orderdate AS DATE)), {_END})')} AS job_start FROM orders GROUP BY o_custkey",
        "month_chunks": _CHUNK_SQL + " SELECT * FROM chunks",
        "missing_months": _CHUNK_SQL
        + """ SELECT * FROM chunks k WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE concat('C', o.o_custkey) = k.ticker
AND strftime(date_trunc('month', o.o_orderdate), '%Y-%m-%d') = k.month)""",
        "history_inventory": f"""SELECT concat('C', o_custkey) AS ticker, CASE WHEN o_orderkey % 3 = 0 THEN 'day' ELSE '15 minute' END AS fidelity,
  {iso('o_orderdate')} AS start_date, {iso('last_day(o_orderdate)')} AS end_date,
  CASE WHEN o_orderkey % 3 = 0 THEN 'csv' ELSE 'parquet' END AS extension, o_orderkey AS size FROM orders WHERE o_orderkey % 10 <> 0""",
        "ticker_universe": "SELECT concat('C', o_custkey) AS ticker, CAST(count(*) AS BIGINT) AS files, CAST(sum(o_orderkey) AS BIGINT) AS bytes FROM orders WHERE o_orderkey % 2 = 0 GROUP BY o_custkey",
        "valid_targets": _TARGET_SQL
        + f" SELECT ticker, ticker_fidelity, months AS duration_months, {iso(f'{_AS_OF} - to_months(months)')} AS start_date, {iso(_AS_OF)} AS end_date FROM k WHERE reason IS NULL",
        "rejected_targets": _TARGET_SQL
        + """ SELECT '2024-01-31T00:00:00' AS log_timestamp_utc, 'targets' AS script_name, ticker, ticker_fidelity AS fidelity,
CAST(NULL AS VARCHAR) AS failed_chunk_start, CAST(NULL AS VARCHAR) AS failed_chunk_end,
CASE WHEN reason IS NULL THEN 'unreadable fidelity' ELSE reason END AS reason FROM k WHERE reason IS NOT NULL OR ticker_fidelity = '5-day'""",
        "history_jobs": _TARGET_SQL
        + f""", g AS (SELECT *, CAST({_AS_OF} - to_months(months) AS DATE) AS s FROM k WHERE reason IS NULL AND ticker_fidelity <> '5-day'),
m AS (SELECT *, CAST(unnest(generate_series(date_trunc('month', s)::TIMESTAMP, {_AS_OF}::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS month FROM g)
SELECT ticker, CAST(CASE WHEN ticker_fidelity = '15 minute' THEN 15 ELSE 1 END AS BIGINT) AS multiplier,
  CASE WHEN ticker_fidelity = '15 minute' THEN 'minute' ELSE lower(trim(ticker_fidelity)) END AS timespan,
  {iso('greatest(month, s)')} AS chunk_start, {iso(f'least(last_day(month), {_AS_OF})')} AS chunk_end FROM m""",
        "parse_fidelity_hist": _parse_sql(fixed.HISTORICAL_WORDS, r"^(\d+)\s+(\S+)$"),
        "parse_fidelity_tech": _parse_sql(fixed.TECHNICAL_WORDS, r"^(\d+)-([^-]*)$"),
        "target_fanout": f"SELECT c_name AS ticker, unnest([{listed}]) AS dataset FROM customer",
        "range_scan": _TARGET_SQL
        + f""", w AS (SELECT c_custkey, ticker, CAST({_END} - to_months(months) AS DATE) AS s FROM k WHERE reason IS NULL)
SELECT w.ticker, o_orderkey, {iso('o_orderdate')} AS date, {iso('s')} AS start_date, {iso(_END)} AS end_date
FROM orders JOIN w ON o_custkey = c_custkey AND CAST(o_orderdate AS DATE) BETWEEN s AND {_END}""",
        "dataset_scan": """SELECT CAST(year(o_orderdate) AS VARCHAR) AS key, CAST(count(*) AS BIGINT) AS n FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1
UNION ALL SELECT 'view', CAST(count(*) AS BIGINT) FROM events
WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-08'""",
        "date_range": f"SELECT o_orderpriority, {iso('min(o_orderdate)')} AS first_day, {iso('max(o_orderdate)')} AS last_day FROM orders GROUP BY 1",
        "overview_address": """SELECT c_name AS ticker, CASE WHEN c_custkey % 13 > 0 THEN concat_ws(', ',
  CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END, n_name, CASE WHEN c_custkey % 4 > 0 THEN r_name END,
  CASE WHEN c_custkey % 5 > 0 THEN CAST(c_nationkey AS VARCHAR) END) END AS address
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
        "related_edges": """SELECT concat('P', l_partkey) AS ticker, concat('S', l_suppkey) AS related_ticker FROM lineitem
UNION ALL SELECT concat('P', l_partkey), concat('L', l_linenumber) FROM lineitem WHERE l_linenumber % 3 > 0""",
        "cik_normalize": f"""WITH r AS (SELECT c_custkey, regexp_replace(coalesce({bd.RAW_CIK}, 'NOT_FOUND'), '\\.0$', '') AS x FROM customer)
SELECT c_custkey, x AS cik_clean, CASE WHEN regexp_matches(x, '^[0-9]+$') THEN ltrim(x, '0') ELSE 'NOT_FOUND' END AS cik_unpadded,
  CASE WHEN NOT regexp_matches(x, '^[0-9]+$') THEN 'NOT_FOUND' WHEN length(x) < 10 THEN lpad(x, 10, '0') ELSE x END AS cik_padded,
  NOT regexp_matches(x, '^[0-9]+$') AS needs_lookup FROM r""",
        "cik_resolve": """SELECT concat('id-', c_custkey) AS ticker, CASE WHEN s_suppkey IS NOT NULL AND s_suppkey % 4 > 0 THEN CAST(s_suppkey AS VARCHAR)
  WHEN s_suppkey IS NOT NULL THEN 'later' WHEN c_custkey % 2 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') ELSE 'NOT_FOUND' END AS CIK
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
        "latest_snapshot": "SELECT DISTINCT o_custkey AS ticker FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
        "standardize_ts": """SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS from_ms,
  CASE WHEN event_id % 7 > 0 THEN strftime(ts, '%Y-%m-%d 00:00:00.000') END AS from_text, CAST(NULL AS VARCHAR) AS from_small FROM events""",
        "conform_schema": """SELECT epoch_ns(ts) AS sip_timestamp, CAST(NULL AS BIGINT) AS participant_timestamp, CAST(NULL AS BIGINT) AS trf_timestamp,
  CAST(event_id AS VARCHAR) AS id, event_id AS sequence_number, CAST(NULL AS BIGINT) AS exchange, value AS price,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS conditions, CAST(NULL AS BIGINT) AS tape,
  CAST(NULL AS BIGINT) AS trf_id FROM events""",
    }
