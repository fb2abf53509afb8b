"""Queries over trades and bars, with the SQL they must agree with."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.functions import fidelity as fid
from tickframe.operators import bars as br
from tickframe.operators import indicators as ind
from tickframe.operators import integrity as itg
from tickframe.operators import liquidity as liq
from tickframe.plans import bindings as bd

# Thresholds scaled to the test table.
TIERS = [(1, 165_000.0, 66.5, 900.0, "Keep (High)"), (2, 150_000.0, 60.0, 1000.0, "Keep (Moderate)")]
SPARSE_TIERS = [(1, 4_000.0, 2.0, 20_000.0, "Keep (High)"), (2, 1_000.0, 1.5, 40_000.0, "Keep (Moderate)")]
LOOKBACK = 25
SPARSE_LOOKBACK = 2

_TRADES = """trades AS (
  SELECT event_type AS ticker, CAST(user_id AS VARCHAR) AS user_ticker, epoch_ns(ts) AS ns, event_id, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS size, ts
  FROM events)"""


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def daily_liquidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liq.daily_liquidity(bd.trades(spark, sf_dir)).withColumn("date", _day("date"))


def daily_liquidity_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liq.daily_liquidity(bd.trades(spark, sf_dir, "user_id")).withColumn("date", _day("date"))


def _daily_sql(ticker: str, where: str = "TRUE") -> str:
    return f"""gaps AS (
  SELECT {ticker} AS ticker, CAST(ts AS DATE) AS day, price, size,
         (ns - lag(ns) OVER (PARTITION BY {ticker}, CAST(ts AS DATE) ORDER BY ns)) // 1000000000 AS gap
  FROM trades WHERE {where}),
daily AS (
  SELECT ticker, strftime(day, '%Y-%m-%d') AS date, CAST(count(*) AS BIGINT) AS daily_trades,
         CAST(sum(CAST(price * size AS DECIMAL(22, 6))) AS DOUBLE) AS daily_dollar_volume,
         CAST(median(gap) AS DOUBLE) AS daily_mtbt_sec
  FROM gaps GROUP BY ticker, day)"""


def _screen(spark: SparkSession, sf_dir: str, ticker: str, days: int, tiers: list) -> DataFrame:
    recent = bd.trades(spark, sf_dir, ticker, bd.AS_OF, days)
    metrics = liq.liquidity_metrics(liq.daily_liquidity(recent))
    return liq.liquidity_report(metrics, bd.trades(spark, sf_dir, ticker), tiers)


def liquidity_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _screen(spark, sf_dir, "event_type", LOOKBACK, TIERS)


def liquidity_screen_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _screen(spark, sf_dir, "user_id", SPARSE_LOOKBACK, SPARSE_TIERS)


def liquidity_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liq.value_counts(liquidity_screen_sparse(spark, sf_dir), "Recommendation")


def _screen_sql(ticker: str, days: int, tiers: list) -> str:
    cutoff = bd.AS_OF - dt.timedelta(days=days)
    cases = " ".join(
        f"WHEN addv >= {a} AND adnt >= {n} AND mtbt <= {m} THEN {{{i}}}" for i, (_, a, n, m, _) in enumerate(tiers)
    )
    unusable = "addv IS NULL OR adnt IS NULL OR mtbt IS NULL OR addv = 0 OR adnt = 0"
    numbers = [t[0] for t in tiers]
    labels = [f"'{t[4]}'" for t in tiers]
    tier = f"CASE WHEN {unusable} THEN 99 {cases.format(*numbers)} ELSE 3 END"
    label = (
        f"CASE WHEN found IS NULL THEN NULL WHEN {unusable} THEN 'Error/Insufficient Data' {cases.format(*labels)} "
        "ELSE 'Remove (Illiquid)' END"
    )
    return f"""WITH {_TRADES}, {_daily_sql(ticker, f"ts >= TIMESTAMP '{cutoff.isoformat()}'")},
metrics AS (
  SELECT ticker, CAST(sum(CAST(daily_dollar_volume AS DECIMAL(22, 6))) AS DOUBLE) / count(*) AS addv,
         avg(daily_trades) AS adnt, median(daily_mtbt_sec) AS mtbt, TRUE AS found
  FROM daily GROUP BY ticker),
universe AS (SELECT DISTINCT {ticker} AS ticker FROM trades),
screened AS (
  SELECT u.ticker, CAST(round(CAST(coalesce(addv, 0) AS DECIMAL(30, 6)), 2) AS DOUBLE) AS ADDV, adnt AS ADNT,
         round(mtbt, 2) AS Median_Time_Between_Trades_Sec, CAST({tier} AS INTEGER) AS Liquidity_Tier,
         {label} AS Recommendation, CASE WHEN found IS NULL THEN 'No data in lookback period' END AS error
  FROM universe u LEFT JOIN metrics m ON u.ticker = m.ticker)"""


def daily_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itg.daily_integrity(bd.trades(spark, sf_dir)).withColumn("date", _day("date"))


def _local_dates(df: DataFrame) -> DataFrame:
    return df.withColumn("start_date_et", _day("start_date_et")).withColumn("end_date_et", _day("end_date_et"))


def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = itg.integrity_summary(bd.trades(spark, sf_dir, "user_id"))
    return itg.order_integrity_report(_local_dates(summary))


def integrity_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integrity against a calendar: weekdays without any trading-hours trade count as zero-volume days."""
    trades = bd.trades(spark, sf_dir, "user_id")
    days = bd.table(spark, sf_dir, "events").select(F.to_date("ts").alias("date")).distinct()
    sessions = days.filter(F.weekday("date") < 5)
    return itg.order_integrity_report(_local_dates(itg.integrity_summary(trades, calendar=sessions)))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _local_dates(itg.coverage(bd.trades(spark, sf_dir)))


_ET = "(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York')"


def _integrity_sql(ticker: str) -> str:
    return f"""WITH {_TRADES}, et AS (SELECT {ticker} AS ticker, ns, {_ET} AS local FROM trades),
rth AS (
  SELECT ticker, CAST(local AS DATE) AS day,
         (ns - lag(ns) OVER (PARTITION BY ticker, CAST(local AS DATE) ORDER BY ns)) // 1000000000 AS gap
  FROM et WHERE CAST(local AS TIME) BETWEEN TIME '09:30:00' AND TIME '16:00:00'),
daily AS (
  SELECT ticker, day, CAST(count(*) AS BIGINT) AS daily_rth_trades,
         CAST(count(*) FILTER (WHERE gap > 900) AS BIGINT) AS significant_gaps_count, max(gap) AS max_gap_sec
  FROM rth GROUP BY ticker, day),
cover AS (SELECT ticker, CAST(min(local) AS DATE) AS first_day, CAST(max(local) AS DATE) AS last_day
  FROM et GROUP BY ticker),
summed AS (
  SELECT ticker, CAST(count(*) AS BIGINT) AS days_seen,
         CAST(count(*) FILTER (WHERE significant_gaps_count > 0) AS BIGINT) AS gap_days,
         max(max_gap_sec) FILTER (WHERE significant_gaps_count > 0) AS worst
  FROM daily GROUP BY ticker)"""


def _report_sql(zero_days: str) -> str:
    return f"""SELECT c.ticker,
  CASE WHEN days_seen IS NULL THEN 'No RTH Data Found' WHEN {zero_days} > 0 OR gap_days > 0 THEN 'Anomalies Detected'
       ELSE 'Healthy' END AS status,
  CASE WHEN days_seen IS NOT NULL THEN strftime(first_day, '%Y-%m-%d') END AS start_date_et,
  CASE WHEN days_seen IS NOT NULL THEN strftime(last_day, '%Y-%m-%d') END AS end_date_et,
  days_seen AS total_trading_days_rth, CAST({zero_days} AS BIGINT) AS days_zero_rth_volume,
  coalesce(gap_days, 0) AS days_with_significant_gaps, CAST(coalesce(worst, 0) AS DOUBLE) AS max_intraday_gap_sec
FROM cover c LEFT JOIN summed s ON c.ticker = s.ticker"""


def _bars(spark: SparkSession, sf_dir: str, multiplier: int, timespan: str) -> DataFrame:
    return br.bars(bd.trades(spark, sf_dir), multiplier, timespan)


def bars_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(spark, sf_dir, 15, "minute").withColumn("vw", F.round("vw", 6))


def bars_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(spark, sf_dir, 1, "day").withColumn("vw", F.round("vw", 6))


def bars_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(spark, sf_dir, 1, "week").withColumn("vw", F.round("vw", 6))


def _bar_targets(trades: DataFrame) -> DataFrame:
    """Each ticker at four fidelities with ranges of one to four weeks, one fidelity unknown."""
    wanted = F.expr(
        "array(named_struct('text', '15 minute', 'days', 6), named_struct('text', '2 hour', 'days', 13), "
        "named_struct('text', 'day', 'days', 20), named_struct('text', 'week', 'days', 27), named_struct('text', '3 foo', 'days', 27))"
    )
    return trades.select("ticker").distinct().withColumn("_w", F.explode(wanted)).select(
        "ticker",
        F.when(F.col("_w.text") == "week", fid.technical(F.col("_w.text"))).otherwise(fid.historical(F.col("_w.text"))).alias("_p"),
        F.lit(dt.date(2024, 1, 2)).alias("start_date"),
        F.date_add(F.lit(dt.date(2024, 1, 2)), F.col("_w.days")).alias("end_date"),
    ).select("ticker", "_p.*", "start_date", "end_date")


def target_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = bd.trades(spark, sf_dir)
    return br.target_bars(trades, _bar_targets(trades)).withColumn("vw", F.round("vw", 6)).drop("start_date", "end_date")


#: Twenty targets a ticker: their fidelities in turn, ranges that overlap, nest and touch, whole days from 2024-01-01 on.
_MANY_FIDELITIES = [(15, "minute"), (2, "hour"), (1, "day"), (1, "week"), (7, "minute"), (1, "month"), (90, "minute")]
_MANY_TARGETS = [(*_MANY_FIDELITIES[i % 7], 3 * i % 17, 2 + 5 * i % 13) for i in range(20)]


def target_bars_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of twenty overlapping targets per ticker, trades of one instant told apart by their sequence."""
    trades = bd.trades(spark, sf_dir)
    first = dt.date(2024, 1, 1)
    ranges = [(m, s, first + dt.timedelta(a), first + dt.timedelta(a + n)) for m, s, a, n in _MANY_TARGETS]
    names = ("multiplier", "timespan", "start_date", "end_date")
    each = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in ranges))
    targets = trades.select("ticker").distinct().withColumn("_w", F.explode(each)).select("ticker", "_w.*")
    targets = targets.withColumn("multiplier", F.col("multiplier").cast("bigint"))
    bars = br.target_bars(trades, targets, sequence="sequence_number").withColumn("vw", F.round("vw", 6))
    return bars.withColumns({name: _day(name) for name in ("start_date", "end_date")})


def _overlapping_sql() -> str:
    parts = []
    for multiplier, timespan, start, days in _MANY_TARGETS:
        width = br.FIXED_SECONDS.get(timespan, 0) * multiplier * 1000
        t = f"ns // {width * 1_000_000} * {width}" if width else f"epoch_ms(date_trunc('{timespan}', ts))"
        a, b = (dt.date(2024, 1, 1) + dt.timedelta(n) for n in (start, start + days))
        bar = _bars_sql(t).replace("bar AS (", "(", 1).replace("arg_min(price, ns)", "first(price ORDER BY ns, event_id)")
        bar = bar.replace("arg_max(price, ns)", "last(price ORDER BY ns, event_id)")
        bar = bar.replace("FROM trades", f"FROM trades WHERE ts >= TIMESTAMP '{a}' AND ts < TIMESTAMP '{b + dt.timedelta(1)}'")
        parts.append(
            f"SELECT CAST({multiplier} AS BIGINT) AS multiplier, '{timespan}' AS timespan, '{a}' AS start_date, '{b}' AS end_date, b.* FROM {bar} b"
        )
    return f"WITH {_TRADES} " + " UNION ALL ".join(parts)


def rejected_bar_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of :func:`target_bars` that give no bars, each ticker also with a double week."""
    targets = _bar_targets(bd.trades(spark, sf_dir))
    weeks = targets.filter("timespan = 'week'").withColumn("multiplier", F.lit(2).cast("bigint"))
    return br.rejected_bar_targets(targets.unionByName(weeks)).select("ticker", "multiplier", "timespan", "reject_reason")


def target_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving averages over bars of several fidelities per ticker, each fidelity a series of its own."""
    trades = bd.trades(spark, sf_dir)
    bars = br.target_bars(trades, _bar_targets(trades))
    keys = ["ticker", "multiplier", "timespan"]
    both = ind.ema(ind.sma(bars, 5, keys), 5, keys)
    return both.select(*keys, "t", F.round("sma", 6).alias("sma"), F.round("ema", 6).alias("ema"))


def _target_indicators_sql() -> str:
    return f"""WITH RECURSIVE bars AS ({_target_bars_sql()}),
o AS (SELECT *, row_number() OVER w AS i, CASE WHEN count(*) OVER f = 5 THEN avg(c) OVER f END AS sma FROM bars
  WINDOW w AS (PARTITION BY ticker, multiplier, timespan ORDER BY t),
  f AS (PARTITION BY ticker, multiplier, timespan ORDER BY t ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
e AS (SELECT ticker, multiplier, timespan, i, c AS ema FROM o WHERE i = 1
  UNION ALL SELECT o.ticker, o.multiplier, o.timespan, o.i, e.ema * (1 - 2.0::DOUBLE / 6) + o.c * (2.0::DOUBLE / 6)
  FROM e JOIN o ON o.ticker = e.ticker AND o.multiplier = e.multiplier AND o.timespan = e.timespan AND o.i = e.i + 1)
SELECT o.ticker, o.multiplier, o.timespan, o.t, round(sma, 6) AS sma, round(ema, 6) AS ema
FROM o JOIN e ON o.ticker = e.ticker AND o.multiplier = e.multiplier AND o.timespan = e.timespan AND o.i = e.i"""


def _target_bars_sql() -> str:
    jobs = [(15, "minute", 6, "ns // 900000000000 * 900000"), (2, "hour", 13, "ns // 7200000000000 * 7200000"),
            (1, "day", 20, _DAY_MS), (1, "week", 27, "epoch_ms(date_trunc('week', ts))")]
    parts = []
    for multiplier, timespan, days, start in jobs:
        bar = _bars_sql(start).replace("bar AS (", "(", 1).replace(
            "FROM trades", f"FROM trades WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-03' + INTERVAL {days} DAY"
        )
        parts.append(f"SELECT CAST({multiplier} AS BIGINT) AS multiplier, '{timespan}' AS timespan, b.* FROM {bar} b")
    return f"WITH {_TRADES} " + " UNION ALL ".join(parts)


def _bars_sql(start_ms: str, round_vw: bool = True) -> str:
    vw = "CAST(sum(CAST(price * size AS DECIMAL(22, 6))) AS DOUBLE) / nullif(CAST(sum(size) AS DOUBLE), 0)"
    vw = f"round({vw}, 6)" if round_vw else vw
    return f"""bar AS (
  SELECT ticker, CAST({start_ms} AS BIGINT) AS t, arg_min(price, ns) AS o, max(price) AS h, min(price) AS l,
         arg_max(price, ns) AS c, CAST(sum(size) AS DOUBLE) AS v, {vw} AS vw, CAST(count(*) AS BIGINT) AS n
  FROM trades GROUP BY 1, 2)"""


_DAY_MS = "ns // 86400000000000 * 86400000"


def sma(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = ind.sma(_bars(spark, sf_dir, 1, "hour"), 50)
    return daily.select("ticker", "t", F.round("sma", 6).alias("sma"))


def ema(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ind.ema(_bars(spark, sf_dir, 1, "hour"), 50, block_rows=256)
    return values.select("ticker", "t", F.round("ema", 6).alias("ema"))


def macd(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ind.macd(_bars(spark, sf_dir, 1, "hour"), block_rows=256)
    return values.select("ticker", "t", *[F.round(n, 6).alias(n) for n in ("macd", "signal", "histogram")])


def rsi(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ind.rsi(_bars(spark, sf_dir, 1, "hour"), block_rows=256)
    return values.select("ticker", "t", F.round("rsi", 6).alias("rsi"))


_HOUR_MS = "ns // 3600000000000 * 3600000"
_ORDERED = f"""{_bars_sql(_HOUR_MS)},
b AS (SELECT ticker, t, c, row_number() OVER (PARTITION BY ticker ORDER BY t) AS i,
             c - lag(c) OVER (PARTITION BY ticker ORDER BY t) AS d FROM bar)"""

_EMA_SQL = f"""WITH RECURSIVE {_TRADES}, {_ORDERED},
r AS (
  SELECT ticker, t, i, c AS ema FROM b WHERE i = 1
  UNION ALL
  SELECT b.ticker, b.t, b.i, (1 - 2.0::DOUBLE / 51) * r.ema + 2.0::DOUBLE / 51 * b.c
  FROM r JOIN b ON b.ticker = r.ticker AND b.i = r.i + 1)
SELECT ticker, t, round(ema, 6) AS ema FROM r"""

_MACD_SQL = f"""WITH RECURSIVE {_TRADES}, {_ORDERED},
r AS (
  SELECT ticker, t, i, c AS fast, c AS slow, 0.0::DOUBLE AS signal FROM b WHERE i = 1
  UNION ALL
  SELECT x.ticker, x.t, x.i, x.fast, x.slow, 0.8::DOUBLE * x.before + 0.2::DOUBLE * (x.fast - x.slow)
  FROM (SELECT b.ticker, b.t, b.i, 11.0::DOUBLE / 13 * r.fast + 2.0::DOUBLE / 13 * b.c AS fast,
               25.0::DOUBLE / 27 * r.slow + 2.0::DOUBLE / 27 * b.c AS slow, r.signal AS before
        FROM r JOIN b ON b.ticker = r.ticker AND b.i = r.i + 1) x)
SELECT ticker, t, round(fast - slow, 6) AS macd, round(signal, 6) AS signal,
       round(fast - slow - signal, 6) AS histogram FROM r"""

_RSI_SQL = f"""WITH RECURSIVE {_TRADES}, {_ORDERED},
seed AS (
  SELECT ticker, avg(greatest(d, 0)) AS g, avg(greatest(-d, 0)) AS l FROM b WHERE i BETWEEN 2 AND 15
  GROUP BY ticker HAVING count(*) = 14),
r AS (
  SELECT b.ticker, b.t, b.i, g, l FROM b JOIN seed ON b.ticker = seed.ticker AND b.i = 15
  UNION ALL
  SELECT b.ticker, b.t, b.i, (13 * r.g + greatest(b.d, 0)) / 14, (13 * r.l + greatest(-b.d, 0)) / 14
  FROM r JOIN b ON b.ticker = r.ticker AND b.i = r.i + 1)
SELECT b.ticker, b.t,
  CASE WHEN r.i IS NULL THEN NULL WHEN r.l = 0 THEN 100.0::DOUBLE ELSE round(100 - 100 / (1 + r.g / r.l), 6) END AS rsi
FROM b LEFT JOIN r ON b.ticker = r.ticker AND b.i = r.i"""


def split_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars adjusted for three splits per ticker, one of them on the first day."""
    daily = _bars(spark, sf_dir, 1, "day")
    tickers = bd.trades(spark, sf_dir).select("ticker").distinct()
    splits = tickers.withColumn(
        "_s",
        F.explode(
            F.expr(
                "array(named_struct('execution_date', '2024-01-01', 'split_to', 3D, 'split_from', 1D), "
                "named_struct('execution_date', '2024-01-10', 'split_to', 2D, 'split_from', 1D), "
                "named_struct('execution_date', '2024-01-20', 'split_to', 1D, 'split_from', 4D))"
            )
        ),
    ).select("ticker", "_s.*")
    adjusted = br.split_adjusted(daily, splits)
    return adjusted.select(
        "ticker", "t", *[F.round(name, 6).alias(name) for name in ("o", "h", "l", "c", "v", "vw")], "n"
    )


_FACTOR = "(CASE WHEN t < 1704844800000 THEN 2.0::DOUBLE ELSE 1.0 END * CASE WHEN t < 1705708800000 THEN 0.25::DOUBLE ELSE 1.0 END)"


def queries() -> dict:
    return {
        "daily_liquidity": daily_liquidity,
        "daily_liquidity_sparse": daily_liquidity_sparse,
        "liquidity_screen": liquidity_screen,
        "liquidity_screen_sparse": liquidity_screen_sparse,
        "liquidity_tier_counts": liquidity_tier_counts,
        "daily_integrity": daily_integrity,
        "integrity_report": integrity_report,
        "integrity_sessions": integrity_sessions,
        "coverage": coverage,
        "bars_15m": bars_15m,
        "bars_1d": bars_1d,
        "bars_week": bars_week,
        "target_bars": target_bars,
        "target_bars_overlapping": target_bars_overlapping,
        "rejected_bar_targets": rejected_bar_targets,
        "target_indicators": target_indicators,
        "sma": sma,
        "ema": ema,
        "macd": macd,
        "rsi": rsi,
        "split_adjusted": split_adjusted,
    }


def oracle_sql() -> dict[str, str]:
    sparse = _screen_sql("user_ticker", SPARSE_LOOKBACK, SPARSE_TIERS)
    silent = """, sessions AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE isodow(ts) < 6),
silent AS (
  SELECT c.ticker, count(*) AS zero FROM cover c JOIN sessions x ON x.day BETWEEN c.first_day AND c.last_day
  WHERE NOT EXISTS (SELECT 1 FROM daily d WHERE d.ticker = c.ticker AND d.day = x.day) GROUP BY c.ticker)
"""
    adjusted = ", ".join(f"round({n} / {_FACTOR}, 6) AS {n}" for n in ("o", "h", "l", "c", "vw"))
    return {
        "daily_liquidity": f"WITH {_TRADES}, {_daily_sql('ticker')} SELECT * FROM daily",
        "daily_liquidity_sparse": f"WITH {_TRADES}, {_daily_sql('user_ticker')} SELECT * FROM daily",
        "liquidity_screen": _screen_sql("ticker", LOOKBACK, TIERS) + " SELECT * FROM screened",
        "liquidity_screen_sparse": sparse + " SELECT * FROM screened",
        "liquidity_tier_counts": sparse
        + " SELECT Recommendation, CAST(count(*) AS BIGINT) AS n FROM screened WHERE Recommendation IS NOT NULL GROUP BY 1",
        "daily_integrity": _integrity_sql("ticker")
        + " SELECT ticker, strftime(day, '%Y-%m-%d') AS date, daily_rth_trades, significant_gaps_count, max_gap_sec FROM daily",
        "integrity_report": _integrity_sql("user_ticker") + _report_sql("0"),
        "integrity_sessions": _integrity_sql("user_ticker")
        + silent
        + _report_sql("CASE WHEN days_seen IS NULL THEN 0 ELSE coalesce(zero, 0) END").replace(
            "FROM cover c LEFT", "FROM cover c LEFT JOIN silent z ON c.ticker = z.ticker LEFT"
        ),
        "coverage": _integrity_sql("ticker")
        + " SELECT ticker, strftime(first_day, '%Y-%m-%d') AS start_date_et, strftime(last_day, '%Y-%m-%d') AS end_date_et FROM cover",
        "bars_15m": f"WITH {_TRADES}, {_bars_sql('ns // 900000000000 * 900000')} SELECT * FROM bar",
        "bars_1d": f"WITH {_TRADES}, {_bars_sql(_DAY_MS)} SELECT * FROM bar",
        "bars_week": f"WITH {_TRADES}, {_bars_sql('epoch_ms(date_trunc(' + chr(39) + 'week' + chr(39) + ', ts))')} SELECT * FROM bar",
        "target_bars": _target_bars_sql(),
        "target_bars_overlapping": _overlapping_sql(),
        "rejected_bar_targets": """SELECT DISTINCT event_type AS ticker, CAST(3 AS BIGINT) AS multiplier, 'foo' AS timespan, 'unknown span' AS reject_reason FROM events
UNION ALL SELECT DISTINCT event_type, 2, 'week', 'multiple of a calendar span' FROM events""",
        "target_indicators": _target_indicators_sql(),
        "sma": f"WITH {_TRADES}, {_ORDERED} SELECT ticker, t, CASE WHEN i >= 50 THEN round(avg(c) OVER "
        "(PARTITION BY ticker ORDER BY t ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 6) END AS sma FROM b",
        "ema": _EMA_SQL,
        "macd": _MACD_SQL,
        "rsi": _RSI_SQL,
        "split_adjusted": f"WITH {_TRADES}, {_bars_sql(_DAY_MS, False)} SELECT ticker, t, {adjusted}, "
        f"round(v * {_FACTOR}, 6) AS v, n FROM bar",
    }
