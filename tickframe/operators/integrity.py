"""Intraday-gap integrity of tick history in the market's own time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe import fixed
from tickframe.functions.instants import in_trading_hours, local_date
from tickframe.operators.gaps import gap_counts

_IN_HOURS = "_in_hours"


def _daily(
    trades: DataFrame,
    ticker: str,
    ts: str,
    zone: str,
    opens: str,
    closes: str,
    threshold: int,
) -> DataFrame:
    """Per (ticker, local day, inside or outside trading hours): rows, large gaps, largest gap, first and last."""
    rows = trades.select(
        F.col(ticker).alias("ticker"),
        ts,
        local_date(F.col(ts), zone).alias("date"),
        in_trading_hours(F.col(ts), opens, closes, zone).alias(_IN_HOURS),
    )
    counts = gap_counts(rows, ["ticker", "date", _IN_HOURS], ts)
    return counts.groupBy("ticker", "date", _IN_HOURS).agg(
        F.sum("n").alias("daily_rth_trades"),
        F.coalesce(F.sum(F.when(F.col("gap_sec") > threshold, F.col("n"))), F.lit(0)).alias("significant_gaps_count"),
        F.max("gap_sec").alias("max_gap_sec"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )


def daily_integrity(
    trades: DataFrame,
    ticker: str = "ticker",
    ts: str = "sip_timestamp",
    zone: str = fixed.MARKET_ZONE,
    opens: str = fixed.SESSION_OPEN,
    closes: str = fixed.SESSION_CLOSE,
    threshold: int = fixed.SIGNIFICANT_GAP_SECONDS,
) -> DataFrame:
    """Trading-hours rows, gaps above ``threshold`` whole seconds and the largest gap per (ticker, local day)."""
    rows = trades.filter(in_trading_hours(F.col(ts), opens, closes, zone))
    daily = _daily(rows, ticker, ts, zone, opens, closes, threshold)
    return daily.select("ticker", "date", "daily_rth_trades", "significant_gaps_count", "max_gap_sec")


def coverage(
    trades: DataFrame, ticker: str = "ticker", ts: str = "sip_timestamp", zone: str = fixed.MARKET_ZONE
) -> DataFrame:
    """First and last local day per ticker, before any trading-hours filter."""
    ends = trades.groupBy(F.col(ticker).alias("ticker")).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    return ends.select(
        "ticker",
        local_date(F.col("_first"), zone).alias("start_date_et"),
        local_date(F.col("_last"), zone).alias("end_date_et"),
    )


class _Sessions:
    """The days of a calendar as bits, 64 to a word, with the sessions before each word; one row of a subquery.

    A calendar has a word for two months, however often it names a day.
    """

    def __init__(self, calendar: DataFrame):
        day = F.unix_date("date")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(64)))
        words = calendar.filter(F.col("date").isNotNull()).groupBy(F.floor(day / 64).cast("int").alias("w")).agg(F.bit_or(bit).alias("bits"))
        entries = words.agg(F.min("w").alias("low"), F.max("w").alias("high"), F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("at"))
        every = F.transform(F.sequence("low", "high"), lambda w: F.coalesce(F.try_element_at("at", w), F.lit(0).cast("bigint")))
        dense = entries.select("low", every.alias("bits"))
        counts = F.transform(
            F.sequence(F.lit(0), F.size("bits")),
            lambda i: F.aggregate(F.slice("bits", 1, i), F.lit(0), lambda n, word: n + F.bit_count(word)),
        )
        self._all = dense.select(F.struct("low", "bits", counts.alias("before")).alias("sessions")).scalar()

    def _word(self, day: Column) -> tuple[Column, Column]:
        place = F.floor(day / 64).cast("int") - self._all["low"]
        return place, F.when(place >= 0, F.get(self._all["bits"], place))

    def holds(self, date: Column) -> Column:
        day = F.unix_date(date)
        _, word = self._word(day)
        bit = F.call_function("shiftrightunsigned", word, F.pmod(day, F.lit(64))).bitwiseAND(F.lit(1).cast("bigint"))
        return F.coalesce(bit == 1, F.lit(False))

    def before(self, day: Column) -> Column:
        """Sessions before a day, given as days since 1970."""
        place, word = self._word(day)
        below = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(64))) - 1
        inside = F.get(self._all["before"], place) + F.bit_count(word.bitwiseAND(below))
        return F.when(place < 0, F.lit(0)).otherwise(F.coalesce(inside, F.element_at(self._all["before"], -1), F.lit(0)))

    def within(self, first: Column, last: Column) -> Column:
        return self.before(F.unix_date(last) + 1) - self.before(F.unix_date(first))


def integrity_summary(
    trades: DataFrame,
    ticker: str = "ticker",
    ts: str = "sip_timestamp",
    zone: str = fixed.MARKET_ZONE,
    opens: str = fixed.SESSION_OPEN,
    closes: str = fixed.SESSION_CLOSE,
    threshold: int = fixed.SIGNIFICANT_GAP_SECONDS,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Status, coverage and gap figures per ticker from one scan.

    Rows outside trading hours travel along as their own groups, so coverage needs no second scan and a ticker
    without trading-hours rows keeps its row. ``calendar`` (a table with a ``date`` column of sessions) makes sessions
    without any trade count as zero-volume days; without it days come from the rows themselves. It is read as bits by
    a subquery, so the trades are neither scanned nor joined again.
    """
    daily = _daily(trades, ticker, ts, zone, opens, closes, threshold)
    in_hours = F.col(_IN_HOURS)
    gap_day = in_hours & (F.col("significant_gaps_count") > 0)
    sessions = None if calendar is None else _Sessions(calendar)
    on_session = F.lit(False) if sessions is None else sessions.holds(F.col("date"))
    summary = daily.groupBy("ticker").agg(
        F.min("first_ts").alias("_first"),
        F.max("last_ts").alias("_last"),
        F.count_if(in_hours).alias("total_trading_days_rth"),
        F.count_if(in_hours & (F.col("daily_rth_trades") == 0)).alias("days_zero_rth_volume"),
        F.count_if(in_hours & on_session).alias("_sessions"),
        F.count_if(gap_day).alias("days_with_significant_gaps"),
        F.max(F.when(gap_day, F.col("max_gap_sec"))).alias("_worst"),
    )
    if sessions is not None:
        # Every day with trades lies between the ends, so what is left of the sessions there was silent.
        silent = sessions.within(local_date(F.col("_first"), zone), local_date(F.col("_last"), zone)) - F.col("_sessions")
        summary = summary.withColumn(
            "days_zero_rth_volume", F.when(F.col("total_trading_days_rth") > 0, silent.cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        )
    has_days = F.col("total_trading_days_rth") > 0
    status = (
        F.when(~has_days, fixed.NO_RTH)
        .when((F.col("days_zero_rth_volume") > 0) | (F.col("days_with_significant_gaps") > 0), fixed.ANOMALIES)
        .otherwise(fixed.HEALTHY)
    )
    return summary.select(
        "ticker",
        status.alias("status"),
        F.when(has_days, local_date(F.col("_first"), zone)).alias("start_date_et"),
        F.when(has_days, local_date(F.col("_last"), zone)).alias("end_date_et"),
        F.when(has_days, F.col("total_trading_days_rth")).alias("total_trading_days_rth"),
        "days_zero_rth_volume",
        "days_with_significant_gaps",
        F.round(F.coalesce("_worst", F.lit(0)).cast("double"), 2).alias("max_intraday_gap_sec"),
    )


def order_integrity_report(summary: DataFrame) -> DataFrame:
    """Worst status first, then most gap days, then most zero-volume days."""
    rank = F.lit(fixed.UNKNOWN_STATUS_RANK)
    for name, place in fixed.STATUS_RANK.items():
        rank = F.when(F.col("status") == name, place).otherwise(rank)
    return (
        summary.withColumn("_rank", rank)
        .orderBy(
            F.asc("_rank"), F.desc("days_with_significant_gaps"), F.desc("days_zero_rth_volume"), F.asc("ticker")
        )
        .drop("_rank")
    )
