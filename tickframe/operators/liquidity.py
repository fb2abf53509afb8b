"""Liquidity screening: daily statistics, per-ticker metrics, tiers, report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe import fixed
from tickframe.functions.conform import numeric_or
from tickframe.functions.instants import lookback_cutoff_ns, utc_date
from tickframe.functions.money import micro_dollars, total_dollars
from tickframe.operators.gaps import gap_counts


def within_lookback(
    trades: DataFrame, as_of: dt.date, days: int = fixed.LOOKBACK_DAYS, ts: str = "sip_timestamp"
) -> DataFrame:
    """Trades from UTC midnight ``days`` before ``as_of`` on; a literal on the raw column, so Parquet sees it."""
    return trades.filter(F.col(ts) >= lookback_cutoff_ns(as_of, days))


def daily_liquidity(
    trades: DataFrame,
    ticker: str = "ticker",
    ts: str = "sip_timestamp",
    price: str = "price",
    size: str = "size",
) -> DataFrame:
    """Trades, dollar volume and median gap in seconds per (ticker, UTC day).

    Money is added in integers, so a recomputed task cannot change the last digit. The median is exact: it runs
    over counted gap values, of which a day has a bounded number. Trades are exchanged once, combined by second.
    """
    rows = trades.select(F.col(ticker).alias("ticker"), ts, utc_date(F.col(ts)).alias("date"), price, size)
    counts = gap_counts(rows, ["ticker", "date"], ts, {"micros": micro_dollars(F.col(price), F.col(size))})
    return counts.groupBy("ticker", "date").agg(
        F.sum("n").alias("daily_trades"),
        F.coalesce(total_dollars(F.col("micros")), F.lit(0.0)).alias("daily_dollar_volume"),
        F.percentile("gap_sec", 0.5, F.col("n")).alias("daily_mtbt_sec"),
    )


def liquidity_metrics(daily: DataFrame) -> DataFrame:
    """ADDV, ADNT and the median of the daily medians per ticker; a group is at most the days of the lookback."""
    dollars = F.sum(F.col("daily_dollar_volume").cast("decimal(28,6)")).cast("double")
    return daily.groupBy("ticker").agg(
        (dollars / F.count(F.lit(1))).alias("ADDV"),
        F.avg("daily_trades").alias("ADNT"),
        F.median("daily_mtbt_sec").alias("Median_Time_Between_Trades_Sec"),
    )


def classify(
    addv: Column,
    adnt: Column,
    mtbt: Column,
    tiers: Sequence[tuple[int, float, float, float, str]] = fixed.LIQUIDITY_TIERS,
) -> Column:
    """Struct (tier, label) by the first tier whose three thresholds are met."""
    unusable = addv.isNull() | adnt.isNull() | mtbt.isNull() | (addv == 0) | (adnt == 0)
    chosen = F.when(unusable, _tier(*fixed.INSUFFICIENT))
    for number, min_addv, min_adnt, max_mtbt, label in tiers:
        chosen = chosen.when((addv >= min_addv) & (adnt >= min_adnt) & (mtbt <= max_mtbt), _tier(number, label))
    return chosen.otherwise(_tier(*fixed.ILLIQUID))


def _tier(number: int, label: str) -> Column:
    return F.struct(F.lit(number).alias("tier"), F.lit(label).alias("label"))


def liquidity_report(
    metrics: DataFrame,
    universe: DataFrame,
    tiers: Sequence[tuple[int, float, float, float, str]] = fixed.LIQUIDITY_TIERS,
) -> DataFrame:
    """One row per ticker of ``universe``; tickers without usable trades are kept in the last tier."""
    tier = classify(F.col("ADDV"), F.col("ADNT"), F.col("Median_Time_Between_Trades_Sec"), tiers)
    tiered = metrics.withColumn("_tier", tier).withColumn("_found", F.lit(True))
    joined = universe.select("ticker").distinct().join(tiered, "ticker", "left")
    return joined.select(
        "ticker",
        numeric_or(F.col("ADDV"), 0.0, 2).alias("ADDV"),
        "ADNT",
        numeric_or(F.col("Median_Time_Between_Trades_Sec"), None, 2).alias("Median_Time_Between_Trades_Sec"),
        F.coalesce(F.col("_tier.tier"), F.lit(fixed.INSUFFICIENT[0])).alias("Liquidity_Tier"),
        F.col("_tier.label").alias("Recommendation"),
        F.when(F.col("_found").isNull(), fixed.NO_DATA).alias("error"),
    ).orderBy(F.asc("Liquidity_Tier"), F.desc("ADDV"), F.asc("ticker"))


def value_counts(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(out))
    return counts.orderBy(F.desc(out), F.asc(column))
