"""OHLCV bars from trades, and split adjustment.

Bars of many targets come from one aggregation of the trades: the date ranges of a ticker's targets are cut at all their
ends into segments that don't overlap, and trades are added up once per segment in cells that nest in the bars of every
target there. Only the cells meet the targets, however many of them overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.instants import NS_PER_SECOND, floor_div, utc_timestamp
from tickframe.functions.money import micro_dollars, money_parts, whole_dollars

# Seconds per timespan; longer spans follow the calendar.
FIXED_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}
CALENDAR_SPANS = ("week", "month")
NS_PER_MS = 1_000_000
DAY_NS = 86_400 * NS_PER_SECOND


def bar_start_ms(ns: Column, multiplier: int, timespan: str) -> Column:
    """Start of the bar that holds ``ns``, epoch milliseconds; weeks start on Monday, months on the first."""
    if timespan in FIXED_SECONDS:
        width = multiplier * FIXED_SECONDS[timespan] * NS_PER_SECOND
        return floor_div(ns, width) * F.lit(width // 1_000_000).cast("bigint")
    if timespan not in CALENDAR_SPANS or multiplier != 1:
        raise ValueError(f"unsupported bar of {multiplier} {timespan}")
    return F.unix_millis(F.date_trunc(timespan, utc_timestamp(ns)))


def _fixed_width_ns(multiplier: Column, timespan: Column) -> Column:
    seconds = F.create_map(*[F.lit(part) for pair in FIXED_SECONDS.items() for part in pair])
    return multiplier * F.try_element_at(seconds, timespan).cast("bigint") * NS_PER_SECOND


def _order(ts: str, sequence: str | None) -> Column:
    """What trades are ordered by; with ``sequence`` both numbers in one decimal, which hash aggregates can hold."""
    if sequence is None:
        return F.col(ts)
    above = F.lit("1" + 19 * "0").cast("decimal(20,0)")
    return (F.col(ts).cast("decimal(19,0)") * above + F.coalesce(F.col(sequence), F.lit(-1)).cast("decimal(19,0)")).cast("decimal(38,0)")


def _partial(ts: str, price: str, size: str, sequence: str | None) -> list[Column]:
    """Aggregates of trades that add up further."""
    order = _order(ts, sequence)
    high, low = money_parts(micro_dollars(F.col(price), F.col(size)))
    return [
        F.min_by(price, order).alias("o"),
        F.max(price).alias("h"),
        F.min(price).alias("l"),
        F.max_by(price, order).alias("c"),
        F.sum(size).alias("_size"),
        high.alias("_high"),
        low.alias("_low"),
        F.count(F.lit(1)).alias("n"),
    ]


def _finished(partial: DataFrame, *keys: str) -> DataFrame:
    volume = F.col("_size").cast("double")
    vw = whole_dollars(F.col("_high"), F.col("_low")) / F.nullif(volume, F.lit(0.0))
    return partial.select(*keys, "o", "h", "l", "c", volume.alias("v"), vw.alias("vw"), "n")


def bars(
    trades: DataFrame,
    multiplier: int,
    timespan: str,
    ticker: str = "ticker",
    ts: str = "sip_timestamp",
    price: str = "price",
    size: str = "size",
    sequence: str | None = None,
) -> DataFrame:
    """Open, high, low, close, volume, volume-weighted price and count per (ticker, bar).

    Open and close are the first and last price by ``ts``; trades of the same nanosecond are told apart by
    ``sequence`` when it is named (whole numbers from 0; unknown ones come first). Every aggregate combines before the
    shuffle, so a hot ticker costs one row per bar and task.
    """
    added = (
        trades.filter(F.col(ts).isNotNull() & F.col(price).isNotNull())
        .groupBy(F.col(ticker).alias("ticker"), bar_start_ms(F.col(ts), multiplier, timespan).alias("t"))
        .agg(*_partial(ts, price, size, sequence))
    )
    return _finished(added, "ticker", "t")


def _bar_reject() -> Column:
    """Why a target gives no bars; null if it does."""
    fixed_span, calendar = F.col("timespan").isin(*FIXED_SECONDS), F.col("timespan").isin(*CALENDAR_SPANS)
    return (
        F.when(F.col("ticker").isNull(), "missing ticker")
        .when(F.col("timespan").isNull() | F.col("multiplier").isNull(), "unreadable fidelity")
        .when(F.col("start_date").isNull() | F.col("end_date").isNull(), "missing date range")
        .when(~fixed_span & ~calendar, "unknown span")
        .when(F.col("multiplier") < 1, "multiple below one")
        .when(calendar & (F.col("multiplier") != 1), "multiple of a calendar span")
    )


def rejected_bar_targets(targets: DataFrame) -> DataFrame:
    """Targets that give no bars, with ``reject_reason``."""
    return targets.withColumn("reject_reason", _bar_reject()).filter(F.col("reject_reason").isNotNull())


_TARGET = ["ticker", "multiplier", "timespan", "start_date", "end_date"]


def _jobs(targets: DataFrame) -> DataFrame:
    """Distinct usable targets with their range in nanoseconds and their ``_grain``: calendar bars are made of days."""
    width = _fixed_width_ns(F.col("multiplier"), F.col("timespan"))
    return (
        targets.select(*_TARGET)
        .distinct()
        .filter(_bar_reject().isNull())
        .select(
            *_TARGET,
            width.alias("_width"),
            F.coalesce(width, F.lit(DAY_NS)).alias("_grain"),
            (F.unix_date("start_date").cast("bigint") * DAY_NS).alias("_from"),
            ((F.unix_date("end_date").cast("bigint") + 1) * DAY_NS).alias("_until"),
        )
        .filter("_from < _until")
    )


def _merged(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Half-open spans of equal keys that overlap or touch as one."""
    ordered = Window.partitionBy(*keys).orderBy("_from", "_until")
    opens = F.coalesce(F.col("_from") > F.max("_until").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    marked = spans.distinct().withColumn("_opens", opens.cast("int"))
    island = F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marked.withColumn("_island", island)
        .groupBy(*keys, "_island")
        .agg(F.min("_from").alias("_from"), F.max("_until").alias("_until"))
        .drop("_island")
    )


def _cell_width(grains: Column) -> Column:
    """The least of a few widths where it divides them all, else the longest unit that does."""
    divides = lambda unit: F.forall(grains, lambda grain: grain % unit == 0)
    cell = F.when(divides(F.array_min(grains)), F.array_min(grains))
    for seconds in sorted(FIXED_SECONDS.values(), reverse=True):
        unit = F.lit(seconds * NS_PER_SECOND)
        cell = cell.when(divides(unit), unit)
    return cell


def target_segments(targets: DataFrame) -> DataFrame:
    """The ranges of each ticker's targets, cut at all their ends: ``ticker``, ``_from``, ``_until`` (nanoseconds, apart from
    each other) and ``_cell``, the width of cells that nest in the bars of every target over the segment.

    Which widths cover a segment is found among merged ranges per width, so that step grows with ends and widths, not with
    the pairs of targets that overlap.
    """
    jobs = _jobs(targets).select("ticker", "_grain", "_from", "_until")
    spans = _merged(jobs, ["ticker", "_grain"])
    ends = jobs.select("ticker", F.explode(F.array("_from", "_until")).alias("_from")).distinct()
    after = F.lead("_from").over(Window.partitionBy("ticker").orderBy("_from"))
    cuts = ends.withColumn("_until", after).filter(F.col("_until").isNotNull())
    over = spans.select(F.col("ticker").alias("_ticker"), "_grain", F.col("_from").alias("_a"), F.col("_until").alias("_b"))
    covered = cuts.join(over, (F.col("ticker") == F.col("_ticker")) & (F.col("_a") <= F.col("_from")) & (F.col("_until") <= F.col("_b")))
    grains = covered.groupBy("ticker", "_from", "_until").agg(F.collect_set("_grain").alias("_grains"))
    return grains.select("ticker", "_from", "_until", _cell_width(F.col("_grains")).alias("_cell"))


#: Segments are also cut up by spans of this width, so that a trade meets few of its ticker's.
_BUCKET_NS = 32 * DAY_NS


def _cells(trades: DataFrame, targets: DataFrame, ts: str, price: str, size: str, sequence: str | None) -> DataFrame:
    """Trades added up per segment and cell: each trade once, whatever the number of targets over it."""
    segments = target_segments(targets).select(
        F.col("ticker").alias("_ticker"),
        "_from",
        "_until",
        "_cell",
        F.explode(F.sequence(floor_div(F.col("_from"), _BUCKET_NS), floor_div(F.col("_until") - 1, _BUCKET_NS))).alias("_bucket"),
    )
    inside = (
        (F.col("ticker") == F.col("_ticker"))
        & (floor_div(F.col(ts), _BUCKET_NS) == F.col("_bucket"))
        & (F.col(ts) >= F.col("_from"))
        & (F.col(ts) < F.col("_until"))
    )
    cell = F.col(ts) - F.pmod(F.col(ts), F.col("_cell"))
    order = _order(ts, sequence)
    return (
        trades.filter(F.col(price).isNotNull() & F.col(ts).isNotNull())
        .join(segments, inside)
        .groupBy("ticker", "_from", "_until", cell.alias("_start"))
        .agg(*_partial(ts, price, size, sequence), F.min(order).alias("_first"), F.max(order).alias("_last"))
    )


def target_bars(
    trades: DataFrame,
    targets: DataFrame,
    ts: str = "sip_timestamp",
    price: str = "price",
    size: str = "size",
    sequence: str | None = None,
) -> DataFrame:
    """Bars of every target at its own fidelity and date range, all in one job.

    ``targets`` has (ticker, multiplier, timespan, start_date, end_date); both days are included whole, and targets
    that differ in any of these keep bars of their own. Targets of other spans come back from
    :func:`rejected_bar_targets`. Trades are scanned and added up once; the targets meet the sums.
    """
    cells = _cells(trades, targets, ts, price, size, sequence)
    jobs = _jobs(targets).withColumnsRenamed({"ticker": "_ticker", "_from": "_a", "_until": "_b"})
    inside = (F.col("ticker") == F.col("_ticker")) & (F.col("_a") <= F.col("_from")) & (F.col("_until") <= F.col("_b"))
    instant = F.col("_start")
    start = (
        F.when(F.col("timespan") == "week", bar_start_ms(instant, 1, "week"))
        .when(F.col("timespan") == "month", bar_start_ms(instant, 1, "month"))
        .otherwise(F.call_function("div", instant - F.pmod(instant, F.col("_width")), F.lit(NS_PER_MS).cast("bigint")))
    )
    added = (
        cells.join(jobs, inside)
        .groupBy(*_TARGET, start.alias("t"))
        .agg(
            F.min_by("o", "_first").alias("o"),
            F.max("h").alias("h"),
            F.min("l").alias("l"),
            F.max_by("c", "_last").alias("c"),
            *(F.sum(name).alias(name) for name in ("_size", "_high", "_low", "n")),
        )
    )
    return _finished(added, *_TARGET, "t")


def split_factors(splits: DataFrame) -> DataFrame:
    """Per ticker the date ranges [valid_from, valid_to) and the price divisor that applies in them.

    The divisor of a day is the product of split_to / split_from over later execution dates. Splits per ticker
    are few, and their table is small next to any bar table.
    """
    daily = splits.groupBy("ticker", F.col("execution_date").cast("date").alias("valid_to")).agg(
        F.product(F.col("split_to") / F.col("split_from")).alias("_ratio")
    )
    ahead = Window.partitionBy("ticker").orderBy(F.desc("valid_to"))
    return daily.select(
        "ticker",
        F.coalesce(F.lead("valid_to").over(ahead), F.lit("0001-01-01").cast("date")).alias("valid_from"),
        "valid_to",
        F.product("_ratio").over(ahead.rowsBetween(Window.unboundedPreceding, 0)).alias("factor"),
    )


def split_adjusted(bar_rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Bars with prices divided by, and volume multiplied by, the ratio of all later splits.

    A bar falls in at most one factor range, so the join adds no rows.
    """
    day = F.to_date(F.timestamp_millis("t"))
    factors = split_factors(splits).withColumnRenamed("ticker", "_ticker")
    joined = bar_rows.join(
        factors,
        (F.col("ticker") == F.col("_ticker")) & (day >= F.col("valid_from")) & (day < F.col("valid_to")),
        "left",
    )
    factor = F.coalesce("factor", F.lit(1.0))
    adjusted = {name: F.col(name) / factor for name in ("o", "h", "l", "c", "vw")}
    adjusted["v"] = F.col("v") * factor
    return joined.select(*[adjusted[name].alias(name) if name in adjusted else F.col(name) for name in bar_rows.columns])
