"""Moving averages, MACD and RSI over bars.

Definitions: SMA(w) is the mean of the last w closes. EMA(w) has weight 2/(w+1) and starts at the first close.
MACD is EMA(12) - EMA(26) with an EMA(9) signal. RSI(n) uses Wilder's smoothing: the mean of the first n gains and
losses, then weight 1/n.

``keys`` name what a series is: the ticker, and the fidelity where a table holds several. No series is sorted whole.
Windows look back over blocks of numbered bars, which take their last predecessors along as a halo; bars are numbered
within days and shifted by the counts of the days before. Averages with a memory of everything before are recurrences
(:mod:`tickframe.operators.recurrence`). Bars of a series at one instant are in the order of their values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators.recurrence import BLOCK_ROWS, Term, recurrence

_BLOCK, _DAY = "_block", "_day"
_DAY_MS = 86_400_000


def numbered(
    bars: DataFrame, keys: Sequence[str] = ("ticker",), t: str = "t", out: str = "bar_no", tie: Sequence[str] = ()
) -> DataFrame:
    """Number the bars of a series in time order from 1: within days, shifted by the days before; ``tie`` orders one instant."""
    dated = bars.withColumn(_DAY, F.expr(f"`{t}` div {_DAY_MS}"))
    ahead = Window.partitionBy(*keys).orderBy(_DAY).rowsBetween(Window.unboundedPreceding, -1)
    days = dated.groupBy(*keys, _DAY).agg(F.count(F.lit(1)).alias("_n"))
    days = days.select(*keys, _DAY, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*keys, _DAY).orderBy(t, *tie))
    return (
        dated.withColumn(out, own).join(days, [*keys, _DAY]).withColumn(out, F.col("_before") + F.col(out)).select(*bars.columns, out)
    )


def over_blocks(rows: DataFrame, keys: Sequence[str], halo: int, columns: dict, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``columns``, each a function of a window over numbered rows that looks back at most ``halo`` rows.

    Each block of at least ``halo`` rows takes the last ``halo`` rows of the block before along.
    """
    size = max(block_rows, halo)
    own = F.floor((F.col("bar_no") - 1) / size).cast("bigint")
    last = (F.col("bar_no") - 1) % size >= size - halo
    blocks = F.when(last, F.array(own, own + 1)).otherwise(F.array(own))
    spread = rows.withColumn("_own", own).withColumn(_BLOCK, F.explode(blocks))
    window = Window.partitionBy(*keys, _BLOCK).orderBy("bar_no")
    added = spread.withColumns({name: make(window) for name, make in columns.items()})
    return added.filter(F.col(_BLOCK) == F.col("_own")).drop("_own", _BLOCK)


def _keys(ticker: str | Sequence[str]) -> list[str]:
    return [ticker] if isinstance(ticker, str) else list(ticker)


def sma(
    bars: DataFrame,
    window: int = 50,
    ticker: str | Sequence[str] = "ticker",
    t: str = "t",
    value: str = "c",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean of the last ``window`` closes, null before there are so many."""
    keys = _keys(ticker)

    def mean(by: Window) -> Column:
        last = by.rowsBetween(-(window - 1), 0)
        return F.when(F.count(value).over(last) == window, F.avg(value).over(last))

    return over_blocks(numbered(bars, keys, t, tie=[value]), keys, window - 1, {"sma": mean}, block_rows).drop("bar_no")


def _average(window: int, value: Column | None = None, of: dict[str, float] | None = None) -> Term:
    """Exponential average with weight 2/(window+1) of a column, or of a sum of earlier terms."""
    alpha = 2.0 / (window + 1)
    if value is None:
        return Term(1.0 - alpha, 0.0, 0.0, {name: alpha * factor for name, factor in of.items()})
    # Started from its own first value, the average is that value there.
    return Term(1.0 - alpha, value * alpha, value)


def ema(
    bars: DataFrame,
    window: int = 50,
    ticker: str | Sequence[str] = "ticker",
    t: str = "t",
    value: str = "c",
    out: str = "ema",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exponential average with weight 2/(window+1), seeded with the first close."""
    return recurrence(bars, _keys(ticker), t, {out: _average(window, F.col(value))}, [value], block_rows)


def macd(
    bars: DataFrame,
    short_window: int = 12,
    long_window: int = 26,
    signal_window: int = 9,
    ticker: str | Sequence[str] = "ticker",
    t: str = "t",
    value: str = "c",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """MACD line, its signal and their difference; the line starts at 0, and so does its average."""
    averages = {
        "_short": _average(short_window, F.col(value)),
        "_long": _average(long_window, F.col(value)),
        "signal": _average(signal_window, of={"_short": 1.0, "_long": -1.0}),
    }
    made = recurrence(bars, _keys(ticker), t, averages, [value], block_rows)
    line = F.col("_short") - F.col("_long")
    return made.select(*bars.columns, line.alias("macd"), "signal", (line - F.col("signal")).alias("histogram"))


def rsi(
    bars: DataFrame,
    window: int = 14,
    ticker: str | Sequence[str] = "ticker",
    t: str = "t",
    value: str = "c",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Wilder's relative strength, null until ``window`` changes are known; 100 when there was no loss."""
    keys = _keys(ticker)
    change = {"_change": lambda by: F.col(value) - F.lag(value).over(by)}
    rows = over_blocks(numbered(bars, keys, t, tie=[value]), keys, 1, change, block_rows)
    # The k-th change has weight 1/k up to the window, which makes the running value their plain mean.
    weight = F.lit(1.0) / F.least(F.greatest(F.col("bar_no") - 1, F.lit(1)), F.lit(window))
    keep = F.when(F.col("bar_no") <= 2, 0.0).otherwise(1.0 - weight)
    gain = F.coalesce(F.greatest("_change", F.lit(0.0)), F.lit(0.0))
    loss = F.coalesce(F.greatest(-F.col("_change"), F.lit(0.0)), F.lit(0.0))
    averages = recurrence(
        rows, keys, t, {"_gain": Term(keep, gain * weight, 0.0), "_loss": Term(keep, loss * weight, 0.0)}, ["bar_no"], block_rows
    )
    strength = F.when(F.col("_loss") == 0, 100.0).otherwise(
        100.0 - 100.0 / (1.0 + F.col("_gain") / F.nullif(F.col("_loss"), F.lit(0.0)))
    )
    return averages.withColumn("rsi", F.when(F.col("bar_no") > window, strength)).drop(
        "bar_no", "_change", "_gain", "_loss"
    )
