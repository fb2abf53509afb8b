"""Download targets: validation, date ranges, fan-out, range scans."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions import fidelity as fid
from tickframe.functions.conform import nonempty
from tickframe.functions.instants import window_start
from tickframe.operators.history import month_chunks


def _duration(value: Column) -> Column:
    """Whole months: integers and integral or fractional numbers as text, towards zero; NaN is unreadable."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number.try_cast("int"))


def check_targets(targets: DataFrame) -> DataFrame:
    """Add ``duration_months`` and ``reject_reason`` (null for a usable target)."""
    raw = nonempty(F.trim(F.col("ticker_duration_months").cast("string")))
    months = _duration(raw)
    reason = (
        F.when(nonempty(F.col("ticker")).isNull(), "missing ticker")
        .when(nonempty(F.col("ticker_fidelity")).isNull(), "missing fidelity")
        .when(raw.isNull() | (raw.try_cast("double") == 0), "missing duration")
        .when(months.isNull(), "invalid duration")
    )
    return targets.withColumn("duration_months", months).withColumn("reject_reason", reason)


def valid_targets(targets: DataFrame) -> DataFrame:
    return check_targets(targets).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_targets(targets: DataFrame) -> DataFrame:
    return check_targets(targets).filter(F.col("reject_reason").isNotNull())


def with_range(targets: DataFrame, as_of: dt.date) -> DataFrame:
    """Start and end of each valid target's range, ending at ``as_of``."""
    return targets.withColumn("start_date", window_start(as_of, F.col("duration_months"))).withColumn(
        "end_date", F.lit(as_of)
    )


def history_jobs(targets: DataFrame, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    """(monthly jobs, rejected targets): invalid rows and fidelities that cannot be read go to the second."""
    checked = check_targets(targets).withColumn("parsed", fid.historical(F.col("ticker_fidelity")))
    unreadable = F.col("reject_reason").isNull() & F.col("parsed.timespan").isNull()
    checked = checked.withColumn(
        "reject_reason", F.when(unreadable, "unreadable fidelity").otherwise(F.col("reject_reason"))
    )
    good = with_range(checked.filter(F.col("reject_reason").isNull()), as_of)
    jobs = month_chunks(good, "start_date", "end_date").select(
        "ticker",
        F.col("ticker_fidelity").alias("fidelity"),
        "parsed.multiplier",
        "parsed.timespan",
        "month",
        "chunk_start",
        "chunk_end",
    )
    return jobs, checked.filter(F.col("reject_reason").isNotNull()).drop("parsed")


def fan_out(targets: DataFrame, names: Sequence[str], out: str = "dataset") -> DataFrame:
    """Each target once per name of a short literal list."""
    return targets.withColumn(out, F.explode(F.array(*[F.lit(name) for name in names])))


def merged_ranges(targets: DataFrame, key: str = "ticker") -> DataFrame:
    """Targets of a key with overlapping date ranges as one range; repeats collapse before the shuffle."""
    distinct = targets.select(key, "start_date", "end_date").distinct()
    earlier = Window.partitionBy(key).orderBy("start_date", "end_date").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("start_date") > F.max("end_date").over(earlier), F.lit(True))
    island = F.sum(opens.cast("int")).over(Window.partitionBy(key).orderBy("start_date", "end_date").rowsBetween(Window.unboundedPreceding, 0))
    marked = distinct.withColumn("_island", island)
    return marked.groupBy(key, "_island").agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")).drop("_island")


def range_scan(dataset: DataFrame, targets: DataFrame, date: str, key: str = "ticker") -> DataFrame:
    """Rows of ``dataset`` inside the date range of a target with the same key, both ends included, each once.

    Repeated and overlapping targets are merged first, so a row meets one range at most; it carries that range. The
    equality carries the join; Spark broadcasts the ranges when their size allows and otherwise sorts, where adaptive
    execution splits a hot key.
    """
    window = merged_ranges(targets, key).select(
        F.col(key).alias("_key"), F.col("start_date").alias("_start"), F.col("end_date").alias("_end")
    )
    condition = (F.col(key) == F.col("_key")) & F.col(date).between(F.col("_start"), F.col("_end"))
    return dataset.join(window, condition).withColumnsRenamed({"_start": "start_date", "_end": "end_date"}).drop(
        "_key"
    )
