"""Consecutive-row operators that stay spread out when one group is very large.

A plain ``lag`` over (ticker, day) sorts the whole group in one task. Gaps in whole seconds don't need that: between rows of
one second they are 0, so a second is told by its count and its ends, which combine before the shuffle, and only the
summaries of seconds are put in order. Other values are lagged inside buckets, and the one row per bucket that has no
predecessor there takes the end of the previous bucket, found among bucket summaries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.instants import NS_PER_SECOND, floor_div

SECOND = "_second"


def gap_counts(df: DataFrame, keys: Sequence[str], ts: str, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Gaps to the previous row of the same ``keys``, in whole seconds, as counted values.

    ``ts`` is a bigint of nanoseconds; rows without it are left out. One or two rows per (keys, second) with ``gap_sec`` (null
    for the first row of a group), ``n`` rows, ``first_ts``, ``last_ts`` and every column of ``sums`` added up. Rows are
    exchanged once, combined by second; copies of an instant and crowded seconds cost one row per task. A day of a
    key has at most 86,400 summaries, which meet in one task, so ``keys`` should name the day.
    """
    sums = dict(sums or {})
    second = F.lit(NS_PER_SECOND).cast("bigint")
    seconds = (
        df.filter(F.col(ts).isNotNull())
        .select(*keys, F.col(ts), floor_div(F.col(ts), NS_PER_SECOND).alias(SECOND), *[value.alias(name) for name, value in sums.items()])
        .groupBy(*keys, SECOND)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
            *[F.sum(name).alias(name) for name in sums],
        )
    )
    before = F.lag("last_ts").over(Window.partitionBy(*keys).orderBy(SECOND))
    carried = ["first_ts", "last_ts", *sums]
    step = F.struct(F.call_function("div", F.col("first_ts") - before, second).alias("gap_sec"), F.lit(1).cast("bigint").alias("n"), *carried)
    nothing = [F.lit(None).alias(name) for name in carried]
    # Every further row of a second follows the one before it after 0 seconds.
    inside = F.struct(F.lit(0).cast("bigint").alias("gap_sec"), (F.col("_rows") - 1).alias("n"), *nothing)
    both = F.when(F.col("_rows") > 1, F.array(step, inside)).otherwise(F.array(step))
    return seconds.select(*keys, SECOND, both.alias("_both")).select(*keys, SECOND, F.explode("_both").alias("_step")).select(*keys, SECOND, "_step.*")


def lag_over_buckets(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], value: str, out: str
) -> DataFrame:
    """``lag(value)`` over ``keys`` ordered by (``bucket``, ``order``), without one task per key.

    ``bucket`` must ascend with the wanted order and be non-null. The result equals the plain window; only the
    bucket summaries of a key meet in one task.
    """
    inner = Window.partitionBy(*keys, bucket).orderBy(*order)
    local = df.withColumn("_rank", F.row_number().over(inner)).withColumn("_local", F.lag(value).over(inner))
    ends = df.groupBy(*keys, bucket).agg(F.max_by(F.struct(value), F.struct(*order)).alias("_end"))
    carried = ends.select(
        *keys, bucket, F.lag(F.col("_end")[value]).over(Window.partitionBy(*keys).orderBy(bucket)).alias("_carry")
    )
    first = F.col("_rank") == 1
    return (
        local.join(carried, [*keys, bucket], "left")
        .withColumn(out, F.when(first, F.col("_carry")).otherwise(F.col("_local")))
        .select(*df.columns, out)
    )
