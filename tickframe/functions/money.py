"""Exact sums of money in machine integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
_LOW_BITS = 32


def micro_dollars(price: Column, size: Column) -> Column:
    """Dollar volume of a trade in whole millionths, which add up exactly in any order.

    Overflow, at some nine trillion dollars for one trade, raises.
    """
    return F.round(price * size * MICROS).cast("bigint")


def money_parts(micros: Column) -> tuple[Column, Column]:
    """Aggregates: sums of the upper and lower halves of ``micros``, which neither overflow nor need decimals per row."""
    return F.sum(F.shiftright(micros, _LOW_BITS)), F.sum(micros.bitwiseAND(F.lit(2**_LOW_BITS - 1)))


def whole_dollars(high: Column, low: Column) -> Column:
    """Dollars of two such sums (or of sums of them), null for no values."""
    whole = high.cast("decimal(20,0)") * F.lit(2**_LOW_BITS).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    return (whole.cast("decimal(32,0)") / F.lit(MICROS).cast("decimal(7,0)")).cast("decimal(34,6)").cast("double")


def total_dollars(micros: Column) -> Column:
    """Aggregate: sum of ``micros`` in dollars, null for no values."""
    return whole_dollars(*money_parts(micros))
