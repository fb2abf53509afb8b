"""Bring a DataFrame to a fixed schema, and repair report columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order: absent ones null, unknown ones dropped, the rest cast."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def numeric_or(value: Column, default: float | None = None, digits: int | None = None) -> Column:
    """Numeric reading of ``value``; unreadable and null become ``default``; rounded when ``digits`` is given."""
    number = value.try_cast("double")
    if default is not None:
        number = F.coalesce(number, F.lit(float(default)))
    return F.round(number, digits) if digits is not None else number


def nonempty(value: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(value, F.lit(""))
