"""Ordered operators per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in a total order.

    ``row_number() = 1`` lets Spark cut every map task to one row per key before the
    shuffle (WindowGroupLimit), so a hot key costs no more than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def previous_day(df: DataFrame, keys: list[str], day: str, tie: str, out: str) -> DataFrame:
    """Day of the preceding row per key, rows ordered by (day, tie).

    Same as ``lag(day)``, without ordering all rows of a key in one task: the lag
    runs over the distinct days of a key, which the calendar bounds. On one day the
    first row looks back to the previous day and the others to the same day.
    """
    days = df.filter(F.col(day).isNotNull()).groupBy(*keys, day).agg(F.min(tie).alias("_first"))
    w = Window.partitionBy(*keys).orderBy(day)
    days = days.withColumn("_before", F.lag(day).over(w))
    joined = df.join(days, [*keys, day], "left")
    return joined.withColumn(out, F.when(F.col(tie) == F.col("_first"), F.col("_before")).otherwise(F.col(day))).select(*df.columns, out)


def key_maximum(df: DataFrame, keys: list[str], value: Column, out: str) -> DataFrame:
    """Maximum per key on every row, combined before the shuffle."""
    tops = df.groupBy(*keys).agg(F.max(value).alias(out))
    on = None
    a, b = df.alias("a"), tops.alias("b")
    for k in keys:
        c = F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        on = c if on is None else on & c
    return a.join(b, on, "left").select("a.*", f"b.{out}")
