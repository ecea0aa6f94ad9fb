"""Ratios, bands and value maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(a: Column, b: Column) -> Column:
    """Quotient as double, null for a zero divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def inverse_mean(mean: Column) -> Column:
    """1 / mean for a positive mean, else the mean itself: shorter is better."""
    return F.when(mean > 0, safe_divide(F.lit(1), mean)).otherwise(mean)


def lookup(key: Column, mapping: Mapping[str, object], default: object = None) -> Column:
    """Constant mapping as an expression: no join, no shuffle."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def cap(value: Column, limit: float) -> Column:
    """Upper limit that leaves nulls null."""
    return F.when(value >= limit, F.lit(limit)).otherwise(value)


def coverage(open_value: Column, gap: Column, ceiling: float = 10.0) -> Column:
    """Pipeline ÷ remaining gap; negative or very large ratios are set to the ceiling."""
    ratio = safe_divide(open_value, gap)
    return F.when((ratio < 0) | (ratio > ceiling), F.lit(float(ceiling))).otherwise(ratio)
