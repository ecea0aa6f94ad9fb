"""Unions, renames and tags."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_to(df: DataFrame, vocabulary: Mapping[str, str]) -> DataFrame:
    """Only the mapped columns, under their common names."""
    return df.select(*[F.col(old).alias(new) for old, new in vocabulary.items()])


def tag(df: DataFrame, **labels: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in labels.items()})


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def union_distinct(parts: list[DataFrame]) -> DataFrame:
    return union_all(parts).distinct()
