"""Text expressions with the null rules of the reports."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_like(text: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    """True when the text matches one of the LIKE patterns."""
    return reduce(or_, [text.like(p) for p in patterns], F.lit(False))


def extract_or_null(text: Column, pattern: str, group: int = 1) -> Column:
    """Regex group, null (not the empty string) when nothing matches."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def split_item(text: Column, separator: str, index: int) -> Column:
    """Item of a delimited label, null when out of range. The separator is literal."""
    return F.get(F.split(text, r"\Q" + separator + r"\E"), F.lit(index))


def first_chars(text: Column | str, n: int) -> Column:
    return F.left(F.col(text) if isinstance(text, str) else text, F.lit(n))


def record_url(base: str, record_id: Column) -> Column:
    return F.concat(F.lit(base), record_id.cast("string"))
