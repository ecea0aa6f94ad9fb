"""Joins that plain equality does not cover, written so that no key is handled by one task alone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrellis.functions.dates import OPEN_START

SPREAD = 256
GLOBAL_COPIES = 64


def _cell(day: Column, width: Column) -> Column:
    return F.floor(F.unix_date(day) / F.pow(F.lit(2), width)).cast("int")


def interval_hits(left: DataFrame, right: DataFrame, keys: list[str], point: str, start: str, end: str) -> DataFrame:
    """The distinct (keys, point) days of ``left`` with every row of ``right`` whose [start, end] holds the day.

    An interval is laid on a grid of cells as wide as the power of two above its length, so it covers one cell or two,
    however long it is. A day looks up its cell of each width that its key has. So nothing grows with the calendar, an open
    end or a wrong date adds a width to its key, and a hot key is split over its cells.
    """
    spans = right.filter(F.col(start) <= F.col(end))
    spans = spans.withColumn("_width", F.ceil(F.log2(F.datediff(end, start) + 1)).cast("int"))
    spans = spans.withColumn("_cell", F.explode(F.array_distinct(F.array(_cell(F.col(start), F.col("_width")), _cell(F.col(end), F.col("_width"))))))
    widths = spans.select(*keys, "_width").distinct()
    days = left.select(*keys, F.col(point).alias("_day")).filter(F.col("_day").isNotNull()).distinct()
    cells = days.join(widths, keys).withColumn("_cell", _cell(F.col("_day"), F.col("_width")))
    return cells.join(spans, [*keys, "_width", "_cell"]).filter(F.col("_day").between(F.col(start), F.col(end))).drop("_width", "_cell")


def _with_hits(left: DataFrame, hits: DataFrame, keys: list[str], point: str, how: str, spread_on: list[str] | None) -> DataFrame:
    """Rows of left with the hits of their keys and day. Rows that can match nothing are scattered."""
    rows, found, on = left.withColumn("_on_day", F.col(point)), hits.withColumnRenamed("_day", "_on_day"), [*keys, "_on_day"]
    if how == "left" and spread_on:
        rows, found, on = _spread_unmatchable(rows, found, on, spread_on)
    a, b = rows.alias("a"), found.alias("b")
    condition = F.lit(True)
    for k in on:
        condition = condition & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return a.join(b, condition, how).select(*[F.col(f"a.{c}") for c in left.columns], *[F.col(f"b.{c}") for c in hits.columns if c not in keys and c != "_day"])


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], point: str, start: str, end: str, how: str = "inner", spread_on: list[str] | None = None) -> DataFrame:
    """Rows of ``left`` with every row of ``right`` whose [start, end] holds the day ``point``; intervals may overlap."""
    if start in keys or end in keys:
        raise ValueError("interval bounds cannot be join keys")
    return _with_hits(left, interval_hits(left, right, keys, point, start, end), keys, point, how, spread_on)


def interval_minimum(left: DataFrame, right: DataFrame, keys: list[str], point: str, start: str, end: str, value: str, out: str, spread_on: list[str]) -> DataFrame:
    """Every row of ``left`` once, with the smallest ``value`` of the rows of ``right`` that hold its day.

    The winner is chosen per key and day, before the rows of left are met, so overlapping periods multiply none.
    """
    hits = interval_hits(left, right.select(*keys, start, end, value), keys, point, start, end)
    return _with_hits(left, hits.groupBy(*keys, "_day").agg(F.min(value).alias(out)), keys, point, "left", spread_on)


def asof_merge(
    left: DataFrame, right: DataFrame, keys: list[str], point: str, start: str, end: str, how: str = "inner", spread_on: list[str] | None = None, streams: list[str] | None = None
) -> DataFrame:
    """Rows of ``left`` with the row of ``right`` whose [start, end] holds the day ``point``; the intervals of a key must be disjoint.

    An ordered merge: the distinct days of a key and the starts of its intervals are sorted together, and the interval
    that started last is carried on to the days after it. No interval is copied, and one with a wrong date changes
    no volume. A key has at most one row per day on either side here, so the sort of a hot key is bounded by
    the calendar; the rows of left only meet the result, by key and day.

    ``streams`` are further columns of ``right`` if only its intervals of equal keys and streams are disjoint: a day is then
    merged with each stream of its key, and can have a hit in each.
    """
    own = [*keys, *(streams or [])]
    spans = right.filter(F.col(start) <= F.col(end))
    payload = F.struct(*[c for c in right.columns if c not in own])
    starts = spans.select(*own, F.col(start).alias("_day"), payload.alias("_span"))
    days = left.select(*keys, F.col(point).alias("_day")).filter(F.col("_day").isNotNull()).distinct()
    days = days.join(spans.select(*own).distinct(), keys)
    events = starts.unionByName(days.withColumn("_span", F.lit(None).cast(starts.schema["_span"].dataType)))
    order = Window.partitionBy(*own).orderBy("_day", F.col("_span").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = events.withColumn("_open", F.last("_span", ignorenulls=True).over(order)).filter(F.col("_span").isNull())
    hits = carried.filter(F.col("_day") <= F.col(f"_open.{end}")).select(*own, "_day", "_open.*").select(*keys, "_day", *[c for c in right.columns if c not in keys])
    return _with_hits(left, hits, keys, point, how, spread_on)


def _bucket(day: Column, unit: str, low: date | Column, high: date | Column) -> Column:
    """Calendar bucket of a day after clamping to [low, high]; null stays null.

    Clamping keeps order, so a day inside an interval always lies between the
    interval's first and last bucket: no match is lost whatever the bounds are.
    """
    clamped = F.least(F.greatest(day, F.lit(low)), F.lit(high))  # F.lit leaves columns as they are
    return F.when(day.isNotNull(), F.trunc(clamped, unit))


def calendar_interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    point: str,
    start: str,
    end: str,
    how: str = "inner",
    unit: str = "month",
    low: date | Column = OPEN_START,
    high: date | Column = date(2100, 1, 1),
    spread_on: list[str] | None = None,
) -> DataFrame:
    """Rows of ``left`` with every row of ``right`` whose [start, end] holds ``point``.

    Both sides carry a calendar bucket as a further equality key: a hot key is
    split over its months (or years), and a row meets only the intervals of its own
    bucket. ``low``/``high`` bound how many buckets an open interval is copied to.
    Choose them near the range of the data; results do not depend on the choice.
    """
    step = {"month": F.expr("INTERVAL 1 MONTH"), "quarter": F.expr("INTERVAL 3 MONTH"), "year": F.expr("INTERVAL 1 YEAR")}[unit]
    first, last = _bucket(F.col(start), unit, low, high), _bucket(F.col(end), unit, low, high)
    spans = right.filter(F.col(start) <= F.col(end)).withColumn("_slot", F.explode(F.sequence(first, last, step)))
    if start in keys or end in keys:
        raise ValueError("interval bounds cannot be join keys")
    points = left.withColumn("_slot", _bucket(F.col(point), unit, low, high))
    on = [*keys, "_slot"]
    if how == "left" and spread_on:
        points, spans, on = _spread_unmatchable(points, spans, on, spread_on)
    a, b = points.alias("a"), spans.alias("b")
    condition = F.col(f"a.{point}").between(F.col(f"b.{start}"), F.col(f"b.{end}"))
    for k in on:
        condition = condition & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    out = a.join(b, condition, how)
    keep = [F.col(f"a.{c}") for c in left.columns]
    keep += [F.col(f"b.{c}") for c in right.columns if c not in keys]
    return out.select(*keep)


def _no_salt(*keys: str) -> Column:
    """0, computed from the keys. Spark folds a literal into the join condition, and the salt is then no key of the shuffle any more."""
    return F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")


def _spread_unmatchable(left: DataFrame, right: DataFrame, on: list[str], spread_on: list[str]):
    """Rows with a null key match nothing; scatter them instead of sending all to one task."""
    unmatchable = F.lit(False)
    for k in on:
        unmatchable = unmatchable | F.col(k).isNull()
    salt = F.when(unmatchable, F.pmod(F.xxhash64(*spread_on), F.lit(SPREAD))).otherwise(F.lit(0)).cast("int")
    return left.withColumn("_spread", salt), right.withColumn("_spread", _no_salt(*on)), [*on, "_spread"]


def measured_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equality join whose sides are dealt by the keys first, so that a broadcast is decided by their real size.

    Of rows that come straight from files Spark knows an estimate, which leaves out an explode and what compression saves, and the
    driver holds what is broadcast. Behind a shuffle adaptive execution knows the bytes. Both sides are dealt because it changes a
    plan only if that takes no further shuffle. For sides without very hot keys: a shuffle that was asked for is not split.
    """
    return left.repartition(*keys).join(right.repartition(*keys), keys, how)


def left_join_nullable(left: DataFrame, right: DataFrame, keys: list[str], spread_on: list[str], measured: bool = False) -> DataFrame:
    """Left join whose key is often null on the left side; ``measured`` as in ``measured_join``."""
    a, b, on = _spread_unmatchable(left, right, keys, spread_on)
    return (measured_join(a, b, on, "left") if measured else a.join(b, on, "left")).drop("_spread")


def full_outer_nullable(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_spread: list[str], right_spread: list[str]) -> DataFrame:
    """Full outer join on keys that are often null.

    Rows with a null key match nothing and are scattered by a salt; rows with a key carry salt 0 on both sides, so
    they meet as they would without it. The salts of the two sides never agree, as a null key matches none.
    """

    def salted(df: DataFrame, key: str, spread: list[str], name: str) -> DataFrame:
        return df.withColumn(name, F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*spread), F.lit(SPREAD))).otherwise(_no_salt(key)).cast("int"))

    a, b = salted(left, left_key, left_spread, "_left_spread"), salted(right, right_key, right_spread, "_right_spread")
    on = (F.col(left_key) == F.col(right_key)) & (F.col("_left_spread") == F.col("_right_spread"))
    return a.join(b, on, "full_outer").drop("_left_spread", "_right_spread")


def semi_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys), keys, "left_semi")


def anti_join_null_aware(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``key NOT IN (SELECT key FROM right)`` with SQL's null rules, for a list of any size.

    A null in a non-empty list removes every row; a null key passes only an empty
    list. Spark's own plan for NOT IN broadcasts the list whatever its size, so the
    two list facts are uncorrelated scalar subqueries here and the match itself is
    an ordinary anti join, which is free to shuffle.
    """
    facts = right.select(F.col(key).alias("_k"))
    rows = facts.agg(F.count("*").alias("n")).scalar()
    nulls = facts.agg(F.count(F.when(F.col("_k").isNull(), 1)).alias("n")).scalar()
    kept = left.filter((rows == 0) | ((nulls == 0) & F.col(key).isNotNull()))
    return kept.join(right.select(key).filter(F.col(key).isNotNull()), key, "left_anti").select(*left.columns)


def join_group_or_global(left: DataFrame, right: DataFrame, key: str, is_group_row: Column) -> DataFrame:
    """Join on ``key`` for group rows of ``right``, and with every left row for its global rows.

    An OR condition would be a nested loop over both sides. This is one equality join: a left row stands under its key
    and under a salt, and the global rows, the parameters that apply to everybody, under each salt.
    """
    values = [c for c in right.columns if c != key]
    salt = F.concat(F.lit("*"), F.pmod(F.xxhash64(*left.columns), F.lit(GLOBAL_COPIES)).cast("string"))
    own = lambda c: F.concat(F.lit("="), F.col(c).cast("string"))
    standing = left.withColumn("_under", F.explode(F.array_compact(F.array(own(key), salt))))
    copies = F.transform(F.sequence(F.lit(0), F.lit(GLOBAL_COPIES - 1)), lambda i: F.concat(F.lit("*"), i.cast("string")))
    places = F.when(is_group_row, F.array_compact(F.array(own(key)))).otherwise(copies)
    under = right.select(*values, F.explode(places).alias("_under"))
    return standing.join(under, "_under").select(*left.columns, *values)
