"""Products of several tables per key, with the rows of heavy keys dealt over many tasks."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrellis.operators.sets import union_all

SHARE = 32
LEAST = 10_000
SCATTER = 256


@dataclass(frozen=True)
class Side:
    """Rows of one table by the key, and the columns whose hash deals them. ``unique``: one row per key, never heavy."""

    rows: DataFrame
    spread_on: tuple[str, ...] = ()
    unique: bool = False


def heavy_parts(sides: list[Side], key: str, share: int = SHARE, least: int = LEAST) -> DataFrame:
    """The heavy keys with ``_parts<i>``: the number of parts that side i's rows of the key are dealt to.

    A key is heavy on a side where it has more than 1/share of all rows, and ``least`` rows or more; each part then has about
    1/share of the side's rows. So there are fewer than ``share`` heavy keys a side, whatever the size of the tables.
    """
    counted = [i for i, s in enumerate(sides) if not s.unique]
    keys = union_all([sides[i].rows.select(F.col(key).alias("_key"), F.lit(i).alias("_side")) for i in counted]).filter(F.col("_key").isNotNull())
    counts = keys.groupBy("_key").agg(*[F.count_if(F.col("_side") == i).alias(f"_n{i}") for i in counted])
    totals = counts.agg(F.array(*[F.sum(f"_n{i}") for i in counted])).scalar()
    parts: dict[int, Column] = {}
    for at, i in enumerate(counted):
        n = F.col(f"_n{i}")
        heavy = (n >= least) & (n * share > totals[at])
        parts[i] = F.when(heavy, F.ceil(n * share / totals[at])).otherwise(1).cast("bigint")
    found = counts.select(F.col("_key").alias(key), *[parts.get(i, F.lit(1).cast("bigint")).alias(f"_parts{i}") for i in range(len(sides))])
    return found.filter(reduce(Column.__or__, [F.col(f"_parts{i}") > 1 for i in counted]))


def left_product(sides: list[Side], key: str, share: int = SHARE, least: int = LEAST) -> DataFrame:
    """First side left joined with each further one by ``key``: every combination of their rows of a key.

    The combinations of a heavy key form a grid with a dimension for each side it is heavy on. A side's rows are dealt along its
    own dimension and stand in all cells of the others, so each combination comes up in one cell. All joins are on (key, cell), so
    each side is shuffled once. Cells of a heavy dimension that got none of its rows are dropped: the key has rows there, so
    a row without a partner belongs to no result. Rows whose key is null match nothing and are scattered.
    """
    names = [f"_parts{i}" for i in range(len(sides))]
    # One value for the whole plan; by definition of a heavy key it has fewer entries than the number of sides times `share`.
    entries = F.collect_list(F.struct(key, F.array(*names)))
    heavy = heavy_parts(sides, key, share, least).agg(F.map_from_entries(entries)).scalar()
    once = F.array(*[F.lit(1).cast("bigint")] * len(sides))

    def dealt(i: int) -> DataFrame:
        side = sides[i]
        rows = side.rows.withColumn("_parts", F.coalesce(F.try_element_at(heavy, F.col(key)), once))
        rows = rows.withColumns({n: F.col("_parts")[j] for j, n in enumerate(names)})
        own = F.pmod(F.xxhash64(*(side.spread_on or side.rows.columns)), F.col(names[i]))
        below = reduce(Column.__mul__, [F.col(n) for n in names[:i]], F.lit(1).cast("bigint"))
        above = reduce(Column.__mul__, [F.col(n) for n in names[i + 1 :]], F.lit(1).cast("bigint"))
        rows = rows.withColumns({"_own": own, "_below": below})
        rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), below * above - 1)))
        place = F.col("_other") % F.col("_below") + F.col("_below") * (F.col("_own") + F.col(names[i]) * F.floor(F.col("_other") / F.col("_below")))
        if i == 0:
            place = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*side.rows.columns), F.lit(SCATTER))).otherwise(place)
        return rows.withColumn("_cell", place).select(*side.rows.columns, "_cell", *(names if i == 0 else []))

    out = dealt(0)
    for i in range(1, len(sides)):
        met = dealt(i).withColumn("_met", F.lit(True))
        out = out.join(met, [key, "_cell"], "left").filter((F.col(names[i]) == 1) | F.col("_met")).drop("_met")
    return out.drop("_cell", *names)
