"""Per-key products with heavy keys, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from revtrellis.operators.heavy import Side, heavy_parts, left_product


def _tables(spark, seed):
    """Three tables; key 1 holds a third of two of them or more, one key stands in one table only, some keys are null."""
    rng = random.Random(seed)
    key = lambda hot: 1 if rng.random() < hot else rng.choice([2, 3, 4, 5, None])
    a = [(key(0.5), i) for i in range(40)] + [(9, 100)]
    b = [(key(0.4), i) for i in range(60)] + [(8, 100)]
    c = [(key(0.0), i) for i in range(30)]
    frames = [spark.createDataFrame(rows, f"k int, {name} int") for rows, name in zip((a, b, c), "abc")]
    return (a, b, c), frames


def _brute(a, b, c):
    out = []
    for k, x in a:
        for y in [v for j, v in b if j == k and k is not None] or [None]:
            for z in [v for j, v in c if j == k and k is not None] or [None]:
                out.append((k, x, y, z))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("share", [3, 8])
def test_left_product_matches_brute_force(spark, seed, share):
    rows, frames = _tables(spark, seed)
    got = left_product([Side(f) for f in frames], "k", share=share, least=1)
    assert sorted(map(tuple, got.select("k", "a", "b", "c").collect()), key=repr) == _brute(*rows)


def test_unique_and_empty_sides(spark):
    (a, b, _), (fa, fb, _) = _tables(spark, 4)
    names = [(k, k * 10) for k in range(1, 6)]
    got = left_product([Side(fa), Side(spark.createDataFrame(names, "k int, c int"), unique=True), Side(fb)], "k", share=4, least=1)
    assert sorted(map(tuple, got.select("k", "a", "b", "c").collect()), key=repr) == _brute(a, b, names)
    none = spark.createDataFrame([], "k int, c int")
    got = left_product([Side(fa), Side(fb), Side(none)], "k", share=4, least=1)
    assert sorted(map(tuple, got.select("k", "a", "b", "c").collect()), key=repr) == _brute(a, b, [])
    assert left_product([Side(none.select("k")), Side(fb)], "k", share=4, least=1).count() == 0


def test_rows_of_a_hot_key_are_bounded(spark):
    n, share = 3000, 16
    rows = spark.range(n).select(F.when(F.col("id") < n // 2, 0).otherwise(F.col("id")).cast("int").alias("k"), F.col("id").alias("x"))
    other = rows.withColumnRenamed("x", "y").filter("y % 10 = 0")
    sides = [Side(rows), Side(other)]
    parts = heavy_parts(sides, "k", share, least=10).collect()
    assert [(r.k, r._parts0, r._parts1) for r in parts] == [(0, 8, 8)]
    assert heavy_parts(sides, "k", share).count() == 0  # fewer rows than are worth a split
    joined = left_product(sides, "k", share, least=10)
    assert joined.count() == (n // 2) * (n // 20) + n // 2
    tasks = joined.filter("k = 0").groupBy(F.pmod(F.xxhash64("x"), F.lit(8)), F.pmod(F.xxhash64("y"), F.lit(8))).count()
    assert tasks.count() == 64 and tasks.agg(F.max("count")).head()[0] < 2.5 * (n // 2) * (n // 20) / 64
