"""Joins on small tables, against brute force over the same rows."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from revtrellis.operators.joins import anti_join_null_aware, asof_merge, full_outer_nullable, interval_hits, interval_join, interval_minimum, join_group_or_global, left_join_nullable, semi_join


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _brute(points, spans, how):
    out = []
    for pid, key, day in points:
        hits = [sid for sid, k, a, b in spans if k is not None and k == key and None not in (day, a, b) and a <= day <= b]
        out += [(pid, sid) for sid in hits]
        if not hits and how == "left":
            out.append((pid, None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [7, 8, 9])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_matches_brute_force(spark, seed, how):
    rng = random.Random(seed)
    start = date(1995, 1, 1)
    # A third of all rows sits on one key; some keys and days are missing, some spans are empty or open.
    key = lambda: "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None])
    day = lambda: None if rng.random() < 0.05 else start + timedelta(days=rng.randrange(1500))
    points = [(i, key(), day()) for i in range(400)]
    spans = []
    for i in range(120):
        a = day()
        b = None if a is None else rng.choice([a - timedelta(days=1), a, a + timedelta(days=rng.randrange(400)), date(9999, 12, 31)])
        spans.append((i, key(), a, b))
    left = spark.createDataFrame(points, "pid int, k string, d date")
    right = spark.createDataFrame(spans, "sid int, k string, a date, b date")
    joined = interval_join(left, right, ["k"], "d", "a", "b", how, spread_on=["pid"])
    assert _rows(joined.select("pid", "sid")) == _brute(points, spans, how)


def test_interval_join_edges(spark):
    """Previous close + 1 up to close; the close day of the previous deal belongs to the previous deal."""
    spans = [(1, "x", date(1900, 1, 1), date(2024, 2, 29)), (2, "x", date(2024, 3, 1), date(2024, 3, 31))]
    points = [(1, "x", date(2024, 2, 29)), (2, "x", date(2024, 3, 1)), (3, "x", date(2024, 3, 31)), (4, "x", date(2024, 4, 1))]
    left = spark.createDataFrame(points, "pid int, k string, d date")
    right = spark.createDataFrame(spans, "sid int, k string, a date, b date")
    got = _rows(interval_join(left, right, ["k"], "d", "a", "b", "left").select("pid", "sid"))
    assert got == [(1, 1), (2, 2), (3, 2), (4, None)]


@pytest.mark.parametrize("listed", [[], [1, 2], [1, None], [None]])
def test_anti_join_follows_not_in(spark, listed):
    left = spark.createDataFrame([(1, "a"), (3, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(x,) for x in listed], "k int")
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    wanted = _rows(spark.sql("SELECT * FROM l WHERE k NOT IN (SELECT k FROM r)"))
    assert _rows(anti_join_null_aware(left, right, "k")) == wanted


def test_anti_join_does_not_broadcast_the_list(spark):
    left, right = spark.range(10).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = anti_join_null_aware(left, right, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_left_join_nullable_keeps_null_keys(spark):
    left = spark.createDataFrame([(1, 5), (2, None), (3, 6)], "id int, k int")
    right = spark.createDataFrame([(5, "five"), (None, "null")], "k int, v string")
    assert _rows(left_join_nullable(left, right, ["k"], ["id"]).select("id", "v")) == [(1, "five"), (2, None), (3, None)]


def test_semi_join_does_not_multiply(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert _rows(semi_join(left, right, ["k"])) == [(1,)]


def test_group_or_global_join(spark):
    left = spark.createDataFrame([("r1", "g1"), ("r2", "g2"), ("r3", None)], "rep string, g string")
    sheet = spark.createDataFrame([("g1", "core", "m1"), ("g2", "core", "m2"), (None, "other", "x"), ("g1", "other", "y")], "g string, kind string, metric string")
    got = _rows(join_group_or_global(left, sheet, "g", F.col("kind") == "core").select("rep", "metric"))
    assert got == sorted([("r1", "m1"), ("r2", "m2")] + [(r, m) for r in ("r1", "r2", "r3") for m in ("x", "y")])


def test_full_outer_join_scatters_null_keys(spark):
    rng = random.Random(5)
    left = [(i, None if rng.random() < 0.9 else rng.randrange(60)) for i in range(3000)]
    right = [(None if i % 3 == 0 else i % 80, f"r{i}") for i in range(300)]
    expected = [(i, k, r) for i, k in left for x, r in right if k is not None and x == k]
    met = {i for i, _, _ in expected}, {r for _, _, r in expected}
    expected += [(i, k, None) for i, k in left if i not in met[0]] + [(None, None, r) for _, r in right if r not in met[1]]
    a, b = spark.createDataFrame(left, "id long, k long"), spark.createDataFrame(right, "x long, r string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = full_outer_nullable(a, b, "k", "x", ["id"], ["r"])
        got = sorted(((r.id, r.k, r.r) for r in joined.collect()), key=repr)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(expected, key=repr)
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def _disjoint(rng, key, n):
    """Periods of a key that do not overlap, some empty, the last one open."""
    days = sorted(rng.sample(range(1500), 2 * n))
    base = date(1995, 1, 1)
    out = [(key, base + timedelta(days=a), base + timedelta(days=b - rng.choice([0, 1]))) for a, b in zip(days[::2], days[1::2])]
    return out + [(key, base + timedelta(days=700), base + timedelta(days=699)), (key, base + timedelta(days=1501), rng.choice([date(9000, 1, 1), date(9999, 12, 31)])), (key, None, base)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_merge_matches_brute_force(spark, how):
    rng = random.Random(11)
    spans = [(i, *x) for i, x in enumerate(x for k in ("hot", "a", "b", None) for x in _disjoint(rng, k, 20))]
    start = date(1995, 1, 1)
    points = [(i, "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None]), None if rng.random() < 0.05 else start + timedelta(days=rng.randrange(1600))) for i in range(500)]
    points += [(900, "a", date(9000, 1, 1)), (901, "b", date(1, 1, 1))]
    left, right = spark.createDataFrame(points, "pid int, k string, d date"), spark.createDataFrame(spans, "sid int, k string, a date, b date")
    got = asof_merge(left, right, ["k"], "d", "a", "b", how, spread_on=["pid"])
    assert _rows(got.select("pid", "sid")) == _brute(points, spans, how)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "NestedLoop" not in plan


def test_asof_merge_with_streams(spark):
    rng = random.Random(12)
    base = date(1995, 1, 1)
    spans = [(i, k, s, a, b) for i, (k, s, (_, a, b)) in enumerate((k, s, x) for k in "xy" for s in "123" for x in _disjoint(rng, k, 10))]
    points = [(i, rng.choice("xyz"), base + timedelta(days=rng.randrange(1500))) for i in range(200)]
    left, right = spark.createDataFrame(points, "pid int, k string, d date"), spark.createDataFrame(spans, "sid int, k string, s string, a date, b date")
    got = asof_merge(left, right, ["k"], "d", "a", "b", streams=["s"])
    assert got.columns == ["pid", "k", "d", "sid", "s", "a", "b"]
    assert _rows(got.select("pid", "sid")) == _brute(points, [(i, k, a, b) for i, k, _, a, b in spans], "inner")


def test_a_wrong_date_changes_no_volume(spark):
    """What the interval operators make between scan and result does not depend on how far a date is off."""
    base = date(1995, 1, 1)
    points = spark.createDataFrame([(i, "k", base + timedelta(days=i)) for i in range(50)], "pid int, k string, d date")
    volumes = []
    for far in (date(1996, 1, 1), date(9000, 1, 1)):
        spans = spark.createDataFrame([(i, "k", base + timedelta(days=i), base + timedelta(days=i)) for i in range(50)] + [(99, "k", base, far)], "sid int, k string, a date, b date")
        hits = interval_hits(points, spans, ["k"], "d", "a", "b")
        volumes.append((hits.count(), interval_join(points, spans, ["k"], "d", "a", "b").count()))
    assert volumes[0] == volumes[1] == (100, 100)


def test_interval_minimum_keeps_one_row(spark):
    base = date(1995, 1, 1)
    points = [(1, "a", base), (2, "a", base + timedelta(days=5)), (3, "a", base), (4, None, base), (5, "b", base), (6, "a", None)]
    spans = [("z", "a", base, date(9999, 12, 31)), ("m", "a", base + timedelta(days=4), base + timedelta(days=6)), (None, "b", base, base)]
    left, right = spark.createDataFrame(points, "pid int, k string, d date"), spark.createDataFrame(spans, "name string, k string, a date, b date")
    got = interval_minimum(left, right, ["k"], "d", "a", "b", "name", "owner", ["pid"])
    assert _rows(got.select("pid", "owner")) == [(1, "z"), (2, "m"), (3, "z"), (4, None), (5, None), (6, None)]


@pytest.mark.parametrize("outer", ["left", "full"])
def test_null_keys_are_dealt_over_many_tasks(spark, outer):
    """The salt is a key of the shuffle: rows without a key do not meet in one task."""
    left = spark.range(400).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), F.col("id").alias("i"))
    right = spark.range(0, 400, 5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        if outer == "left":
            joined = left_join_nullable(left, right, ["k"], ["i"])
        else:
            joined = full_outer_nullable(left, right.withColumnRenamed("k", "rk"), "k", "rk", ["i"], ["v"])
        places = joined.filter(F.col("k").isNull() & F.col("i").isNotNull()).select("i", F.spark_partition_id().alias("p")).collect()
        met = joined.filter("v IS NOT NULL AND i IS NOT NULL").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    counts = [sum(r.p == p for r in places) for p in {r.p for r in places}]
    assert sum(counts) == 360 and met == 40
    assert len(counts) == 8 and max(counts) < 120
