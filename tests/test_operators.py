"""Edge rows and invariants of the other operators."""

from datetime import date

from pyspark.sql import functions as F

from revtrellis.functions import dates as D
from revtrellis.functions import numbers as N
from revtrellis.functions import text as X
from revtrellis.operators import activity, funnel, partners, retail, scorecard
from revtrellis.operators.windows import key_maximum, latest_per_key, previous_day
from revtrellis.sources.sheets import SCORECARD_SHEET, read_sheet
from revtrellis.sources.sinks import replace_folder, replace_table


def _one(spark, **cols):
    row = spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).collect()[0]
    return row.asDict()


def test_week_numbers_and_quarter_ends(spark):
    days = [date(2023, 1, 1), date(2022, 1, 1), date(2022, 1, 2), date(2024, 2, 29), date(2024, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [tuple(r) for r in df.select(D.week_number_sunday("d"), D.quarter_end("d"), D.week_start_monday("d")).collect()]
    for d, (week, quarter, monday) in zip(days, got):
        assert week == int(d.strftime("%U"))
        assert quarter.month in (3, 6, 9, 12) and quarter >= d
        assert monday.weekday() == 0 and 0 <= (d - monday).days < 7


def test_minutes_count_boundaries(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:00:59' AS a, TIMESTAMP_NTZ'2024-01-01 10:01:01' AS b")
    assert df.select(D.minutes_between("b", "a")).collect()[0][0] == 1


def test_null_and_zero_rules(spark):
    got = _one(
        spark,
        zero=N.safe_divide(F.lit(1), F.lit(0)),
        none=X.extract_or_null(F.lit("abc"), r"(\d+)", 1),
        found=X.extract_or_null(F.lit("abc 12"), r"(\d+)", 1),
        outside=X.split_item(F.lit("AMER - Canada"), " - ", 2),
        null_cap=funnel.enriched_cap(F.lit(None).cast("double")),
        capped=funnel.enriched_cap(F.lit(3e8)),
        inverse=N.inverse_mean(F.lit(4.0)),
        not_positive=N.inverse_mean(F.lit(-2.0)),
        over=N.coverage(F.lit(100.0), F.lit(1.0)),
        negative=N.coverage(F.lit(1.0), F.lit(-1.0)),
        no_gap=N.coverage(F.lit(1.0), F.lit(0.0)),
    )
    assert got == {
        "zero": None, "none": None, "found": "12", "outside": None, "null_cap": None, "capped": 2e8, "inverse": 0.25, "not_positive": -2.0,
        "over": 10.0, "negative": 10.0, "no_gap": None,
    }


def test_bands_are_monotone_and_gaps_can_be_closed(spark):
    values = [0.0, 1999999.0, 1999999.5, 2000000.0, 39999999.0, 40000000.0, 199999999.0, 200000000.0, 200000001.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    exact = [r[0] for r in df.select(partners.gmv_band(F.col("v"))).collect()]
    closed = [r[0] for r in df.select(partners.gmv_band(F.col("v"), half_open=True)).collect()]
    assert exact == ["0-2M", "0-2M", "Unknown", "2-5M", "5-40M", "40-200M", "40-200M", "Unknown", "200M+", "Unknown"]
    assert closed == ["0-2M", "0-2M", "0-2M", "2-5M", "5-40M", "40-200M", "40-200M", "200M+", "200M+", "Unknown"]


def test_stage_label_keeps_unaccepted_in_progress(spark):
    df = spark.createDataFrame([("Envision", None), ("Envision", 0), ("Pre-Qualified", 0), ("Closed Won", 1)], "s string, a int")
    got = [r[0] for r in df.select(retail.stage_label(F.col("s"), F.col("a"))).collect()]
    assert got == ["In progress", "Not Accepted", "Pre-Qualified", "Closed Won"]


def test_empty_arrays_drop_rows(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, [(7, "p")])], "lead_id int, referring_partners array<struct<partner_id:int,partner_name:string>>")
    assert [tuple(r) for r in partners.referring_partners(df).collect()] == [(3, 7, "p")]


def test_previous_day_is_lag(spark):
    rows = [("a", 3, date(2024, 1, 5)), ("a", 1, date(2024, 1, 1)), ("a", 2, date(2024, 1, 5)), ("a", 4, None), ("b", 5, date(2024, 1, 2))]
    df = spark.createDataFrame(rows, "k string, id int, d date")
    got = {r["id"]: r["p"] for r in previous_day(df, ["k"], "d", "id", "p").collect()}
    assert got == {1: None, 2: date(2024, 1, 1), 3: date(2024, 1, 5), 4: None, 5: None}


def test_latest_per_key_cuts_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    picked = latest_per_key(df, ["k"], [F.desc("id")])
    assert sorted(r["id"] for r in picked.collect()) == [997, 998, 999]
    assert "WindowGroupLimit" in picked._jdf.queryExecution().executedPlan().toString()


def test_key_maximum_handles_null_keys(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (None, 2), (None, 3)], "k int, v int")
    assert sorted((r["k"] or 0, r["m"]) for r in key_maximum(df, ["k"], F.col("v"), "m").collect()) == [(0, 3), (0, 3), (1, 7), (1, 7)]


def test_activity_class_prefers_the_dialler(spark):
    df = spark.createDataFrame([("Reply", "Call"), (None, "In-Person Meeting"), ("LinkedIn - InMail", None), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(activity.activity_class(F.col("a"), F.col("b"))).collect()] == ["Email", "Meeting", "LinkedIn", "Other"]


def test_points_never_exceed_the_weight(spark):
    rows = [("r%d" % i, "g" if i else None, "AMER", "m", date(2024, 1, 31), "t", float(i), 10.0) for i in range(9)]
    rep = spark.createDataFrame(rows, "rep_name string, team_group string, region_compare string, metric string, month_date date, team string, value double, points double")
    got = {r["rep_name"]: r["rep_points"] for r in scorecard.points(rep).collect()}
    assert "r0" not in got
    assert [got[f"r{i}"] for i in range(1, 9)] == [3.0, 5.0, 5.0, 8.0, 8.0, 10.0, 10.0, 10.0]


def test_one_value_per_rep_month_metric(spark, testdata):
    from revtrellis.lens.source import LensSource

    facts = scorecard.all_facts(LensSource(spark, testdata), date(1998, 6, 17), date(1998, 5, 4), ["Tier 1"])
    assert facts.groupBy("rep_name", "month_date", "metric").count().filter("count > 1").count() == 0


def test_sheet_and_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(None, "s", "1a. Calls, sent", 5.0, "count", "g", "sg", "d", None, 1.0)], SCORECARD_SHEET)
    replace_folder(df, str(tmp_path / "sheet"), file_format="csv", header=True)
    assert read_sheet(spark, str(tmp_path / "sheet")).collect() == df.collect()
    replace_table(df, "sheet_copy", path=str(tmp_path / "table"))
    replace_table(df, "sheet_copy", path=str(tmp_path / "table"))
    assert spark.table("sheet_copy").count() == 1
    spark.sql("DROP TABLE sheet_copy")


def test_accounts_are_counted_before_the_reps_are_joined(spark):
    """An account in two territories of a rep counts once; a territory's accounts are not multiplied by its reps."""
    day = date(2024, 3, 30)
    snapshots = spark.createDataFrame(
        [("a1", day, "east", "Tier 1"), ("a1", day, "west", "Tier 1"), ("a2", day, "east", "Tier 2"), ("a3", day, "west", "Tier 4"), ("a4", date(2024, 3, 1), "east", "Tier 1")],
        "account_id string, snapshot_date date, territory_name string, tier string",
    )
    reps = spark.createDataFrame([("both", "East", date(2024, 3, 31)), ("both", "West", date(2024, 3, 31)), ("west", "WEST", date(2024, 3, 31))], "rep_name string, territory_name string, quarter_end date")
    acts = spark.createDataFrame([("a1", date(2024, 3, 2), "Sales"), ("a3", date(2024, 3, 2), "Sales"), ("a2", date(2024, 3, 2), "Support")], "account_id string, activity_date date, activity_group string")
    book = scorecard.book_contacted(snapshots, reps, acts, ["Tier 1", "Tier 2"])
    contacted = scorecard.accounts_contacted(snapshots, reps, acts)
    assert {(r["rep_name"], r["value"], r["snapshot_date"]) for r in book.collect()} == {("both", 0.5, day), ("west", 1.0, day)}
    assert {(r["rep_name"], r["value"], r["snapshot_date"]) for r in contacted.collect()} == {("both", 2, day), ("west", 2, day)}
    for df in (book, contacted):
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        joined = next(i for i, x in enumerate(lines) if "Join Inner" in x)
        assert not [x for x in lines[:joined] if "Aggregate [" in x and "account_id" in x]


def test_quotas_are_dealt_by_worker(spark):
    quota = spark.createDataFrame(
        [(w, f"P:2024:{m:02d}", f"{kind} : PERIODIC : QUOTA", 10.0 * w) for w in (1, 2) for m in (1, 2, 4) for kind in ("INCREMENTAL PRODUCT PROFIT", "TOTAL REVENUE")],
        "payee_id int, period string, attribute_id string, quota double",
    )
    workers = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "worker_id int, worker_name string")
    assert "REPARTITION_BY_COL" in scorecard.quotas(quota, workers)._jdf.queryExecution().executedPlan().toString()
    every = scorecard.quota_keys(quota, workers)
    one = scorecard.quota_keys(quota, workers, spark.createDataFrame([("a",), ("z",)], "rep_name string"))
    wanted = sorted(map(str, every.filter("rep_name = 'a'").collect()))
    assert sorted(map(str, one.collect())) == wanted and len(wanted) == 10


def test_last_snapshot_of_a_month_is_picked_among_rows_with_a_manager_and_a_role(spark):
    """The last row of each pair of ids is picked before managers and roles are joined; a later row without them must not hide an earlier one."""
    days = [date(2024, 1, d) for d in (3, 9, 20, 25, 31)]
    daily = spark.createDataFrame(
        [
            (1, "a", days[0], "Sales", "Field", "old", 10),
            (1, "a", days[1], "Sales", "Field", "kept", 10),
            (1, "a", days[2], "Sales", "Field", "manager left", 11),
            (1, "a", days[3], "Sales", "Field", "no manager", None),
            (2, "a", days[4], "Sales", "Field", "no role", 10),
            (None, "a", days[4], "Sales", "Field", "no id", 10),
            (3, "b", days[1], "Sales", "Field", "z", 10),
            (3, "b", days[1], "Sales", "Field", "y", 10),
            (4, "b", days[1], "Sales", "Field", "x", 10),
        ],
        "worker_id int, worker_name string, effective_on date, discipline string, subdiscipline string, team string, manager_id int",
    )
    workers = spark.createDataFrame([(10, True), (11, False), (10, True)], "worker_id int, is_active boolean")
    users = spark.createDataFrame([(1, "AMER-1", "Main"), (1, "EMEA-1", "Main"), (2, "none", "Main"), (3, "AMER-1", "Main"), (4, "EMEA-1", "Main")], "employee_id int, user_role string, source_system string")
    got = scorecard.worker_month(daily, workers, users, date(2024, 1, 1)).collect()
    assert sorted((r["rep_name"], r["team"]) for r in got) == [("a", "kept"), ("b", "y")]


def test_workers_without_a_manager_stay(spark):
    workers = spark.createDataFrame([(1, "a", "C1", "5", None, True), (2, "b", "C1", "5", 1, True), (3, "c", "C1", "5", 9, True), (4, "d", "C1", "5", 1, False)], "worker_id int, worker_name string, country string, tenure_days string, manager_id int, is_active boolean")
    users = spark.createDataFrame([(i, "AMER-1", "Main") for i in (1, 2, 3, 4)], "employee_id int, user_role string, source_system string")
    got = scorecard.worker_current(workers, users, date(2024, 1, 31)).collect()
    assert sorted((r["rep_name"], r["manager_name"]) for r in got) == [("a", None), ("b", "a"), ("c", None)]
