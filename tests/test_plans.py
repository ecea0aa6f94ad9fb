"""Physical plans stay free of nested loops, row-at-a-time Python and unbounded single tasks."""

import re
from datetime import date

import pytest

from revtrellis.catalog.registry import spark_queries
from revtrellis.operators import scorecard

QUERIES = spark_queries()
REPORTS = sorted(n for n in QUERIES if n.startswith("pipe_"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, testdata):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {name: _plan(QUERIES[name](spark, testdata)) for name in sorted(QUERIES)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_nested_loops_or_forced_broadcasts(plans):
    for name, plan in plans.items():
        for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "BroadcastHashJoin", "BroadcastExchange"):
            assert operator not in plan, (name, operator)


def test_no_python_in_plans(plans):
    for name, plan in plans.items():
        assert "Python" not in plan and "ArrowEval" not in plan, name


def test_reviews_read_the_fact_once(plans):
    assert plans["pipe_qbr"].count("FileScan") <= 4


def test_date_bounds_reach_the_scan(spark, testdata):
    from revtrellis.functions.dates import whole_months_window

    orders = spark.read.parquet(f"{testdata}/orders.parquet")
    df = orders.filter(whole_months_window(orders.o_orderdate, date(1998, 6, 17), 14, 3)).select("o_orderkey")
    plan = _plan(df)
    assert "GreaterThanOrEqual(o_orderdate" in plan and "o_totalprice" not in plan


def test_accounts_are_counted_before_the_watch_list_is_joined(spark, testdata):
    """The stage of the watch list's join holds one aggregate above it, not the three of a distinct count."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        plan = _plan(QUERIES["pipe_outbound_activity"](spark, testdata)).splitlines()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    join = next(i for i, line in enumerate(plan) if "SortMergeJoin [account_id" in line and "LeftOuter" in line)
    above = next(i for i in range(join, -1, -1) if "Exchange" in plan[i])
    below = next(i for i in range(join, len(plan)) if "Exchange" in plan[i])
    assert sum("HashAggregate" in line for line in plan[above:join]) == 1
    assert not any("HashAggregate" in line for line in plan[join:below])


def _held_at_once(node, here):
    """Sorts and aggregates per stage; each holds a page of memory at least, all of a stage in the same task."""
    name = node.nodeName()
    if "Exchange" in name:
        here = []
        yield here
    elif name == "Sort" or name.endswith("Aggregate"):
        here.append(name)
    children = node.children()
    for i in range(children.size()):
        yield from _held_at_once(children.apply(i), here)


@pytest.mark.parametrize("name", ["dom_partner_lead_rows", "pipe_leads"])
def test_no_stage_of_the_lead_rows_holds_many_operators(spark, testdata, name):
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        plan = QUERIES[name](spark, testdata)._jdf.queryExecution().executedPlan()
        last = []
        stages = [last, *_held_at_once(plan, last)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(len(s) for s in stages) <= 12


@pytest.mark.parametrize("name", ["dom_influence_flag", "dom_influence_flag_patterns"])
def test_activities_without_an_opportunity_are_dealt_by_their_salt(spark, testdata, name):
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        plan = _plan(QUERIES[name](spark, testdata))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    keys = [k for k in re.findall(r"SortMergeJoin \[([^\]]*)\], [^\n]*LeftOuter", plan) if re.match("opportunity_id|_account", k)]
    assert len(keys) == 3 and all("_spread" in k for k in keys)


def _broadcast_rows(node):
    """Rows of each table that a finished run has broadcast."""
    name = node.nodeName()
    if name == "BroadcastExchange":
        yield node.metrics().apply("numOutputRows").value()
    below = [node.children().apply(i) for i in range(node.children().size())]
    below += [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if name.endswith("QueryStage") else []
    for child in below:
        yield from _broadcast_rows(child)


def test_users_and_workers_are_not_broadcast_by_the_size_of_their_files(spark, tmp_path):
    """Files of sequential keys and names are small, their rows are not, and an explode is not in the estimate."""
    n, name, boss = 20_000, "'Rep ' || id", "id - id % 10"
    texts = {
        "user": f"id AS user_id, {name} AS name, 'rep' || id || '@x' AS email, id AS guid, id AS employee_id, 'AMER-1' AS user_role, 'Main' AS source_system, 'Rep ' || ({boss}) AS manager_name",
        "worker": f"id AS worker_id, {name} AS worker_name, 'C1' AS country, '10' AS tenure_days, {boss} AS manager_id, true AS is_active",
        "daily": f"id AS worker_id, {name} AS worker_name, DATE'2024-01-31' AS effective_on, 'Sales' AS discipline, 'Field' AS subdiscipline, 'Sales SMB' AS team, {boss} AS manager_id",
        "quota": "id AS payee_id, 'P:2024:01' AS period, explode(array('TOTAL REVENUE : PERIODIC : QUOTA', 'SOLUTION ACTIVATIONS : PERIODIC : QUOTA')) AS attribute_id, 1e0 AS quota",
        "call": "id, DATE'2024-01-31' AS created_date, struct(id AS id) AS sender, 'Connected' AS disposition, 'Interested' AS sentiment",
    }
    for t, text in texts.items():
        spark.sql(f"SELECT {text} FROM range(0, {n}, 1, 1)").write.parquet(str(tmp_path / t))
    users, workers, daily, quota, calls = (spark.read.parquet(str(tmp_path / t)) for t in texts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "300k")
    try:
        found = {
            "activity_keys": scorecard.activity_keys([scorecard.call_events(calls)], users),
            "worker_month": scorecard.worker_month(daily, workers, users, date(2024, 1, 1)),
            "worker_current": scorecard.worker_current(workers, users, date(2024, 1, 31)),
            "quotas": scorecard.quotas(quota, workers),
            "quota_keys": scorecard.quota_keys(quota, workers),
        }
        rows = {k: len(df.collect()) for k, df in found.items()}
        sent = {k: max(_broadcast_rows(df._jdf.queryExecution().executedPlan()), default=0) for k, df in found.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == {"activity_keys": n, "worker_month": n, "worker_current": n, "quotas": n, "quota_keys": 4 * n}
    assert max(sent.values()) < n // 10, sent
