"""Rep scorecard: monthly facts per rep and metric, bands, points, totals.

Each metric is a long fact ``(rep_name, month_date, metric, value)``. The facts are unioned and
meet the worker-month grid in one join; the reports' form has one outer join per metric.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrellis.functions.dates import as_date, days_between, minutes_between, month_end, period_month, quarter_end, quarter_start
from revtrellis.functions.numbers import count_if, coverage, inverse_mean, lookup, safe_divide, sum_if, zero_if_null
from revtrellis.functions.text import any_like
from revtrellis.operators.joins import join_group_or_global, left_join_nullable, measured_join, semi_join
from revtrellis.operators.sets import union_all
from revtrellis.operators.windows import latest_per_key
from revtrellis.params import fixed_values as V
from revtrellis.params.scorecard_sheet import CORE_GROUPS

LONG = ["rep_name", "month_date", "metric", "value"]
SALES_REGIONS = ("AMER", "EMEA", "APAC", "LATA")


# ---------------------------------------------------------------- workers


def team_group(team: Column, role: Column) -> Column:
    """Scorecard group of a team; the enterprise team splits by role text."""
    enterprise, emerging = team == V.ENTERPRISE_TEAM, any_like(role, V.EMERGING_ROLE_PATTERNS)
    return (
        F.when(enterprise & emerging, "ENT Emerging")
        .when(enterprise & ~emerging, "ENT Established")
        .when(team.like("Sales Global%"), "Global Accounts")
        .when(team.like("%Sales Lending Cross-Sell%"), "Lending Acceleration")
        .when(team.like("%Sales Ads Cross-Sell%"), "Ads")
        .otherwise(lookup(team, V.TEAM_GROUPS))
    )


def _sales_users(users: DataFrame) -> DataFrame:
    kept = users.filter(F.left("user_role", F.lit(4)).isin(*SALES_REGIONS) & (F.col("source_system") == "Main"))
    return kept.select(F.col("employee_id").alias("worker_id"), "user_role")


def worker_month(daily: DataFrame, workers: DataFrame, users: DataFrame, from_date: date) -> DataFrame:
    """Last snapshot of each worker in each month, for workers with an active manager.

    Manager and role depend on the ids of a row only, so the last row of each pair of ids is picked before they are joined.
    """
    managers = workers.filter("is_active").select(F.col("worker_id").alias("manager_id"))
    rows = daily.filter(F.col("effective_on") >= F.lit(from_date)).withColumn("month_date", month_end("effective_on"))
    rows = latest_per_key(rows, ["worker_name", "month_date", "worker_id", "manager_id"], [F.desc("effective_on"), F.asc("team")])
    rows = measured_join(measured_join(rows, managers, ["manager_id"], "left_semi"), _sales_users(users), ["worker_id"])
    picked = latest_per_key(rows, ["worker_name", "month_date"], [F.desc("effective_on"), F.asc("user_role"), F.asc("team")])
    return picked.select(
        F.col("worker_name").alias("rep_name"), "month_date", "discipline", "subdiscipline", "team", team_group(F.col("team"), F.col("user_role")).alias("team_group")
    )


def worker_current(workers: DataFrame, users: DataFrame, as_of) -> DataFrame:
    """Active worker with manager name, region and start date from tenure."""
    managers = workers.select(F.col("worker_id").alias("manager_id"), F.col("worker_name").alias("manager_name"))
    rows = left_join_nullable(workers.filter("is_active"), managers, ["manager_id"], ["worker_id"], measured=True)
    rows = measured_join(rows, _sales_users(users), ["worker_id"])
    role = F.col("user_role")
    region = F.when(role.like("%AMER%"), "AMER").when(role.like("%EMEA%"), "EMEA").when(role.like("%APAC%"), "APAC").when(role.like("%LATA%"), "LATAM")
    return rows.select(
        F.col("worker_name").alias("rep_name"),
        "manager_name",
        "country",
        F.date_sub(as_date(as_of), F.col("tenure_days").cast("int")).alias("tenure_start_date"),
        region.alias("region"),
        F.when(role.like("%AMER%"), "AMER").otherwise("International").alias("region_compare"),
        F.col("user_role").alias("rep_role"),
    )


# ---------------------------------------------------------------- long facts


def to_long(df: DataFrame, metrics: dict[str, str], rep: str = "rep_name", month: str = "month_date") -> DataFrame:
    """Wide per-rep columns to long rows; missing values are dropped, as the report does."""
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(c).cast("double").alias("value")) for c, name in metrics.items()])
    rows = df.select(F.col(rep).alias("rep_name"), F.col(month).alias("month_date"), F.explode(pairs).alias("_p"))
    return rows.select("rep_name", "month_date", "_p.*").filter(F.col("value").isNotNull())


def _tally(rows: DataFrame, who: Column, month: Column, key: str, total: Column | None = None, n: Column | None = None, hits: Column | None = None, opps: Column | None = None) -> DataFrame:
    """Rows of one activity source per actor and month, in the form of the activity stream."""
    sums = {"total": (total, "double"), "n": (F.count("*") if n is None else n, "long"), "hits": (hits, "long"), "opps": (opps, "long")}
    out = rows.groupBy(who.alias("who"), month.alias("month_date"), F.lit(key).alias("key"), F.lit(None).cast("string").alias("guest"))
    return out.agg(*[(F.lit(None) if v is None else v).cast(kind).alias(name) for name, (v, kind) in sums.items()])


def _who(kind: str, value: str) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.col(value).cast("string"))


def email_events(rows: DataFrame) -> DataFrame:
    return _tally(rows, _who("id", "sender.id"), month_end("created_date"), "email", hits=count_if(F.col("view_tracking")), opps=count_if(F.col("counts.replies") > 0))


def call_events(rows: DataFrame) -> DataFrame:
    connected, interested = count_if(F.col("disposition") == "Connected"), count_if(F.col("sentiment") == "Interested")
    return _tally(rows, _who("id", "sender.id"), month_end("created_date"), "call", hits=connected, opps=interested)


def cadence_events(cadences: DataFrame) -> DataFrame:
    return _tally(cadences, _who("id", "owner.id"), month_end("created_date"), "cadence", hits=F.sum("counts.meetings_booked"), opps=F.sum("counts.people_acted_on"))


def talk_events(conversations: DataFrame) -> DataFrame:
    return _tally(conversations, _who("guid", "user_guid"), month_end("created_date"), "talk", total=F.sum(F.col("duration_ms") / 60000))


def meeting_events(meetings: DataFrame, cadences: DataFrame | None = None, kinds: tuple[str, ...] = ("show", "minutes", "accepted")) -> DataFrame:
    """Kept meetings by calendar, minutes by the owner of the cadence, and accepted guests: one read of the meetings."""
    rows = meetings
    tags = []
    none = F.lit(None).cast("string")

    def tag(who: Column, month: Column, key: str, guest: Column = none, minutes: Column = F.lit(None).cast("long"), hit: Column = F.lit(None).cast("long")) -> Column:
        return F.struct(who.alias("who"), month.alias("month_date"), F.lit(key).alias("key"), guest.alias("guest"), minutes.cast("long").alias("minutes"), hit.cast("long").alias("hit"))

    calendar = _who("email", "calendar_id")
    if "show" in kinds:
        tags.append(F.array(tag(calendar, month_end("created_date"), "show", hit=F.when(~F.col("no_show"), 1))))
    if "minutes" in kinds:
        owners = cadences.select(F.col("id").alias("_cadence"), _who("id", "owner.id").alias("_owner"))
        rows = rows.withColumn("_cadence", F.col("cadence.id")).join(owners, "_cadence", "left")
        tags.append(F.array(tag(F.col("_owner"), month_end("start_time"), "minutes", minutes=minutes_between("end_time", "start_time"))))
    if "accepted" in kinds:
        accepted = F.filter(F.coalesce("attendees", F.array().cast(meetings.schema["attendees"].dataType)), lambda a: a["status"] == "accepted")
        tags.append(F.transform(accepted, lambda a: tag(calendar, month_end("start_time"), "accepted", guest=a["email"])))
    events = rows.select(F.explode(F.concat(*tags)).alias("_e")).select("_e.*").filter(F.col("who").isNotNull())
    return events.groupBy("who", "month_date", "key", "guest").agg(
        F.sum("minutes").cast("double").alias("total"), F.when(F.col("key") == "minutes", F.count("minutes")).otherwise(F.count("*")).alias("n"), F.count("hit").alias("hits"), F.lit(None).cast("long").alias("opps")
    )


def activity_keys(events: list[DataFrame], users: DataFrame) -> DataFrame:
    """The activity stream in the form of ``fact_keys``: all sources are reduced per actor, then meet the users once.

    A guest only counts if it is the actor's manager. Users stand there once per kind of name, which Spark's estimate of their size leaves out.
    """
    stream = union_all(events)
    names = users.select(
        F.explode(F.array(_who("id", "user_id"), _who("email", "email"), _who("guid", "guid"))).alias("who"), F.col("name").alias("rep_name"), "manager_name"
    ).filter(F.col("who").isNotNull())
    rows = measured_join(stream, names, ["who"])
    managers = users.filter(F.col("email").isNotNull()).groupBy(F.col("email").alias("guest"), F.col("name").alias("manager_name")).agg(F.count("*").alias("_managers"))
    rows = left_join_nullable(rows, managers, ["guest", "manager_name"], ["who", "month_date"], measured=True)
    rows = rows.filter((F.col("key") != "accepted") | F.col("_managers").isNotNull()).withColumn("n", F.col("n") * F.coalesce("_managers", F.lit(1)))
    return rows.groupBy("rep_name", "month_date", "key").agg(*[F.sum(c).alias(c) for c in ("total", "n", "hits", "opps")])


def _shown(keys: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return keys.select("month_date", "rep_name", *[v.alias(k) for k, v in columns.items()])


def emails(rows: DataFrame, users: DataFrame) -> DataFrame:
    n = F.col("n")
    return _shown(activity_keys([email_events(rows)], users), {"emails_sent": n, "email_open_rate": safe_divide(F.col("hits"), n), "email_response_rate": safe_divide(F.col("opps"), n)})


def calls(rows: DataFrame, users: DataFrame) -> DataFrame:
    n, interested = F.col("n"), F.col("opps")
    shown = {"calls_sent": n, "calls_response_rate": safe_divide(F.col("hits"), n), "calls_interested": interested, "call_interest_rate": safe_divide(interested, n)}
    return _shown(activity_keys([call_events(rows)], users), shown)


def appointments(cadences: DataFrame, users: DataFrame) -> DataFrame:
    return _shown(activity_keys([cadence_events(cadences)], users), {"value": safe_divide(F.col("hits"), F.col("opps"))})


def show_rate(meetings: DataFrame, users: DataFrame) -> DataFrame:
    return _shown(activity_keys([meeting_events(meetings, kinds=("show",))], users), {"value": safe_divide(F.col("hits"), F.col("n"))})


def meeting_minutes(meetings: DataFrame, cadences: DataFrame, users: DataFrame) -> DataFrame:
    return _shown(activity_keys([meeting_events(meetings, cadences, ("minutes",))], users), {"value": safe_divide(F.col("total"), F.col("n"))})


def manager_accepted(meetings: DataFrame, users: DataFrame) -> DataFrame:
    """Meetings whose accepted attendee is the rep's manager."""
    return _shown(activity_keys([meeting_events(meetings, kinds=("accepted",))], users), {"value": F.col("n")})


def actual_facts(fact: DataFrame, metrics: list[str], value_types: list[str], dataset: str = "Actuals") -> DataFrame:
    return fact.filter((F.col("dataset") == dataset) & F.col("metric").isin(*metrics) & F.col("value_type").isin(*value_types))


def _per_owner(rows: DataFrame, period: Column | None = None) -> DataFrame:
    return rows.groupBy(F.col("opportunity_owner").alias("rep_name"), (month_end("full_date") if period is None else period).alias("month_date"))


def created(fact: DataFrame) -> DataFrame:
    return _per_owner(actual_facts(fact, ["Created"], ["Opportunity Deal Count"])).agg(F.sum("value").alias("value"))


def created_value(fact: DataFrame) -> DataFrame:
    rows = actual_facts(fact, ["Created"], ["Total Revenue", "Incremental Product Profit"])
    return _per_owner(rows).agg(
        sum_if(F.col("value_type") == "Total Revenue", F.col("value")).alias("created_revenue"),
        sum_if(F.col("value_type") == "Incremental Product Profit", F.col("value")).alias("created_profit"),
    )


def _territory_reps(territory_reps: DataFrame) -> DataFrame:
    return territory_reps.select("rep_name", F.upper("territory_name").alias("_territory"), F.col("quarter_end").alias("_quarter")).distinct()


def _territory_days(snapshots: DataFrame, activity: DataFrame) -> DataFrame:
    """Accounts of each territory on each snapshot day, with whether sales contacted them that month."""
    contacted = activity.filter(F.col("activity_group") == "Sales").select("account_id", month_end("activity_date").alias("month_date")).distinct()
    rows = snapshots.withColumns({"_territory": F.upper("territory_name"), "_quarter": quarter_end("snapshot_date"), "month_date": month_end("snapshot_date")})
    return rows.join(contacted.withColumn("_hit", F.lit(1)), ["account_id", "month_date"], "left")


def _rep_days(rows: DataFrame, territory_reps: DataFrame) -> DataFrame:
    """Accounts of each rep's territories on each snapshot day, and how many of them were contacted.

    Accounts are counted per set of territories they are in on a day, most often one territory, before the reps are joined: a territory
    of many accounts is not multiplied by its reps, and an account in two territories of a rep counts once.
    """
    day = ["_quarter", "month_date", "snapshot_date"]
    per_account = rows.groupBy(*day, "account_id").agg(F.array_sort(F.collect_set("_territory")).alias("_held"), F.max("_hit").alias("hit"))
    counts = per_account.groupBy(*day, "_held").agg(F.count("account_id").alias("accounts"), F.count("hit").alias("hits"))
    of_rep = counts.withColumn("_territory", F.explode("_held")).join(_territory_reps(territory_reps), ["_territory", "_quarter"])
    of_rep = of_rep.select("rep_name", *day, "_held", "accounts", "hits").distinct()
    return of_rep.groupBy("rep_name", "month_date", "snapshot_date").agg(F.sum("accounts").alias("accounts"), F.sum("hits").alias("hits"))


def _last_snapshot(counts: DataFrame) -> DataFrame:
    return counts.groupBy("rep_name", "month_date").agg(F.max_by("value", "snapshot_date").alias("value"), F.max("snapshot_date").alias("snapshot_date"))


def book_contacted(snapshots: DataFrame, territory_reps: DataFrame, activity: DataFrame, tiers: list[str]) -> DataFrame:
    """Share of the book contacted, on the last snapshot of the month."""
    counts = _rep_days(_territory_days(snapshots.filter(F.col("tier").isin(*tiers)), activity), territory_reps)
    return _last_snapshot(counts.withColumn("value", safe_divide(F.col("hits"), F.col("accounts"))))


def accounts_contacted(snapshots: DataFrame, territory_reps: DataFrame, activity: DataFrame) -> DataFrame:
    """Contacted accounts on the last snapshot of the month that has any."""
    counts = _rep_days(_territory_days(snapshots, activity).filter(F.col("_hit") == 1), territory_reps)
    return _last_snapshot(counts.withColumnRenamed("accounts", "value"))


def quotas(attainment: DataFrame, workers: DataFrame, quarterly: bool = True) -> DataFrame:
    """Three quotas per worker and month or quarter.

    There is about a group per worker and period, which no task may hold alone: the rows are dealt by worker before they are summed.
    """
    names = workers.select(F.col("worker_id").alias("payee_id"), F.col("worker_name").alias("rep_name")).filter(F.col("rep_name").isNotNull())
    first = period_month("period")
    kinds = {"profit_quota": V.QUOTA_PROFIT, "revenue_quota": V.QUOTA_REVENUE, "activations_quota": V.QUOTA_ACTIVATIONS}
    rows = measured_join(attainment.filter(F.col("attribute_id").isin(*kinds.values())), names, ["payee_id"])
    return rows.groupBy("rep_name", (quarter_end(first) if quarterly else F.last_day(first)).alias("month_date")).agg(
        *[sum_if(F.col("attribute_id") == v, F.col("quota")).alias(k) for k, v in kinds.items()]
    )


VALUE_KINDS = {"profit": "Incremental Product Profit", "revenue": "Total Revenue", "activations": "Solution Activations"}


def value_sums(fact: DataFrame, metric: str, prefix: str, quarterly: bool, dataset: str = "Actuals", snapshot: date | None = None) -> DataFrame:
    """Profit, revenue and activations per owner and period, in columns."""
    rows = actual_facts(fact, [metric], list(VALUE_KINDS.values()), dataset).filter(F.col("opportunity_owner") != "")
    if snapshot is not None:
        rows = rows.filter(F.col("snapshot_date") == F.lit(snapshot))
    period = quarter_end("full_date") if quarterly else month_end("full_date")
    return _per_owner(rows, period).agg(*[sum_if(F.col("value_type") == v, F.col("value")).alias(f"{prefix}_{k}") for k, v in VALUE_KINDS.items()])


def pipe_coverage(quota: DataFrame, actuals: DataFrame, open_pipe: DataFrame, quarter: Column, month: Column) -> DataFrame:
    """Open pipeline ÷ what is left of the quota, for one quarter; reported in the as-of month."""
    keys = ["rep_name", "month_date"]
    rows = quota.filter(F.col("month_date") == quarter).join(actuals, keys, "left").join(open_pipe, keys, "left")
    cols = {}
    for k in VALUE_KINDS:
        gap = F.col(f"{k}_quota") - zero_if_null(F.col(f"actual_{k}"))
        cols[f"{k}_coverage"] = coverage(F.col(f"open_{k}"), gap)
        cols[f"{k}_gap"] = F.when(gap < 0, F.lit(0.0)).otherwise(gap)
    return rows.withColumns({**cols, "month_date": month})


def attainment_to_date(quota: DataFrame, actuals: DataFrame, as_of: date) -> DataFrame:
    """Attainment of the running quarter, reported in the as-of month."""
    today = F.lit(as_of)
    running = quota.filter(F.col("month_date") == quarter_end(today))
    return attainment(running, actuals).withColumn("month_date", F.last_day(today))


def attainment(quota: DataFrame, actuals: DataFrame) -> DataFrame:
    rows = quota.join(actuals, ["rep_name", "month_date"], "left")
    return rows.withColumns({f"{k}_attainment": safe_divide(F.col(f"actual_{k}"), F.col(f"{k}_quota")) for k in VALUE_KINDS})


def pacing(quota: DataFrame, actuals: DataFrame, as_of) -> DataFrame:
    """Actuals against the quota due by now; the quarter is taken as elapsed up to the as-of day."""
    today = as_date(as_of)
    total = days_between(quarter_end(today), quarter_start(today)) + 1
    elapsed = total - days_between(quarter_end(today), today)
    rows = quota.filter(F.col("month_date") == quarter_end(today)).join(actuals, ["rep_name", "month_date"], "left")
    paced = {f"{k}_pacing": safe_divide(F.col(f"actual_{k}"), F.col(f"{k}_quota") * elapsed / total) for k in VALUE_KINDS}
    return rows.withColumns({"percent_of_quarter": safe_divide(elapsed, total) * 100, **paced}).withColumn("month_date", F.last_day(today))


def meetings_recorded(meetings: DataFrame) -> DataFrame:
    rows = meetings.filter(F.col("owner_name") != "Unknown")
    return rows.groupBy(F.col("owner_name").alias("rep_name"), month_end("activity_date").alias("month_date")).agg(
        F.count("event_id").alias("meetings"), F.count("recording_url").alias("recorded")
    )


def talk_conversion(conversations: DataFrame, users: DataFrame, created_opps: DataFrame) -> DataFrame:
    """Conversation minutes ÷ created opportunities, the latter counted once per conversation."""
    names = users.select(F.col("guid").cast("string").alias("user_guid"), F.col("name").alias("rep_name"))
    talk = conversations.join(names, "user_guid").groupBy("rep_name", month_end("created_date").alias("month_date")).agg(
        F.sum(F.col("duration_ms") / 60000).alias("minutes"), F.count("*").alias("n")
    )
    joined = talk.join(created_opps.withColumnRenamed("value", "created"), ["rep_name", "month_date"])
    return joined.select("rep_name", "month_date", safe_divide(F.col("minutes"), F.col("created") * F.col("n")).alias("value"))


def distinct_share(rows: DataFrame, flags: dict[str, Column], period: Column | None = None) -> DataFrame:
    """Share of distinct opportunities with each flag: flags are reduced per opportunity, then summed."""
    keyed = rows.filter(F.col("opportunity_id").isNotNull()).groupBy(
        F.col("opportunity_owner").alias("rep_name"), (month_end("full_date") if period is None else period).alias("month_date"), "opportunity_id"
    )
    per_opp = keyed.agg(*[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in flags.items()])
    return per_opp.groupBy("rep_name", "month_date").agg(*[safe_divide(F.sum(n), F.count("*")).alias(n) for n in flags])


def multi_year(fact: DataFrame, metric: str) -> DataFrame:
    rows = actual_facts(fact, [metric], ["Opportunity Deal Count"]).filter(F.col("term_length").isNotNull())
    return distinct_share(rows, {"value": F.col("term_length").cast("double") > 1})


def demos(fact: DataFrame) -> DataFrame:
    return _per_owner(actual_facts(fact, ["Activity Subtype Count"], ["Demo"], "Activity")).agg(F.sum("value").alias("value"))


def follow_up(activity: DataFrame) -> DataFrame:
    """Share of an owner's opportunity × activity-type pairs with more than one activity."""
    rows = activity.filter(
        F.col("opportunity_id").isNotNull() & F.col("activity_type").isin("Call", "Meeting") & (F.col("opportunity_owner") == F.col("activity_owner"))
    )
    counts = rows.groupBy("opportunity_id", "opportunity_owner", "activity_type").agg(
        F.min(F.trunc("activity_date", "month")).alias("first_month"), F.count("*").alias("n")
    )
    return counts.groupBy(F.col("opportunity_owner").alias("rep_name"), F.last_day("first_month").alias("month_date")).agg(
        safe_divide(count_if(F.col("n") > 1), F.count("*")).alias("value")
    )


STAGES = {
    "2f. Stage Progression - Envision": ("envision_at", "solution_at"),
    "2f. Stage Progression - Solution": ("solution_at", "demonstrate_at"),
    "2f. Stage Progression - Demonstrate": ("demonstrate_at", "deal_craft_at"),
    "2f. Stage Progression - Deal Craft": ("deal_craft_at", "closed_at"),
}


def _staged(stages: DataFrame, opportunities: DataFrame) -> DataFrame:
    owners = opportunities.filter(F.col("owner_name").isNotNull()).select("opportunity_id", F.col("owner_name").alias("rep_name"), F.col("close_date").alias("_close"), "stage_name")
    return stages.join(owners, "opportunity_id")


def stage_progress(stages: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Inverse mean days in each stage, by the month the stage was entered: one pass for all stage pairs."""
    steps = F.array(
        *[F.struct(F.lit(m).alias("metric"), month_end(a).alias("month_date"), days_between(b, a).alias("days")) for m, (a, b) in STAGES.items()]
    )
    rows = _staged(stages, opportunities).select("rep_name", F.explode(steps).alias("_s")).select("rep_name", "_s.*")
    return rows.groupBy("rep_name", "month_date", "metric").agg(inverse_mean(F.avg("days")).alias("value"))


def next_steps(fact: DataFrame, as_of) -> DataFrame:
    rows = actual_facts(fact, ["Open Pipe"], ["Opportunity Deal Count"]).filter(F.col("full_date") >= as_date(as_of))
    return distinct_share(rows, {"value": F.col("next_step").isNotNull()})


def open_age(fact: DataFrame, as_of) -> DataFrame:
    rows = actual_facts(fact, ["Open Pipe SAL"], ["Opportunity Deal Count"])
    return _per_owner(rows, month_end("qualified_date")).agg(inverse_mean(F.avg(days_between(as_date(as_of), "qualified_date"))).alias("value"))


def win_rate(fact: DataFrame) -> DataFrame:
    rows = actual_facts(fact, ["Closed Won", "Closed Lost"], ["Opportunity Deal Count"])
    return distinct_share(rows, {"value": F.col("metric") == "Closed Won"})


def cycle_length(stages: DataFrame, opportunities: DataFrame) -> DataFrame:
    rows = _staged(stages, opportunities).filter(F.col("stage_name").like("%Closed%"))
    return rows.groupBy("rep_name", month_end("_close").alias("month_date")).agg(inverse_mean(F.avg(days_between("_close", "envision_at"))).alias("value"))


def unified_partner(fact: DataFrame, relationships: DataFrame) -> DataFrame:
    coselling = relationships.filter("is_coselling").select("opportunity_id").distinct().withColumn("_partner", F.lit(True))
    rows = actual_facts(fact, ["Closed Won"], ["Opportunity Deal Count"]).join(coselling, "opportunity_id", "left")
    return distinct_share(rows, {"unified_share": F.col("is_unified"), "partner_share": F.col("_partner").isNotNull()})


def contract_length(fact: DataFrame) -> DataFrame:
    rows = actual_facts(fact, ["Closed Won"], ["Opportunity Deal Count"])
    return _per_owner(rows).agg(F.round(F.avg(F.col("term_length").cast("double")), 2).alias("value"))


PRODUCTS = {"capital": "Capital", "payments": "Payments", "retail_payments": "Retail Payments", "installments": "Installments"}


def product_mix(fact: DataFrame) -> DataFrame:
    rows = actual_facts(fact, ["Closed Won"], ["Product Deal Count"])
    return distinct_share(rows, {k: F.col("product_name") == v for k, v in PRODUCTS.items()})


# ---------------------------------------------------------------- one pass over the metric fact


@dataclass(frozen=True)
class FactPart:
    """What one key takes from the metric fact: which rows, for which period, and what of them."""

    metric: tuple[str, ...]
    value_type: str
    dataset: str = "Actuals"
    period: str = "month"
    where: str | None = None
    hit: Column | None = None
    value: Column | None = None


def row_conditions(as_of: date, snapshot: date) -> dict[str, Column]:
    owned = F.col("opportunity_owner") != ""
    return {
        "owned": owned,
        "snapshot": owned & (F.col("snapshot_date") == F.lit(snapshot)),
        "has_term": F.col("term_length").isNotNull(),
        "from_today": F.col("full_date") >= as_date(as_of),
    }


def fact_parts(as_of: date) -> dict[str, FactPart]:
    """Every use the scorecard makes of the metric fact."""
    count, product, term = "Opportunity Deal Count", "Product Deal Count", F.col("term_length").cast("double")
    won, sal = ("Closed Won",), ("Open Pipe SAL",)
    parts = {
        "created": FactPart(("Created",), count),
        "created_revenue": FactPart(("Created",), VALUE_KINDS["revenue"]),
        "created_profit": FactPart(("Created",), VALUE_KINDS["profit"]),
        "demos": FactPart(("Activity Subtype Count",), "Demo", "Activity"),
        "multi_open": FactPart(sal, count, where="has_term", hit=term > 1),
        "multi_won": FactPart(won, count, where="has_term", hit=term > 1),
        "next_steps": FactPart(("Open Pipe",), count, where="from_today", hit=F.col("next_step").isNotNull()),
        "open_age": FactPart(sal, count, period="qualified", value=days_between(as_date(as_of), "qualified_date")),
        "win_rate": FactPart(("Closed Won", "Closed Lost"), count, hit=F.col("metric") == "Closed Won"),
        "unified": FactPart(won, count, hit=F.col("is_unified")),
        "partner": FactPart(won, count),
        "contract": FactPart(won, count, value=term),
    }
    for k, v in PRODUCTS.items():
        parts[f"mix_{k}"] = FactPart(won, product, hit=F.col("product_name") == v)
    for k, v in VALUE_KINDS.items():
        parts[f"actual_month_{k}"] = FactPart(won, v, where="owned")
        parts[f"actual_{k}"] = FactPart(won, v, period="quarter", where="owned")
        parts[f"open_{k}"] = FactPart(sal, v, period="quarter", where="owned")
        parts[f"past_actual_{k}"] = FactPart(won, v, "Snapshots", "quarter", "snapshot")
        parts[f"past_open_{k}"] = FactPart(sal, v, "Snapshots", "quarter", "snapshot")
    return parts


def fact_keys(fact: DataFrame, as_of: date, snapshot: date, relationships: DataFrame) -> DataFrame:
    """Sums, means and distinct shares of all keys, from a single read of the metric fact.

    A row is expanded to the keys it belongs to and reduced per opportunity first: distinct counts
    become sums, and an owner with very many rows is spread over many tasks. The opportunities with a co-selling partner
    are met after that, by key and opportunity.
    """
    parts = fact_parts(as_of)
    kinds: dict[tuple[str, str, str], list[str]] = {}
    for key, part in parts.items():
        for metric in part.metric:
            kinds.setdefault((part.dataset, metric, part.value_type), []).append(key)
    used = F.lit(True)
    for column, values in zip(("dataset", "metric", "value_type"), zip(*kinds)):
        used = used & F.col(column).isin(*sorted(set(values)))
    # The keys of a row come from a constant map, what each key takes from short chains: the generated code stays small
    # enough for the JVM to compile.
    table = F.create_map(*[x for kind, keys in kinds.items() for x in (F.lit("|".join(kind)), F.array(*[F.lit(k) for k in keys]))])
    keys = F.try_element_at(table, F.concat_ws("|", "dataset", "metric", "value_type"))
    periods = {"_month": month_end("full_date"), "_quarter": quarter_end("full_date"), "_qualified": month_end("qualified_date")}
    rows = fact.filter(used).withColumns(periods).withColumn("key", F.explode(keys))
    key = F.col("key")

    def named(test) -> list[str]:
        return [k for k, p in parts.items() if test(p)]

    for name, condition in row_conditions(as_of, snapshot).items():
        rows = rows.filter(~key.isin(*named(lambda p, name=name: p.where == name)) | condition)
    period, value, hit = F.col("_month"), F.col("value"), F.lit(0)
    for name in ("quarter", "qualified"):
        period = F.when(key.isin(*named(lambda p, name=name: p.period == name)), F.col(f"_{name}")).otherwise(period)
    for k, p in parts.items():
        if p.value is not None:
            value = F.when(key == k, p.value.cast("double")).otherwise(value)
        if p.hit is not None:
            hit = F.when(key == k, p.hit.cast("int")).otherwise(hit)
    # Only shares of distinct opportunities need the opportunity; sums shrink to few rows before the shuffle without it.
    counted = F.when(key.isin("partner", *named(lambda p: p.hit is not None)), F.col("opportunity_id"))
    rows = rows.select(
        F.col("opportunity_owner").alias("rep_name"), "key", period.alias("month_date"), value.alias("value"), F.coalesce(hit, F.lit(0)).alias("hit"), counted.alias("opportunity_id")
    )
    per_opp = rows.groupBy("rep_name", "month_date", "key", "opportunity_id").agg(
        F.sum("value").alias("total"), F.count("value").alias("n"), F.max("hit").alias("hit")
    )
    coselling = relationships.filter("is_coselling").select("opportunity_id").distinct().withColumns({"key": F.lit("partner"), "_partner": F.lit(1)})
    per_opp = left_join_nullable(per_opp, coselling, ["opportunity_id", "key"], ["rep_name", "month_date", "key"])
    per_opp = per_opp.withColumn("hit", F.when(key == "partner", F.coalesce("_partner", F.lit(0))).otherwise(F.col("hit")))
    known = F.col("opportunity_id").isNotNull()
    return per_opp.groupBy("rep_name", "month_date", "key").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.sum(F.when(known, F.col("hit"))).alias("hits"), F.count(F.when(known, 1)).alias("opps")
    )


def quota_keys(attainment_rows: DataFrame, workers: DataFrame, reps: DataFrame | None = None) -> DataFrame:
    """Quotas by month and by quarter in the form of ``fact_keys``; of all workers, or of the ``reps`` (rep_name) only."""
    names = workers.select(F.col("worker_id").alias("payee_id"), F.col("worker_name").alias("rep_name")).filter(F.col("rep_name").isNotNull())
    if reps is not None:
        names = semi_join(names, reps, ["rep_name"])
    kinds = {V.QUOTA_PROFIT: "profit", V.QUOTA_REVENUE: "revenue", V.QUOTA_ACTIVATIONS: "activations"}
    first, kind = period_month("period"), lookup(F.col("attribute_id"), kinds)
    both = F.array(
        F.struct(F.last_day(first).alias("month_date"), F.concat(F.lit("quota_month_"), kind).alias("key")),
        F.struct(quarter_end(first).alias("month_date"), F.concat(F.lit("quota_"), kind).alias("key")),
    )
    rows = measured_join(attainment_rows.filter(F.col("attribute_id").isin(*kinds)), names, ["payee_id"])
    rows = rows.select("rep_name", "quota", F.explode(both).alias("_k")).select("rep_name", "quota", "_k.*")
    none = F.lit(None).cast("long")
    return rows.groupBy("rep_name", "month_date", "key").agg(F.sum("quota").alias("total"), none.alias("n"), none.alias("hits"), none.alias("opps"))


def _value_forms() -> list[tuple[str, str, str]]:
    """(metric, key or value kind, form) of every metric that comes from the keys."""
    out = [
        ("1a. Emails Sent", "email", "count"),
        ("1b. Email Open Rate", "email", "hit_rate"),
        ("1c. Response Rate - Email", "email", "opp_rate"),
        ("1a. Calls Sent", "call", "count"),
        ("1c. Response Rate - Call", "call", "hit_rate"),
        ("1k. Total Call interested", "call", "opps"),
        ("1k. Call Interest Rate", "call", "opp_rate"),
        ("1d. Appointments booked responses", "cadence", "share"),
        ("1e. Show rate", "show", "hit_rate"),
        ("1f. Average meeting time (hr)", "minutes", "mean"),
        ("2i. Meetings Accepted by Manager", "accepted", "count"),
        ("1g. Created Opps", "created", "total"),
        ("2b. Talk-to-Meeting Conversion Rate", "talk", "talk"),
        ("2c. Multi vs Single Yr Deals - Open Pipe", "multi_open", "share"),
        ("2d. # of Demos Scheduled", "demos", "total"),
        ("2g. % of Pipe w/ Next steps", "next_steps", "share"),
        ("2h. Average Age - Open Pipe", "open_age", "inverse_mean"),
        ("3a. Win Rate", "win_rate", "share"),
        ("3d. Unified Commerce Exposure", "unified", "share"),
        ("3e. Partner attach", "partner", "share"),
        ("3g. Multi vs Single Yr Deals - Closed Won", "multi_won", "share"),
        ("3h. Contract Length", "contract", "rounded_mean"),
        ("3i. Product Mix Capital", "mix_capital", "share"),
        ("3j. Product Mix Payments", "mix_payments", "share"),
        ("3k. Product Mix Retail Payments", "mix_retail_payments", "share"),
        ("3l. Product Mix Installments", "mix_installments", "share"),
        ("99b. Created LTR", "created_revenue", "total"),
        ("99b. Created IPP", "created_profit", "total"),
    ]
    for kind, label in {"revenue": "LTR", "profit": "IPP", "activations": "SA"}.items():
        out += [
            (f"1j. Pipe Coverage {label}", kind, "coverage"),
            (f"3m. Attainment {label}", kind, "attainment"),
            (f"3n. Pacing {label}", kind, "pacing"),
            (f"99h. 25Q1 Attainment {'SAU' if label == 'SA' else label}", kind, "attained"),
        ]
        if kind != "activations":
            out += [
                (f"1l. LQ Pipe Coverage {label}", kind, "past_coverage"),
                (f"99e. Targets - Actuals {label}", kind, "gap"),
                (f"99i. {label} Targets", kind, "quota"),
                (f"99k. Open Pipe {label}", kind, "open"),
            ]
    return out


def fact_values(keys: DataFrame, as_of: date, snapshot: date) -> DataFrame:
    """Metric values per rep and period from the keys of that period.

    The keys of a period are a fixed list of a few dozen, so they are folded into one map per (rep, period).
    Each metric names its key and its form, and one short expression per form computes it.
    """
    entry = F.struct("total", "n", "hits", "opps")
    folded = keys.groupBy("rep_name", "month_date").agg(F.map_from_entries(F.collect_list(F.struct("key", entry))).alias("k"))
    wanted = [F.struct(F.lit(m).alias("metric"), F.lit(key).alias("key"), F.lit(form).alias("form")) for m, key, form in _value_forms()]
    rows = folded.withColumn("_w", F.explode(F.array(*wanted))).select("rep_name", "month_date", "k", "_w.*")

    def total(prefix: str) -> Column:
        return F.try_element_at("k", F.concat(F.lit(prefix), F.col("key"))).getField("total")

    rows = rows.withColumn("e", F.try_element_at("k", F.col("key"))).withColumns(
        {name: total(f"{name}_") for name in ("quota", "actual", "open", "quota_month", "actual_month", "past_actual", "past_open")}
    )
    today = as_date(as_of)
    this_quarter, past_quarter = quarter_end(today), quarter_end(F.lit(snapshot))
    days = days_between(this_quarter, quarter_start(today)) + 1
    elapsed = days - days_between(this_quarter, today)
    quota, actual, form, e = F.col("quota"), F.col("actual"), F.col("form"), F.col("e")
    gap, mean = quota - zero_if_null(actual), safe_divide(e.getField("total"), e.getField("n"))
    created_total = F.try_element_at("k", F.lit("created")).getField("total")
    current = {
        "coverage": coverage(F.col("open"), gap),
        "pacing": safe_divide(actual, quota * elapsed / days),
        "attained": safe_divide(actual, quota),
        "gap": F.when(gap < 0, F.lit(0.0)).otherwise(gap),
        "quota": quota,
        "open": F.when(quota.isNotNull(), F.col("open")),
    }
    others = {
        "total": e.getField("total"),
        "share": safe_divide(e.getField("hits"), e.getField("opps")),
        "count": e.getField("n"),
        "opps": e.getField("opps"),
        "hit_rate": safe_divide(e.getField("hits"), e.getField("n")),
        "opp_rate": safe_divide(e.getField("opps"), e.getField("n")),
        "mean": mean,
        "inverse_mean": inverse_mean(mean),
        "rounded_mean": F.round(mean, 2),
        "talk": safe_divide(e.getField("total"), created_total * e.getField("n")),
        "attainment": safe_divide(F.col("actual_month"), F.col("quota_month")),
        "past_coverage": F.when(F.col("month_date") == past_quarter, coverage(F.col("past_open"), quota - zero_if_null(F.col("past_actual")))),
    }
    value = None
    for name, v in {**others, **{k: F.when(F.col("month_date") == this_quarter, v) for k, v in current.items()}}.items():
        value = F.when(form == name, v.cast("double")) if value is None else value.when(form == name, v.cast("double"))
    # Figures of the running quarter are shown in the as-of month.
    month = F.when(form.isin(*current), F.last_day(today)).otherwise(F.col("month_date"))
    return rows.select("rep_name", month.alias("month_date"), "metric", value.alias("value")).filter(F.col("value").isNotNull())


# ---------------------------------------------------------------- assembly


def stage_values(stages: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Stage progression and cycle length in one pass over the stage facts."""
    rows = _staged(stages, opportunities)
    steps = [F.struct(F.lit(m).alias("metric"), month_end(a).alias("month_date"), days_between(b, a).alias("days")) for m, (a, b) in STAGES.items()]
    cycle = F.struct(F.lit("3c. Cycle Length").alias("metric"), month_end("_close").alias("month_date"), days_between("_close", "envision_at").alias("days"))
    tags = F.array_compact(F.array(*steps, F.when(F.col("stage_name").like("%Closed%"), cycle)))
    rows = rows.select("rep_name", F.explode(tags).alias("_s")).select("rep_name", "_s.*").filter(F.col("days").isNotNull())
    return rows.groupBy("rep_name", "month_date", "metric").agg(inverse_mean(F.avg("days")).alias("value")).select(*LONG)


def book_values(snapshots: DataFrame, territory_reps: DataFrame, activity: DataFrame, tiers: list[str]) -> DataFrame:
    """Book contacted and accounts contacted in one pass over the account snapshots.

    Accounts are counted per territory and day before the reps are joined, so a territory of many accounts is not
    multiplied by its reps. An account is in one territory on a day.
    """
    rows = _territory_days(snapshots, activity).withColumn("_tiered", F.col("tier").isin(*tiers))
    day = ["_territory", "_quarter", "month_date", "snapshot_date"]
    per_account = rows.groupBy(*day, "account_id").agg(
        F.max("_hit").alias("hit"), F.max(F.when(F.col("_tiered"), 1)).alias("tiered"), F.max(F.when(F.col("_tiered"), F.col("_hit"))).alias("tiered_hit")
    )
    per_day = per_account.groupBy(*day).agg(F.sum("tiered").alias("book"), F.count("tiered_hit").alias("reached"), F.count("hit").alias("contacted"))
    of_rep = per_day.join(_territory_reps(territory_reps), ["_territory", "_quarter"]).groupBy("rep_name", "month_date", "snapshot_date")
    per_day = of_rep.agg(*[F.sum(c).alias(c) for c in ("book", "reached", "contacted")])
    wide = per_day.groupBy("rep_name", "month_date").agg(
        F.max_by(safe_divide(F.col("reached"), F.col("book")), F.when(F.col("book") > 0, F.col("snapshot_date"))).alias("share"),
        F.max_by("contacted", F.when(F.col("contacted") > 0, F.col("snapshot_date"))).alias("contacted"),
    )
    return to_long(wide, {"share": "1h. % Book Contacted", "contacted": "1i. # Accounts Contacted"})


def daily_reps(daily: DataFrame, from_date: date) -> DataFrame:
    """Names that can stand on the grid: those of the daily worker rows since a day."""
    return daily.filter(F.col("effective_on") >= F.lit(from_date)).select(F.col("worker_name").alias("rep_name")).distinct()


def all_facts(source, as_of: date, snapshot: date, tiers: list[str], reps: DataFrame | None = None) -> DataFrame:
    """Every metric of the sheet as long rows. One row per (rep, month, metric).

    ``reps`` are the names the caller goes on with; quotas of other workers, which have a row for every month, are left out.
    """
    t = source.table
    users, workers, activity = t("crm_user"), t("hr_worker"), t("account_activity")
    events = [email_events(t("act_email")), call_events(t("act_call")), cadence_events(t("act_cadence")), talk_events(t("act_conversation")), meeting_events(t("act_meeting"), t("act_cadence"))]
    keys = union_all([fact_keys(t("fact_metric"), as_of, snapshot, t("partner_relationship")), quota_keys(t("hr_quota"), workers, reps), activity_keys(events, users)])
    parts = [
        fact_values(keys, as_of, snapshot),
        book_values(t("account_snapshot"), t("territory_rep"), activity, tiers),
        to_long(meetings_recorded(t("act_recorded_meeting")), {"recorded": "2a. Total Meetings Recorded", "meetings": "99f. Total Meetings"}),
        to_long(follow_up(activity), {"value": "2e. Follow-Up Rate"}),
        stage_values(t("fact_stage"), t("crm_opportunity")),
    ]
    return union_all(parts)


def metric_grid(months: DataFrame, workers: DataFrame, sheet: DataFrame) -> DataFrame:
    """Worker-months with every metric that applies: the group's core metrics and the global ones."""
    kept = months.filter(
        ~F.col("subdiscipline").isin(*V.EXCLUDED_SUBDISCIPLINES) & ~F.col("subdiscipline").like("Management%") & ~F.col("discipline").isin(*V.EXCLUDED_DISCIPLINES)
    )
    rows = kept.join(workers, "rep_name")
    return join_group_or_global(rows, sheet, "team_group", F.col("metric_group").isin(*CORE_GROUPS)).distinct()


def assemble(grid: DataFrame, facts: DataFrame) -> DataFrame:
    """Grid rows that have a value."""
    return grid.join(facts, ["rep_name", "month_date", "metric"])


BAND_KEYS = ["team_group", "region_compare", "metric", "month_date"]


def _bands(top: Column, low: Column) -> dict[str, Column]:
    return {"min_value": low, "max_value": top, "quarter_1": top / 4, "quarter_2": top / 4 * 2, "quarter_3": top / 4 * 3}


def quartile_bands(rep: DataFrame) -> DataFrame:
    """Quarters of the maximum per group, region, metric and month."""
    return rep.groupBy(*BAND_KEYS).agg(*[v.alias(k) for k, v in _bands(F.max("value"), F.min("value")).items()])


def points(rep: DataFrame) -> DataFrame:
    """Points by the band a value falls in. Rows without a team group meet no band and drop out.

    The bands are taken over the reps of one group, metric and month (a headcount, not a data
    volume), in place, so the rep rows are computed once.
    """
    w = Window.partitionBy(*BAND_KEYS)
    rows = rep.filter(F.col("team_group").isNotNull() & F.col("region_compare").isNotNull())
    rows = rows.withColumns(_bands(F.max("value").over(w), F.min("value").over(w)))
    v, p = F.col("value"), F.col("points")
    earned = F.when(v >= F.col("quarter_3"), p).when(v >= F.col("quarter_2"), p / 4 * 3).when(v >= F.col("quarter_1"), p / 4 * 2).otherwise(p / 4)
    return rows.filter(~F.col("team").like("%DNU%") & (F.col("quarter_3") > 0)).withColumn("rep_points", F.round(earned, 0))


def group_totals(final: DataFrame, sheet: DataFrame) -> DataFrame:
    """Group and subgroup totals, on the first metric of each group only.

    A window holds the metrics of one rep, month and group: at most the length of the sheet.
    """
    keys = ["rep_name", "month_date", "team_group"]
    possible = sheet.groupBy("metric_subgroup", "team_group").agg(F.sum("points").alias("_possible"))
    rows = final.join(possible, ["metric_subgroup", "team_group"], "left")
    out = {}
    for name, col in {"group": "metric_group", "subgroup": "metric_subgroup"}.items():
        w = Window.partitionBy(*keys, col)
        first = F.row_number().over(w.orderBy("metric")) == 1
        out[f"{name}_points"] = F.when(first, F.sum("rep_points").over(w))
        if name == "subgroup":
            out["subgroup_possible"] = F.when(first, F.col("_possible"))
    return rows.withColumns(out).drop("_possible")


def scorecard_rows(source, as_of: date, from_date: date, snapshot: date, tiers: list[str]) -> DataFrame:
    daily = source.table("hr_worker_daily")
    months = worker_month(daily, source.table("hr_worker"), source.table("crm_user"), from_date)
    current = worker_current(source.table("hr_worker"), source.table("crm_user"), as_of)
    grid = metric_grid(months, current, source.table("scorecard_metric"))
    return assemble(grid, all_facts(source, as_of, snapshot, tiers, daily_reps(daily, from_date)))


def scorecard(source, as_of: date, from_date: date, snapshot: date, tiers: list[str]) -> DataFrame:
    rep = scorecard_rows(source, as_of, from_date, snapshot, tiers)
    return group_totals(points(rep), source.table("scorecard_metric"))
