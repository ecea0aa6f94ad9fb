"""Sales activities: one vocabulary, classes, attribution to opportunities, rep calendar, campaigns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrellis.functions.dates import OPEN_START, as_date, days_between, today_in, week_number_sunday, week_start_monday
from revtrellis.functions.numbers import lookup
from revtrellis.functions.text import first_chars
from revtrellis.operators.heavy import Side, left_product
from revtrellis.operators.joins import asof_merge, left_join_nullable
from revtrellis.operators.sets import rename_to, union_all
from revtrellis.operators.windows import latest_per_key, previous_day
from revtrellis.params.fixed_values import ACTIVITY_CLASSES
from revtrellis.sources.sheets import membership_flag

COMMON = {
    "id": "task_id",
    "account_ref": "account_id",
    "activity_day": "activity_date",
    "created_by": "created_by_id",
    "created_day": "created_date",
    "deleted": "is_deleted",
    "owner": "owner_id",
    "type": "activity_type",
    "dialler_type": "dialler_type",
    "related_id": "related_id",
    "subject": "subject",
    "click_count": "click_count",
    "sub_type": "activity_sub_type",
    "call_disposition": "call_disposition",
    "call_minutes": "call_minutes",
    "call_sentiment": "call_sentiment",
    "cadence_name": "cadence_name",
    "connected_count": "connected_count",
    "email_template": "email_template",
    "replies_count": "replies_count",
    "unique_click_count": "unique_click_count",
    "unique_reply_count": "unique_reply_count",
    "unique_view_count": "unique_view_count",
    "view_count": "view_count",
}
EVENT_VOCABULARY = {**COMMON, "event_day": "completed_date"}
TASK_VOCABULARY = {**COMMON, "completed_day": "completed_date"}


def unify(events: DataFrame, tasks: DataFrame) -> DataFrame:
    """Calendar events and tasks in one vocabulary; tasks without the deleted ones."""
    parts = [rename_to(events, EVENT_VOCABULARY), rename_to(tasks.filter(~F.col("deleted")), TASK_VOCABULARY)]
    return union_all(parts)


def activity_class(dialler_type: Column, activity_type: Column) -> Column:
    """Email, LinkedIn, Call, Meeting or Other; the dialler's own type goes first."""
    return lookup(F.lower(F.coalesce(dialler_type, activity_type)), ACTIVITY_CLASSES, "Other")


def latest_campaign(members: DataFrame, campaigns: DataFrame, pattern: str, campaign_ids: Sequence[object] = ()) -> DataFrame:
    """Newest membership per account among the campaigns whose name matches or whose id is listed."""
    named = F.lower("campaign_name").like(pattern)
    wanted = campaigns.filter((named | F.col("campaign_id").isin(*campaign_ids) if campaign_ids else named) & ~F.col("is_deleted")).drop("is_deleted")
    rows = members.filter(~F.col("is_deleted")).select("account_id", "campaign_id", "joined_date").join(wanted, "campaign_id")
    return latest_per_key(rows, ["account_id"], [F.desc("joined_date"), F.desc("campaign_id")])


def opportunity_intervals(accounts: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Days that belong to each opportunity: after the account's previous close, up to its own."""
    live = accounts.filter(~F.col("is_deleted")).select("account_id")
    opps = opportunities.filter(~F.col("is_deleted")).join(live, "account_id", "left_semi")
    with_previous = previous_day(opps, ["account_id"], "close_date", "opportunity_id", "previous_close")
    return with_previous.withColumn("interval_start", F.coalesce(F.date_add("previous_close", 1), F.lit(OPEN_START)))


def attribute_activities(activities: DataFrame, intervals: DataFrame, day: str) -> DataFrame:
    """Activities with the opportunity of the same account whose interval holds their day.

    An activity that names its opportunity needs no interval: its key is null, so it matches none.
    """
    spans = intervals.select(
        F.col("account_id").alias("_account"), F.col("opportunity_id").alias("interval_opportunity_id"), "interval_start", F.col("close_date").alias("interval_end")
    )
    acts = activities.withColumn("_account", F.when(F.col("related_id").isNull(), F.col("account_id")))
    joined = asof_merge(acts, spans, ["_account"], day, "interval_start", "interval_end", how="left", spread_on=["task_id"])
    return joined.drop("_account", "interval_start", "interval_end")


def rep_attributes(source) -> DataFrame:
    """User with role and the role's segment, team and region."""
    users = source.table("crm_user").select("user_id", "name", "user_role_id")
    roles = source.table("crm_role").select("user_role_id", "role_name")
    attributes = source.table("crm_role_attribute").withColumnRenamed("rep_role", "role_name")
    return users.join(roles, "user_role_id", "left").join(attributes, "role_name", "left").select(
        F.col("user_id"), "name", F.col("role_name").alias("role"), "market_segment", "team_segment", "sales_region"
    )


def influence_window(df: DataFrame, max_days: int = 90) -> DataFrame:
    """Calls and meetings up to ``max_days`` before the opportunity was created."""
    out = df.withColumns(
        {
            "days_before": days_between("opportunity_created_date", "completed_date"),
            "influenced": F.when(F.col("completed_date") <= F.col("opportunity_created_date"), "Yes").otherwise("No"),
        }
    )
    return out.filter(F.col("days_before").between(0, max_days) & (F.col("influenced") == "Yes") & F.col("activity_class").isin("Call", "Meeting"))


def influence_flag(texts: list[Column], campaign_pattern: str, campaigns: list[Column], marker: str) -> Column:
    """1 when a campaign name or any role or segment text carries the marker."""
    cond = F.lit(False)
    for c in campaigns:
        cond = cond | F.coalesce(F.lower(c).like(campaign_pattern), F.lit(False))
    for t in texts:
        cond = cond | F.coalesce(F.upper(t).like(marker), F.lit(False))
    return F.when(cond, 1)


def opportunity_meetings(source) -> DataFrame:
    """Calls and meetings whose completion lies in an opportunity's interval of the same account, and their days before its creation.

    Accounts that share the prefix are merged as a stream each; the opportunity's columns are joined to the hits.
    """
    events = source.table("act_event").filter(~F.col("deleted") & (F.col("type") == "Meeting"))
    acts = unify(events, source.table("act_task"))
    acts = acts.select("task_id", "account_id", "owner_id", "completed_date", "activity_type", "dialler_type").distinct()
    opps = source.table("crm_opportunity").select(
        "account_id", "opportunity_id", "opportunity_name", "opportunity_type", "stage_name", "total_revenue", "contract_value", "product_profit", "sales_rep_role",
        F.col("sales_region").alias("region"), F.col("created_date").alias("opportunity_created_date"), "close_date", "is_deleted",
    )
    intervals = opportunity_intervals(source.table("crm_account"), opps)
    acts = acts.withColumn("activity_class", activity_class(F.col("dialler_type"), F.col("activity_type")))
    acts = acts.filter(F.col("activity_class").isin("Call", "Meeting"))
    spans = intervals.select(
        first_chars("account_id", 15).alias("_account"), F.col("account_id").alias("_stream"), "opportunity_id", "opportunity_created_date", "interval_start", "close_date"
    )
    acts = acts.withColumn("_account", first_chars("account_id", 15)).drop("account_id")
    hits = asof_merge(acts, spans, ["_account"], "completed_date", "interval_start", "close_date", streams=["_stream"])
    details = opps.select(
        F.col("account_id").alias("opportunity_account_id"), "opportunity_id", "opportunity_name", "opportunity_type", "stage_name", "total_revenue", "contract_value",
        "product_profit", "sales_rep_role", "region",
    )
    return influence_window(hits).join(details, "opportunity_id")


def influenced_opportunities(source) -> DataFrame:
    """Calls and meetings that preceded an opportunity of the same account, with the assignee's attributes."""
    reps = rep_attributes(source).filter(F.col("role").isNotNull()).withColumnRenamed("user_id", "owner_id")
    rows = opportunity_meetings(source).join(reps, "owner_id")
    return rows.select(
        F.col("opportunity_account_id").alias("account_id"), F.col("name").alias("task_assigned_to"), F.col("role").alias("task_assigned_to_role"),
        "task_id", F.col("completed_date").alias("task_completed_date"), "opportunity_created_date", "days_before", "influenced", "opportunity_id",
        "opportunity_name", "opportunity_type", "stage_name", "total_revenue", "contract_value", "product_profit", "region", "sales_rep_role", "activity_class", "market_segment",
        "team_segment", "sales_region",
    )


def account_days(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Tasks per key, day and account.

    The rows are dealt over all of these columns before they are counted. Nearly every row is a group of its own, so counting
    before the shuffle as well would only hold them in memory beside the joins that made them.
    """
    by = [*keys, "completed_date", "account_id"]
    return rows.select(*by).repartition(*by).groupBy(*by).agg(F.count("*").alias("_tasks"))


def activity_calendar(days: DataFrame, keys: list[str]) -> DataFrame:
    """Tasks and accounts touched per rep, class and day, with calendar labels, from the rows of ``account_days``."""
    day = F.col("completed_date")
    counts = days.groupBy(*keys, "completed_date").agg(F.sum("_tasks").alias("tasks_count"), F.count("account_id").alias("accounts_touched_count"))
    return counts.withColumns(
        {
            "completed_year": F.year(day),
            "completed_week": week_number_sunday(day),
            "month_name": F.date_format(day, "MMMM"),
            "weekday_name": F.date_format(day, "EEEE"),
            "week_of_completed_date": week_start_monday(day),
        }
    )


def outbound_activity(source, as_of: date | None, from_date: date, zone: str = "America/Los_Angeles") -> DataFrame:
    """Tasks per rep, day and class; segment and region come from the creator's role.

    Without an as-of date the last day is today in the zone. The opportunity, campaign and influence columns of an
    activity do not reach this output and are not joined here: an activity counts once, however many segments its
    opportunity has (see README, differences).
    """
    last = as_date(as_of) if as_of is not None else today_in(zone)
    acts = unify(source.table("act_event"), source.table("act_task")).filter(
        F.col("account_id").isNotNull() & ~F.col("is_deleted") & (F.col("completed_date") >= F.lit(from_date)) & (F.col("completed_date") <= last)
    )
    creators = rep_attributes(source).filter(F.col("market_segment").isNotNull())
    creators = creators.select(F.col("user_id").alias("created_by_id"), "market_segment", "team_segment", "sales_region")
    owners = rep_attributes(source).select(F.col("user_id").alias("owner_id"), F.col("name").alias("task_assigned_to"), F.col("role").alias("task_assigned_to_role"))
    watch = source.table("account_watchlist")
    listed = source.table("crm_account").select("account_id", first_chars("account_id", 15).alias("account_prefix")).join(watch, "account_prefix", "left_semi")
    rows = acts.join(creators, "created_by_id").join(owners, "owner_id", "left")
    rows = rows.withColumn("activity_class", activity_class(F.col("dialler_type"), F.col("activity_type")))
    keys = ["task_assigned_to", "task_assigned_to_role", "market_segment", "team_segment", "sales_region", "activity_class"]
    # The list tells accounts apart, so an account is counted once per key and day whether it is flagged before or after.
    days = membership_flag(account_days(rows, keys), listed, "account_id", "on_watchlist")
    return activity_calendar(days, [*keys, "on_watchlist"])


def attributed_activities(
    source, campaign_pattern: str = "incubation-b2b%", flag_pattern: str = "incubation-smb%", marker: str = "%INC%", campaign_ids: Sequence[object] = ()
) -> DataFrame:
    """Activity rows with opportunity (an explicit link wins), campaign and influence flag.

    One pattern picks the account's campaign, another one and the marker make the flag. An opportunity with several
    segments is flagged if any of them carries the marker; it does not multiply its activities.
    """
    acts = unify(source.table("act_event"), source.table("act_task")).filter(F.col("account_id").isNotNull() & ~F.col("is_deleted"))
    intervals = opportunity_intervals(source.table("crm_account"), source.table("crm_opportunity"))
    rows = attribute_activities(acts, intervals, "created_date")
    rows = rows.withColumn("opportunity_id", F.coalesce("related_id", "interval_opportunity_id")).drop("interval_opportunity_id")
    campaigns = latest_campaign(source.table("crm_campaign_member"), source.table("crm_campaign"), campaign_pattern, campaign_ids).select(
        "account_id", F.col("campaign_name").alias("account_campaign"), "start_date", "end_date"
    )
    rows = rows.join(campaigns, "account_id", "left")
    inside = F.col("created_date").between(F.col("start_date"), F.col("end_date"))
    rows = rows.withColumn("account_campaign", F.when(inside, F.col("account_campaign"))).drop("start_date", "end_date")
    opps = source.table("crm_opportunity").select("opportunity_id", F.col("campaign_id").alias("_campaign"), F.col("lead_source").alias("opportunity_source"))
    names = source.table("crm_campaign").select(F.col("campaign_id").alias("_campaign"), F.col("campaign_name").alias("opportunity_campaign"))
    rows = left_join_nullable(rows, opps.join(names, "_campaign", "left").drop("_campaign"), ["opportunity_id"], ["task_id"])
    segments = source.table("fact_metric").filter(F.col("opportunity_id").isNotNull()).groupBy("opportunity_id")
    marked = segments.agg(F.max(F.when(F.upper("market_segment").like(marker), F.col("market_segment"))).alias("marked_segment"))
    rows = left_join_nullable(rows, marked, ["opportunity_id"], ["task_id"])
    reps = rep_attributes(source)
    creators = reps.select(F.col("user_id").alias("created_by_id"), F.col("role").alias("creator_role"))
    owners = reps.select(F.col("user_id").alias("owner_id"), F.col("role").alias("owner_role"))
    rows = rows.join(creators, "created_by_id", "left").join(owners, "owner_id", "left")
    flag = influence_flag(
        [F.col("creator_role"), F.col("owner_role"), F.col("marked_segment")], flag_pattern, [F.col("account_campaign"), F.col("opportunity_campaign")], marker
    )
    return rows.withColumn("incubation_influenced", flag)


def campaign_accounts(source, joined_from: date | None = None, campaign_ids: list[str] | None = None, fact_campaigns: list[str] | None = None, split_heavy: bool = False) -> DataFrame:
    """Distinct campaign account × opportunity facts × tasks.

    Each side is reduced to its distinct output columns per account before the joins, so the product needs no DISTINCT.
    ``split_heavy`` counts the rows of each account first and deals the product of one that has very many over many tasks, at the
    price of reading the account columns once more; without it a hot account is left to adaptive execution.
    """
    members = source.table("crm_campaign_member")
    if joined_from is not None:
        members = members.filter(F.col("joined_date") >= F.lit(joined_from))
    if campaign_ids is not None:
        pattern = "|".join(campaign_ids)
        members = members.filter(F.col("campaign_id").cast("string").rlike(pattern))
    facts = source.table("fact_metric")
    fact_cols = ["owner_manager", "sales_region", "sales_sub_region", "market_segment", "campaign"]
    if fact_campaigns is not None:
        facts = facts.filter(F.col("campaign").isin(*fact_campaigns))
        fact_cols += [
            "product_name", "lead_group", "close_date", "value", "opportunity_owner", "created_date", "metric", "value_type", "dataset", "snapshot_date", "age",
            "current_stage", "verified_online_revenue", "annual_revenue", "created_by_function", "created_by", "sales_owner_role", "account_name", "account_campaign",
            "opportunity_url", "opportunity_name", "fact_product_name",
        ]
    member_cols = ["account_id", "campaign_id"] if campaign_ids is not None else ["account_id", "campaign_id", "joined_date"]
    members = members.select(*member_cols).distinct()
    accounts = source.table("crm_account").select("account_id", "name", "named_account_code", "platform_group").distinct()
    facts = facts.select("account_id", *fact_cols).distinct()
    tasks = source.table("act_task").select(
        F.col("account_ref").alias("account_id"), F.col("type").alias("task_type"), F.col("activity_day").alias("task_date"), F.col("subject").alias("task_subject"),
        F.col("unique_click_count").alias("task_click_count"), F.col("cadence_name").alias("task_cadence"), F.col("description").alias("task_description"),
    ).distinct()
    if split_heavy:
        rows = left_product([Side(members), Side(accounts, unique=True), Side(facts), Side(tasks)], "account_id")
    else:
        rows = members.join(accounts, "account_id", "left").join(facts, "account_id", "left").join(tasks, "account_id", "left")
    if campaign_ids is None:
        rows = rows.withColumns({"joined_year": F.year("joined_date"), "joined_month": F.month("joined_date")})
    return rows
