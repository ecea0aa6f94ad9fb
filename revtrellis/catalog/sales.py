"""Sales activities, attribution, campaigns and billing exceptions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from revtrellis.catalog.registry import AS_OF, query
from revtrellis.operators import activity, billing
from revtrellis.plans import reports
from revtrellis.sources.sheets import membership_flag

c = F.col
TODAY = f"DATE '{AS_OF}'"

_SHARED = """id AS task_id, account_ref AS account_id, activity_day AS activity_date, created_by AS created_by_id, created_day AS created_date, deleted AS is_deleted,
   owner AS owner_id, type AS activity_type, dialler_type, related_id, subject, click_count, sub_type AS activity_sub_type, call_disposition, call_minutes, call_sentiment,
   cadence_name, connected_count, email_template, replies_count, unique_click_count, unique_reply_count, unique_view_count, view_count"""
_ACTS = f"""SELECT {_SHARED}, event_day AS completed_date FROM act_event UNION ALL SELECT {_SHARED}, completed_day AS completed_date FROM act_task WHERE deleted = false"""
_CLASS = """CASE WHEN lower(coalesce(dialler_type, activity_type)) IN ('email', 'reply') THEN 'Email' WHEN lower(coalesce(dialler_type, activity_type)) LIKE 'linkedin - %' THEN 'LinkedIn'
   WHEN lower(coalesce(dialler_type, activity_type)) IN ('call', 'message') THEN 'Call' WHEN lower(coalesce(dialler_type, activity_type)) IN ('meeting', 'in-person meeting') THEN 'Meeting'
   ELSE 'Other' END"""
_REPS = """SELECT u.user_id, u.name, r.role_name AS role, t.market_segment, t.team_segment, t.sales_region FROM crm_user u LEFT JOIN crm_role r ON r.user_role_id = u.user_role_id
   LEFT JOIN crm_role_attribute t ON t.rep_role = r.role_name"""
_INTERVALS = """SELECT o.*, lag(o.close_date) OVER (PARTITION BY o.account_id ORDER BY o.close_date NULLS FIRST, o.opportunity_id) AS previous_close
   FROM crm_opportunity o JOIN crm_account a ON a.account_id = o.account_id WHERE NOT a.is_deleted AND NOT o.is_deleted"""
_SPAN = "coalesce(i.previous_close + 1, DATE '1900-01-01') AND i.close_date"


def latest_campaign_sql(pattern: str, also: str = "false") -> str:
    return f"""SELECT account_id, campaign_id, joined_date, campaign_name, start_date, end_date FROM (SELECT m.account_id, m.campaign_id, m.joined_date, g.campaign_name, g.start_date, g.end_date,
       row_number() OVER (PARTITION BY m.account_id ORDER BY m.joined_date DESC, m.campaign_id DESC) AS rn FROM crm_campaign_member m
       JOIN crm_campaign g ON g.campaign_id = m.campaign_id WHERE (lower(g.campaign_name) LIKE '{pattern}' OR {also}) AND NOT g.is_deleted AND NOT m.is_deleted) x WHERE rn = 1"""


@query("dom_activity_unify", _ACTS)
def _(s):
    return activity.unify(s.table("act_event"), s.table("act_task"))


@query("dom_activity_class", f"SELECT task_id, activity_type, {_CLASS} AS activity_class FROM ({_ACTS}) a")
def _(s):
    acts = activity.unify(s.table("act_event"), s.table("act_task"))
    return acts.select("task_id", "activity_type", activity.activity_class(c("dialler_type"), c("activity_type")).alias("activity_class"))


@query("dom_campaign_latest", latest_campaign_sql("incubation-b2b%"))
def _(s):
    return activity.latest_campaign(s.table("crm_campaign_member"), s.table("crm_campaign"), "incubation-b2b%")


@query("dom_campaign_latest_listed", latest_campaign_sql("incubation-b2b%", "g.campaign_id IN (1, 2, 3, 5, 8, 13, 21)"))
def _(s):
    return activity.latest_campaign(s.table("crm_campaign_member"), s.table("crm_campaign"), "incubation-b2b%", [1, 2, 3, 5, 8, 13, 21])


@query(
    "dom_account_allow_flag",
    "SELECT account_id, CASE WHEN left(account_id, 15) IN (SELECT account_prefix FROM account_watchlist) THEN 'Y' ELSE 'N' END AS on_watchlist FROM crm_account",
)
def _(s):
    accounts = s.table("crm_account").select("account_id", F.left("account_id", F.lit(15)).alias("account_prefix"))
    return membership_flag(accounts, s.table("account_watchlist"), "account_prefix", "on_watchlist").select("account_id", "on_watchlist")


@query(
    "dom_opp_interval",
    f"SELECT opportunity_id, account_id, previous_close, coalesce(previous_close + 1, DATE '1900-01-01') AS interval_start, close_date FROM ({_INTERVALS}) i WHERE close_date IS NOT NULL",
)
def _(s):
    rows = activity.opportunity_intervals(s.table("crm_account"), s.table("crm_opportunity")).filter(c("close_date").isNotNull())
    return rows.select("opportunity_id", "account_id", "previous_close", "interval_start", "close_date")


_ATTRIBUTED = f"""SELECT a.*, coalesce(a.related_id, i.opportunity_id) AS attributed_id FROM ({_ACTS}) a LEFT JOIN ({_INTERVALS}) i
   ON i.account_id = a.account_id AND a.related_id IS NULL AND a.created_date BETWEEN {_SPAN} WHERE a.account_id IS NOT NULL AND a.is_deleted = false"""


@query("dom_activity_attribution", f"SELECT task_id, account_id, created_date, attributed_id AS opportunity_id FROM ({_ATTRIBUTED}) x")
def _(s):
    return activity.attributed_activities(s, flag_pattern="incubation-b2b%", marker="%ENTER%").select("task_id", "account_id", "created_date", "opportunity_id")


@query(
    "dom_influence_window",
    f"""SELECT a.task_id, a.completed_date, i.opportunity_id, CAST(i.created_date - a.completed_date AS INT) AS days_before
        FROM (SELECT DISTINCT task_id, account_id, owner_id, completed_date, {_CLASS} AS k, activity_type, dialler_type FROM ({_ACTS}) u WHERE is_deleted = false) a
          JOIN ({_INTERVALS}) i ON left(i.account_id, 15) = left(a.account_id, 15) AND a.completed_date BETWEEN {_SPAN}
        WHERE i.created_date - a.completed_date BETWEEN 0 AND 90 AND a.k IN ('Call', 'Meeting')""",
)
def _(s):
    return activity.opportunity_meetings(s).select("task_id", "completed_date", "opportunity_id", "days_before")


def influence_flag_sql(campaign_pattern: str, flag_pattern: str, marker: str, also: str = "false") -> str:
    return f"""SELECT x.task_id, x.created_date, x.attributed_id AS opportunity_id, CASE WHEN lower(k.campaign_name) LIKE '{flag_pattern}' OR lower(g.campaign_name) LIKE '{flag_pattern}'
          OR upper(rc.role) LIKE '{marker}' OR upper(ro.role) LIKE '{marker}'
          OR x.attributed_id IN (SELECT opportunity_id FROM fact_metric WHERE opportunity_id IS NOT NULL AND upper(market_segment) LIKE '{marker}') THEN 1 END AS incubation_influenced
        FROM ({_ATTRIBUTED}) x LEFT JOIN ({latest_campaign_sql(campaign_pattern, also)}) k ON k.account_id = x.account_id AND x.created_date BETWEEN k.start_date AND k.end_date
          LEFT JOIN crm_opportunity o ON o.opportunity_id = x.attributed_id LEFT JOIN crm_campaign g ON g.campaign_id = o.campaign_id
          LEFT JOIN ({_REPS}) rc ON rc.user_id = x.created_by_id LEFT JOIN ({_REPS}) ro ON ro.user_id = x.owner_id"""


@query("dom_influence_flag", influence_flag_sql("incubation-b2b%", "incubation-b2b%", "%ENTER%"))
def _(s):
    return activity.attributed_activities(s, flag_pattern="incubation-b2b%", marker="%ENTER%").select("task_id", "created_date", "opportunity_id", "incubation_influenced")


@query("dom_influence_flag_patterns", influence_flag_sql("%anvil", "cold%", "%NOBODY%", "g.campaign_id IN (1, 2, 3, 5, 8, 13, 21)"))
def _(s):
    rows = activity.attributed_activities(s, campaign_pattern="%anvil", flag_pattern="cold%", marker="%NOBODY%", campaign_ids=[1, 2, 3, 5, 8, 13, 21])
    return rows.select("task_id", "created_date", "opportunity_id", "incubation_influenced")


@query("dom_rep_attributes", _REPS)
def _(s):
    return activity.rep_attributes(s)


_CALENDAR = """CAST(year(completed_date) AS INT) AS completed_year, CAST(strftime(completed_date, '%U') AS BIGINT) AS completed_week, strftime(completed_date, '%B') AS month_name,
   strftime(completed_date, '%A') AS weekday_name, CAST(date_trunc('week', completed_date) AS DATE) AS week_of_completed_date"""


@query(
    "dom_activity_calendar",
    f"""SELECT owner_id, completed_date, count(*) AS tasks_count, count(DISTINCT account_id) AS accounts_touched_count, {_CALENDAR} FROM ({_ACTS}) a GROUP BY owner_id, completed_date""",
)
def _(s):
    return activity.activity_calendar(activity.account_days(activity.unify(s.table("act_event"), s.table("act_task")), ["owner_id"]), ["owner_id"])


def campaign_sql(members: str, member_cols: str, fact_where: str, fact_cols: str) -> str:
    return f"""SELECT DISTINCT m.account_id, m.campaign_id, {member_cols} a.name, a.named_account_code, a.platform_group, {fact_cols}, t.type AS task_type,
         t.activity_day AS task_date, t.subject AS task_subject, t.unique_click_count AS task_click_count, t.cadence_name AS task_cadence, t.description AS task_description
       FROM crm_campaign_member m LEFT JOIN crm_account a ON a.account_id = m.account_id
         LEFT JOIN (SELECT * FROM fact_metric WHERE {fact_where}) f ON f.account_id = a.account_id LEFT JOIN act_task t ON t.account_ref = m.account_id WHERE {members}"""


_ALL_FACTS = "f.owner_manager, f.sales_region, f.sales_sub_region, f.market_segment, f.campaign"
_MORE_FACTS = _ALL_FACTS + ", " + ", ".join(
    f"f.{x}" for x in "product_name lead_group close_date value opportunity_owner created_date metric value_type dataset snapshot_date age current_stage verified_online_revenue annual_revenue created_by_function created_by sales_owner_role account_name account_campaign opportunity_url opportunity_name fact_product_name".split()
)
_CAA = campaign_sql(
    "m.joined_date >= DATE '1998-01-01'",
    "m.joined_date, CAST(year(m.joined_date) AS INT) AS joined_year, CAST(month(m.joined_date) AS INT) AS joined_month,",
    "true",
    _ALL_FACTS,
)
_CA = campaign_sql(
    "regexp_matches(CAST(m.campaign_id AS VARCHAR), '^10[0-9]$') OR regexp_matches(CAST(m.campaign_id AS VARCHAR), '^17$')",
    "",
    "campaign IN ('Winter switch', 'Summer switch')",
    _MORE_FACTS,
)


@query("dom_campaign_accounts", _CAA)
def _(s):
    return activity.campaign_accounts(s, joined_from=date(1998, 1, 1))


@query("pipe_campaign_accounts_all", _CAA)
def _(s):
    return reports.campaign_accounts_all(s, date(1998, 1, 1))


@query("pipe_campaign_accounts", _CA)
def _(s):
    return reports.campaign_accounts(s, ["^10[0-9]$", "^17$"], ["Winter switch", "Summer switch"])


@query(
    "pipe_outbound_activity",
    f"""SELECT w.name AS task_assigned_to, w.role AS task_assigned_to_role, k.market_segment, k.team_segment, k.sales_region, {_CLASS} AS activity_class, completed_date,
          CASE WHEN x.account_id IS NULL THEN 'N' ELSE 'Y' END AS on_watchlist, count(*) AS tasks_count, count(DISTINCT a.account_id) AS accounts_touched_count, {_CALENDAR}
        FROM ({_ACTS}) a JOIN ({_REPS}) k ON k.user_id = a.created_by_id AND k.market_segment IS NOT NULL LEFT JOIN ({_REPS}) w ON w.user_id = a.owner_id
          LEFT JOIN (SELECT account_id FROM crm_account WHERE left(account_id, 15) IN (SELECT account_prefix FROM account_watchlist)) x ON x.account_id = a.account_id
        WHERE a.account_id IS NOT NULL AND a.is_deleted = false AND completed_date >= DATE '1996-01-01' AND completed_date <= {TODAY} GROUP BY ALL""",
)
def _(s):
    return reports.outbound_activity(s, AS_OF, date(1996, 1, 1))


@query(
    "pipe_influenced_opps",
    f"""SELECT i.account_id, r.name AS task_assigned_to, r.role AS task_assigned_to_role, a.task_id, a.completed_date AS task_completed_date, i.created_date AS opportunity_created_date,
          CAST(i.created_date - a.completed_date AS INT) AS days_before, 'Yes' AS influenced, i.opportunity_id, i.opportunity_name, i.opportunity_type, i.stage_name, i.total_revenue, i.contract_value, i.product_profit,
          i.sales_region AS region, i.sales_rep_role, a.k AS activity_class, r.market_segment, r.team_segment, r.sales_region
        FROM (SELECT DISTINCT task_id, account_id, owner_id, completed_date, {_CLASS} AS k, activity_type, dialler_type FROM ({_ACTS}) u WHERE is_deleted = false) a
          JOIN ({_INTERVALS}) i ON left(i.account_id, 15) = left(a.account_id, 15) AND a.completed_date BETWEEN {_SPAN}
          JOIN ({_REPS}) r ON r.user_id = a.owner_id AND r.role IS NOT NULL
        WHERE i.created_date - a.completed_date BETWEEN 0 AND 90 AND a.k IN ('Call', 'Meeting')""",
)
def _(s):
    return reports.influenced_opportunities(s)


# ---------------------------------------------------------------- billing

_LIVE = f"SELECT deal_id, count(*) AS active_shops FROM fin_agreement WHERE NOT is_deleted AND (terminated_on IS NULL OR terminated_on > {TODAY}) GROUP BY deal_id"
_EXPIRED = f"""SELECT 'https://billing.example/deals/' || CAST(d.deal_id AS VARCHAR) AS billing_deal, d.name, d.start_date, d.end_date, coalesce(n.active_shops, 0) AS active_shops
   FROM fin_deal d LEFT JOIN ({_LIVE}) n ON n.deal_id = d.deal_id WHERE d.terminated_on IS NULL AND d.end_date < {TODAY} AND NOT d.is_deleted
     AND d.deal_id NOT IN (SELECT original_deal_id FROM fin_deal WHERE NOT is_deleted AND original_deal_id IS NOT NULL)"""
_NONDEV = """SELECT s.name, s.domain, a.shop_id, a.reason, a.deal_id FROM fin_agreement a JOIN fin_shop s ON s.shop_id = a.shop_id
   WHERE a.reason <> 'Development/Staging shop' AND a.terminated_on IS NULL AND a.is_deleted = false"""
_PLAN_JOIN = "fin_agreement a JOIN fin_deal d ON d.deal_id = a.deal_id"
_INACTIVE = f"SELECT a.shop_id FROM {_PLAN_JOIN} WHERE d.terminated_on IS NOT NULL AND a.terminated_on IS NOT NULL AND NOT a.is_deleted AND NOT d.is_deleted"
_ACTIVE = f"SELECT a.shop_id FROM {_PLAN_JOIN} WHERE (d.terminated_on IS NULL OR d.terminated_on >= {TODAY}) AND (a.terminated_on IS NULL OR a.terminated_on >= {TODAY})"
_ANY = f"SELECT shop_id FROM fin_agreement WHERE terminated_on IS NULL OR terminated_on >= {TODAY}"
_PAYING = """SELECT s.shop_id, s.name, b.base_price FROM fin_shop s JOIN fin_account t ON t.billing_account_id = s.billing_account_id
   JOIN fin_subscription b ON b.subscription_id = t.current_subscription_id AND b.plan_name = 'premium' WHERE s.email NOT LIKE '%@internal%'"""
_ORPHANS = f"""SELECT 'Something is wrong' AS reason, shop_id, 'https://billing.example/shops/' || CAST(shop_id AS VARCHAR) AS shop_url, name, base_price FROM ({_PAYING}) p
     WHERE shop_id IN ({_INACTIVE}) AND shop_id NOT IN (SELECT shop_id FROM ({_ACTIVE}) y)
   UNION ALL SELECT 'No billing deal at all', shop_id, 'https://billing.example/shops/' || CAST(shop_id AS VARCHAR), name, base_price FROM ({_PAYING}) p
     WHERE shop_id NOT IN (SELECT shop_id FROM ({_ANY}) z)"""
_MANAGED = f"""SELECT o.shop_url, o.shop_id, o.name, o.base_price, o.reasons, m.success_manager AS current_manager
   FROM (SELECT shop_url, shop_id, name, base_price, string_agg(reason, ', ' ORDER BY reason) AS reasons FROM ({_ORPHANS}) r GROUP BY ALL) o
     JOIN fin_shop_dimension x ON x.shop_id = o.shop_id JOIN crm_account m ON m.account_id = x.account_id"""
_URLS = ("https://billing.example/shops/", "https://billing.example/deals/")


@query("dom_active_shops", _LIVE)
def _(s):
    return billing.active_shops(s.table("fin_agreement"), AS_OF)


@query("dom_expired_deals", _EXPIRED)
def _(s):
    return billing.expired_deals(s.table("fin_deal"), s.table("fin_agreement"), AS_OF, _URLS[1])


@query("dom_internal_url", "SELECT deal_id, 'https://billing.example/deals/' || CAST(deal_id AS VARCHAR) AS url FROM fin_deal")
def _(s):
    return s.table("fin_deal").select("deal_id", billing.record_url(_URLS[1], c("deal_id")).alias("url"))


@query("dom_nondev_stores", _NONDEV)
def _(s):
    return billing.nondev_stores(s.table("fin_shop"), s.table("fin_agreement"))


@query(
    "dom_plan_sets",
    f"SELECT 'inactive' AS plan_set, shop_id, count(*) AS n FROM ({_INACTIVE}) a GROUP BY 2 UNION ALL SELECT 'active', shop_id, count(*) FROM ({_ACTIVE}) b GROUP BY 2 UNION ALL SELECT 'any', shop_id, count(*) FROM ({_ANY}) c GROUP BY 2",
)
def _(s):
    sets = billing.plan_sets(s.table("fin_deal"), s.table("fin_agreement"), AS_OF)
    parts = [df.withColumn("plan_set", F.lit(name)) for name, df in sets.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("plan_set", "shop_id").agg(F.count("*").alias("n"))


@query("dom_orphan_shops", _ORPHANS)
def _(s):
    return billing.orphan_shops(s, AS_OF, "premium", "%@internal%", _URLS[0])


@query("dom_orphan_reasons", _MANAGED)
def _(s):
    rows = billing.orphan_shops(s, AS_OF, "premium", "%@internal%", _URLS[0])
    return billing.orphan_reasons(rows, s.table("fin_shop_dimension"), s.table("crm_account"))


@query("pipe_expired_deals", _EXPIRED)
def _(s):
    return reports.expired_deals(s, AS_OF)


@query("pipe_nondev_stores", _NONDEV)
def _(s):
    return reports.nondev_stores(s)


@query("pipe_orphans", f"SELECT reason, shop_url, name, base_price FROM ({_ORPHANS}) o")
def _(s):
    return reports.orphans(s, AS_OF)


@query("pipe_orphans_managed", _MANAGED)
def _(s):
    return reports.orphans_managed(s, AS_OF)
