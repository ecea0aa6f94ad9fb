"""Rep scorecard: each metric as its own query, then the assembly."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from revtrellis.catalog.registry import AS_OF, query
from revtrellis.operators import scorecard as S
from revtrellis.params.fixed_values import TEAM_GROUPS

c = F.col
TODAY = f"DATE '{AS_OF}'"
FROM, SNAPSHOT, TIERS = date(1997, 7, 1), date(1998, 5, 4), ["Tier 1", "Tier 2", "Tier 3"]


def _qend(day: str) -> str:
    return f"last_day(CAST(date_trunc('quarter', {day}) + INTERVAL 2 MONTH AS DATE))"


def _actuals(metrics: str, types: str, dataset: str = "Actuals") -> str:
    return f"SELECT *, opportunity_owner AS rep_name, last_day(full_date) AS month_date FROM fact_metric WHERE dataset = '{dataset}' AND metric IN ({metrics}) AND value_type IN ({types})"


_DEALS = "'Opportunity Deal Count'"
_OPP = "count(DISTINCT opportunity_id)"


def _share(rows: str, **flags: str) -> str:
    cols = ", ".join(f"count(DISTINCT CASE WHEN {cond} THEN opportunity_id END)::DOUBLE / nullif({_OPP}, 0) AS {name}" for name, cond in flags.items())
    return f"SELECT rep_name, month_date, {cols} FROM ({rows}) f GROUP BY rep_name, month_date"


# ---------------------------------------------------------------- workers

_GROUP = f"""CASE WHEN team = 'Sales Enterprise' AND user_role IS NOT NULL THEN
     CASE WHEN user_role LIKE '%DI%' OR user_role LIKE '%EN-ALL-MFG%' OR user_role LIKE '%EN-ALL-FAB%' THEN 'ENT Emerging' ELSE 'ENT Established' END
   WHEN team LIKE 'Sales Global%' THEN 'Global Accounts' WHEN team LIKE '%Sales Lending Cross-Sell%' THEN 'Lending Acceleration' WHEN team LIKE '%Sales Ads Cross-Sell%' THEN 'Ads'
   {' '.join(f"WHEN team = '{t}' THEN '{g}'" for t, g in TEAM_GROUPS.items())} END"""
_SALES_USERS = "SELECT employee_id AS worker_id, user_role FROM crm_user WHERE left(user_role, 4) IN ('AMER', 'EMEA', 'APAC', 'LATA') AND source_system = 'Main'"
MONTHS = f"""SELECT rep_name, month_date, discipline, subdiscipline, team, {_GROUP} AS team_group FROM (
     SELECT d.worker_name AS rep_name, last_day(d.effective_on) AS month_date, d.discipline, d.subdiscipline, d.team, u.user_role,
       row_number() OVER (PARTITION BY d.worker_name, last_day(d.effective_on) ORDER BY d.effective_on DESC, u.user_role, d.team) AS rn
     FROM hr_worker_daily d JOIN hr_worker m ON m.worker_id = d.manager_id AND m.is_active JOIN ({_SALES_USERS}) u ON u.worker_id = d.worker_id
     WHERE d.effective_on >= DATE '{FROM}') x WHERE rn = 1"""
WORKERS = f"""SELECT w.worker_name AS rep_name, m.worker_name AS manager_name, w.country, {TODAY} - CAST(w.tenure_days AS INTEGER) AS tenure_start_date,
     CASE left(u.user_role, 4) WHEN 'LATA' THEN 'LATAM' ELSE left(u.user_role, 4) END AS region, CASE WHEN u.user_role LIKE 'AMER%' THEN 'AMER' ELSE 'International' END AS region_compare,
     u.user_role AS rep_role
   FROM hr_worker w LEFT JOIN hr_worker m ON m.worker_id = w.manager_id JOIN ({_SALES_USERS}) u ON u.worker_id = w.worker_id WHERE w.is_active"""

# ---------------------------------------------------------------- metrics

EMAILS = """SELECT last_day(e.created_date) AS month_date, u.name AS rep_name, count(*) AS emails_sent, count(CASE WHEN e.view_tracking THEN 1 END)::DOUBLE / count(*) AS email_open_rate,
     count(CASE WHEN e.counts.replies > 0 THEN 1 END)::DOUBLE / count(*) AS email_response_rate FROM act_email e JOIN crm_user u ON u.user_id = e.sender.id GROUP BY 1, 2"""
CALLS = """SELECT last_day(e.created_date) AS month_date, u.name AS rep_name, count(*) AS calls_sent, count(CASE WHEN disposition = 'Connected' THEN 1 END)::DOUBLE / count(*) AS calls_response_rate,
     count(CASE WHEN sentiment = 'Interested' THEN 1 END) AS calls_interested, count(CASE WHEN sentiment = 'Interested' THEN 1 END)::DOUBLE / count(*) AS call_interest_rate
   FROM act_call e JOIN crm_user u ON u.user_id = e.sender.id GROUP BY 1, 2"""
APPOINTMENTS = """SELECT last_day(k.created_date) AS month_date, u.name AS rep_name, sum(k.counts.meetings_booked)::DOUBLE / nullif(sum(k.counts.people_acted_on), 0) AS value
   FROM act_cadence k JOIN crm_user u ON u.user_id = k.owner.id GROUP BY 1, 2"""
SHOW = """SELECT last_day(m.created_date) AS month_date, u.name AS rep_name, count(CASE WHEN m.no_show = false THEN 1 END)::DOUBLE / count(*) AS value
   FROM act_meeting m JOIN crm_user u ON u.email = m.calendar_id GROUP BY 1, 2"""
MINUTES = """SELECT last_day(CAST(m.start_time AS DATE)) AS month_date, u.name AS rep_name, avg(date_diff('minute', m.start_time, m.end_time)) AS value
   FROM act_meeting m JOIN act_cadence k ON k.id = m.cadence.id JOIN crm_user u ON u.user_id = k.owner.id GROUP BY 1, 2"""
CREATED = f"SELECT rep_name, month_date, sum(value) AS value FROM ({_actuals(chr(39) + 'Created' + chr(39), _DEALS)}) f GROUP BY 1, 2"
CREATED_VALUE = f"""SELECT rep_name, month_date, sum(value) FILTER (value_type = 'Total Revenue') AS created_revenue, sum(value) FILTER (value_type = 'Incremental Product Profit') AS created_profit
   FROM ({_actuals("'Created'", "'Total Revenue', 'Incremental Product Profit'")}) f GROUP BY 1, 2"""
_BOOK = f"""SELECT r.rep_name, last_day(s.snapshot_date) AS month_date, s.snapshot_date, s.account_id, s.tier, a.account_id AS hit
   FROM account_snapshot s JOIN territory_rep r ON upper(r.territory_name) = upper(s.territory_name) AND r.quarter_end = {_qend('s.snapshot_date')}
     LEFT JOIN account_activity a ON a.account_id = s.account_id AND last_day(a.activity_date) = last_day(s.snapshot_date) AND a.activity_group = 'Sales'"""
BOOK = f"""SELECT rep_name, month_date, value, snapshot_date FROM (SELECT rep_name, month_date, snapshot_date, count(DISTINCT hit)::DOUBLE / count(DISTINCT account_id) AS value,
     row_number() OVER (PARTITION BY rep_name, month_date ORDER BY snapshot_date DESC) AS rn FROM ({_BOOK}) b WHERE tier IN ('Tier 1', 'Tier 2', 'Tier 3') GROUP BY 1, 2, 3) x WHERE rn = 1"""
CONTACTED = f"""SELECT rep_name, month_date, value, snapshot_date FROM (SELECT rep_name, month_date, snapshot_date, count(DISTINCT account_id) AS value,
     row_number() OVER (PARTITION BY rep_name, month_date ORDER BY snapshot_date DESC) AS rn FROM ({_BOOK}) b WHERE hit IS NOT NULL GROUP BY 1, 2, 3) x WHERE rn = 1"""


def quota_sql(quarterly: bool) -> str:
    first = "make_date(CAST(substring(q.period, 3, 4) AS INT), CAST(substring(q.period, 8, 2) AS INT), 1)"
    return f"""SELECT w.worker_name AS rep_name, {_qend(first) if quarterly else f'last_day({first})'} AS month_date, sum(q.quota) FILTER (q.attribute_id LIKE 'INCREMENTAL%') AS profit_quota,
         sum(q.quota) FILTER (q.attribute_id LIKE 'TOTAL%') AS revenue_quota, sum(q.quota) FILTER (q.attribute_id LIKE 'SOLUTION%') AS activations_quota
       FROM hr_quota q JOIN hr_worker w ON w.worker_id = q.payee_id GROUP BY 1, 2"""


def sums_sql(metric: str, prefix: str, quarterly: bool, dataset: str = "Actuals", snapshot: str | None = None) -> str:
    more = f"AND snapshot_date = DATE '{snapshot}'" if snapshot else ""
    return f"""SELECT opportunity_owner AS rep_name, {_qend('full_date') if quarterly else 'last_day(full_date)'} AS month_date,
         sum(value) FILTER (value_type = 'Incremental Product Profit') AS {prefix}_profit, sum(value) FILTER (value_type = 'Total Revenue') AS {prefix}_revenue,
         sum(value) FILTER (value_type = 'Solution Activations') AS {prefix}_activations
       FROM fact_metric WHERE dataset = '{dataset}' AND metric = '{metric}' AND opportunity_owner <> '' AND value_type IN ('Incremental Product Profit', 'Total Revenue', 'Solution Activations') {more}
       GROUP BY 1, 2"""


_KINDS = ["profit", "revenue", "activations"]


def coverage_sql(actuals: str, opened: str, quarter: str) -> str:
    cols = []
    for k in _KINDS:
        ratio = f"o.open_{k} / nullif(q.{k}_quota - coalesce(a.actual_{k}, 0), 0)"
        cols.append(f"CASE WHEN {ratio} < 0 OR {ratio} > 10 THEN 10 ELSE {ratio} END AS {k}_coverage")
        cols.append(f"CASE WHEN q.{k}_quota - coalesce(a.actual_{k}, 0) < 0 THEN 0 ELSE q.{k}_quota - coalesce(a.actual_{k}, 0) END AS {k}_gap")
    return f"""SELECT q.*, a.actual_profit, a.actual_revenue, a.actual_activations, o.open_profit, o.open_revenue, o.open_activations, {', '.join(cols)}
       FROM ({quota_sql(True)}) q LEFT JOIN ({actuals}) a ON a.rep_name = q.rep_name AND a.month_date = q.month_date
         LEFT JOIN ({opened}) o ON o.rep_name = q.rep_name AND o.month_date = q.month_date WHERE q.month_date = {quarter}"""


# As of 20 April 1998, the first month of the quarter: the quarter ends in June, the rows are of April.
EARLY = date(1998, 4, 20)
_EARLY_MONTH = "SELECT * REPLACE (DATE '1998-04-30' AS month_date) FROM ({}) x"
COVERAGE = coverage_sql(sums_sql("Closed Won", "actual", True), sums_sql("Open Pipe SAL", "open", True), "DATE '1998-06-30'")
EARLY_COVERAGE = _EARLY_MONTH.format(COVERAGE)
PAST_COVERAGE = coverage_sql(
    sums_sql("Closed Won", "actual", True, "Snapshots", "1998-05-04"), sums_sql("Open Pipe SAL", "open", True, "Snapshots", "1998-05-04"), "DATE '1998-06-30'"
)


def attainment_sql(quarterly: bool, where: str = "true") -> str:
    cols = ", ".join(f"a.actual_{k} / nullif(q.{k}_quota, 0) AS {k}_attainment" for k in _KINDS)
    return f"""SELECT q.*, a.actual_profit, a.actual_revenue, a.actual_activations, {cols} FROM ({quota_sql(quarterly)}) q
       LEFT JOIN ({sums_sql('Closed Won', 'actual', quarterly)}) a ON a.rep_name = q.rep_name AND a.month_date = q.month_date WHERE {where}"""


# As of 17 June 1998: 91 days in the quarter, 13 remain.
PACING = f"""SELECT q.* REPLACE (DATE '1998-06-30' AS month_date), a.actual_profit, a.actual_revenue, a.actual_activations, 78::DOUBLE / 91 * 100 AS percent_of_quarter,
     {', '.join(f'a.actual_{k} / nullif(q.{k}_quota * 78 / 91, 0) AS {k}_pacing' for k in _KINDS)}
   FROM ({quota_sql(True)}) q LEFT JOIN ({sums_sql('Closed Won', 'actual', True)}) a ON a.rep_name = q.rep_name AND a.month_date = q.month_date WHERE q.month_date = DATE '1998-06-30'"""
RECORDED = """SELECT owner_name AS rep_name, last_day(activity_date) AS month_date, count(event_id) AS meetings, count(recording_url) AS recorded
   FROM act_recorded_meeting WHERE owner_name IS NOT NULL AND owner_name <> 'Unknown' GROUP BY 1, 2"""
TALK = f"""SELECT u.name AS rep_name, last_day(v.created_date) AS month_date, sum(v.duration_ms / 60000) / nullif(sum(o.value), 0) AS value FROM act_conversation v
   JOIN crm_user u ON CAST(u.guid AS VARCHAR) = v.user_guid JOIN ({CREATED}) o ON o.rep_name = u.name AND o.month_date = last_day(v.created_date) GROUP BY 1, 2"""


def multi_year_sql(metric: str) -> str:
    return _share(_actuals(f"'{metric}'", _DEALS) + " AND term_length IS NOT NULL", value="CAST(term_length AS DOUBLE) > 1")


DEMOS = f"SELECT rep_name, month_date, sum(value) AS value FROM ({_actuals(chr(39) + 'Activity Subtype Count' + chr(39), chr(39) + 'Demo' + chr(39), 'Activity')}) f GROUP BY 1, 2"
FOLLOW = """SELECT rep_name, last_day(m) AS month_date, count(CASE WHEN n > 1 THEN 1 END)::DOUBLE / count(*) AS value FROM (
     SELECT opportunity_id, opportunity_owner AS rep_name, activity_type, min(CAST(date_trunc('month', activity_date) AS DATE)) AS m, count(*) AS n FROM account_activity
     WHERE opportunity_id IS NOT NULL AND activity_type IN ('Call', 'Meeting') AND opportunity_owner = activity_owner GROUP BY 1, 2, 3) x GROUP BY 1, 2"""


def _inverse(days: str) -> str:
    return f"CASE WHEN avg({days}) > 0 THEN 1 / avg({days}) ELSE avg({days}) END"


STAGE = " UNION ALL ".join(
    f"""SELECT o.owner_name AS rep_name, last_day(s.{a}) AS month_date, '{m}' AS metric, {_inverse(f's.{b} - s.{a}')} AS value
        FROM fact_stage s JOIN crm_opportunity o ON o.opportunity_id = s.opportunity_id WHERE o.owner_name IS NOT NULL GROUP BY 1, 2"""
    for m, (a, b) in S.STAGES.items()
)
NEXT = _share(_actuals("'Open Pipe'", _DEALS) + f" AND full_date >= {TODAY}", value="next_step IS NOT NULL")
AGE = f"""SELECT rep_name, last_day(qualified_date) AS month_date, {_inverse(f'{TODAY} - qualified_date')} AS value FROM ({_actuals("'Open Pipe SAL'", _DEALS)}) f GROUP BY 1, 2"""
WIN = _share(_actuals("'Closed Won', 'Closed Lost'", _DEALS), value="metric = 'Closed Won'")
CYCLE = f"""SELECT o.owner_name AS rep_name, last_day(o.close_date) AS month_date, {_inverse('o.close_date - s.envision_at')} AS value
   FROM fact_stage s JOIN crm_opportunity o ON o.opportunity_id = s.opportunity_id WHERE o.stage_name LIKE '%Closed%' GROUP BY 1, 2"""
UNIFIED = _share(
    f"SELECT f.*, p.opportunity_id AS pid FROM ({_actuals(chr(39) + 'Closed Won' + chr(39), _DEALS)}) f LEFT JOIN (SELECT DISTINCT opportunity_id FROM partner_relationship WHERE is_coselling) p ON p.opportunity_id = f.opportunity_id",
    unified_share="is_unified",
    partner_share="pid IS NOT NULL",
)
CONTRACT = f"SELECT rep_name, month_date, round(avg(CAST(term_length AS DOUBLE)), 2) AS value FROM ({_actuals(chr(39) + 'Closed Won' + chr(39), _DEALS)}) f GROUP BY 1, 2"
MIX = _share(_actuals("'Closed Won'", "'Product Deal Count'"), **{k: f"product_name = '{v}'" for k, v in S.PRODUCTS.items()})
ACCEPTED = """SELECT last_day(CAST(m.start_time AS DATE)) AS month_date, r.name AS rep_name, count(*) AS value FROM (SELECT calendar_id, start_time, unnest(attendees) AS att FROM act_meeting) m
   JOIN crm_user r ON r.email = m.calendar_id JOIN crm_user g ON g.email = m.att.email WHERE g.name = r.manager_name AND m.att.status = 'accepted' GROUP BY 1, 2"""


# ---------------------------------------------------------------- assembly in the form of one lookup per metric

_THIS = "DATE '1998-06-30'"
_LOOKUPS = [
    ("1a. Emails Sent", EMAILS, "emails_sent"), ("1b. Email Open Rate", EMAILS, "email_open_rate"), ("1c. Response Rate - Email", EMAILS, "email_response_rate"),
    ("1a. Calls Sent", CALLS, "calls_sent"), ("1c. Response Rate - Call", CALLS, "calls_response_rate"), ("1k. Total Call interested", CALLS, "calls_interested"),
    ("1k. Call Interest Rate", CALLS, "call_interest_rate"), ("1d. Appointments booked responses", APPOINTMENTS, "value"), ("1e. Show rate", SHOW, "value"),
    ("1f. Average meeting time (hr)", MINUTES, "value"), ("1g. Created Opps", CREATED, "value"), ("1h. % Book Contacted", BOOK, "value"),
    ("1i. # Accounts Contacted", CONTACTED, "value"), ("1j. Pipe Coverage LTR", COVERAGE, "revenue_coverage"), ("1j. Pipe Coverage IPP", COVERAGE, "profit_coverage"),
    ("1j. Pipe Coverage SA", COVERAGE, "activations_coverage"), ("1l. LQ Pipe Coverage LTR", PAST_COVERAGE, "revenue_coverage"),
    ("1l. LQ Pipe Coverage IPP", PAST_COVERAGE, "profit_coverage"), ("2a. Total Meetings Recorded", RECORDED, "recorded"), ("99f. Total Meetings", RECORDED, "meetings"),
    ("2b. Talk-to-Meeting Conversion Rate", TALK, "value"), ("2c. Multi vs Single Yr Deals - Open Pipe", multi_year_sql("Open Pipe SAL"), "value"),
    ("2d. # of Demos Scheduled", DEMOS, "value"), ("2e. Follow-Up Rate", FOLLOW, "value"), ("2g. % of Pipe w/ Next steps", NEXT, "value"),
    ("2h. Average Age - Open Pipe", AGE, "value"), ("2i. Meetings Accepted by Manager", ACCEPTED, "value"), ("3a. Win Rate", WIN, "value"),
    ("3c. Cycle Length", CYCLE, "value"), ("3d. Unified Commerce Exposure", UNIFIED, "unified_share"), ("3e. Partner attach", UNIFIED, "partner_share"),
    ("3g. Multi vs Single Yr Deals - Closed Won", multi_year_sql("Closed Won"), "value"), ("3h. Contract Length", CONTRACT, "value"),
    ("3i. Product Mix Capital", MIX, "capital"), ("3j. Product Mix Payments", MIX, "payments"), ("3k. Product Mix Retail Payments", MIX, "retail_payments"),
    ("3l. Product Mix Installments", MIX, "installments"), ("3m. Attainment LTR", attainment_sql(False), "revenue_attainment"),
    ("3m. Attainment IPP", attainment_sql(False), "profit_attainment"), ("3m. Attainment SA", attainment_sql(False), "activations_attainment"),
    ("3n. Pacing IPP", PACING, "profit_pacing"), ("3n. Pacing LTR", PACING, "revenue_pacing"), ("3n. Pacing SA", PACING, "activations_pacing"),
    ("99b. Created LTR", CREATED_VALUE, "created_revenue"), ("99b. Created IPP", CREATED_VALUE, "created_profit"), ("99e. Targets - Actuals IPP", COVERAGE, "profit_gap"),
    ("99e. Targets - Actuals LTR", COVERAGE, "revenue_gap"), ("99i. IPP Targets", COVERAGE, "profit_quota"), ("99i. LTR Targets", COVERAGE, "revenue_quota"),
    ("99k. Open Pipe LTR", COVERAGE, "open_revenue"), ("99k. Open Pipe IPP", COVERAGE, "open_profit"),
    ("99h. 25Q1 Attainment LTR", attainment_sql(True, f"q.month_date = {_THIS}"), "revenue_attainment"),
    ("99h. 25Q1 Attainment IPP", attainment_sql(True, f"q.month_date = {_THIS}"), "profit_attainment"),
    ("99h. 25Q1 Attainment SAU", attainment_sql(True, f"q.month_date = {_THIS}"), "activations_attainment"),
]
GRID = f"""SELECT DISTINCT w.*, m.month_date, m.discipline, m.subdiscipline, m.team, m.team_group, t.system, t.metric, t.points, t.unit, t.metric_group, t.metric_subgroup
   FROM ({MONTHS}) m JOIN ({WORKERS}) w ON w.rep_name = m.rep_name JOIN scorecard_metric t ON t.metric_group LIKE '99.%' OR (t.team_group = m.team_group AND t.metric_group NOT LIKE '99.%')
   WHERE m.subdiscipline NOT IN ('Account Management', 'Incubation Sales', 'Revenue Operations', 'Program Management') AND m.subdiscipline NOT LIKE 'Management%'
     AND m.discipline NOT IN ('Legal', 'Talent Density', 'Engineering', 'No discipline provided', 'Support')"""
_VALUES = " UNION ALL ".join(
    [f"SELECT rep_name, month_date, '{m}' AS metric, CAST({col} AS DOUBLE) AS value FROM ({sql}) z{i}" for i, (m, sql, col) in enumerate(_LOOKUPS)] + [f"SELECT * FROM ({STAGE}) zz"]
)
REP = f"SELECT g.*, v.value FROM ({GRID}) g JOIN ({_VALUES}) v ON v.rep_name = g.rep_name AND v.month_date = g.month_date AND v.metric = g.metric WHERE v.value IS NOT NULL"
BANDS = """SELECT team_group, region_compare, metric, month_date, min(value) AS min_value, max(value) AS max_value, max(value) / 4 AS quarter_1, max(value) / 4 * 2 AS quarter_2,
   max(value) / 4 * 3 AS quarter_3 FROM ({rep}) b GROUP BY 1, 2, 3, 4"""
POINTS = f"""SELECT r.*, p.min_value, p.max_value, p.quarter_1, p.quarter_2, p.quarter_3, round(CASE WHEN r.value >= p.quarter_3 THEN r.points WHEN r.value >= p.quarter_2 THEN r.points / 4 * 3
     WHEN r.value >= p.quarter_1 THEN r.points / 4 * 2 WHEN r.value < p.quarter_1 THEN r.points / 4 END, 0) AS rep_points
   FROM rep r LEFT JOIN ({BANDS.format(rep='SELECT * FROM rep')}) p ON p.team_group = r.team_group AND p.region_compare = r.region_compare AND p.metric = r.metric AND p.month_date = r.month_date
   WHERE r.team NOT LIKE '%DNU%' AND p.quarter_3 > 0"""
SCORECARD = f"""WITH rep AS MATERIALIZED ({REP}), final AS MATERIALIZED ({POINTS})
   SELECT f.* EXCLUDE (gn, sn), CASE WHEN gn = 1 THEN g.pts END AS group_points, CASE WHEN sn = 1 THEN k.pts END AS subgroup_points, CASE WHEN sn = 1 THEN t.pts END AS subgroup_possible
   FROM (SELECT *, row_number() OVER (PARTITION BY rep_name, month_date, metric_group, team_group ORDER BY metric) AS gn,
           row_number() OVER (PARTITION BY rep_name, month_date, metric_subgroup, team_group ORDER BY metric) AS sn FROM final) f
     LEFT JOIN (SELECT rep_name, team_group, month_date, metric_group, sum(rep_points) AS pts FROM final GROUP BY ALL) g
       ON g.rep_name = f.rep_name AND g.team_group = f.team_group AND g.month_date = f.month_date AND g.metric_group = f.metric_group
     LEFT JOIN (SELECT rep_name, team_group, month_date, metric_subgroup, sum(rep_points) AS pts FROM final GROUP BY ALL) k
       ON k.rep_name = f.rep_name AND k.team_group = f.team_group AND k.month_date = f.month_date AND k.metric_subgroup = f.metric_subgroup
     LEFT JOIN (SELECT metric_subgroup, team_group, sum(points) AS pts FROM scorecard_metric GROUP BY ALL) t ON t.metric_subgroup = f.metric_subgroup AND t.team_group = f.team_group"""


# ---------------------------------------------------------------- registration


@query("sc_team_group", f"SELECT DISTINCT d.team, u.user_role, {_GROUP} AS team_group FROM hr_worker_daily d JOIN crm_user u ON u.user_id = d.worker_id")
def _(s):
    users = s.table("crm_user").select(c("user_id").alias("worker_id"), "user_role")
    rows = s.table("hr_worker_daily").select("worker_id", "team").distinct().join(users, "worker_id")
    return rows.select("team", "user_role", S.team_group(c("team"), c("user_role")).alias("team_group")).distinct()


@query("sc_worker_month", MONTHS)
def _(s):
    return S.worker_month(s.table("hr_worker_daily"), s.table("hr_worker"), s.table("crm_user"), FROM)


@query("sc_worker_current", WORKERS)
def _(s):
    return S.worker_current(s.table("hr_worker"), s.table("crm_user"), AS_OF)


@query("sc_email", EMAILS)
def _(s):
    return S.emails(s.table("act_email"), s.table("crm_user"))


@query("sc_calls", CALLS)
def _(s):
    return S.calls(s.table("act_call"), s.table("crm_user"))


@query("sc_appointments", APPOINTMENTS)
def _(s):
    return S.appointments(s.table("act_cadence"), s.table("crm_user"))


@query("sc_show_rate", SHOW)
def _(s):
    return S.show_rate(s.table("act_meeting"), s.table("crm_user"))


@query("sc_meeting_minutes", MINUTES)
def _(s):
    return S.meeting_minutes(s.table("act_meeting"), s.table("act_cadence"), s.table("crm_user"))


@query("sc_created", CREATED)
def _(s):
    return S.created(s.table("fact_metric"))


@query("sc_created_value", CREATED_VALUE)
def _(s):
    return S.created_value(s.table("fact_metric"))


@query("sc_book_contacted", BOOK)
def _(s):
    return S.book_contacted(s.table("account_snapshot"), s.table("territory_rep"), s.table("account_activity"), TIERS)


@query("sc_accounts_contacted", CONTACTED)
def _(s):
    return S.accounts_contacted(s.table("account_snapshot"), s.table("territory_rep"), s.table("account_activity"))


@query("sc_quota", quota_sql(True))
def _(s):
    return S.quotas(s.table("hr_quota"), s.table("hr_worker"))


@query("sc_closed_actuals", sums_sql("Closed Won", "actual", True))
def _(s):
    return S.value_sums(s.table("fact_metric"), "Closed Won", "actual", True)


@query("sc_open_pipe", sums_sql("Open Pipe SAL", "open", True))
def _(s):
    return S.value_sums(s.table("fact_metric"), "Open Pipe SAL", "open", True)


@query("sc_pipe_coverage", EARLY_COVERAGE)
def _(s):
    fact = s.table("fact_metric")
    return S.pipe_coverage(
        S.quotas(s.table("hr_quota"), s.table("hr_worker")), S.value_sums(fact, "Closed Won", "actual", True), S.value_sums(fact, "Open Pipe SAL", "open", True),
        S.quarter_end(F.lit(EARLY)), F.last_day(F.lit(EARLY)),
    )


@query("sc_pipe_coverage_snapshot", PAST_COVERAGE)
def _(s):
    fact = s.table("fact_metric")
    return S.pipe_coverage(
        S.quotas(s.table("hr_quota"), s.table("hr_worker")),
        S.value_sums(fact, "Closed Won", "actual", True, "Snapshots", SNAPSHOT),
        S.value_sums(fact, "Open Pipe SAL", "open", True, "Snapshots", SNAPSHOT),
        S.quarter_end(F.lit(SNAPSHOT)), S.quarter_end(F.lit(SNAPSHOT)),
    )


@query("sc_attainment", attainment_sql(False))
def _(s):
    return S.attainment(S.quotas(s.table("hr_quota"), s.table("hr_worker"), quarterly=False), S.value_sums(s.table("fact_metric"), "Closed Won", "actual", False))


@query("sc_attainment_quarter", _EARLY_MONTH.format(attainment_sql(True, "q.month_date = DATE '1998-06-30'")))
def _(s):
    return S.attainment_to_date(S.quotas(s.table("hr_quota"), s.table("hr_worker")), S.value_sums(s.table("fact_metric"), "Closed Won", "actual", True), EARLY)


@query("sc_pacing", PACING)
def _(s):
    return S.pacing(S.quotas(s.table("hr_quota"), s.table("hr_worker")), S.value_sums(s.table("fact_metric"), "Closed Won", "actual", True), AS_OF)


@query("sc_meetings_recorded", RECORDED)
def _(s):
    return S.meetings_recorded(s.table("act_recorded_meeting"))


@query("sc_talk_conversion", TALK)
def _(s):
    return S.talk_conversion(s.table("act_conversation"), s.table("crm_user"), S.created(s.table("fact_metric")))


@query("sc_multi_year_open", multi_year_sql("Open Pipe SAL"))
def _(s):
    return S.multi_year(s.table("fact_metric"), "Open Pipe SAL")


@query("sc_multi_year_won", multi_year_sql("Closed Won"))
def _(s):
    return S.multi_year(s.table("fact_metric"), "Closed Won")


@query("sc_demos", DEMOS)
def _(s):
    return S.demos(s.table("fact_metric"))


@query("sc_follow_up", FOLLOW)
def _(s):
    return S.follow_up(s.table("account_activity"))


@query("sc_stage_progress", STAGE)
def _(s):
    return S.stage_progress(s.table("fact_stage"), s.table("crm_opportunity"))


@query("sc_next_steps", NEXT)
def _(s):
    return S.next_steps(s.table("fact_metric"), AS_OF)


@query("sc_open_age", AGE)
def _(s):
    return S.open_age(s.table("fact_metric"), AS_OF)


@query("sc_win_rate", WIN)
def _(s):
    return S.win_rate(s.table("fact_metric"))


@query("sc_cycle_length", CYCLE)
def _(s):
    return S.cycle_length(s.table("fact_stage"), s.table("crm_opportunity"))


@query("sc_unified_partner", UNIFIED)
def _(s):
    return S.unified_partner(s.table("fact_metric"), s.table("partner_relationship"))


@query("sc_contract_length", CONTRACT)
def _(s):
    return S.contract_length(s.table("fact_metric"))


@query("sc_product_mix", MIX)
def _(s):
    return S.product_mix(s.table("fact_metric"))


@query("sc_manager_accepted", ACCEPTED)
def _(s):
    return S.manager_accepted(s.table("act_meeting"), s.table("crm_user"))


def _grid(s):
    months = S.worker_month(s.table("hr_worker_daily"), s.table("hr_worker"), s.table("crm_user"), FROM)
    return S.metric_grid(months, S.worker_current(s.table("hr_worker"), s.table("crm_user"), AS_OF), s.table("scorecard_metric"))


@query("sc_metric_grid", GRID)
def _(s):
    return _grid(s)


@query("sc_assemble", REP)
def _(s):
    return S.scorecard_rows(s, AS_OF, FROM, SNAPSHOT, TIERS)


@query("sc_quartile_bands", BANDS.format(rep=REP))
def _(s):
    return S.quartile_bands(S.scorecard_rows(s, AS_OF, FROM, SNAPSHOT, TIERS))


@query("sc_points", f"WITH rep AS MATERIALIZED ({REP}) {POINTS}")
def _(s):
    return S.points(S.scorecard_rows(s, AS_OF, FROM, SNAPSHOT, TIERS))


@query("sc_group_totals", SCORECARD)
def _(s):
    return S.scorecard(s, AS_OF, FROM, SNAPSHOT, TIERS)
