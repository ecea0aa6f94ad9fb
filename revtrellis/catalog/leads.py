"""Lead and opportunity funnels, and the lead × partner report."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from revtrellis.catalog.registry import AS_OF, query
from revtrellis.operators import funnel, partners
from revtrellis.operators.joins import full_outer_nullable
from revtrellis.operators.windows import key_maximum
from revtrellis.params.fixed_values import REVENUE_BAND_MIDPOINT
from revtrellis.plans import reports

c = F.col

# The reports' settings moved to the dates of the test tables.
INTERNAL = replace(
    reports.INTERNAL_RETAIL, opportunities_from=date(1997, 1, 1), facts_from_year=1997, lead_year=1998, enriched_after=date(1998, 3, 1),
    excluded_accounts=("001000000000003AAA",),
)
_MOVED = {"opportunities_from": date(1997, 1, 1), "facts_from_year": 1997, "lead_year": 1998, "restate_before": date(1998, 2, 1), "restate_to": date(1998, 2, 25)}
AMER = replace(reports.PARTNER_AMER, **_MOVED, enriched_after=date(1998, 3, 1), lead_campaigns=("Incubation-b2b blue bolt", "red widget"), excluded_accounts=("001000000000003AAA",))
EMEA = replace(reports.PARTNER_EMEA, **_MOVED, excluded_accounts=("001000000000003AAA",))
TOFU = replace(reports.TOP_OF_FUNNEL, opportunities_from=date(1997, 7, 1), facts_from=date(1997, 7, 1), leads_from=date(1998, 2, 1))


def _any(col: str, patterns) -> str:
    return "(" + " OR ".join(f"{col} LIKE '{p}'" for p in patterns) + ")"


def midpoint_sql(col: str, text: bool = False) -> str:
    cases = " ".join(f"WHEN '{band}' THEN " + (f"'{v}'" if text else f"CAST({v} AS DOUBLE)") for band, v in REVENUE_BAND_MIDPOINT.items())
    return f"CASE {col} {cases} END"


def opportunities_sql(p) -> str:
    when = f"full_date >= DATE '{p.facts_from}'" if p.facts_from else f"year >= {p.facts_from_year}"
    extra = ", f.team_segment" if "team_segment" in p.fact_columns else ""
    roles = f" AND ({_any('o.role_at_creation', p.creation_role_patterns)} OR {_any('r.role_name', p.owner_role_patterns)})" if p.creation_role_patterns else ""
    return f"""SELECT o.opportunity_id, o.role_at_creation AS sdr_role, r.role_name AS opp_owner_role, o.created_date AS opp_created_date, o.stage_name AS opp_stage_name,
        o.offline_revenue AS opp_offline_revenue, coalesce(o.committed_revenue, o.verified_revenue) AS opp_committed_revenue,
        coalesce(f.lead_group, 'Unknown') AS lead_group{extra}
      FROM crm_opportunity o LEFT JOIN (SELECT DISTINCT opportunity_id, {', '.join(p.fact_columns)} FROM fact_metric WHERE dataset = 'Actuals' AND {when}) f
        ON f.opportunity_id = o.opportunity_id
      LEFT JOIN crm_user u ON u.user_id = o.owner_id LEFT JOIN crm_role r ON r.user_role_id = u.user_role_id
      WHERE o.is_deleted = false AND o.created_date >= DATE '{p.opportunities_from}'{roles}"""


def leads_sql(p) -> str:
    conds = ["l.is_deleted = false"]
    if p.leads_from:
        conds.append(f"l.created_date >= DATE '{p.leads_from}'")
    if p.lead_role_patterns:
        wanted = f"({_any('l.owner_role', p.lead_role_patterns)} AND year(l.{p.lead_year_column}) = {p.lead_year})"
        if p.lead_campaigns:
            names = ", ".join(f"'{n}'" for n in p.lead_campaigns)
            wanted += f" OR g.campaign_name IN ({names})"
        conds.append(f"({wanted})")
    campaign = "LEFT JOIN crm_campaign_member m ON m.lead_id = l.lead_id LEFT JOIN crm_campaign g ON g.campaign_id = m.campaign_id" if p.lead_campaigns else ""
    return f"""SELECT DISTINCT l.lead_id, l.owner_role AS lead_owner, l.owner_id AS lead_owner_id, u.name AS lead_owner_name, l.lead_source, l.status, l.offline_revenue_band,
        l.enriched_revenue, l.created_date, l.mql_date, l.sal_date, l.region_label, l.converted_account_id, l.converted_opportunity_id, l.is_customer,
        l.retail_locations, l.disqualified_reason, a.territory_name, a.account_id
      FROM crm_lead_raw l {campaign} LEFT JOIN crm_account a ON a.account_id = l.converted_account_id LEFT JOIN crm_user u ON u.user_id = l.owner_id
      WHERE {' AND '.join(conds)}"""


def joined_sql(p) -> str:
    keep = "lead_id IS NOT NULL"
    if p.kept_role_patterns:
        keep += f" OR {_any('sdr_role', p.kept_role_patterns)} OR {_any('opp_owner_role', p.kept_role_patterns)}"
    return f"SELECT DISTINCT * FROM ({leads_sql(p)}) l FULL OUTER JOIN ({opportunities_sql(p)}) o ON l.converted_opportunity_id = o.opportunity_id WHERE {keep}"


FLAGS = """CASE WHEN lead_id IS NULL THEN 0 ELSE 1 END AS is_lead, CASE WHEN {q} IS NULL THEN 0 ELSE 1 END AS is_mql, CASE WHEN opportunity_id IS NULL THEN 0 ELSE 1 END AS is_sql,
   CASE WHEN lead_id IS NULL THEN 'Outbound' WHEN opportunity_id IS NULL THEN 'No SQL' WHEN {q} IS NULL THEN 'Lead not qualified' ELSE 'MQL' END AS sql_source,
   CASE WHEN opp_stage_name NOT IN ('Pre-Qualified', 'Closed Lost') THEN 1 ELSE 0 END AS is_sal"""
CAPPED = "CASE WHEN enriched_revenue >= 200000000 THEN 200000000.0::DOUBLE ELSE enriched_revenue END"
SEGMENT = """CASE WHEN lower(lead_owner) LIKE '%forecasting%role%' THEN CASE WHEN account_id IS NOT NULL AND offline_revenue_band IS NULL THEN 'MM'
   WHEN account_id IS NULL AND offline_revenue_band IS NOT NULL THEN 'Retail' WHEN account_id IS NULL AND offline_revenue_band IS NULL THEN 'D2C MM' END END"""


def restate_sql(col: str, p) -> str:
    return f"CASE WHEN {col} < DATE '{p.restate_before}' THEN DATE '{p.restate_to}' ELSE {col} END"


def funnel_sql(p) -> str:
    cols = [f"{midpoint_sql('offline_revenue_band')} AS lead_midpoint_revenue"]
    qualified = "mql_date"
    if p.with_enriched:
        cols.append(f"{CAPPED} AS enriched_revenue_capped")
    if p.restate_before:
        cols += [f"{restate_sql('created_date', p)} AS restated_created_date", f"{restate_sql('mql_date', p)} AS restated_mql_date"]
        qualified = "restated_mql_date"
    if p.with_segment:
        cols.append(f"{SEGMENT} AS segment")
    estimate = "lead_midpoint_revenue"
    if p.enriched_after:
        estimate = f"CASE WHEN {qualified} > DATE '{p.enriched_after}' AND lead_midpoint_revenue IS NULL THEN enriched_revenue_capped ELSE lead_midpoint_revenue END"
    where = f"WHERE coalesce(account_id, '') NOT IN ({', '.join(repr(a) for a in p.excluded_accounts)})" if p.excluded_accounts else ""
    return f"""SELECT *, {estimate} AS lead_estimated_offline_revenue, {FLAGS.format(q=qualified)}
      FROM (SELECT *, {', '.join(cols)} FROM ({joined_sql(p)}) j) e {where}"""


@query("dom_band_midpoint", f"SELECT lead_id, {midpoint_sql('offline_revenue_band')} AS midpoint, {midpoint_sql('offline_revenue_band', True)} AS midpoint_text FROM crm_lead_raw")
def _(s):
    band = c("offline_revenue_band")
    return s.table("crm_lead_raw").select("lead_id", funnel.band_midpoint(band).cast("double").alias("midpoint"), funnel.band_midpoint_text(band).alias("midpoint_text"))


@query("dom_enriched_cap", f"SELECT lead_id, {CAPPED} AS capped FROM crm_lead_raw")
def _(s):
    return s.table("crm_lead_raw").select("lead_id", funnel.enriched_cap(c("enriched_revenue")).alias("capped"))


@query(
    "dom_offline_gmv_fallback",
    f"""SELECT lead_id, CASE WHEN mql_date > DATE '1998-03-01' AND m IS NULL THEN e ELSE m END AS estimate
        FROM (SELECT lead_id, mql_date, {midpoint_sql('offline_revenue_band')} AS m, {CAPPED} AS e FROM crm_lead_raw) x""",
)
def _(s):
    estimate = funnel.offline_estimate(
        c("mql_date"), funnel.band_midpoint(c("offline_revenue_band")).cast("double"), funnel.enriched_cap(c("enriched_revenue")), date(1998, 3, 1)
    )
    return s.table("crm_lead_raw").select("lead_id", estimate.alias("estimate"))


@query("dom_date_restate", f"SELECT lead_id, {restate_sql('mql_date', AMER)} AS restated FROM crm_lead_raw")
def _(s):
    return s.table("crm_lead_raw").select("lead_id", funnel.restate(c("mql_date"), AMER.restate_before, AMER.restate_to).alias("restated"))


@query(
    "dom_role_pattern_filter",
    "SELECT opportunity_id FROM crm_opportunity WHERE role_at_creation LIKE 'AMER-%N3%' OR sales_rep_role LIKE '%SMB%' OR sales_rep_role LIKE 'APAC%'",
)
def _(s):
    cond = funnel.role_filter(c("role_at_creation"), ["AMER-%N3%"], c("sales_rep_role"), ["%SMB%", "APAC%"])
    return s.table("crm_opportunity").filter(cond).select("opportunity_id")


@query("dom_opportunity_enrich", opportunities_sql(TOFU))
def _(s):
    return funnel.enrich_opportunities(s, TOFU)


@query("dom_lead_enrich", leads_sql(AMER))
def _(s):
    return funnel.enrich_leads(s, AMER)


@query("dom_lead_opp_outer", joined_sql(AMER))
def _(s):
    return funnel.lead_opportunity_outer(funnel.enrich_leads(s, AMER), funnel.enrich_opportunities(s, AMER), AMER)


@query(
    "dom_funnel_flags",
    f"""SELECT lead_id, opportunity_id, {FLAGS.format(q='mql_date')} FROM (SELECT lead_id, mql_date, opportunity_id, stage_name AS opp_stage_name
        FROM crm_lead_raw l FULL JOIN crm_opportunity o ON l.converted_opportunity_id = o.opportunity_id) x""",
)
def _(s):
    left = s.table("crm_lead_raw").select("lead_id", "mql_date", "converted_opportunity_id")
    right = s.table("crm_opportunity").select("opportunity_id", c("stage_name").alias("opp_stage_name"))
    rows = full_outer_nullable(left, right, "converted_opportunity_id", "opportunity_id", ["lead_id"], ["opportunity_id"])
    return rows.select("lead_id", "opportunity_id", *[v.alias(k) for k, v in funnel.funnel_flags(c("mql_date")).items()])


@query("dom_segment_from_gaps", f"SELECT lead_id, {SEGMENT} AS segment FROM (SELECT lead_id, owner_role AS lead_owner, converted_account_id AS account_id, offline_revenue_band FROM crm_lead_raw) x")
def _(s):
    segment = funnel.segment_from_gaps(c("owner_role"), c("converted_account_id"), c("offline_revenue_band"))
    return s.table("crm_lead_raw").select("lead_id", segment.alias("segment"))


@query("pipe_internal_retail", funnel_sql(INTERNAL))
def _(s):
    return reports.internal_retail(s, INTERNAL)


@query("pipe_partner_team_amer", funnel_sql(AMER))
def _(s):
    return reports.partner_team_amer(s, AMER.lead_campaigns, AMER.excluded_accounts, AMER)


@query("pipe_partner_team_emea", funnel_sql(EMEA))
def _(s):
    return reports.partner_team_emea(s, EMEA)


@query("pipe_tofu", funnel_sql(TOFU))
def _(s):
    return reports.top_of_funnel(s, TOFU)


# ---------------------------------------------------------------- lead × partner

_REFERRALS = "SELECT lead_id, unnest(referring_partners, recursive := true) FROM partner_referral"
_IDS = f"""SELECT lead_id FROM crm_lead UNION SELECT l.lead_id FROM crm_lead l JOIN legacy_lead g ON g.legacy_id = l.legacy_id WHERE g.eligibility_segment IS NULL
   UNION SELECT l.lead_id FROM crm_lead l JOIN legacy_lead g ON g.legacy_id = l.legacy_id WHERE g.eligibility_segment = 'Retail' UNION SELECT lead_id FROM ({_REFERRALS}) r"""
_PARTNER_LEADS = f"""SELECT * EXCLUDE (rn) FROM (SELECT reference_id AS lead_id, reference_object, membership_id, partner_id, shop_id, country_code, updated_on,
   row_number() OVER (PARTITION BY reference_id, membership_id ORDER BY updated_on DESC, shop_id DESC, partner_id DESC) AS rn
   FROM partner_lead WHERE reference_object = 'Lead' AND reference_id IN ({_IDS})) x WHERE rn = 1"""
_OWNERS = "SELECT l.lead_id, l.owner_role AS lead_owner_role, u.name AS lead_owner_name FROM crm_lead_raw l LEFT JOIN crm_user u ON u.user_id = l.owner_id"
_STATUS = "SELECT lead_id, max(end_date) AS current_status_date FROM lead_status_history GROUP BY lead_id"
_COUNTRY = """CASE WHEN starts_with(region_label, 'AMER - United States') THEN 'United States'
   WHEN strpos(region_label, ' - ') > 0 THEN substring(region_label, strpos(region_label, ' - ') + 3) END"""
_REGION = "CASE WHEN regexp_matches(region_label, '^([^ -]+) -') THEN regexp_extract(region_label, '^([^ -]+) -', 1) END"
_GMV = """CASE WHEN v BETWEEN 0 AND 1999999 THEN '0-2M' WHEN v BETWEEN 2000000 AND 4999999 THEN '2-5M' WHEN v BETWEEN 5000000 AND 39999999 THEN '5-40M'
   WHEN v BETWEEN 40000000 AND 199999999 THEN '40-200M' WHEN v > 200000000 THEN '200M+' ELSE 'Unknown' END"""
_MANAGERS = """SELECT partner_id, on_date, coalesce(min(CASE WHEN lower(programme) LIKE 'plus-partners%' THEN manager END), min(CASE WHEN lower(programme) = 'partners' THEN manager END),
     min(CASE WHEN lower(programme) LIKE 'agency%' THEN manager END), min(CASE WHEN lower(programme) LIKE 'retail_partnerships%' THEN manager END)) AS programme_manager,
     count(CASE WHEN programme LIKE 'plus-partners%' THEN 1 END) > 0 AS in_plus_programme
   FROM partner_manager_daily WHERE lower(programme) = 'partners' OR lower(programme) LIKE 'plus-partners%' OR lower(programme) LIKE 'agency%' OR lower(programme) LIKE 'retail_partnerships%'
   GROUP BY partner_id, on_date"""
_PAYMENT = "SELECT DISTINCT partner_id FROM (SELECT partner_id, unnest(memberships) AS m FROM partner) x WHERE m LIKE '%payment%'"
_CAMPAIGN = "SELECT m.lead_id, min(g.campaign_name) AS campaign_name FROM crm_campaign_member m JOIN crm_campaign g ON g.campaign_id = m.campaign_id GROUP BY m.lead_id"
_WON = """SELECT opportunity_id, min(close_date) AS closed_won_date FROM fact_metric WHERE dataset = 'Actuals' AND metric = 'Closed Won' AND value_type = 'Product Deal Count'
   GROUP BY opportunity_id"""


@query("dom_consolidated_ids", _IDS)
def _(s):
    return partners.consolidated_ids(s.table("crm_lead"), s.table("partner_referral"))


@query("dom_partner_lead_latest", _PARTNER_LEADS)
def _(s):
    ids = partners.consolidated_ids(s.table("crm_lead"), s.table("partner_referral"))
    return partners.partner_lead_latest(s.table("partner_lead"), ids)


@query("dom_lead_owner", _OWNERS)
def _(s):
    return partners.lead_owner(s.table("crm_lead_raw"), s.table("crm_user"))


@query("dom_sales_assist", "SELECT lead_id, partner_involvement AS requested, CASE WHEN mql_date IS NULL THEN 'No' ELSE 'Yes' END AS assisted FROM crm_lead_raw")
def _(s):
    return s.table("crm_lead_raw").select("lead_id", c("partner_involvement").alias("requested"), F.when(c("mql_date").isNotNull(), "Yes").otherwise("No").alias("assisted"))


@query(
    "dom_revenue_total",
    """SELECT opportunity_id, online_revenue_verified + offline_revenue AS total, coalesce(online_revenue_verified, 0) AS online_zero, coalesce(offline_revenue, 0) AS offline_zero
       FROM crm_opportunity""",
)
def _(s):
    online, offline = c("online_revenue_verified"), c("offline_revenue")
    return s.table("crm_opportunity").select(
        "opportunity_id", partners.revenue_total(online, offline).alias("total"), partners.zero_if_null(online).alias("online_zero"), partners.zero_if_null(offline).alias("offline_zero")
    )


@query("dom_status_latest", _STATUS)
def _(s):
    return partners.status_latest(s.table("lead_status_history"))


@query("dom_region_country_parse", f"SELECT lead_id, {_REGION} AS region, {_COUNTRY} AS country FROM crm_lead")
def _(s):
    label = c("region_label")
    return s.table("crm_lead").select("lead_id", partners.region_of(label).alias("region"), partners.country_of(label).alias("country"))


@query("dom_gmv_band", f"SELECT lead_id, {_GMV} AS band FROM (SELECT lead_id, online_revenue_verified AS v FROM crm_lead_raw) x")
def _(s):
    return s.table("crm_lead_raw").select("lead_id", partners.gmv_band(c("online_revenue_verified")).alias("band"))


@query("dom_manager_asof", _MANAGERS)
def _(s):
    return partners.manager_asof(s.table("partner_manager_daily"))


@query(
    "dom_type2_owner",
    """SELECT l.lead_id, d.manager_name AS developer FROM crm_lead l LEFT JOIN partner_developer_history d
       ON d.account_id = l.converted_account_id AND l.created_date BETWEEN d.start_date AND d.end_date""",
)
def _(s):
    rows = s.table("crm_lead").select("lead_id", "converted_account_id", "created_date")
    return partners.type2_asof(rows, s.table("partner_developer_history"), "converted_account_id", "created_date", "developer", AS_OF).select("lead_id", "developer")


@query("dom_payment_partner", f"SELECT p.partner_id, CASE WHEN q.partner_id IS NULL THEN 'No' ELSE 'Yes' END AS payment_program FROM partner p LEFT JOIN ({_PAYMENT}) q ON q.partner_id = p.partner_id")
def _(s):
    paying = partners.payment_partners(s.table("partner")).withColumn("_p", F.lit(True))
    rows = s.table("partner").select("partner_id").join(paying, "partner_id", "left")
    return rows.select("partner_id", F.when(c("_p"), "Yes").otherwise("No").alias("payment_program"))


@query(
    "dom_plus_flag",
    """SELECT h.lead_id, h.end_date, l.owner_id, max(CASE WHEN d.programme LIKE 'plus-%' THEN 'Yes' ELSE 'No' END) OVER (PARTITION BY h.lead_id, l.owner_id) AS plus_program
       FROM lead_status_history h JOIN crm_lead l ON l.lead_id = h.lead_id LEFT JOIN partner_manager_daily d ON d.partner_id = l.owner_id AND d.on_date = h.end_date""",
)
def _(s):
    rows = s.table("lead_status_history").join(s.table("crm_lead").select("lead_id", "owner_id"), "lead_id")
    daily = s.table("partner_manager_daily").select(c("partner_id").alias("owner_id"), c("on_date").alias("end_date"), "programme")
    rows = rows.join(daily, ["owner_id", "end_date"], "left")
    flag = F.when(c("programme").like("plus-%"), "Yes").otherwise("No")
    return key_maximum(rows, ["lead_id", "owner_id"], flag, "plus_program").select("lead_id", "end_date", "owner_id", "plus_program")


@query(
    "dom_outcome_ids",
    """SELECT lead_id, CASE WHEN sales_ready_date IS NOT NULL THEN lead_id END AS qualified_lead_id, CASE WHEN disqualified_date IS NOT NULL THEN lead_id END AS disqualified_id,
       CASE WHEN nurture_date IS NOT NULL THEN lead_id END AS nurture_id, CASE WHEN sales_ready_date IS NULL THEN lead_id END AS unworked_id FROM crm_lead""",
)
def _(s):
    return s.table("crm_lead").select("lead_id", *[v.alias(k) for k, v in partners.outcome_ids().items()])


@query("dom_days_in_status", f"SELECT lead_id, CAST(DATE '{AS_OF}' - current_status_date AS INT) AS days FROM ({_STATUS}) x")
def _(s):
    from revtrellis.functions.dates import as_date, days_between

    return partners.status_latest(s.table("lead_status_history")).select("lead_id", days_between(as_date(AS_OF), "current_status_date").alias("days"))


_COMMON = f"""SELECT l.lead_id, l.lead_source, l.lead_source_original, l.status, l.disqualified_reason, l.product_interest, l.product_interest_at_creation, l.enriched_revenue,
     l.converted_contact_id, l.sales_accepted_date, l.created_date, l.sales_ready_date,
     l.disqualified_date, l.nurture_date, l.opportunity_date, l.converted_opportunity_id, l.converted_account_id, l.online_revenue, l.offline_revenue, l.owner_role,
     w.lead_owner_role, w.lead_owner_name, b.routing_segment, b.is_customer, b.organization_id, b.partner_involvement, b.online_revenue_verified, b.lead_grade,
     b.mql_date AS raw_mql_date, b.referrer_name, b.referrer_email, coalesce(b.last_activity_date, g.last_activity_date) AS last_activity_date, st.current_status_date, cp.campaign_name, o.stage_name AS current_stage_name,
     o.offline_revenue AS opp_offline_revenue, o.online_revenue_verified AS opp_online_revenue, o.total_revenue AS opp_total_revenue, cw.closed_won_date,
     coalesce(b.retail_locations, g.number_of_locations) AS retail_locations, coalesce(b.company, g.company) AS company,
     {_COUNTRY.replace('region_label', 'l.region_label')} AS country_name, {_REGION.replace('region_label', 'l.region_label')} AS region,
     o.online_revenue_verified + o.offline_revenue AS opp_total_revenue_verified, TRY_CAST(o.winning_partner_id AS BIGINT) AS winning_partner
   FROM crm_lead l LEFT JOIN ({_OWNERS}) w ON w.lead_id = l.lead_id LEFT JOIN crm_lead_raw b ON b.lead_id = l.lead_id LEFT JOIN legacy_lead g ON g.legacy_id = l.lead_id
     LEFT JOIN ({_STATUS}) st ON st.lead_id = l.lead_id LEFT JOIN ({_CAMPAIGN}) cp ON cp.lead_id = l.lead_id
     LEFT JOIN crm_opportunity o ON o.opportunity_id = l.converted_opportunity_id LEFT JOIN ({_WON}) cw ON cw.opportunity_id = o.opportunity_id"""

_ALL_IDS = _COMMON.replace("FROM crm_lead l LEFT JOIN", f"FROM (SELECT i.lead_id, c.* EXCLUDE (lead_id) FROM ({_IDS}) i LEFT JOIN crm_lead c ON c.lead_id = i.lead_id) l LEFT JOIN", 1)
_DROP = "EXCLUDE (winning_partner, partner_involvement, online_revenue_verified, raw_mql_date)"
PARTNER_ROWS = f"""SELECT x.* {_DROP}, p.partner_name, p.sub_region AS partner_sub_region, p.management_model, p.partner_type, m.programme_manager AS partner_manager,
     CASE WHEN m.in_plus_programme THEN 'Yes' ELSE 'No' END AS plus_program, x.partner_involvement AS sales_assistance, NULL::VARCHAR AS gmv_band,
     NULL::VARCHAR AS market_segment, NULL::DATE AS mql_date
   FROM (SELECT k.*, CAST(pl.shop_id AS VARCHAR) AS shop_id, gc.sub_region, gc.market_maturity, CAST(rf.referred_on AS VARCHAR) AS referral_timestamp,
       CAST(rf.referral_index AS VARCHAR) AS referral_index, coalesce(rf.partner_id, pl.partner_id, k.winning_partner) AS partner_id
     FROM ({_ALL_IDS}) k LEFT JOIN ({_PARTNER_LEADS}) pl ON pl.lead_id = k.lead_id LEFT JOIN geo_country gc ON gc.country_code = pl.country_code
       LEFT JOIN ({_REFERRALS}) rf ON rf.lead_id = k.lead_id) x
     LEFT JOIN partner p ON p.partner_id = x.partner_id LEFT JOIN ({_MANAGERS}) m ON m.partner_id = p.partner_id AND m.on_date = x.current_status_date"""
_NOT_MARKETING = "('Partner POS Referral', 'Partner Referral', 'ZoomInfo', 'LinkedIn Sales Navigator', 'Outbound', 'Business Development Rep', 'Lead List')"
_ABSENT = "sub_region market_maturity partner_manager partner_name plus_program referral_timestamp referral_index shop_id partner_sub_region management_model partner_type".split()
MARKETING_ROWS = f"""SELECT x.* {_DROP}, a.market_segment, x.raw_mql_date AS mql_date, x.winning_partner AS partner_id,
     {_GMV.replace('v ', 'x.online_revenue_verified ')} AS gmv_band, CASE WHEN x.raw_mql_date IS NOT NULL THEN 'Yes' ELSE 'No' END AS sales_assistance,
     {', '.join(f'NULL::VARCHAR AS {n}' for n in _ABSENT)}
   FROM ({_COMMON}) x LEFT JOIN crm_account a ON a.account_id = x.converted_account_id WHERE x.lead_source_original NOT IN {_NOT_MARKETING}"""


def report_sql(rows: str, label: str, where: str = "true") -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
      SELECT r.* EXCLUDE (opp_offline_revenue, opp_online_revenue, partner_manager, partner_name), '{label}' AS metric_name,
        CASE WHEN sales_ready_date IS NOT NULL THEN r.lead_id END AS qualified_lead_id, CASE WHEN disqualified_date IS NOT NULL THEN r.lead_id END AS disqualified_id,
        CASE WHEN nurture_date IS NOT NULL THEN r.lead_id END AS nurture_id, CASE WHEN sales_ready_date IS NULL THEN r.lead_id END AS unworked_id,
        CAST(DATE '{AS_OF}' - current_status_date AS INT) AS days_in_current_status, coalesce(opp_offline_revenue, 0) AS opp_offline_revenue,
        coalesce(opp_online_revenue, 0) AS opp_online_revenue, coalesce(d.manager_name, r.partner_manager) AS partner_manager,
        coalesce(h.manager_name, pd.recruiter) AS partner_recruiter, coalesce(r.partner_name, pd.partner_name) AS partner_name, pd.partner_account_id,
        CASE WHEN pay.partner_id IS NULL THEN 'No' ELSE 'Yes' END AS payment_program, r.region AS partner_region, r.country_name AS partner_country,
        row_number() OVER (PARTITION BY r.lead_id, r.partner_id ORDER BY r.referral_index NULLS LAST, r.shop_id NULLS LAST, d.manager_name NULLS LAST, h.manager_name NULLS LAST) AS rn
      FROM ({rows}) r LEFT JOIN partner pd ON pd.partner_id = r.partner_id
        LEFT JOIN partner_developer_history d ON d.account_id = pd.partner_account_id AND r.created_date BETWEEN d.start_date AND d.end_date
        LEFT JOIN partner_recruiter_history h ON h.account_id = pd.partner_account_id AND r.created_date BETWEEN h.start_date AND h.end_date
        LEFT JOIN ({_PAYMENT}) pay ON pay.partner_id = r.partner_id WHERE {where}) z WHERE rn = 1"""


PQL = report_sql(PARTNER_ROWS, "PQL", "r.lead_source_original IN ('Partner POS Referral', 'Partner Referral')")
MQL = report_sql(MARKETING_ROWS, "MQL")


@query("dom_partner_lead_rows", PARTNER_ROWS)
def _(s):
    return partners.partner_lead_rows(s)


@query("dom_marketing_lead_rows", MARKETING_ROWS)
def _(s):
    return partners.marketing_lead_rows(s)


@query("dom_pql", PQL)
def _(s):
    return partners.partner_qualified_leads(s, AS_OF)


@query("dom_mql", MQL)
def _(s):
    return partners.marketing_qualified_leads(s, AS_OF)


_LEADS = f"""SELECT u.*, ra.team_segment, ra.market_segment AS owner_market_segment FROM (SELECT * FROM ({PQL}) a UNION ALL BY NAME SELECT * FROM ({MQL}) b) u
   LEFT JOIN crm_role_attribute ra ON ra.rep_role = u.lead_owner_role"""


@query("dom_leads_union_role", _LEADS)
def _(s):
    return partners.leads_with_role(s, AS_OF)


@query("pipe_leads", _LEADS)
def _(s):
    return reports.leads(s, AS_OF)
