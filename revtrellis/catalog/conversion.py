"""Retail funnel and closed conversion."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from revtrellis.catalog.leads import midpoint_sql
from revtrellis.catalog.registry import AS_OF, query
from revtrellis.operators import retail
from revtrellis.operators.retail import RetailSpec
from revtrellis.params import fixed_values as V
from revtrellis.plans import reports

c = F.col


FUNNEL = RetailSpec(actors_from=date(1997, 6, 1), campaign_pattern="%ring%", low_band_countries=("C2", "C3"))
CONVERSION = replace(FUNNEL, inbound_sources=tuple(V.INBOUND_SOURCES_CONVERSION))


def _quoted(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def bucket_sql(col: str, inbound) -> str:
    return f"""CASE WHEN {col} IS NULL THEN 'Outbound' WHEN lower({col}) IN ({_quoted(V.OUTBOUND_SOURCES)}) THEN 'Outbound'
      WHEN lower({col}) IN ({_quoted(V.PARTNER_SOURCES)}) THEN 'Partner' WHEN lower({col}) IN ({_quoted(inbound)}) THEN 'Demand-Gen' ELSE 'Other Inbound' END"""


def actor_sql(role: str, day: str) -> str:
    return f"""CASE WHEN {day} < DATE '1997-06-01' THEN 'N/A' WHEN {role} IS NULL THEN 'OTHER'
      WHEN strpos({role}, 'N3') > 0 THEN CASE WHEN strpos({role}, 'SC') > 0 THEN 'N3 SC' ELSE 'N3 Rep' END
      ELSE CASE WHEN strpos({role}, 'SC') > 0 THEN 'In-house SC' ELSE 'In-house Rep' END END"""


_PROGRAMME = """CASE WHEN pl.must_win = 'Y' THEN 'Must Win' WHEN lower(cg.campaign_name) LIKE '%ring%' OR pm.shop_id IS NOT NULL THEN 'Other' ELSE 'None' END"""


def attributes_sql(inbound) -> str:
    return f"""SELECT o.opportunity_id, o.close_date AS closed_date, o.created_date, o.opportunity_type, o.account_id, o.stage_name AS current_stage_name,
        lower(o.lead_source) AS lead_source, {bucket_sql('o.lead_source', inbound)} AS lead_source_bucket, o.country_code,
        CASE WHEN o.sales_region = 'NA' THEN 'AMER' ELSE o.sales_region END AS region, {_PROGRAMME} AS programme,
        {actor_sql('o.role_at_creation', 'o.created_date')} AS created_by, {actor_sql('o.sales_rep_role', 'o.created_date')} AS owned_by,
        o.primary_shop_id, o.market_segment
      FROM crm_opportunity o LEFT JOIN programme_merchant pm ON TRY_CAST(pm.shop_id AS BIGINT) = o.primary_shop_id
        LEFT JOIN programme_list pl ON pl.promo_code = pm.promo_code LEFT JOIN crm_campaign cg ON cg.campaign_id = o.campaign_id"""


_GRAIN = """SELECT opportunity_id, team_segment, min(product) AS any_product, arg_max(sales_price, product) AS amount, arg_min(total_locations, product) AS locations,
     count(DISTINCT product) AS product_count FROM fact_stage WHERE product IN ('Point of Sale', 'Retail Payments') GROUP BY 1, 2"""
_SAL = """SELECT opportunity_id, min(coalesce(envision_at, solution_at, demonstrate_at, deal_craft_at, closed_at)) AS qualified_sal_date, CAST(1 AS INT) AS is_sal
   FROM fact_stage WHERE product IN ('Point of Sale', 'Retail Payments')
     AND (envision_at IS NOT NULL OR solution_at IS NOT NULL OR demonstrate_at IS NOT NULL OR deal_craft_at IS NOT NULL OR is_won) GROUP BY 1"""
_CONDITIONED = """CASE WHEN product_count = 1 THEN any_product ELSE 'Point of Sale + Retail Payments' END AS product_name,
     CASE WHEN product_count = 1 AND any_product = 'Retail Payments' THEN 0 ELSE locations END AS number_of_locations,
     CASE WHEN product_count = 1 AND any_product = 'Point of Sale' THEN 0 ELSE amount END AS payments_amount"""
_STAGE = """CASE WHEN current_stage_name = 'Pre-Qualified' THEN 'Pre-Qualified' WHEN is_sal <> 1 THEN 'Not Accepted'
     WHEN current_stage_name IN ('Closed Lost', 'Closed Won') THEN current_stage_name ELSE 'In progress' END"""


def base_sql(inbound) -> str:
    return f"""SELECT g.opportunity_id, a.created_date, a.closed_date, a.lead_source, a.lead_source_bucket, g.team_segment,
        CASE WHEN n.eligible_since IS NULL THEN 'Rest of the World' ELSE a.country_code END AS country_code,
        CASE WHEN n.eligible_since IS NULL THEN 'Rest of the World' ELSE n.country_name END AS country_name, a.region AS region_code,
        coalesce(q.is_sal, 0) AS sal, q.qualified_sal_date, {_CONDITIONED}, a.programme, {_STAGE} AS current_stage, a.current_stage_name, a.primary_shop_id,
        a.opportunity_type, a.created_by, a.owned_by, a.market_segment
      FROM ({_GRAIN}) g JOIN ({attributes_sql(inbound)}) a ON a.opportunity_id = g.opportunity_id LEFT JOIN geo_country n ON n.country_code = a.country_code
        LEFT JOIN ({_SAL}) q ON q.opportunity_id = g.opportunity_id"""


_BASE = base_sql(V.INBOUND_SOURCES_FUNNEL)
_FIRST = "SELECT organization_id, min(snapshot_date) AS first_active FROM org_daily WHERE ending_active >= 1 GROUP BY 1"
_LAST = f"""SELECT organization_id, max(first_active) AS first_active_date, arg_max(opportunity_id, (closed_date, opportunity_id)) AS opportunity_id
   FROM (SELECT b.opportunity_id, b.closed_date, s.organization_id, f.first_active FROM ({_BASE}) b LEFT JOIN org_shop s ON s.shop_id = b.primary_shop_id
     LEFT JOIN ({_FIRST}) f ON f.organization_id = s.organization_id WHERE b.current_stage = 'Closed Won') w GROUP BY 1"""
_KEYS = """region_code, country_name, country_code, {day} AS event_date, current_stage, lead_source, lead_source_bucket, opportunity_type, product_name,
     'Not Applicable' AS location_band, 'Not Applicable' AS revenue_band, '{metric}' AS metric, programme, created_by, owned_by, market_segment, team_segment"""


def stage_sql(metric: str, day: str, where: str, extra: str = "") -> str:
    return f"""SELECT {_KEYS.format(day=day, metric=metric)}, sum(number_of_locations) AS total_locations, sum(payments_amount) AS total_payments_amount,
        count(opportunity_id) AS total_leads FROM (SELECT b.* {', x.first_active_date' if extra else ''} FROM ({_BASE}) b {extra}) y WHERE {where} GROUP BY ALL"""


_SQLS = stage_sql("02. Sales qualified lead", "created_date", "true")
_SALS = stage_sql("03. Sales accepted lead", "closed_date", "sal = 1")
_WONS = stage_sql("04. Closed won", "closed_date", "current_stage = 'Closed Won'")
_ACTIVE = stage_sql("05. Retail FWAS", "first_active_date", "true", f"JOIN ({_LAST}) x ON x.opportunity_id = b.opportunity_id")
_NA = "'Not Applicable for MQLs'"
_LOCATION = """CASE WHEN r.retail_locations = '1' THEN '01. 1' WHEN r.retail_locations = '2-5' THEN '02. 2-5' WHEN r.retail_locations = '6-10' THEN '03. 6-10'
   WHEN r.retail_locations = 'More than 10' THEN '04. 10+' WHEN r.retail_locations = 'Opening location soon' THEN '05. Opening soon'
   WHEN coalesce(r.retail_locations, '') IN ('', 'No locations yet') THEN '06. Unknown' ELSE r.retail_locations END"""
_MQLS = f"""SELECT CASE WHEN region IN ('AMER', 'APAC', 'EMEA', 'LATAM') THEN region ELSE 'Unknown Region' END AS region_code, country_name, country_code, sales_ready_date AS event_date,
     {_NA} AS current_stage, lead_source, coalesce(bucket, 'Outbound') AS lead_source_bucket, {_NA} AS opportunity_type, {_NA} AS product_name, location_band, revenue_band,
     '01. Marketing qualified leads' AS metric, {_NA} AS programme, {_NA} AS created_by, {_NA} AS owned_by, {_NA} AS market_segment, team_segment,
     0::DOUBLE AS total_locations, 0::DOUBLE AS total_payments_amount, count(*) AS total_leads
   FROM (SELECT string_split(l.region_label, ' - ')[1] AS region, string_split(l.region_label, ' - ')[2] AS country_name, n.country_code, l.sales_ready_date, l.lead_source, b.bucket,
       {_LOCATION} AS location_band, {midpoint_sql('r.offline_revenue_band', True)} AS revenue_band, coalesce(r.offline_revenue_band, g.revenue_band) AS band,
       CASE WHEN r.owner_role LIKE 'AMER-%N3%' THEN 'N3 Retail for MQL only' ELSE 'Internal for MQL only' END AS team_segment
     FROM crm_lead l JOIN crm_lead_raw r ON r.lead_id = l.lead_id AND NOT r.is_deleted LEFT JOIN legacy_lead g ON g.legacy_id = l.lead_id
       LEFT JOIN geo_country n ON n.country_name = string_split(l.region_label, ' - ')[2]
       LEFT JOIN (SELECT DISTINCT lower(lead_source) AS k, {bucket_sql('lead_source', V.INBOUND_SOURCES_FUNNEL)} AS bucket FROM crm_opportunity) b ON b.k = lower(l.lead_source)
     WHERE l.product_interest = 'Point of Sale' AND l.lead_source NOT LIKE '%partner%') m
   WHERE band IN ({_quoted(V.QUALIFYING_BANDS)}) OR (country_code IN ('C2', 'C3') AND band IN ({_quoted(V.LOW_BANDS)})) GROUP BY ALL"""
_BAND_N = """CASE WHEN number_of_locations = 1 THEN '01. 1' WHEN number_of_locations BETWEEN 2 AND 5 THEN '02. 2-5' WHEN number_of_locations BETWEEN 6 AND 10 THEN '03. 6-10'
   WHEN number_of_locations > 10 THEN '04. 10+' ELSE '06. Unknown' END"""
_INBOUND = f"""SELECT region_code, country_name, country_code, created_date AS event_date, {_NA} AS current_stage, 'inbound call' AS lead_source, lead_source_bucket,
     {_NA} AS opportunity_type, {_NA} AS product_name, {_BAND_N} AS location_band, 'Not Available for Inbound Calls' AS revenue_band, '01. Marketing qualified leads' AS metric,
     {_NA} AS programme, {_NA} AS created_by, {_NA} AS owned_by, {_NA} AS market_segment, {_NA} AS team_segment, coalesce(number_of_locations, 0) AS total_locations,
     coalesce(payments_amount, 0) AS total_payments_amount, count(*) AS total_leads FROM ({_BASE}) b WHERE lead_source = 'inbound sales inquiry' GROUP BY ALL"""
_LONG = f"""SELECT * FROM ({' UNION ALL BY NAME '.join(f'SELECT * FROM ({q}) t{i}' for i, q in enumerate([_MQLS, _INBOUND, _SQLS, _SALS, _WONS, _ACTIVE]))}) u
   WHERE event_date >= DATE '1997-04-01' AND event_date <= DATE '1998-08-31'"""


@query("dom_lead_source_bucket", f"SELECT DISTINCT lower(lead_source) AS source_key, {bucket_sql('lead_source', V.INBOUND_SOURCES_FUNNEL)} AS lead_source_bucket FROM crm_opportunity")
def _(s):
    return retail.lead_source_dimension(s.table("crm_opportunity"), FUNNEL.inbound_sources)


@query("dom_role_actor_class", f"SELECT opportunity_id, {actor_sql('role_at_creation', 'created_date')} AS created_by FROM crm_opportunity")
def _(s):
    return s.table("crm_opportunity").select("opportunity_id", retail.actor_class(c("role_at_creation"), c("created_date"), FUNNEL).alias("created_by"))


@query("dom_programme_tag", f"SELECT opportunity_id, programme FROM ({attributes_sql(V.INBOUND_SOURCES_FUNNEL)}) x")
def _(s):
    return retail.opportunity_attributes(s, FUNNEL).select("opportunity_id", "programme")


@query(
    "dom_region_normalise",
    """SELECT opportunity_id, CASE sales_region WHEN 'NA' THEN 'AMER' ELSE sales_region END AS region,
       CASE sales_region WHEN 'NA' THEN 'AMER' WHEN 'UNKNOWN' THEN 'Unknown Region' ELSE sales_region END AS folded FROM crm_opportunity""",
)
def _(s):
    region = c("sales_region")
    return s.table("crm_opportunity").select("opportunity_id", retail.normalise_region(region).alias("region"), retail.fold_unknown_region(region).alias("folded"))


@query("dom_opportunity_attributes", attributes_sql(V.INBOUND_SOURCES_FUNNEL))
def _(s):
    return retail.opportunity_attributes(s, FUNNEL)


@query("dom_product_grain_collapse", _GRAIN)
def _(s):
    return retail.product_grain_collapse(s.table("fact_stage"), FUNNEL)


@query("dom_product_conditioned", f"SELECT opportunity_id, {_CONDITIONED} FROM ({_GRAIN}) g")
def _(s):
    rows = retail.product_grain_collapse(s.table("fact_stage"), FUNNEL)
    return rows.select("opportunity_id", *[v.alias(k) for k, v in retail.product_conditioned(FUNNEL).items()])


@query("dom_retail_opportunities", _BASE)
def _(s):
    return retail.retail_opportunities(s, FUNNEL)


@query("dom_mql_team", "SELECT lead_id, CASE WHEN owner_role LIKE 'AMER-%N3%' THEN 'N3 Retail for MQL only' ELSE 'Internal for MQL only' END AS team FROM crm_lead_raw")
def _(s):
    return s.table("crm_lead_raw").select("lead_id", retail.mql_team(c("owner_role"), FUNNEL).alias("team"))


@query("dom_sal_qualify", _SAL)
def _(s):
    return retail.sal_qualify(s.table("fact_stage"), FUNNEL)


@query("dom_stage_label", f"SELECT opportunity_id, {_STAGE} AS current_stage FROM (SELECT o.opportunity_id, o.stage_name AS current_stage_name, q.is_sal FROM crm_opportunity o LEFT JOIN ({_SAL}) q USING (opportunity_id)) x")
def _(s):
    rows = s.table("crm_opportunity").select("opportunity_id", "stage_name").join(retail.sal_qualify(s.table("fact_stage"), FUNNEL), "opportunity_id", "left")
    return rows.select("opportunity_id", retail.stage_label(c("stage_name"), c("is_sal")).alias("current_stage"))


@query(
    "dom_eligible_country",
    """SELECT o.opportunity_id, CASE WHEN n.eligible_since IS NOT NULL THEN n.country_name ELSE 'Rest of the World' END AS country_name
       FROM crm_opportunity o LEFT JOIN geo_country n ON n.country_code = o.country_code""",
)
def _(s):
    rows = s.table("crm_opportunity").select("opportunity_id", "country_code").join(s.table("geo_country"), "country_code", "left")
    return rows.select("opportunity_id", retail.eligible_country(c("eligible_since"), c("country_name"), FUNNEL).alias("country_name"))


@query("dom_first_active", _FIRST)
def _(s):
    return retail.first_active(s.table("org_daily"))


@query("dom_last_closed_per_org", _LAST)
def _(s):
    return retail.last_closed_per_org(retail.won_retail_opportunities(s, FUNNEL), s.table("org_shop"), retail.first_active(s.table("org_daily")))


@query("dom_stage_counts", f"SELECT * FROM ({_SQLS}) a UNION ALL SELECT * FROM ({_SALS}) b UNION ALL SELECT * FROM ({_WONS}) c")
def _(s):
    base = retail.retail_opportunities(s, FUNNEL)
    won = base.filter(c("current_stage") == "Closed Won")
    parts = [
        retail.stage_counts(base, "02. Sales qualified lead", "created_date"),
        retail.stage_counts(base.filter(c("sal") == 1), "03. Sales accepted lead", "closed_date"),
        retail.stage_counts(won, "04. Closed won", "closed_date"),
    ]
    return retail.union_all(parts)


@query("dom_mql_counts", _MQLS)
def _(s):
    return retail.mql_counts(s, FUNNEL)


@query(
    "dom_location_band",
    f"""SELECT lead_id, {_LOCATION.replace('r.retail', 'retail')} AS band, {_BAND_N} AS number_band FROM (SELECT *, lead_id % 13 AS number_of_locations FROM crm_lead_raw) x""",
)
def _(s):
    n = c("lead_id") % 13
    return s.table("crm_lead_raw").select("lead_id", retail.location_band_text(c("retail_locations")).alias("band"), retail.location_band_number(n).alias("number_band"))


@query("dom_inbound_call_mql", _INBOUND)
def _(s):
    return retail.inbound_call_mql(retail.retail_opportunities(s, FUNNEL))


@query("dom_long_funnel", _LONG)
def _(s):
    return retail.long_funnel(s, FUNNEL, AS_OF)


@query("pipe_retail_funnel", _LONG)
def _(s):
    return reports.retail_funnel(s, AS_OF, FUNNEL)


_CBASE = f"""SELECT *, current_stage_name IN ('Closed Lost', 'Closed Won') AS is_closed, current_stage_name = 'Closed Won' AS is_won FROM ({base_sql(V.INBOUND_SOURCES_CONVERSION)}) b"""
_CKEYS = """closed_date, created_date, opportunity_type, opportunity_id, lead_source_bucket, lead_source, product_name,
   CASE WHEN region_code = 'NA' THEN 'AMER' WHEN region_code = 'UNKNOWN' THEN 'Unknown Region' ELSE region_code END AS region_code, country_name, programme, created_by, owned_by,
   market_segment, team_segment"""
_DAYS = """CAST(sum(CASE WHEN sal = 1 AND is_closed THEN qualified_sal_date - created_date ELSE 0 END) AS BIGINT) AS sql_to_sal_days,
   CAST(sum(CASE WHEN sal = 1 AND is_closed THEN closed_date - qualified_sal_date ELSE 0 END) AS BIGINT) AS sal_to_closed_days,
   CAST(sum(CASE WHEN is_closed THEN closed_date - created_date ELSE 0 END) AS BIGINT) AS sql_to_closed_days,
   CAST(sum(CASE WHEN is_won THEN closed_date - created_date ELSE 0 END) AS BIGINT) AS sql_to_won_days"""
_CONV = """count(opportunity_id) AS total_opportunities, count(*) FILTER (is_closed) AS closed_count, count(*) FILTER (sal = 1 AND is_closed) AS sal_count,
   count(*) FILTER (is_won) AS won_count, sum(CASE WHEN is_won THEN payments_amount ELSE 0 END) AS payments_amount_won,
   sum(CASE WHEN is_won THEN number_of_locations ELSE 0 END) AS locations_won, sum(CASE WHEN is_won THEN product_profit ELSE 0 END) AS product_profit_won,
   count(*) FILTER (is_won AND product_name = 'Point of Sale + Retail Payments') AS both_products_won,
   count(*) FILTER (is_won AND product_name IN ('Point of Sale + Retail Payments', 'Point of Sale')) AS location_product_won"""
_IPP = """SELECT opportunity_id, max(total_revenue) AS total_revenue, max(product_profit) AS product_profit, max(product_attach_count) AS product_attach_count,
   max(subscription_revenue) AS subscription_revenue, max(sales_accepted) AS sales_accepted
   FROM fact_opportunity_revenue GROUP BY 1"""


@query("dom_opp_revenue_max", _IPP)
def _(s):
    return retail.opportunity_revenue_max(s.table("fact_opportunity_revenue"))


@query("dom_cycle_days", f"SELECT market_segment, lead_source_bucket, {_DAYS} FROM ({_CBASE}) b GROUP BY 1, 2")
def _(s):
    base = retail.conversion_base(s, CONVERSION)
    return base.groupBy("market_segment", "lead_source_bucket").agg(*[v.alias(k) for k, v in retail.cycle_days().items()])


@query("dom_conversion_counts", f"SELECT created_by, product_name, {_CONV} FROM ({_CBASE}) b LEFT JOIN ({_IPP}) i USING (opportunity_id) GROUP BY 1, 2")
def _(s):
    base = retail.conversion_base(s, CONVERSION).join(retail.opportunity_revenue_max(s.table("fact_opportunity_revenue")), "opportunity_id", "left")
    return base.groupBy("created_by", "product_name").agg(*[v.alias(k) for k, v in retail.conversion_counts(CONVERSION).items()])


@query(
    "pipe_closed_conversion",
    f"""SELECT {_CKEYS}, {_DAYS}, {_CONV} FROM ({_CBASE}) b LEFT JOIN ({_IPP}) i USING (opportunity_id)
        WHERE closed_date >= DATE '1996-10-01' AND closed_date <= DATE '1998-06-30' GROUP BY ALL""",
)
def _(s):
    return reports.closed_conversion(s, AS_OF, CONVERSION)
