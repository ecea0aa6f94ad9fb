"""Revenue-operations entities projected from the generic test tables.

Each function returns the SELECT text of one entity. The text is portable; the
dialect argument supplies the few spellings that differ between engines. Amounts
are whole-number doubles, so sums do not depend on the order of addition.
"""

from __future__ import annotations

from revtrellis.lens.dialect import Dialect
from revtrellis.params import scorecard_sheet

ENTITIES: dict[str, object] = {}

OWNERS = 40
RAW_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def entity(fn):
    ENTITIES[fn.__name__] = fn
    return fn


def _role(key: str) -> str:
    names = [
        "AMER-SDR-LA-RETAIL",
        "AMER-SALES-N3-RET",
        "EMEA-SC-N3",
        "EMEA-SALES-MM",
        "APAC-SC-LA",
        "LATAM-SALES-SMB",
        "AMER-SDR-MM-RETAIL",
    ]
    cases = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    return f"CASE ({key}) % 8 {cases} END"


def _account(key: str, suffix: str = "'AAA'") -> str:
    return f"'001' || lpad(CAST({key} AS STRING), 12, '0') || {suffix}"


def _rep_name(key: str) -> str:
    return f"'Supplier#' || lpad(CAST({key} AS STRING), 9, '0')"


def _email(key: str) -> str:
    return f"'rep' || CAST({key} AS STRING) || '@example.org'"


# ---------------------------------------------------------------- people


@entity
def crm_user(q: Dialect) -> str:
    return f"""SELECT s_suppkey AS user_id, s_name AS name, {_email('s_suppkey')} AS email,
      s_suppkey AS employee_id, {_rep_name('s_suppkey - s_suppkey % 10')} AS manager_name,
      CASE WHEN s_suppkey % 8 = 7 THEN NULL ELSE s_suppkey % 8 END AS user_role_id,
      {_role('s_suppkey')} AS user_role, 'Main' AS source_system, s_suppkey AS guid
    FROM {q.t('supplier')}"""


@entity
def crm_role(q: Dialect) -> str:
    return f"""SELECT DISTINCT s_suppkey % 8 AS user_role_id, {_role('s_suppkey')} AS role_name
    FROM {q.t('supplier')} WHERE {_role('s_suppkey')} IS NOT NULL"""


@entity
def crm_role_attribute(q: Dialect) -> str:
    return f"""SELECT role_name AS rep_role,
      CASE WHEN role_name LIKE '%MM%' THEN 'Mid Market' WHEN role_name LIKE '%-LA%' THEN 'Large Accounts'
           WHEN role_name LIKE '%SMB%' THEN 'SMB' WHEN role_name LIKE '%SALES%' THEN 'Retail' END AS market_segment,
      CASE WHEN role_name LIKE '%N3%' THEN 'N3 Retail' ELSE 'Internal' END AS team_segment,
      left(role_name, 4) AS sales_region
    FROM {q.t('crm_role')}"""


@entity
def hr_worker(q: Dialect) -> str:
    return f"""SELECT s_suppkey AS worker_id, s_name AS worker_name, 'C' || CAST(s_nationkey AS STRING) AS country,
      CAST(100 + s_suppkey * 3 AS STRING) AS tenure_days, s_suppkey - s_suppkey % 10 AS manager_id,
      s_suppkey % 13 <> 5 AS is_active
    FROM {q.t('supplier')}"""


@entity
def hr_worker_daily(q: Dialect) -> str:
    w = f"(o_custkey % {OWNERS})"
    return f"""SELECT {w} AS worker_id, {_rep_name(w)} AS worker_name, CAST(o_orderdate AS DATE) AS effective_on,
      CASE WHEN {w} % 9 = 8 THEN 'Support' ELSE 'Sales' END AS discipline,
      CASE WHEN {w} % 10 = 9 THEN 'Management - Field' WHEN {w} % 10 = 7 THEN 'Account Management' ELSE 'Field Sales' END AS subdiscipline,
      CASE ({w} + month(o_orderdate)) % 10 WHEN 0 THEN 'Sales Mid Market' WHEN 1 THEN 'Sales Large' WHEN 2 THEN 'Sales Enterprise'
        WHEN 3 THEN 'Sales Global East' WHEN 4 THEN 'Sales Retail SMB' WHEN 5 THEN 'Sales Retail Cross-Sell - Large'
        WHEN 6 THEN 'Sales Lending Cross-Sell A' WHEN 7 THEN 'Sales Large' WHEN 8 THEN 'Unmapped DNU' ELSE 'Sales SMB' END AS team,
      {w} - {w} % 10 AS manager_id
    FROM {q.t('orders')}"""


@entity
def hr_quota(q: Dialect) -> str:
    months = [f"'P:{y}:{m:02d}'" for y in (1997, 1998) for m in range(1, 13)]
    names = ["INCREMENTAL PRODUCT PROFIT", "TOTAL REVENUE", "SOLUTION ACTIVATIONS"]
    return f"""SELECT payee_id, period, {q.explode(*[f"'{n} : PERIODIC : QUOTA'" for n in names])} AS attribute_id, quota
    FROM (SELECT s_suppkey AS payee_id, {q.explode(*months)} AS period,
            CAST(50000 + s_suppkey * 1000 AS DOUBLE) AS quota FROM {q.t('supplier')}) p"""


# ---------------------------------------------------------------- accounts, opportunities, facts


@entity
def crm_account(q: Dialect) -> str:
    return f"""SELECT {_account('c_custkey')} AS account_id, c_custkey AS account_key, c_name AS name,
      'NAC-' || CAST(c_custkey % 50 AS STRING) AS named_account_code, c_mktsegment AS market_segment,
      n_name AS territory_name, r_name || ' - ' || n_name AS region_label,
      CASE WHEN c_acctbal > 0 THEN c_acctbal * 100000 END AS annual_revenue,
      CASE WHEN c_custkey % 3 = 0 THEN 'Hosted' ELSE 'Self-built' END AS platform_group,
      CASE WHEN c_custkey % 5 > 0 THEN 'CSM ' || CAST(c_custkey % 7 AS STRING) END AS success_manager,
      c_custkey % 97 = 0 AS is_deleted
    FROM {q.t('customer')} JOIN {q.t('nation')} ON c_nationkey = n_nationkey JOIN {q.t('region')} ON n_regionkey = r_regionkey"""


_STAGE = """CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 'Closed Lost' WHEN o_orderstatus = 'F' THEN 'Closed Won'
        WHEN o_orderstatus = 'O' THEN 'Envision' ELSE 'Pre-Qualified' END"""


@entity
def crm_opportunity(q: Dialect) -> str:
    created = "CAST(o_orderdate AS DATE)"
    return f"""SELECT o_orderkey AS opportunity_id, 'Deal ' || CAST(o_orderkey AS STRING) AS opportunity_name,
      {_account('o_custkey')} AS account_id, o_custkey % {OWNERS} AS owner_id, {_rep_name(f'o_custkey % {OWNERS}')} AS owner_name,
      {_role('o_orderkey')} AS role_at_creation, {_role('o_custkey')} AS sales_rep_role,
      {created} AS created_date,
      CASE WHEN o_orderstatus = 'F' THEN {q.add_days(created, 'o_orderkey % 120')} END AS close_date,
      {_STAGE} AS stage_name,
      CASE WHEN o_orderkey % 7 = 0 THEN 'Inbound Sales Inquiry' ELSE CASE left(o_orderpriority, 1) WHEN '1' THEN 'Partner Referral'
        WHEN '2' THEN 'Website' WHEN '3' THEN 'Outbound' WHEN '4' THEN 'Seminar' END END AS lead_source,
      CASE WHEN o_orderkey % 2 = 0 THEN 'New' ELSE 'Expansion' END AS opportunity_type,
      'C' || CAST(o_custkey % 26 AS STRING) AS country_code,
      CASE o_custkey % 5 WHEN 0 THEN 'NA' WHEN 1 THEN 'EMEA' WHEN 2 THEN 'APAC' WHEN 3 THEN 'UNKNOWN' ELSE 'LATAM' END AS sales_region,
      o_custkey AS primary_shop_id,
      CASE WHEN o_custkey % 2 = 0 THEN 'Retail' ELSE 'Mid Market' END AS market_segment,
      CASE o_orderkey % 6 WHEN 0 THEN 'N3 Retail' WHEN 1 THEN NULL ELSE 'Internal' END AS team_segment,
      o_orderkey % 2000 AS campaign_id,
      CAST(floor(o_totalprice) AS DOUBLE) AS total_revenue,
      CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderkey % 1000 AS DOUBLE) END AS offline_revenue,
      CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 2500 AS DOUBLE) END AS online_revenue_verified,
      CASE WHEN o_orderkey % 3 = 0 THEN CAST(floor(o_totalprice) AS DOUBLE) END AS committed_revenue,
      CAST(floor(o_totalprice) AS DOUBLE) * 2 AS verified_revenue,
      CAST(floor(o_totalprice / 4) AS DOUBLE) AS product_profit, CAST(floor(o_totalprice / 2) AS DOUBLE) AS contract_value,
      CASE WHEN o_orderkey % 4 = 1 THEN 'none' ELSE CAST(o_custkey % {OWNERS} AS STRING) END AS winning_partner_id,
      o_orderkey % 61 = 0 AS is_deleted
    FROM {q.t('orders')}"""


@entity
def fact_metric(q: Dialect) -> str:
    created = "CAST(o_orderdate AS DATE)"
    values = {
        "CASE WHEN dataset = 'Activity' THEN 'Demo' ELSE 'Opportunity Deal Count' END": "1e0",
        "'Product Deal Count'": "1e0",
        "'Total Revenue'": "revenue",
        "'Incremental Product Profit'": "floor(revenue / 4) * 1e0",
        "'Solution Activations'": "opp_key % 5 * 1e0",
    }
    entries = q.explode(*[q.struct(value_type=t, value=v) for t, v in values.items()])
    kept = """account_id, opportunity_owner, owner_manager, market_segment, team_segment, sales_region, sales_sub_region, lead_group, full_date,
      term_length, product_name, next_step, is_unified, qualified_date, created_date, close_date, campaign, platform_group, age, current_stage,
      verified_online_revenue, annual_revenue, created_by_function, created_by, sales_owner_role, account_name, account_campaign, opportunity_url,
      opportunity_name, fact_product_name"""
    return f"""SELECT dataset, metric, e.value_type AS value_type, e.value AS value, opportunity_id, year, quarter, snapshot_date, {kept}
    FROM (SELECT dataset, CASE dataset WHEN 'Head Count' THEN 'Head Count Capacity' WHEN 'Activity' THEN 'Activity Subtype Count' ELSE stage_metric END AS metric,
        {entries} AS e, CASE WHEN dataset NOT IN ('Targets', 'Head Count') THEN opp_key END AS opportunity_id,
        CAST(year(full_date) AS INT) AS year, 'Q' || CAST(quarter(full_date) AS STRING) AS quarter,
        CASE WHEN dataset = 'Snapshots' THEN DATE '1998-05-04' END AS snapshot_date, {kept}
      FROM (SELECT o_orderkey AS opp_key, {_account('o_custkey')} AS account_id, CAST(floor(o_totalprice) AS DOUBLE) AS revenue,
        CASE o_orderkey % 10 WHEN 6 THEN 'Head Count' WHEN 7 THEN 'Targets' WHEN 8 THEN 'Snapshots' WHEN 9 THEN 'Activity' ELSE 'Actuals' END AS dataset,
        CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 'Closed Lost' WHEN o_orderstatus = 'F' THEN 'Closed Won'
          WHEN o_orderstatus = 'O' THEN CASE o_custkey % 4 WHEN 0 THEN 'Open Pipe' WHEN 1 THEN 'Pipeline SAL' ELSE 'Open Pipe SAL' END
          ELSE CASE o_custkey % 4 WHEN 0 THEN 'Qualified SAL' WHEN 1 THEN 'Created SAL' ELSE 'Created' END END AS stage_metric,
        CASE WHEN o_custkey % 37 = 0 THEN '' ELSE {_rep_name(f'o_custkey % {OWNERS}')} END AS opportunity_owner,
        {_rep_name(f'o_custkey % {OWNERS} - o_custkey % 10')} AS owner_manager,
        CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Enterprise' WHEN 'MACHINERY' THEN 'Large Accounts' WHEN 'FURNITURE' THEN 'Mid Market'
          WHEN 'BUILDING' THEN 'SMB' ELSE 'Retail' END AS market_segment,
        CASE o_orderkey % 6 WHEN 0 THEN 'N3 Retail' WHEN 1 THEN NULL ELSE 'Internal' END AS team_segment,
        r_name AS sales_region, n_name AS sales_sub_region,
        CASE left(o_orderpriority, 1) WHEN '1' THEN 'Partner' WHEN '2' THEN 'Inbound' WHEN '3' THEN 'Outbound' END AS lead_group,
        {created} AS full_date, {created} AS created_date,
        {q.add_days(created, 'o_orderkey % 30')} AS qualified_date, {q.add_days(created, 'o_orderkey % 120')} AS close_date,
        CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderkey % 4 AS STRING) END AS term_length,
        CASE o_custkey % 5 WHEN 0 THEN 'Capital' WHEN 1 THEN 'Payments' WHEN 2 THEN 'Retail Payments' WHEN 3 THEN 'Installments' ELSE 'Point of Sale' END AS product_name,
        CASE WHEN o_orderkey % 3 = 1 THEN 'call back' END AS next_step, o_orderkey % 4 = 2 AS is_unified,
        CASE WHEN o_custkey % 6 = 1 THEN 'Winter switch' WHEN o_custkey % 6 = 2 THEN 'Summer switch' END AS campaign,
        CASE WHEN c_custkey % 3 = 0 THEN 'Hosted' ELSE 'Self-built' END AS platform_group, CAST(o_orderkey % 90 AS BIGINT) AS age,
        CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' END AS current_stage, CAST(o_orderkey % 2500 AS DOUBLE) AS verified_online_revenue,
        CAST(floor(c_acctbal) AS DOUBLE) AS annual_revenue, CASE WHEN o_orderkey % 2 = 0 THEN 'Sales' ELSE 'Marketing' END AS created_by_function,
        {_rep_name(f'o_orderkey % {OWNERS}')} AS created_by, 'Role ' || CAST(o_custkey % 7 AS STRING) AS sales_owner_role, c_name AS account_name,
        CASE WHEN c_custkey % 4 = 1 THEN 'Account switch' END AS account_campaign, 'https://crm.example/' || CAST(o_orderkey AS STRING) AS opportunity_url,
        'Deal ' || CAST(o_orderkey AS STRING) AS opportunity_name, CASE WHEN o_orderkey % 2 = 1 THEN 'Bundle' END AS fact_product_name
      FROM {q.t('orders')} JOIN {q.t('customer')} ON o_custkey = c_custkey JOIN {q.t('nation')} ON c_nationkey = n_nationkey
        JOIN {q.t('region')} ON n_regionkey = r_regionkey) b) x"""


@entity
def fact_stage(q: Dialect) -> str:
    start = "CAST(l_shipdate AS DATE)"
    return f"""SELECT opportunity_id, product, max(team_segment) AS team_segment, sum(sales_price) AS sales_price,
      sum(locations) AS total_locations, min(envision_at) AS envision_at, min(solution_at) AS solution_at,
      min(demonstrate_at) AS demonstrate_at, min(deal_craft_at) AS deal_craft_at, max(closed_at) AS closed_at, max(won) = 1 AS is_won
    FROM (SELECT l_orderkey AS opportunity_id,
        CASE WHEN l_linenumber = 7 THEN 'Capital' WHEN l_linestatus = 'O' THEN 'Point of Sale' ELSE 'Retail Payments' END AS product,
        CASE WHEN l_orderkey % 6 = 0 THEN 'N3 Retail' ELSE 'Internal' END AS team_segment,
        CAST(floor(l_extendedprice) AS DOUBLE) AS sales_price, CAST(l_quantity AS DOUBLE) AS locations,
        CASE WHEN l_returnflag = 'A' THEN {start} END AS envision_at,
        CASE WHEN l_returnflag = 'A' AND l_linenumber > 1 THEN {q.add_days(start, 'l_linenumber * 3')} END AS solution_at,
        CASE WHEN l_returnflag = 'N' AND l_linenumber > 2 THEN {q.add_days(start, 'l_linenumber * 5')} END AS demonstrate_at,
        CASE WHEN l_returnflag = 'N' AND l_linenumber > 3 THEN {q.add_days(start, 'l_linenumber * 7')} END AS deal_craft_at,
        CASE WHEN l_orderkey % 2 = 0 THEN {q.add_days(start, '60')} END AS closed_at,
        CASE WHEN l_orderkey % 3 = 1 THEN 1 ELSE 0 END AS won
      FROM {q.t('lineitem')}) s GROUP BY opportunity_id, product"""


@entity
def fact_opportunity_revenue(q: Dialect) -> str:
    return f"""SELECT l_orderkey AS opportunity_id, CAST(floor(l_extendedprice) AS DOUBLE) AS total_revenue,
      CAST(floor(l_extendedprice / 4) AS DOUBLE) AS product_profit, CAST(l_linenumber AS BIGINT) AS product_attach_count,
      CAST(floor(l_extendedprice / 8) AS DOUBLE) AS subscription_revenue, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS sales_accepted
    FROM {q.t('lineitem')}"""


@entity
def partner_relationship(q: Dialect) -> str:
    return f"SELECT l_orderkey AS opportunity_id, l_linenumber <= 1 AS is_coselling FROM {q.t('lineitem')}"


# ---------------------------------------------------------------- geography, programmes, organisations


@entity
def geo_country(q: Dialect) -> str:
    return f"""SELECT 'C' || CAST(n_nationkey AS STRING) AS country_code, n_name AS country_name,
      CASE WHEN n_nationkey % 2 = 0 THEN DATE '1996-01-01' END AS eligible_since,
      CASE WHEN n_nationkey % 3 = 0 THEN 'Mature' ELSE 'Emerging' END AS market_maturity, 'Sub ' || n_name AS sub_region
    FROM {q.t('nation')}"""


@entity
def programme_merchant(q: Dialect) -> str:
    return f"""SELECT CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS STRING) ELSE 'x' || CAST(c_custkey AS STRING) END AS shop_id,
      'P' || CAST(c_nationkey AS STRING) AS promo_code FROM {q.t('customer')}"""


@entity
def programme_list(q: Dialect) -> str:
    return f"""SELECT 'P' || CAST(n_nationkey AS STRING) AS promo_code,
      CASE WHEN n_nationkey % 4 = 0 THEN 'Y' ELSE 'N' END AS must_win FROM {q.t('nation')} WHERE n_regionkey <> 3"""


@entity
def org_shop(q: Dialect) -> str:
    return f"SELECT c_custkey AS shop_id, {q.idiv('c_custkey', '3')} AS organization_id FROM {q.t('customer')}"


@entity
def org_daily(q: Dialect) -> str:
    return f"""SELECT {q.idiv('o_custkey', '3')} AS organization_id, CAST(o_orderdate AS DATE) AS snapshot_date,
      o_orderkey % 4 AS ending_active FROM {q.t('orders')}"""


# ---------------------------------------------------------------- leads and partners

_SIGNUP = "event_type = 'signup'"
_LEAD_DAY = "DATE '1998-01-01'"
_LABEL = """CASE event_id % 7 WHEN 0 THEN 'AMER - United States - West' WHEN 1 THEN 'AMER - NATION_1' WHEN 2 THEN 'EMEA - NATION_2'
        WHEN 3 THEN 'APAC - NATION_3' WHEN 4 THEN 'LATAM - NATION_4' WHEN 5 THEN 'EMEA' END"""
_BAND = """CASE event_id % 5 WHEN 0 THEN '$0 to $50,000' WHEN 1 THEN '$250,000 to $1,000,000' WHEN 2 THEN '$1,000,000+'
        WHEN 3 THEN '$50,000 to $250,000' END"""


@entity
def crm_lead(q: Dialect) -> str:
    day = q.add_days(_LEAD_DAY, "event_id % 240")
    return f"""SELECT event_id AS lead_id, user_id AS owner_id, {_role('event_id')} AS owner_role,
      CASE user_id % 6 WHEN 0 THEN 'Website' WHEN 1 THEN 'Partner Referral' WHEN 2 THEN 'Outbound' WHEN 3 THEN 'Webinar'
        WHEN 4 THEN 'partner portal' ELSE 'Seminar' END AS lead_source,
      CASE WHEN user_id % 4 = 0 THEN 'Partner Referral' WHEN user_id % 4 = 1 THEN 'Website' WHEN user_id % 4 = 2 THEN 'Lead List' END AS lead_source_original,
      CASE WHEN event_id % 2 = 0 THEN 'Open' ELSE 'Working' END AS status,
      CASE WHEN event_id % 6 = 0 THEN 'No budget' END AS disqualified_reason,
      {_LABEL} AS region_label,
      CASE WHEN user_id % 2 = 0 THEN 'Point of Sale' ELSE 'Online' END AS product_interest,
      CASE WHEN user_id % 3 = 0 THEN 'Point of Sale' ELSE 'Online' END AS product_interest_at_creation, value * 2000000 AS enriched_revenue,
      CASE WHEN event_id % 3 = 0 THEN event_id * 7 END AS converted_contact_id, CASE WHEN value > 30 THEN {q.add_days(day, '6')} END AS sales_accepted_date,
      {day} AS created_date,
      CASE WHEN value > 15 THEN {q.add_days(day, '5')} END AS sales_ready_date,
      CASE WHEN event_id % 6 = 0 THEN {q.add_days(day, '9')} END AS disqualified_date,
      CASE WHEN event_id % 8 = 0 THEN {q.add_days(day, '11')} END AS nurture_date,
      CASE WHEN event_id % 3 = 0 THEN {q.add_days(day, '7')} END AS opportunity_date,
      CASE WHEN event_id % 3 = 0 THEN event_id END AS converted_opportunity_id,
      CASE WHEN event_id % 3 = 0 THEN {_account('user_id')} END AS converted_account_id,
      CASE WHEN value < 25 THEN event_id END AS legacy_id,
      CAST(event_id % 900 AS DOUBLE) AS online_revenue, CAST(event_id % 700 AS DOUBLE) AS offline_revenue
    FROM {q.t('events')} WHERE {_SIGNUP}"""


@entity
def crm_lead_raw(q: Dialect) -> str:
    day = q.add_days(_LEAD_DAY, "event_id % 240")
    return f"""SELECT event_id AS lead_id, user_id AS owner_id, CASE WHEN event_id % 16 = 7 THEN 'Forecasting Role' ELSE {_role('event_id')} END AS owner_role,
      CASE WHEN user_id % 6 = 0 THEN 'Website' ELSE 'Webinar' END AS lead_source,
      CASE WHEN event_id % 2 = 0 THEN 'Open' ELSE 'Working' END AS status,
      {_BAND} AS offline_revenue_band, value * 2000000 AS enriched_revenue,
      {day} AS created_date, CASE WHEN value > 15 THEN {q.add_days(day, '3')} END AS mql_date,
      CASE WHEN value > 30 THEN {q.add_days(day, '6')} END AS sal_date,
      {_LABEL} AS region_label,
      CASE WHEN event_id % 3 = 0 THEN {_account('user_id')} END AS converted_account_id,
      CASE WHEN event_id % 3 = 0 THEN event_id END AS converted_opportunity_id,
      event_id % 2 = 0 AS is_customer,
      CASE event_id % 6 WHEN 0 THEN '1' WHEN 1 THEN '2-5' WHEN 2 THEN 'More than 10' WHEN 3 THEN '' WHEN 4 THEN 'Opening location soon' END AS retail_locations,
      CASE WHEN event_id % 6 = 0 THEN 'No budget' END AS disqualified_reason,
      event_id % 41 = 0 AS is_deleted,
      'Seg ' || CAST(event_id % 3 AS STRING) AS routing_segment, CASE WHEN event_id % 2 = 0 THEN event_id % 500 END AS organization_id,
      CASE WHEN event_id % 5 > 0 THEN 'Company ' || CAST(event_id AS STRING) END AS company,
      CASE WHEN event_id % 3 = 1 THEN 'Joint call' END AS partner_involvement,
      CASE WHEN event_id % 9 > 0 THEN CAST(user_id AS DOUBLE) * 1000000 END AS online_revenue_verified,
      'Grade ' || CAST(event_id % 4 AS STRING) AS lead_grade,
      CASE WHEN event_id % 5 = 0 THEN 'Ref ' || CAST(user_id AS STRING) END AS referrer_name,
      CASE WHEN event_id % 5 = 0 THEN {_email('user_id')} END AS referrer_email,
      CASE WHEN event_id % 4 > 0 THEN {q.add_days(day, '20')} END AS last_activity_date
    FROM {q.t('events')} WHERE {_SIGNUP}"""


@entity
def legacy_lead(q: Dialect) -> str:
    return f"""SELECT event_id AS legacy_id, CASE WHEN event_id % 8 = 0 THEN 'Retail' WHEN event_id % 12 = 4 THEN 'Other' END AS eligibility_segment,
      CASE WHEN event_id % 5 = 4 THEN '$500k - $1M' END AS revenue_band, 'Legacy ' || CAST(event_id AS STRING) AS company,
      CAST(event_id % 12 AS STRING) AS number_of_locations, {q.add_days(_LEAD_DAY, 'event_id % 300')} AS last_activity_date
    FROM {q.t('events')} WHERE {_SIGNUP} AND value < 25"""


@entity
def partner_lead(q: Dialect) -> str:
    return f"""SELECT event_id AS reference_id, CASE WHEN event_id % 10 = 9 THEN 'Account' ELSE 'Lead' END AS reference_object,
      event_id % 3 AS membership_id, (user_id + version) % {OWNERS} AS partner_id, event_id * 2 + version AS shop_id,
      'C' || CAST(user_id % 26 AS STRING) AS country_code, {q.add_days(_LEAD_DAY, 'event_id % 100 + version')} AS updated_on
    FROM (SELECT event_id, user_id, event_type, value, {q.explode('0', '1')} AS version FROM {q.t('events')}) v
    WHERE {_SIGNUP} AND value < 60"""


@entity
def partner_referral(q: Dialect) -> str:
    one = q.struct(partner_id=f"user_id % {OWNERS}", partner_name="'Partner ' || CAST(user_id AS STRING)", referred_on=q.add_days(_LEAD_DAY, "event_id % 60"), referral_index="1")
    two = q.struct(partner_id=f"(user_id + 1) % {OWNERS}", partner_name="'Partner ' || CAST(user_id + 1 AS STRING)", referred_on=q.add_days(_LEAD_DAY, "event_id % 90"), referral_index="2")
    return f"""SELECT event_id AS lead_id, CASE event_id % 4 WHEN 0 THEN {q.array(one)} WHEN 1 THEN {q.array(one, two)} END AS referring_partners
    FROM {q.t('events')} WHERE {_SIGNUP}"""


@entity
def partner(q: Dialect) -> str:
    return f"""SELECT s_suppkey AS partner_id, 'Partner ' || CAST(s_suppkey AS STRING) AS partner_name, r_name AS region, n_name AS country_name,
      'Sub ' || n_name AS sub_region, CASE WHEN s_suppkey % 2 = 0 THEN 'Managed' ELSE 'Open' END AS management_model,
      CASE WHEN s_suppkey % 3 = 0 THEN 'Agency' ELSE 'Technology' END AS partner_type,
      {_account('s_suppkey')} AS partner_account_id, 'Recruiter ' || CAST(s_suppkey % 4 AS STRING) AS recruiter,
      CASE s_suppkey % 4 WHEN 0 THEN {q.array("'plus-partners'", "'card-payment-a'", "'web-payment-b'")} WHEN 1 THEN {q.array("'agency'")} WHEN 2 THEN {q.array("'card-payment-a'")} END AS memberships
    FROM {q.t('supplier')} JOIN {q.t('nation')} ON s_nationkey = n_nationkey JOIN {q.t('region')} ON n_regionkey = r_regionkey"""


@entity
def partner_manager_daily(q: Dialect) -> str:
    return f"""SELECT partner_id, on_date, programme, min(manager) AS manager
    FROM (SELECT o_custkey % {OWNERS} AS partner_id, {q.add_days("DATE '1998-03-01'", 'o_orderkey % 90')} AS on_date,
        CASE {q.idiv('o_orderkey', '97')} % 5 WHEN 0 THEN 'plus-partners-east' WHEN 1 THEN 'Partners' WHEN 2 THEN 'agency-west' WHEN 3 THEN 'retail_partnerships' ELSE 'other' END AS programme,
        'PM ' || CAST(o_custkey % 9 AS STRING) AS manager FROM {q.t('orders')}) m
    GROUP BY partner_id, on_date, programme"""


@entity
def partner_developer_history(q: Dialect) -> str:
    start = "CAST(o_orderdate AS DATE)"
    return f"""SELECT {_account('o_custkey')} AS account_id, 'Developer ' || CAST(o_orderkey % 6 AS STRING) AS manager_name, {start} AS start_date,
      CASE WHEN o_orderkey % 10 = 0 THEN DATE '9999-12-31' ELSE {q.add_days(start, 'o_orderkey % 200 - 1')} END AS end_date FROM {q.t('orders')}"""


@entity
def partner_recruiter_history(q: Dialect) -> str:
    start = "CAST(o_orderdate AS DATE)"
    return f"""SELECT {_account('o_custkey')} AS account_id, 'Hist recruiter ' || CAST(o_orderkey % 8 AS STRING) AS manager_name, {start} AS start_date,
      {q.add_days(start, 'o_orderkey % 60')} AS end_date FROM {q.t('orders')}"""


@entity
def lead_status_history(q: Dialect) -> str:
    return f"""SELECT event_id AS lead_id, 'S' || CAST(step AS STRING) AS status, {q.add_days("DATE '1998-03-01'", 'event_id % 45 + step * 10')} AS end_date
    FROM (SELECT event_id, event_type, value, {q.explode('0', '1', '2')} AS step FROM {q.t('events')}) s WHERE {_SIGNUP} AND value > 4"""


# ---------------------------------------------------------------- activities and campaigns

_LINE_ACCOUNT = _account("o_custkey", "CASE WHEN l_linenumber <= 2 THEN 'AAA' ELSE 'BBB' END")


def _activity(q: Dialect, completed: str, where: str) -> str:
    return f"""SELECT l_orderkey * 10 + l_linenumber AS id, {_LINE_ACCOUNT} AS account_ref, CAST(l_shipdate AS DATE) AS activity_day,
      CAST(l_shipdate AS DATE) AS {completed}, {q.add_days('CAST(l_shipdate AS DATE)', '-2')} AS created_day,
      l_suppkey AS created_by, (l_suppkey + 3) % 100 AS owner, l_linenumber = 6 AS deleted,
      CASE l_returnflag WHEN 'A' THEN 'Call' WHEN 'N' THEN 'Meeting' ELSE 'Email' END AS type,
      CASE WHEN l_discount > 0.08 THEN 'LinkedIn - InMail' WHEN l_discount < 0.01 THEN 'Reply' END AS dialler_type,
      'Subject ' || CAST(l_linenumber AS STRING) AS subject, CAST(l_linenumber AS BIGINT) AS click_count,
      CASE WHEN l_quantity > 45 THEN l_orderkey END AS related_id,
      CASE WHEN l_linenumber = 2 THEN 'Demo' ELSE 'Follow-up' END AS sub_type, CASE WHEN l_quantity < 20 THEN 'Connected' END AS call_disposition,
      floor(l_quantity) * 1e0 AS call_minutes, CASE WHEN l_tax > 0.04 THEN 'Positive' END AS call_sentiment,
      CASE WHEN l_suppkey % 3 > 0 THEN 'Cadence ' || CAST(l_suppkey % 3 AS STRING) END AS cadence_name, CAST(l_linenumber % 3 AS BIGINT) AS connected_count,
      CASE WHEN l_returnflag = 'R' THEN 'Template ' || CAST(l_partkey % 5 AS STRING) END AS email_template, CAST(l_partkey % 4 AS BIGINT) AS replies_count,
      CAST(l_linenumber % 2 AS BIGINT) AS unique_click_count, CAST(l_partkey % 2 AS BIGINT) AS unique_reply_count,
      CAST(l_suppkey % 2 AS BIGINT) AS unique_view_count, CAST(l_suppkey % 7 AS BIGINT) AS view_count,
      CASE WHEN l_linenumber % 4 = 0 THEN 'Notes ' || CAST(l_partkey % 9 AS STRING) END AS description
    FROM {q.t('lineitem')} JOIN {q.t('orders')} ON l_orderkey = o_orderkey WHERE {where}"""


@entity
def act_event(q: Dialect) -> str:
    return _activity(q, "event_day", "l_returnflag = 'N'")


@entity
def act_task(q: Dialect) -> str:
    return _activity(q, "completed_day", "l_returnflag <> 'N'")


@entity
def crm_campaign(q: Dialect) -> str:
    start = q.add_days("DATE '1995-01-01'", "p_partkey * 7 % 2000")
    return f"""SELECT p_partkey AS campaign_id, CASE WHEN p_type = 'PROMO' THEN 'Incubation-b2b ' ELSE '' END || p_name AS campaign_name,
      {start} AS start_date, {q.add_days(start, '180')} AS end_date, p_partkey % 31 = 0 AS is_deleted FROM {q.t('part')}"""


@entity
def crm_campaign_member(q: Dialect) -> str:
    return f"""SELECT DISTINCT l_partkey AS campaign_id, {_account('o_custkey')} AS account_id, l_orderkey AS lead_id,
      CAST(l_shipdate AS DATE) AS joined_date, l_linenumber = 5 AS is_deleted
    FROM {q.t('lineitem')} JOIN {q.t('orders')} ON l_orderkey = o_orderkey WHERE l_quantity > 40"""


@entity
def account_watchlist(q: Dialect) -> str:
    return f"SELECT left({_account('c_custkey')}, 15) AS account_prefix FROM {q.t('customer')} WHERE c_acctbal > 6000"


def _day(q: Dialect) -> str:
    return q.add_days("DATE '1998-01-01'", "event_id % 180")


@entity
def act_email(q: Dialect) -> str:
    return f"""SELECT event_id AS id, {_day(q)} AS created_date, {q.struct(id=f'user_id % {OWNERS}')} AS sender,
      {q.struct(replies='event_id % 3')} AS counts, event_id % 4 = 0 AS view_tracking FROM {q.t('events')} WHERE event_type = 'view'"""


@entity
def act_call(q: Dialect) -> str:
    return f"""SELECT event_id AS id, {_day(q)} AS created_date, {q.struct(id=f'user_id % {OWNERS}')} AS sender,
      CASE WHEN event_id % 3 = 0 THEN 'Connected' ELSE 'No answer' END AS disposition,
      CASE WHEN event_id % 5 = 0 THEN 'Interested' END AS sentiment FROM {q.t('events')} WHERE event_type = 'click'"""


@entity
def act_cadence(q: Dialect) -> str:
    return f"""SELECT event_id AS id, {_day(q)} AS created_date, {q.struct(id=f'user_id % {OWNERS}')} AS owner,
      {q.struct(meetings_booked='event_id % 4', people_acted_on='event_id % 3')} AS counts FROM {q.t('events')} WHERE event_type = 'purchase'"""


@entity
def act_meeting(q: Dialect) -> str:
    rep = f"user_id % {OWNERS}"
    boss = f"({rep} - user_id % 10)"
    guest = q.struct(email=_email(f"(user_id + 1) % {OWNERS}"), status="'accepted'")
    lead = q.struct(email=_email(boss), status="CASE WHEN event_id % 3 = 0 THEN 'declined' ELSE 'accepted' END")
    return f"""SELECT event_id AS id, {_email(rep)} AS calendar_id, {_day(q)} AS created_date,
      {q.at_minute(_day(q), 'event_id % 600')} AS start_time, {q.at_minute(_day(q), 'event_id % 600 + event_id % 55')} AS end_time,
      event_id % 4 = 0 AS no_show, {q.struct(id='event_id - 1')} AS cadence,
      CASE event_id % 5 WHEN 0 THEN {q.array(guest)} WHEN 4 THEN NULL ELSE {q.array(guest, lead)} END AS attendees
    FROM {q.t('events')} WHERE event_type = 'error'"""


@entity
def act_conversation(q: Dialect) -> str:
    return f"""SELECT conv_id * 100 + turn AS id, {q.add_days("DATE '1998-01-01'", 'conv_id % 180')} AS created_date,
      CAST(conv_id % {OWNERS} AS STRING) AS user_guid, length(text) * 60000 AS duration_ms FROM {q.t('conversations')}"""


@entity
def act_recorded_meeting(q: Dialect) -> str:
    return f"""SELECT l_orderkey * 10 + l_linenumber AS event_id, CASE WHEN l_suppkey % 12 = 11 THEN 'Unknown' ELSE {_rep_name(f'l_suppkey % {OWNERS}')} END AS owner_name,
      CAST(l_shipdate AS DATE) AS activity_date, CASE WHEN l_linenumber < 4 THEN 'rec' END AS recording_url
    FROM {q.t('lineitem')} WHERE l_returnflag = 'N'"""


@entity
def account_activity(q: Dialect) -> str:
    return f"""SELECT {_account('o_custkey')} AS account_id, CAST(l_shipdate AS DATE) AS activity_date,
      CASE WHEN l_linenumber < 6 THEN 'Sales' ELSE 'Support' END AS activity_group,
      CASE l_returnflag WHEN 'A' THEN 'Call' WHEN 'N' THEN 'Meeting' ELSE 'Email' END AS activity_type,
      CASE WHEN l_linenumber < 7 THEN l_orderkey END AS opportunity_id, {_rep_name(f'o_custkey % {OWNERS}')} AS opportunity_owner,
      {_rep_name(f'(o_custkey + l_linenumber % 2) % {OWNERS}')} AS activity_owner
    FROM {q.t('lineitem')} JOIN {q.t('orders')} ON l_orderkey = o_orderkey"""


@entity
def account_snapshot(q: Dialect) -> str:
    return f"""SELECT DISTINCT {_account('c_custkey')} AS account_id, CAST(o_orderdate AS DATE) AS snapshot_date, lower(n_name) AS territory_name,
      CASE WHEN c_custkey % 4 = 3 THEN 'Tier 4' ELSE 'Tier ' || CAST(c_custkey % 4 + 1 AS STRING) END AS tier
    FROM {q.t('orders')} JOIN {q.t('customer')} ON o_custkey = c_custkey JOIN {q.t('nation')} ON c_nationkey = n_nationkey"""


@entity
def territory_rep(q: Dialect) -> str:
    ends = [f"DATE '{y}-{d}'" for y in (1997, 1998, 1999) for d in ("03-31", "06-30", "09-30", "12-31")]
    return f"""SELECT {_rep_name(f's_suppkey % {OWNERS}')} AS rep_name, n_name AS territory_name, {q.explode(*ends)} AS quarter_end
    FROM {q.t('supplier')} JOIN {q.t('nation')} ON s_nationkey = n_nationkey"""


# ---------------------------------------------------------------- billing


@entity
def fin_shop(q: Dialect) -> str:
    return f"""SELECT o_orderkey AS shop_id, 'Shop ' || CAST(o_orderkey AS STRING) AS name, 'shop' || CAST(o_orderkey AS STRING) || '.example.org' AS domain,
      CASE WHEN o_orderkey % 20 = 0 THEN 'a@internal.example' WHEN o_orderkey % 33 = 0 THEN NULL ELSE 'a@example.org' END AS email,
      o_custkey % 25 AS billing_account_id FROM {q.t('orders')}"""


@entity
def fin_deal(q: Dialect) -> str:
    start = "CAST(o_orderdate AS DATE)"
    return f"""SELECT o_orderkey AS deal_id, 'Contract ' || CAST(o_orderkey AS STRING) AS name,
      CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey - 1 END AS original_deal_id, {start} AS start_date, {q.add_days(start, '365')} AS end_date,
      CASE WHEN o_orderstatus = 'F' THEN {q.add_days(start, 'o_orderkey % 365')} END AS terminated_on, o_orderkey % 50 = 0 AS is_deleted
    FROM {q.t('orders')}"""


@entity
def fin_agreement(q: Dialect) -> str:
    return f"""SELECT l_orderkey - l_linenumber AS deal_id, l_orderkey AS shop_id,
      CASE WHEN l_returnflag IN ('R', 'A') THEN CAST(l_shipdate AS DATE) END AS terminated_on, l_linenumber = 7 AS is_deleted,
      CASE WHEN l_linestatus = 'O' THEN 'Development/Staging shop' ELSE 'Standard' END AS reason FROM {q.t('lineitem')}"""


@entity
def fin_account(q: Dialect) -> str:
    return f"SELECT n_nationkey AS billing_account_id, n_nationkey + 100 AS current_subscription_id FROM {q.t('nation')}"


@entity
def fin_subscription(q: Dialect) -> str:
    return f"""SELECT n_nationkey + 100 AS subscription_id, CASE WHEN n_nationkey % 3 = 0 THEN 'basic' ELSE 'premium' END AS plan_name,
      CAST(2000 + n_nationkey AS DOUBLE) AS base_price FROM {q.t('nation')}"""


@entity
def fin_shop_dimension(q: Dialect) -> str:
    return f"SELECT o_orderkey AS shop_id, {_account('o_custkey')} AS account_id FROM {q.t('orders')}"


# ---------------------------------------------------------------- parameter sheet


@entity
def scorecard_metric(q: Dialect) -> str:
    rows = ", ".join(
        "(" + ", ".join("CAST(NULL AS STRING)" if v is None else (f"CAST({v} AS DOUBLE)" if isinstance(v, float) else "'" + v + "'") for v in r) + ")"
        for r in scorecard_sheet.rows()
    )
    return f"SELECT * FROM (VALUES {rows}) AS v(team_group, system, metric, points, unit, metric_group, metric_subgroup)"
