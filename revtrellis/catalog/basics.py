"""Sources, filters, joins, aggregates, windows, sets and scalar functions."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrellis.catalog.registry import AS_OF, query
from revtrellis.functions import dates as D
from revtrellis.functions import numbers as N
from revtrellis.functions import text as X
from revtrellis.operators import joins, sets, windows
from revtrellis.params.entity_schemas import entity_schemas
from revtrellis.session import scratch_path
from revtrellis.sources import sheets, sinks
from revtrellis.sources.tables import CheckedSource, scan

c = F.col

# ---------------------------------------------------------------- sources and sinks


@query("src_table_scan", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(s):
    return scan(s, "orders", "o_orderkey", "o_orderstatus")


@query(
    "src_parameter_sheet",
    "SELECT s_name AS metric, s_acctbal AS points FROM supplier",
)
def _(s):
    path = scratch_path(s.spark, "sheet")
    sheet = s.table("supplier").select(c("s_name").alias("metric"), c("s_acctbal").alias("points"))
    sinks.replace_folder(sheet, path, file_format="csv", header=True)
    schema = T.StructType([T.StructField("metric", T.StringType()), T.StructField("points", T.DoubleType())])
    return sheets.read_sheet(s.spark, path, schema)


@query(
    "src_literal_id_list",
    "SELECT account_id, name FROM crm_account WHERE left(account_id, 15) IN (SELECT account_prefix FROM account_watchlist)",
)
def _(s):
    accounts = s.table("crm_account").select("account_id", "name", X.first_chars("account_id", 15).alias("account_prefix"))
    return sheets.keep_members(accounts, s.table("account_watchlist"), "account_prefix").drop("account_prefix")


@query(
    "src_inline_derived",
    """SELECT opportunity_id, stage_name, lead_group FROM crm_opportunity
       LEFT JOIN (SELECT DISTINCT opportunity_id, lead_group FROM fact_metric WHERE dataset = 'Actuals' AND year >= 1997) f USING (opportunity_id)""",
)
def _(s):
    inner = s.table("fact_metric").filter((c("dataset") == "Actuals") & (c("year") >= 1997)).select("opportunity_id", "lead_group").distinct()
    return s.table("crm_opportunity").select("opportunity_id", "stage_name").join(inner, "opportunity_id", "left")


@query("snk_replace_table", "SELECT market_segment, count(*) AS accounts FROM crm_account GROUP BY market_segment")
def _(s):
    path, name = scratch_path(s.spark, "table"), f"account_counts_{uuid.uuid4().hex}"
    rows = s.table("crm_account").groupBy("market_segment").agg(F.count("*").alias("accounts"))
    old = rows.withColumn("market_segment", F.concat(F.lit("old "), "market_segment"))
    # The second refresh replaces all partitions of the first and reads the table that it replaces.
    sinks.replace_table(rows.unionByName(old), name, partition_by=["market_segment"], path=path)
    kept = s.spark.table(name).filter(~c("market_segment").like("old %"))
    sinks.replace_table(kept, name, partition_by=["market_segment"], path=path, checks=(sinks.same_columns, sinks.rows_kept(0.5)))
    s.spark.sql(f"DROP TABLE {name}")  # the name; the files stay until the application ends
    return s.spark.read.schema(rows.schema).parquet(f"{path}/v-*").select("market_segment", "accounts")


_SHEET_LINES = """SELECT CASE WHEN s_suppkey % 10 = 0 THEN 'Supplier#twice' ELSE s_name END AS metric,
   CASE WHEN s_suppkey % 7 = 0 THEN 'n/a' WHEN s_suppkey % 7 = 1 THEN '' ELSE CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) END AS points FROM supplier"""


@query(
    "src_sheet_rejects",
    f"""SELECT metric, points, concat_ws('; ', CASE WHEN points = 'n/a' THEN 'points is no double: n/a' END, CASE WHEN n > 1 THEN 'repeated key: ' || metric END) AS reason
        FROM (SELECT metric, points, count(*) OVER (PARTITION BY metric) AS n FROM ({_SHEET_LINES}) l) x WHERE n > 1 OR points = 'n/a'""",
)
def _(s):
    number = c("s_suppkey") % 7
    lines = s.table("supplier").select(
        F.when(c("s_suppkey") % 10 == 0, "Supplier#twice").otherwise(c("s_name")).alias("metric"),
        F.when(number == 0, "n/a").when(number == 1, "").otherwise(F.floor("s_acctbal").cast("long").cast("string")).alias("points"),
    )
    schema = T.StructType([T.StructField("metric", T.StringType()), T.StructField("points", T.DoubleType())])
    return sheets.check_sheet(lines, schema, key=("metric",), required=("metric",)).rejects


@query("src_checked_scan", "SELECT opportunity_id, account_id, stage_name, close_date FROM crm_opportunity")
def _(s):
    return CheckedSource(s, entity_schemas()).table("crm_opportunity").select("opportunity_id", "account_id", "stage_name", "close_date")


# ---------------------------------------------------------------- projections and filters


@query("prj_rename", "SELECT id AS task_id, account_ref AS account_id, activity_day AS activity_date, deleted AS is_deleted FROM act_task")
def _(s):
    return sets.rename_to(s.table("act_task"), {"id": "task_id", "account_ref": "account_id", "activity_day": "activity_date", "deleted": "is_deleted"})


@query("prj_star_plus", "SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def _(s):
    return s.table("lineitem").withColumns({"net": c("l_extendedprice") * (1 - c("l_discount"))})


@query(
    "prj_star_except",
    "SELECT o.*, c.* EXCLUDE (c_custkey, c_name) FROM orders o JOIN customer c ON o_custkey = c_custkey",
)
def _(s):
    return s.table("orders").join(s.table("customer"), c("o_custkey") == c("c_custkey")).drop("c_custkey", "c_name")


@query("prj_constant_tag", "SELECT opportunity_id, '02. Sales qualified lead' AS metric, 'Not Applicable' AS revenue_band FROM crm_opportunity")
def _(s):
    return sets.tag(s.table("crm_opportunity").select("opportunity_id"), metric="02. Sales qualified lead", revenue_band="Not Applicable")


@query("prj_distinct", "SELECT DISTINCT account_id, stage_name FROM crm_opportunity")
def _(s):
    return s.table("crm_opportunity").select("account_id", "stage_name").distinct()


@query("flt_compare_date", "SELECT opportunity_id, created_date FROM crm_opportunity WHERE created_date >= DATE '1998-01-01'")
def _(s):
    return s.table("crm_opportunity").filter(c("created_date") >= F.lit(date(1998, 1, 1))).select("opportunity_id", "created_date")


@query(
    "flt_rolling_months",
    "SELECT opportunity_id, created_date FROM crm_opportunity WHERE created_date BETWEEN DATE '1997-04-01' AND DATE '1998-08-31'",
)
def _(s):
    return s.table("crm_opportunity").filter(D.whole_months_window(c("created_date"), AS_OF, 14, 3)).select("opportunity_id", "created_date")


@query("flt_in_list", "SELECT opportunity_id, stage_name FROM crm_opportunity WHERE stage_name IN ('Closed Won', 'Closed Lost')")
def _(s):
    return s.table("crm_opportunity").filter(c("stage_name").isin("Closed Won", "Closed Lost")).select("opportunity_id", "stage_name")


@query(
    "flt_not_in_list_coalesced",
    "SELECT lead_id, converted_account_id FROM crm_lead_raw WHERE coalesce(converted_account_id, '') NOT IN ('001000000000003AAA', '001000000000009AAA')",
)
def _(s):
    keep = ~F.coalesce("converted_account_id", F.lit("")).isin("001000000000003AAA", "001000000000009AAA")
    return s.table("crm_lead_raw").filter(keep).select("lead_id", "converted_account_id")


@query(
    "flt_not_in_list_nullable",
    "SELECT lead_id, lead_source_original FROM crm_lead WHERE lead_source_original NOT IN ('Partner Referral', 'Lead List')",
)
def _(s):
    return s.table("crm_lead").filter(~c("lead_source_original").isin("Partner Referral", "Lead List")).select("lead_id", "lead_source_original")


@query("flt_like", "SELECT opportunity_id, role_at_creation FROM crm_opportunity WHERE role_at_creation LIKE '%SDR%RETAIL'")
def _(s):
    return s.table("crm_opportunity").filter(c("role_at_creation").like("%SDR%RETAIL")).select("opportunity_id", "role_at_creation")


@query("flt_not_like", "SELECT shop_id, email FROM fin_shop WHERE email NOT LIKE '%@internal%'")
def _(s):
    return s.table("fin_shop").filter(~c("email").like("%@internal%")).select("shop_id", "email")


@query(
    "flt_regex_contains",
    "SELECT opportunity_id, role_at_creation FROM crm_opportunity WHERE regexp_matches(role_at_creation, 'SC|N3') OR regexp_matches(lead_source, '^Web')",
)
def _(s):
    cond = c("role_at_creation").rlike("SC|N3") | c("lead_source").rlike("^Web")
    return s.table("crm_opportunity").filter(cond).select("opportunity_id", "role_at_creation")


@query("flt_compare_number", "SELECT opportunity_id, total_revenue FROM crm_opportunity WHERE total_revenue >= 250000")
def _(s):
    return s.table("crm_opportunity").filter(c("total_revenue") >= 250000).select("opportunity_id", "total_revenue")


@query("flt_not_equal", "SELECT deal_id, reason FROM fin_agreement WHERE reason <> 'Standard'")
def _(s):
    return s.table("fin_agreement").filter(c("reason") != "Standard").select("deal_id", "reason")


@query("flt_not", "SELECT user_id, user_role FROM crm_user WHERE NOT (user_role LIKE '%SALES%' OR user_role LIKE '%SC%')")
def _(s):
    return s.table("crm_user").filter(~X.any_like(c("user_role"), ["%SALES%", "%SC%"])).select("user_id", "user_role")


@query("flt_null_test", "SELECT deal_id, terminated_on, original_deal_id FROM fin_deal WHERE terminated_on IS NULL AND original_deal_id IS NOT NULL")
def _(s):
    return s.table("fin_deal").filter(c("terminated_on").isNull() & c("original_deal_id").isNotNull()).select("deal_id", "terminated_on", "original_deal_id")


@query("flt_bool_not_deleted", "SELECT deal_id FROM fin_deal WHERE NOT is_deleted")
def _(s):
    return s.table("fin_deal").filter(~c("is_deleted")).select("deal_id")


@query(
    "flt_or_groups",
    """SELECT lead_id FROM crm_lead_raw WHERE NOT is_deleted AND ((owner_role LIKE '%RETAIL%' AND mql_date IS NOT NULL)
       OR (offline_revenue_band IN ('$1,000,000+') AND sal_date IS NULL))""",
)
def _(s):
    first = c("owner_role").like("%RETAIL%") & c("mql_date").isNotNull()
    second = c("offline_revenue_band").isin("$1,000,000+") & c("sal_date").isNull()
    return s.table("crm_lead_raw").filter(~c("is_deleted") & (first | second)).select("lead_id")


@query("flt_between_numeric", "SELECT lead_id, online_revenue FROM crm_lead WHERE online_revenue BETWEEN 100 AND 300")
def _(s):
    return s.table("crm_lead").filter(c("online_revenue").between(100, 300)).select("lead_id", "online_revenue")


@query("flt_post_projection", "SELECT * FROM (SELECT opportunity_id, close_date - created_date AS days FROM crm_opportunity) x WHERE days > 60")
def _(s):
    rows = s.table("crm_opportunity").select("opportunity_id", D.days_between("close_date", "created_date").cast("long").alias("days"))
    return rows.filter(c("days") > 60)


@query(
    "cse_case_search",
    """SELECT opportunity_id, CASE WHEN stage_name LIKE 'Closed%' THEN 'closed' WHEN total_revenue > 300000 THEN 'large' ELSE 'open' END AS label
       FROM crm_opportunity""",
)
def _(s):
    label = F.when(c("stage_name").like("Closed%"), "closed").when(c("total_revenue") > 300000, "large").otherwise("open")
    return s.table("crm_opportunity").select("opportunity_id", label.alias("label"))


@query(
    "cse_case_nested",
    """SELECT account_id, sum(CASE WHEN stage_name = 'Closed Won' THEN CASE WHEN total_revenue > 200000 THEN 2 ELSE 1 END ELSE 0 END)::BIGINT AS score
       FROM crm_opportunity GROUP BY account_id""",
)
def _(s):
    inner = F.when(c("total_revenue") > 200000, 2).otherwise(1)
    return s.table("crm_opportunity").groupBy("account_id").agg(F.sum(F.when(c("stage_name") == "Closed Won", inner).otherwise(0)).alias("score"))


@query("cse_coalesce", "SELECT opportunity_id, product, coalesce(envision_at, solution_at, demonstrate_at, deal_craft_at, closed_at) AS first_stage FROM fact_stage")
def _(s):
    first = F.coalesce("envision_at", "solution_at", "demonstrate_at", "deal_craft_at", "closed_at")
    return s.table("fact_stage").select("opportunity_id", "product", first.alias("first_stage"))


@query("cse_ifnull", "SELECT opportunity_id, coalesce(offline_revenue, 0) AS offline_revenue FROM crm_opportunity")
def _(s):
    return s.table("crm_opportunity").select("opportunity_id", N.zero_if_null(c("offline_revenue")).alias("offline_revenue"))


# ---------------------------------------------------------------- joins


@query("jn_inner_equi", "SELECT a.deal_id, name, shop_id FROM fin_agreement a JOIN fin_deal d ON a.deal_id = d.deal_id")
def _(s):
    return s.table("fin_agreement").select("deal_id", "shop_id").join(s.table("fin_deal").select("deal_id", "name"), "deal_id")


@query(
    "jn_left_equi",
    """SELECT o.opportunity_id, a.name, u.name AS owner, r.role_name, g.country_name FROM crm_opportunity o LEFT JOIN crm_account a ON o.account_id = a.account_id
       LEFT JOIN crm_user u ON o.owner_id = u.user_id LEFT JOIN crm_role r ON u.user_role_id = r.user_role_id LEFT JOIN geo_country g ON o.country_code = g.country_code""",
)
def _(s):
    users = s.table("crm_user").select(c("user_id").alias("owner_id"), c("name").alias("owner"), "user_role_id")
    rows = s.table("crm_opportunity").select("opportunity_id", "account_id", "owner_id", "country_code")
    rows = rows.join(s.table("crm_account").select("account_id", "name"), "account_id", "left").join(users, "owner_id", "left")
    rows = rows.join(s.table("crm_role"), "user_role_id", "left").join(s.table("geo_country").select("country_code", "country_name"), "country_code", "left")
    return rows.select("opportunity_id", "name", "owner", "role_name", "country_name")


@query(
    "jn_left_on_constant",
    """SELECT o.opportunity_id, f.value FROM crm_opportunity o
       LEFT JOIN fact_metric f ON o.opportunity_id = f.opportunity_id AND f.metric = 'Closed Won' AND f.value_type = 'Total Revenue' AND f.dataset = 'Actuals'""",
)
def _(s):
    won = s.table("fact_metric").filter((c("metric") == "Closed Won") & (c("value_type") == "Total Revenue") & (c("dataset") == "Actuals"))
    return s.table("crm_opportunity").select("opportunity_id").join(won.select("opportunity_id", "value"), "opportunity_id", "left")


@query(
    "jn_left_filter_left_in_on",
    "SELECT l.lead_id, a.territory_name FROM crm_lead_raw l LEFT JOIN crm_account a ON l.converted_account_id = a.account_id AND NOT l.is_deleted",
)
def _(s):
    a, b = s.table("crm_lead_raw").alias("a"), s.table("crm_account").alias("b")
    on = (c("a.converted_account_id") == c("b.account_id")) & ~c("a.is_deleted")
    return a.join(b, on, "left").select("a.lead_id", "b.territory_name")


@query(
    "jn_left_then_where",
    "SELECT a.account_id, o.opportunity_id FROM crm_account a LEFT JOIN crm_opportunity o ON a.account_id = o.account_id WHERE NOT a.is_deleted AND NOT o.is_deleted",
)
def _(s):
    a, o = s.table("crm_account").alias("a"), s.table("crm_opportunity").alias("o")
    return a.join(o, "account_id", "left").filter(~c("a.is_deleted") & ~c("o.is_deleted")).select("account_id", "opportunity_id")


@query(
    "jn_full_outer",
    "SELECT lead_id, opportunity_id FROM crm_lead_raw l FULL JOIN crm_opportunity o ON l.converted_opportunity_id = o.opportunity_id",
)
def _(s):
    left = s.table("crm_lead_raw").select("lead_id", "converted_opportunity_id")
    right = s.table("crm_opportunity").select("opportunity_id")
    rows = joins.full_outer_nullable(left, right, "converted_opportunity_id", "opportunity_id", ["lead_id"], ["opportunity_id"])
    return rows.select("lead_id", "opportunity_id")


@query(
    "jn_full_outer_left_filtered",
    """SELECT lead_id, opportunity_id, stage_name FROM crm_lead_raw l FULL JOIN crm_opportunity o ON l.converted_opportunity_id = o.opportunity_id
       WHERE lead_id IS NOT NULL""",
)
def _(s):
    left = s.table("crm_lead_raw").select("lead_id", "converted_opportunity_id")
    right = s.table("crm_opportunity").select("opportunity_id", "stage_name")
    joined = joins.left_join_nullable(left, right.withColumnRenamed("opportunity_id", "converted_opportunity_id").withColumn("opportunity_id", c("converted_opportunity_id")), ["converted_opportunity_id"], ["lead_id"])
    return joined.select("lead_id", "opportunity_id", "stage_name")


@query("jn_using", "SELECT opportunity_id, stage_name, product FROM crm_opportunity JOIN fact_stage USING (opportunity_id)")
def _(s):
    return s.table("crm_opportunity").join(s.table("fact_stage"), ["opportunity_id"]).select("opportunity_id", "stage_name", "product")


@query(
    "jn_composite_key",
    """SELECT q.rep, q.m, quota, n FROM (SELECT payee_id AS rep, substring(period, 3, 7) AS m, sum(quota) AS quota FROM hr_quota GROUP BY ALL) q
       JOIN (SELECT owner_id AS rep, strftime(created_date, '%Y:%m') AS m, count(*) AS n FROM crm_opportunity GROUP BY ALL) o ON q.rep = o.rep AND q.m = o.m""",
)
def _(s):
    quota = s.table("hr_quota").groupBy(c("payee_id").alias("rep"), F.substring("period", 3, 7).alias("m")).agg(F.sum("quota").alias("quota"))
    opps = s.table("crm_opportunity").groupBy(c("owner_id").alias("rep"), F.date_format("created_date", "yyyy:MM").alias("m")).agg(F.count("*").alias("n"))
    return quota.join(opps, ["rep", "m"])


@query("jn_self", "SELECT w.worker_name, m.worker_name AS manager FROM hr_worker w LEFT JOIN hr_worker m ON w.manager_id = m.worker_id")
def _(s):
    w, m = s.table("hr_worker").alias("w"), s.table("hr_worker").alias("m")
    return w.join(m, c("w.manager_id") == c("m.worker_id"), "left").select("w.worker_name", c("m.worker_name").alias("manager"))


@query(
    "jn_case_insensitive",
    """SELECT t.rep_name, s.account_id FROM (SELECT DISTINCT rep_name, territory_name FROM territory_rep) t
       JOIN (SELECT DISTINCT account_id, territory_name FROM account_snapshot) s ON upper(t.territory_name) = upper(s.territory_name)""",
)
def _(s):
    reps = s.table("territory_rep").select("rep_name", F.upper("territory_name").alias("k")).distinct()
    accounts = s.table("account_snapshot").select("account_id", F.upper("territory_name").alias("k")).distinct()
    return reps.join(accounts, "k").drop("k")


@query(
    "jn_prefix_key",
    """SELECT t.id, a.name FROM (SELECT id, account_ref FROM act_task) t JOIN crm_account a ON left(t.account_ref, 15) = left(a.account_id, 15)""",
)
def _(s):
    tasks = s.table("act_task").select("id", X.first_chars("account_ref", 15).alias("k"))
    return tasks.join(s.table("crm_account").select("name", X.first_chars("account_id", 15).alias("k")), "k").drop("k")


@query(
    "jn_safe_cast_key",
    "SELECT o.opportunity_id, m.promo_code FROM crm_opportunity o LEFT JOIN programme_merchant m ON o.primary_shop_id = TRY_CAST(m.shop_id AS BIGINT)",
)
def _(s):
    merchants = s.table("programme_merchant").select(F.expr("try_cast(shop_id AS BIGINT)").alias("primary_shop_id"), "promo_code")
    return s.table("crm_opportunity").select("opportunity_id", "primary_shop_id").join(merchants, "primary_shop_id", "left").drop("primary_shop_id")


@query("jn_cast_text_key", "SELECT v.id, u.name FROM act_conversation v JOIN crm_user u ON v.user_guid = CAST(u.guid AS VARCHAR)")
def _(s):
    users = s.table("crm_user").select(c("guid").cast("string").alias("user_guid"), "name")
    return s.table("act_conversation").select("id", "user_guid").join(users, "user_guid").drop("user_guid")


@query(
    "jn_split_key",
    "SELECT l.lead_id, g.country_code FROM crm_lead l LEFT JOIN geo_country g ON g.country_name = string_split(l.region_label, ' - ')[2]",
)
def _(s):
    rows = s.table("crm_lead").select("lead_id", X.split_item(c("region_label"), " - ", 1).alias("country_name"))
    countries = s.table("geo_country").select("country_name", "country_code")
    return joins.left_join_nullable(rows, countries, ["country_name"], ["lead_id"]).drop("country_name")


@query(
    "jn_coalesced_key",
    """SELECT t.id, o.stage_name FROM act_task t LEFT JOIN crm_opportunity o ON coalesce(t.related_id, t.id // 10) = o.opportunity_id""",
)
def _(s):
    rows = s.table("act_task").select("id", F.coalesce("related_id", F.expr("id div 10")).alias("opportunity_id"))
    return rows.join(s.table("crm_opportunity").select("opportunity_id", "stage_name"), "opportunity_id", "left").drop("opportunity_id")


@query(
    "jn_range_interval",
    """SELECT t.id, d.account_id, d.manager_name FROM act_task t JOIN partner_developer_history d
       ON left(t.account_ref, 15) = left(d.account_id, 15) AND t.completed_day BETWEEN d.start_date AND d.end_date""",
)
def _(s):
    tasks = s.table("act_task").select("id", X.first_chars("account_ref", 15).alias("k"), "completed_day")
    spans = s.table("partner_developer_history").withColumn("k", X.first_chars("account_id", 15))
    rows = joins.interval_join(tasks, spans, ["k"], "completed_day", "start_date", "end_date")
    return rows.select("id", "account_id", "manager_name")


@query(
    "jn_range_campaign_window",
    """SELECT t.id, m.campaign_id FROM act_task t LEFT JOIN (
         SELECT * FROM (SELECT m.account_id, m.campaign_id, c.start_date, c.end_date,
             row_number() OVER (PARTITION BY m.account_id ORDER BY m.joined_date DESC, m.campaign_id DESC) AS rn
           FROM crm_campaign_member m JOIN crm_campaign c ON m.campaign_id = c.campaign_id AND NOT c.is_deleted WHERE NOT m.is_deleted) x WHERE rn = 1) m
       ON t.account_ref = m.account_id AND t.created_day BETWEEN m.start_date AND m.end_date""",
)
def _(s):
    from revtrellis.operators.activity import latest_campaign

    newest = latest_campaign(s.table("crm_campaign_member"), s.table("crm_campaign"), "%").select(c("account_id").alias("account_ref"), "campaign_id", "start_date", "end_date")
    rows = s.table("act_task").select("id", "account_ref", "created_day").join(newest, "account_ref", "left")
    return rows.select("id", F.when(c("created_day").between(c("start_date"), c("end_date")), c("campaign_id")).alias("campaign_id"))


@query(
    "jn_type2_asof",
    """SELECT o.opportunity_id, h.manager_name FROM crm_opportunity o LEFT JOIN partner_recruiter_history h
       ON o.account_id = h.account_id AND o.created_date BETWEEN h.start_date AND h.end_date""",
)
def _(s):
    rows = s.table("crm_opportunity").select("opportunity_id", "account_id", "created_date")
    joined = joins.interval_join(rows, s.table("partner_recruiter_history"), ["account_id"], "created_date", "start_date", "end_date", "left", ["opportunity_id"])
    return joined.select("opportunity_id", "manager_name")


@query(
    "jn_snapshot_asof",
    """SELECT h.lead_id, h.end_date, d.programme, d.manager FROM lead_status_history h JOIN crm_lead l ON h.lead_id = l.lead_id
       JOIN partner_manager_daily d ON d.partner_id = l.owner_id AND d.on_date = h.end_date""",
)
def _(s):
    rows = s.table("lead_status_history").join(s.table("crm_lead").select("lead_id", c("owner_id").alias("partner_id")), "lead_id")
    daily = s.table("partner_manager_daily").withColumnRenamed("on_date", "end_date")
    return rows.join(daily, ["partner_id", "end_date"]).select("lead_id", "end_date", "programme", "manager")


@query(
    "jn_period_align",
    """SELECT w.worker_name, w.n, q.quota FROM (SELECT worker_name, worker_id, last_day(effective_on) AS m, count(*) AS n FROM hr_worker_daily GROUP BY ALL) w
       JOIN (SELECT payee_id, last_day(make_date(CAST(substring(period, 3, 4) AS INT), CAST(substring(period, 8, 2) AS INT), 1)) AS m, sum(quota) AS quota FROM hr_quota GROUP BY ALL) q
       ON w.worker_id = q.payee_id AND w.m = q.m""",
)
def _(s):
    w = s.table("hr_worker_daily").groupBy("worker_name", "worker_id", D.month_end("effective_on").alias("m")).agg(F.count("*").alias("n"))
    q = s.table("hr_quota").groupBy(c("payee_id").alias("worker_id"), F.last_day(D.period_month("period")).alias("m")).agg(F.sum("quota").alias("quota"))
    return w.join(q, ["worker_id", "m"]).select("worker_name", "n", "quota")


@query(
    "jn_or_condition",
    """SELECT DISTINCT w.worker_id, m.metric FROM (SELECT DISTINCT worker_id, CASE WHEN team = 'Sales Large' THEN 'D2C LA Acquisition' ELSE 'Ads' END AS team_group FROM hr_worker_daily) w
       JOIN scorecard_metric m ON (w.team_group = m.team_group AND m.metric_group NOT LIKE '99%') OR m.metric_group LIKE '99%'""",
)
def _(s):
    group = F.when(c("team") == "Sales Large", "D2C LA Acquisition").otherwise("Ads")
    left = s.table("hr_worker_daily").select("worker_id", group.alias("team_group")).distinct()
    right = s.table("scorecard_metric").select("team_group", "metric", "metric_group")
    return joins.join_group_or_global(left, right, "team_group", ~c("metric_group").like("99%")).select("worker_id", "metric").distinct()


@query(
    "jn_inequality_residual",
    """SELECT m.id, r.name, a.name AS guest FROM (SELECT id, calendar_id, unnest(attendees) AS att FROM act_meeting) m JOIN crm_user r ON m.calendar_id = r.email
       JOIN crm_user a ON a.email = m.att.email WHERE a.name = r.manager_name""",
)
def _(s):
    reps = s.table("crm_user").select(c("email").alias("calendar_id"), "name", "manager_name")
    guests = s.table("crm_user").select(c("email").alias("guest_email"), c("name").alias("guest"))
    rows = s.table("act_meeting").select("id", "calendar_id", F.explode("attendees").alias("a")).withColumn("guest_email", c("a.email"))
    return rows.join(reps, "calendar_id").join(guests, "guest_email").filter(c("guest") == c("manager_name")).select("id", "name", "guest")


@query("jn_semi_in", "SELECT shop_id, name FROM fin_shop WHERE shop_id IN (SELECT shop_id FROM fin_agreement WHERE terminated_on IS NOT NULL)")
def _(s):
    ended = s.table("fin_agreement").filter(c("terminated_on").isNotNull())
    return joins.semi_join(s.table("fin_shop").select("shop_id", "name"), ended, ["shop_id"])


@query(
    "jn_anti_null_aware",
    """SELECT deal_id, name FROM fin_deal WHERE deal_id NOT IN (SELECT original_deal_id FROM fin_deal WHERE original_deal_id IS NOT NULL)""",
)
def _(s):
    renewed = s.table("fin_deal").filter(c("original_deal_id").isNotNull()).select(c("original_deal_id").alias("deal_id"))
    return joins.anti_join_null_aware(s.table("fin_deal").select("deal_id", "name"), renewed, "deal_id")


@query(
    "jn_distinct_right",
    "SELECT o.opportunity_id, p.is_coselling FROM crm_opportunity o LEFT JOIN (SELECT DISTINCT opportunity_id, is_coselling FROM partner_relationship WHERE is_coselling) p ON o.opportunity_id = p.opportunity_id",
)
def _(s):
    right = s.table("partner_relationship").filter("is_coselling").dropDuplicates(["opportunity_id", "is_coselling"])
    return s.table("crm_opportunity").select("opportunity_id").join(right, "opportunity_id", "left")


@query(
    "jn_fact_preagg",
    """SELECT d.deal_id, coalesce(n, 0) AS n FROM fin_deal d LEFT JOIN (SELECT deal_id, count(*) AS n FROM fin_agreement WHERE NOT is_deleted GROUP BY deal_id) a USING (deal_id)""",
)
def _(s):
    counts = s.table("fin_agreement").filter(~c("is_deleted")).groupBy("deal_id").agg(F.count("*").alias("n"))
    return s.table("fin_deal").select("deal_id").join(counts, "deal_id", "left").select("deal_id", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "jn_wide_metric_assembly",
    """WITH facts AS (
         SELECT owner_name AS rep, last_day(created_date) AS m, count(*)::DOUBLE AS created, sum(total_revenue) AS revenue,
           count(CASE WHEN stage_name = 'Closed Won' THEN 1 END)::DOUBLE AS won FROM crm_opportunity GROUP BY ALL),
       grid AS (SELECT DISTINCT worker_name AS rep, last_day(effective_on) AS m, metric FROM hr_worker_daily, (VALUES ('created'), ('revenue'), ('won')) v(metric))
       SELECT g.rep, g.m, g.metric, coalesce(a.created, b.revenue, d.won) AS value FROM grid g
         LEFT JOIN facts a ON a.rep = g.rep AND a.m = g.m AND g.metric = 'created' LEFT JOIN facts b ON b.rep = g.rep AND b.m = g.m AND g.metric = 'revenue'
         LEFT JOIN facts d ON d.rep = g.rep AND d.m = g.m AND g.metric = 'won' WHERE coalesce(a.created, b.revenue, d.won) IS NOT NULL""",
)
def _(s):
    from revtrellis.operators.scorecard import to_long

    facts = s.table("crm_opportunity").groupBy(c("owner_name").alias("rep_name"), D.month_end("created_date").alias("month_date")).agg(
        F.count("*").alias("created"), F.sum("total_revenue").alias("revenue"), N.count_if(c("stage_name") == "Closed Won").alias("won")
    )
    long = to_long(facts, {"created": "created", "revenue": "revenue", "won": "won"})
    months = s.table("hr_worker_daily").select(c("worker_name").alias("rep_name"), D.month_end("effective_on").alias("month_date")).distinct()
    return long.join(months, ["rep_name", "month_date"]).select(c("rep_name").alias("rep"), c("month_date").alias("m"), "metric", "value")


# ---------------------------------------------------------------- aggregates


@query("agg_count_star", "SELECT stage_name, count(*) AS n FROM crm_opportunity GROUP BY stage_name")
def _(s):
    return s.table("crm_opportunity").groupBy("stage_name").agg(F.count("*").alias("n"))


@query("agg_count_col", "SELECT stage_name, count(close_date) AS n FROM crm_opportunity GROUP BY stage_name")
def _(s):
    return s.table("crm_opportunity").groupBy("stage_name").agg(F.count("close_date").alias("n"))


@query("agg_count_distinct", "SELECT stage_name, count(DISTINCT account_id) AS n FROM crm_opportunity GROUP BY stage_name")
def _(s):
    return s.table("crm_opportunity").groupBy("stage_name").agg(F.countDistinct("account_id").alias("n"))


@query("agg_count_if", "SELECT owner_id, count(CASE WHEN total_revenue > 250000 THEN 1 END) AS n FROM crm_opportunity GROUP BY owner_id")
def _(s):
    return s.table("crm_opportunity").groupBy("owner_id").agg(N.count_if(c("total_revenue") > 250000).alias("n"))


@query(
    "agg_count_distinct_if",
    """SELECT market_segment, count(DISTINCT CASE WHEN lead_group = 'Inbound' THEN opportunity_id END) AS inbound,
       count(DISTINCT CASE WHEN lead_group = 'Partner' THEN opportunity_id END) AS partner, count(DISTINCT opportunity_id) AS total FROM fact_metric GROUP BY market_segment""",
)
def _(s):
    # One row per (group, opportunity) with flags, then sums: no Expand over several distinct columns.
    per_opp = s.table("fact_metric").filter(c("opportunity_id").isNotNull()).groupBy("market_segment", "opportunity_id").agg(
        *[F.max(F.when(c("lead_group") == g, 1).otherwise(0)).alias(g.lower()) for g in ("Inbound", "Partner")]
    )
    return per_opp.groupBy("market_segment").agg(F.sum("inbound").alias("inbound"), F.sum("partner").alias("partner"), F.count("*").alias("total"))


@query("agg_sum", "SELECT owner_id, sum(total_revenue) AS revenue FROM crm_opportunity GROUP BY owner_id")
def _(s):
    return s.table("crm_opportunity").groupBy("owner_id").agg(F.sum("total_revenue").alias("revenue"))


@query(
    "agg_sum_if",
    """SELECT payee_id, sum(CASE WHEN attribute_id LIKE 'TOTAL%' THEN quota END) AS revenue_quota, sum(CASE WHEN attribute_id LIKE 'INCR%' THEN quota END) AS profit_quota
       FROM hr_quota GROUP BY payee_id""",
)
def _(s):
    return s.table("hr_quota").groupBy("payee_id").agg(
        N.sum_if(c("attribute_id").like("TOTAL%"), c("quota")).alias("revenue_quota"), N.sum_if(c("attribute_id").like("INCR%"), c("quota")).alias("profit_quota")
    )


@query("agg_avg", "SELECT owner_id, avg(close_date - created_date) AS days FROM crm_opportunity GROUP BY owner_id")
def _(s):
    return s.table("crm_opportunity").groupBy("owner_id").agg(F.avg(D.days_between("close_date", "created_date")).alias("days"))


@query("agg_avg_if", "SELECT owner_id, avg(CASE WHEN lead_source = 'Website' THEN close_date - created_date END) AS days FROM crm_opportunity GROUP BY owner_id")
def _(s):
    return s.table("crm_opportunity").groupBy("owner_id").agg(F.avg(F.when(c("lead_source") == "Website", D.days_between("close_date", "created_date"))).alias("days"))


@query("agg_min_max", "SELECT account_id, min(created_date) AS first_created, max(close_date) AS last_close FROM crm_opportunity GROUP BY account_id")
def _(s):
    return s.table("crm_opportunity").groupBy("account_id").agg(F.min("created_date").alias("first_created"), F.max("close_date").alias("last_close"))


@query("agg_max_by", "SELECT opportunity_id, arg_max(sales_price, product) AS price FROM fact_stage GROUP BY opportunity_id")
def _(s):
    return s.table("fact_stage").groupBy("opportunity_id").agg(F.max_by("sales_price", "product").alias("price"))


@query("agg_min_by", "SELECT opportunity_id, arg_min(total_locations, product) AS locations FROM fact_stage GROUP BY opportunity_id")
def _(s):
    return s.table("fact_stage").groupBy("opportunity_id").agg(F.min_by("total_locations", "product").alias("locations"))


@query("agg_any_value", "SELECT opportunity_id, min(product) AS product FROM fact_stage GROUP BY opportunity_id")
def _(s):
    return s.table("fact_stage").groupBy("opportunity_id").agg(F.min("product").alias("product"))


@query("agg_string_agg", "SELECT opportunity_id, string_agg(product, ', ' ORDER BY product) AS products FROM fact_stage GROUP BY opportunity_id")
def _(s):
    return s.table("fact_stage").groupBy("opportunity_id").agg(F.expr("listagg(product, ', ') WITHIN GROUP (ORDER BY product)").alias("products"))


@query(
    "agg_ratio_safe",
    "SELECT owner.id AS owner_id, sum(counts.meetings_booked)::DOUBLE / nullif(sum(counts.people_acted_on), 0) AS ratio FROM act_cadence GROUP BY owner.id",
)
def _(s):
    return s.table("act_cadence").groupBy(c("owner.id").alias("owner_id")).agg(
        N.safe_divide(F.sum("counts.meetings_booked"), F.sum("counts.people_acted_on")).alias("ratio")
    )


@query("agg_ratio_plain", "SELECT market_segment, sum(value) / nullif(count(DISTINCT opportunity_id), 0) AS mean FROM fact_metric GROUP BY market_segment")
def _(s):
    return s.table("fact_metric").groupBy("market_segment").agg(N.safe_divide(F.sum("value"), F.countDistinct("opportunity_id")).alias("mean"))


@query(
    "agg_ratio_guarded",
    """SELECT account_id, CASE WHEN count(close_date) > 0 THEN count(CASE WHEN stage_name = 'Closed Won' THEN 1 END)::DOUBLE / count(close_date) END AS win_rate
       FROM crm_opportunity GROUP BY account_id""",
)
def _(s):
    n = F.count("close_date")
    return s.table("crm_opportunity").groupBy("account_id").agg(F.when(n > 0, N.count_if(c("stage_name") == "Closed Won") / n).alias("win_rate"))


@query(
    "agg_inverse_mean",
    """SELECT account_id, CASE WHEN avg(close_date - created_date) > 0 THEN 1 / avg(close_date - created_date) ELSE avg(close_date - created_date) END AS speed
       FROM crm_opportunity GROUP BY account_id""",
)
def _(s):
    return s.table("crm_opportunity").groupBy("account_id").agg(N.inverse_mean(F.avg(D.days_between("close_date", "created_date"))).alias("speed"))


@query("agg_round_avg", "SELECT opportunity_owner, round(avg(CAST(term_length AS DOUBLE)), 2) AS term FROM fact_metric GROUP BY opportunity_owner")
def _(s):
    return s.table("fact_metric").groupBy("opportunity_owner").agg(F.round(F.avg(c("term_length").cast("double")), 2).alias("term"))


@query("agg_group_by_all", "SELECT opportunity_owner, last_day(full_date) AS m, value_type, sum(value) AS v FROM fact_metric GROUP BY ALL")
def _(s):
    return s.table("fact_metric").groupBy("opportunity_owner", D.month_end("full_date").alias("m"), "value_type").agg(F.sum("value").alias("v"))


@query("agg_group_by_ordinal", "SELECT sales_region, year, sum(value) AS v FROM fact_metric GROUP BY 1, 2")
def _(s):
    return s.table("fact_metric").groupBy("sales_region", "year").agg(F.sum("value").alias("v"))


@query("agg_group_by_alias", "SELECT last_day(full_date) AS month_date, count(*) AS n FROM fact_metric GROUP BY month_date")
def _(s):
    return s.table("fact_metric").groupBy(D.month_end("full_date").alias("month_date")).agg(F.count("*").alias("n"))


@query("agg_group_only", "SELECT lower(lead_source) AS lead_source, stage_name FROM crm_opportunity GROUP BY 1, 2")
def _(s):
    return s.table("crm_opportunity").select(F.lower("lead_source").alias("lead_source"), "stage_name").distinct()


@query(
    "agg_two_level",
    """SELECT owner_id, count(CASE WHEN n > 1 THEN 1 END)::DOUBLE / count(*) AS repeat_share
       FROM (SELECT owner_id, account_id, count(*) AS n FROM crm_opportunity GROUP BY owner_id, account_id) x GROUP BY owner_id""",
)
def _(s):
    inner = s.table("crm_opportunity").groupBy("owner_id", "account_id").agg(F.count("*").alias("n"))
    return inner.groupBy("owner_id").agg(N.safe_divide(N.count_if(c("n") > 1), F.count("*")).alias("repeat_share"))


@query(
    "agg_regional_plus_global",
    """SELECT market_segment, sales_region, count(DISTINCT opportunity_id) AS n, sum(value) AS v FROM fact_metric GROUP BY 1, 2
       UNION ALL SELECT market_segment, 'GLOBAL', count(DISTINCT opportunity_id), sum(value) FROM fact_metric GROUP BY 1""",
)
def _(s):
    per_opp = (
        s.table("fact_metric")
        .groupingSets([["market_segment", "sales_region", "opportunity_id"], ["market_segment", "opportunity_id"]], "market_segment", "sales_region", "opportunity_id")
        .agg(F.sum("value").alias("v"), F.grouping("sales_region").alias("g"))
    )
    region = F.when(c("g") == 1, "GLOBAL").otherwise(c("sales_region")).alias("sales_region")
    return per_opp.groupBy("market_segment", region).agg(F.count("opportunity_id").alias("n"), F.sum("v").alias("v"))


# ---------------------------------------------------------------- windows, sorts, sets


@query(
    "win_latest_per_key",
    """SELECT account_id, opportunity_id, created_date FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY created_date DESC, opportunity_id DESC) AS rn
       FROM crm_opportunity) x WHERE rn = 1""",
)
def _(s):
    rows = s.table("crm_opportunity").select("account_id", "opportunity_id", "created_date")
    return windows.latest_per_key(rows, ["account_id"], [F.desc("created_date"), F.desc("opportunity_id")])


@query(
    "win_rank_then_join_filter",
    """SELECT a.account_id, m.campaign_id FROM crm_account a LEFT JOIN (SELECT account_id, campaign_id,
         row_number() OVER (PARTITION BY account_id ORDER BY joined_date DESC, campaign_id DESC, lead_id DESC) AS ranking FROM crm_campaign_member) m
       ON a.account_id = m.account_id AND m.ranking = 1""",
)
def _(s):
    newest = windows.latest_per_key(s.table("crm_campaign_member"), ["account_id"], [F.desc("joined_date"), F.desc("campaign_id"), F.desc("lead_id")])
    return s.table("crm_account").select("account_id").join(newest.select("account_id", "campaign_id"), "account_id", "left")


@query(
    "win_dedupe_no_order",
    """SELECT lead_id, partner_id, updated_on FROM (SELECT reference_id AS lead_id, partner_id, updated_on,
         row_number() OVER (PARTITION BY reference_id, partner_id ORDER BY updated_on, shop_id) AS rn FROM partner_lead) x WHERE rn = 1""",
)
def _(s):
    rows = s.table("partner_lead").withColumnRenamed("reference_id", "lead_id")
    return windows.latest_per_key(rows, ["lead_id", "partner_id"], [F.asc("updated_on"), F.asc("shop_id")]).select("lead_id", "partner_id", "updated_on")


@query(
    "win_over_aggregate",
    """SELECT rep_name, m, snapshot_date, n FROM (SELECT rep_name, m, snapshot_date, n, row_number() OVER (PARTITION BY rep_name, m ORDER BY snapshot_date DESC) AS rn
       FROM (SELECT t.rep_name, last_day(s.snapshot_date) AS m, s.snapshot_date, count(*) AS n FROM account_snapshot s
         JOIN (SELECT DISTINCT rep_name, territory_name FROM territory_rep) t ON upper(s.territory_name) = upper(t.territory_name) GROUP BY 1, 2, 3) x) y WHERE rn = 1""",
)
def _(s):
    reps = s.table("territory_rep").select("rep_name", F.upper("territory_name").alias("k")).distinct()
    rows = s.table("account_snapshot").withColumn("k", F.upper("territory_name")).join(reps, "k")
    counts = rows.groupBy("rep_name", D.month_end("snapshot_date").alias("m"), "snapshot_date").agg(F.count("*").alias("n"))
    return windows.latest_per_key(counts, ["rep_name", "m"], [F.desc("snapshot_date")])


@query(
    "win_group_sequence",
    """SELECT rep, m, metric, row_number() OVER (PARTITION BY rep, m ORDER BY metric) AS position FROM
       (SELECT DISTINCT opportunity_owner AS rep, last_day(full_date) AS m, metric FROM fact_metric) x""",
)
def _(s):
    rows = s.table("fact_metric").select(c("opportunity_owner").alias("rep"), D.month_end("full_date").alias("m"), "metric").distinct()
    return rows.withColumn("position", F.row_number().over(Window.partitionBy("rep", "m").orderBy("metric")).cast("long"))


@query(
    "win_lag",
    """SELECT account_id, opportunity_id, close_date, lag(close_date) OVER (PARTITION BY account_id ORDER BY close_date, opportunity_id) AS previous_close
       FROM crm_opportunity WHERE close_date IS NOT NULL""",
)
def _(s):
    rows = s.table("crm_opportunity").filter(c("close_date").isNotNull()).select("account_id", "opportunity_id", "close_date")
    return windows.previous_day(rows, ["account_id"], "close_date", "opportunity_id", "previous_close")


@query(
    "win_partition_max",
    """SELECT partner_id, on_date, programme, max(CASE WHEN programme LIKE 'plus-%' THEN 'Yes' ELSE 'No' END) OVER (PARTITION BY partner_id, on_date) AS plus
       FROM partner_manager_daily""",
)
def _(s):
    flag = F.when(c("programme").like("plus-%"), "Yes").otherwise("No")
    return windows.key_maximum(s.table("partner_manager_daily"), ["partner_id", "on_date"], flag, "plus").select("partner_id", "on_date", "programme", "plus")


@query("srt_order_desc", "SELECT deal_id, name, end_date FROM fin_deal ORDER BY end_date DESC")
def _(s):
    return s.table("fin_deal").select("deal_id", "name", "end_date").orderBy(F.desc("end_date"), "deal_id")


@query("srt_order_multi", "SELECT opportunity_id, account_id, created_date FROM crm_opportunity ORDER BY created_date, opportunity_id")
def _(s):
    return s.table("crm_opportunity").select("opportunity_id", "account_id", "created_date").orderBy("created_date", "opportunity_id")


@query("set_union_all", "SELECT id, owner, type FROM act_event UNION ALL SELECT id, owner, type FROM act_task WHERE NOT deleted")
def _(s):
    return sets.union_all([s.table("act_event").select("id", "owner", "type"), s.table("act_task").filter(~c("deleted")).select("id", "owner", "type")])


@query(
    "set_union_all_many",
    " UNION ALL ".join(
        f"SELECT '{label}' AS stage, account_id, count(*) AS n FROM crm_opportunity WHERE {cond} GROUP BY account_id"
        for label, cond in [("created", "true"), ("closed", "close_date IS NOT NULL"), ("won", "stage_name = 'Closed Won'"), ("open", "close_date IS NULL")]
    ),
)
def _(s):
    # The branches are filters on one table, so rows are tagged with the branches they belong to and counted in one pass.
    stage = c("stage_name")
    tags = F.array(
        F.lit("created"), F.when(c("close_date").isNotNull(), "closed"), F.when(stage == "Closed Won", "won"), F.when(c("close_date").isNull(), "open")
    )
    rows = s.table("crm_opportunity").select("account_id", F.explode(F.array_compact(tags)).alias("stage"))
    return rows.groupBy("stage", "account_id").agg(F.count("*").alias("n"))


@query("set_union_distinct", "SELECT lead_id FROM crm_lead UNION SELECT legacy_id FROM legacy_lead UNION SELECT reference_id FROM partner_lead")
def _(s):
    return sets.union_distinct(
        [s.table("crm_lead").select("lead_id"), s.table("legacy_lead").select(c("legacy_id").alias("lead_id")), s.table("partner_lead").select(c("reference_id").alias("lead_id"))]
    )


# ---------------------------------------------------------------- scalar functions


@query("str_lower_upper", "SELECT o_orderkey, lower(o_orderpriority) AS lo, upper(o_orderpriority) AS up FROM orders")
def _(s):
    return s.table("orders").select("o_orderkey", F.lower("o_orderpriority").alias("lo"), F.upper("o_orderpriority").alias("up"))


@query("str_left", "SELECT p_partkey, left(p_name, 4) AS head FROM part")
def _(s):
    return s.table("part").select("p_partkey", X.first_chars("p_name", 4).alias("head"))


@query("str_substring", "SELECT doc_id, substring(text, 3, 20) AS part FROM documents")
def _(s):
    return s.table("documents").select("doc_id", F.substring("text", 3, 20).alias("part"))


@query("str_replace", "SELECT DISTINCT market_segment, replace(market_segment, 'SMB', 'Cross-Sell') AS label FROM fact_metric")
def _(s):
    return s.table("fact_metric").select("market_segment", F.replace("market_segment", F.lit("SMB"), F.lit("Cross-Sell")).alias("label")).distinct()


@query("str_concat", "SELECT DISTINCT year, quarter, CAST(year AS VARCHAR) || '-' || quarter AS yr_qtr FROM fact_metric")
def _(s):
    return s.table("fact_metric").select("year", "quarter", F.concat(c("year").cast("string"), F.lit("-"), c("quarter")).alias("yr_qtr")).distinct()


@query("str_concat_op", "SELECT shop_id, 'https://billing.example/shops/' || CAST(shop_id AS VARCHAR) || coalesce(email, '') AS url, 'x' || email AS maybe FROM fin_shop")
def _(s):
    url = F.concat(X.record_url("https://billing.example/shops/", c("shop_id")), F.coalesce("email", F.lit("")))
    return s.table("fin_shop").select("shop_id", url.alias("url"), F.concat(F.lit("x"), c("email")).alias("maybe"))


@query(
    "str_split_safe_offset",
    "SELECT lead_id, string_split(region_label, ' - ')[1] AS first_item, string_split(region_label, ' - ')[3] AS third_item FROM crm_lead",
)
def _(s):
    label = c("region_label")
    return s.table("crm_lead").select("lead_id", X.split_item(label, " - ", 0).alias("first_item"), X.split_item(label, " - ", 2).alias("third_item"))


@query(
    "str_regexp_extract",
    """SELECT lead_id, CASE WHEN regexp_matches(region_label, ' - (.+)$') THEN regexp_extract(region_label, ' - (.+)$', 1) END AS country,
       CASE WHEN regexp_matches(region_label, '^AMER - United States') THEN regexp_extract(region_label, '^AMER - United States', 0) END AS whole FROM crm_lead""",
)
def _(s):
    label = c("region_label")
    return s.table("crm_lead").select("lead_id", X.extract_or_null(label, r" - (.+)$", 1).alias("country"), X.extract_or_null(label, r"^AMER - United States", 0).alias("whole"))


@query("cst_safe_cast", "SELECT opportunity_id, TRY_CAST(winning_partner_id AS BIGINT) AS partner_id FROM crm_opportunity")
def _(s):
    return s.table("crm_opportunity").select("opportunity_id", F.expr("try_cast(winning_partner_id AS BIGINT)").alias("partner_id"))


@query("cst_cast", "SELECT worker_id, CAST(tenure_days AS BIGINT) AS days, CAST(worker_id AS VARCHAR) AS id_text FROM hr_worker")
def _(s):
    return s.table("hr_worker").select("worker_id", c("tenure_days").cast("long").alias("days"), c("worker_id").cast("string").alias("id_text"))


@query("mth_safe_divide", "SELECT id, counts.meetings_booked / nullif(counts.people_acted_on, 0) AS ratio FROM act_cadence")
def _(s):
    return s.table("act_cadence").select("id", N.safe_divide(c("counts.meetings_booked"), c("counts.people_acted_on")).alias("ratio"))


@query("mth_arith_round", "SELECT o_orderkey, round((floor(o_totalprice) - 7) * 3 / 4, 0) AS v, o_orderkey / 13 AS per_week FROM orders")
def _(s):
    return s.table("orders").select("o_orderkey", F.round((F.floor("o_totalprice") - 7) * 3 / 4, 0).alias("v"), (c("o_orderkey") / 13).alias("per_week"))


@query("dt_to_date", "SELECT event_id, CAST(ts AS DATE) AS d FROM events")
def _(s):
    return s.table("events").select("event_id", F.to_date("ts").alias("d"))


@query("dt_to_timestamp", "SELECT opportunity_id, CAST(created_date AS TIMESTAMP) AS t FROM crm_opportunity")
def _(s):
    return s.table("crm_opportunity").select("opportunity_id", c("created_date").cast("timestamp_ntz").alias("t"))


@query("dt_make_date", "SELECT payee_id, period, attribute_id, make_date(CAST(substring(period, 3, 4) AS INT), CAST(substring(period, 8, 2) AS INT), 1) AS d FROM hr_quota")
def _(s):
    return s.table("hr_quota").select("payee_id", "period", "attribute_id", D.period_month("period").alias("d"))


@query(
    "dt_trunc",
    """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q, CAST(date_trunc('day', o_orderdate) AS DATE) AS d FROM orders""",
)
def _(s):
    day = F.to_date("o_orderdate")
    return s.table("orders").select("o_orderkey", F.trunc(day, "month").alias("m"), D.quarter_start("o_orderdate").alias("q"), day.alias("d"))


@query("dt_week_monday", "SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS w FROM orders")
def _(s):
    return s.table("orders").select("o_orderkey", D.week_start_monday("o_orderdate").alias("w"))


@query("dt_last_day_month", "SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS m FROM orders")
def _(s):
    return s.table("orders").select("o_orderkey", D.month_end("o_orderdate").alias("m"))


@query("dt_last_day_quarter", "SELECT o_orderkey, last_day(CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE)) AS q FROM orders")
def _(s):
    return s.table("orders").select("o_orderkey", D.quarter_end("o_orderdate").alias("q"))


@query("dt_diff_day", "SELECT opportunity_id, date_diff('day', created_date, close_date) AS days FROM crm_opportunity")
def _(s):
    return s.table("crm_opportunity").select("opportunity_id", D.days_between("close_date", "created_date").cast("long").alias("days"))


@query("dt_diff_minute", "SELECT id, date_diff('minute', start_time, end_time) AS minutes FROM act_meeting")
def _(s):
    return s.table("act_meeting").select("id", D.minutes_between("end_time", "start_time").alias("minutes"))


@query(
    "dt_add_sub",
    """SELECT opportunity_id, created_date + 1 AS next_day, CAST(created_date - INTERVAL 14 MONTH AS DATE) AS earlier, created_date - 30 AS month_ago FROM crm_opportunity""",
)
def _(s):
    return s.table("crm_opportunity").select(
        "opportunity_id", F.date_add("created_date", 1).alias("next_day"), F.add_months("created_date", -14).alias("earlier"), F.date_sub("created_date", 30).alias("month_ago")
    )


@query("dt_extract", "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders")
def _(s):
    return s.table("orders").select("o_orderkey", F.year("o_orderdate").cast("long").alias("y"), F.month("o_orderdate").cast("long").alias("m"))


@query("dt_extract_week_sunday", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%U') AS BIGINT) AS w FROM orders")
def _(s):
    return s.table("orders").select("o_orderkey", D.week_number_sunday("o_orderdate").alias("w"))


@query("dt_format_names", "SELECT o_orderkey, strftime(o_orderdate, '%B') AS month_name, strftime(o_orderdate, '%A') AS weekday FROM orders")
def _(s):
    return s.table("orders").select("o_orderkey", F.date_format("o_orderdate", "MMMM").alias("month_name"), F.date_format("o_orderdate", "EEEE").alias("weekday"))


@query(
    "dt_current_date_tz",
    """SELECT opportunity_id, DATE '1998-06-16' - created_date AS age FROM crm_opportunity WHERE created_date <= DATE '1998-06-16'""",
)
def _(s):
    # Five in the morning of the 17th, universal time, is still the 16th in Los Angeles.
    today = D.today_in("America/Los_Angeles", now=F.lit("1998-06-17 05:00:00").cast("timestamp"))
    return s.table("crm_opportunity").filter(c("created_date") <= today).select("opportunity_id", D.days_between(today, "created_date").cast("long").alias("age"))


# ---------------------------------------------------------------- nested data


@query("nst_struct_field", "SELECT id, sender.id AS sender_id, counts.replies AS replies FROM act_email")
def _(s):
    return s.table("act_email").select("id", c("sender.id").alias("sender_id"), c("counts.replies").alias("replies"))


@query(
    "nst_unnest_structs",
    "SELECT lead_id, rp.partner_id, rp.partner_name, rp.referred_on, rp.referral_index FROM (SELECT lead_id, unnest(referring_partners) AS rp FROM partner_referral) x",
)
def _(s):
    from revtrellis.operators.partners import referring_partners

    return referring_partners(s.table("partner_referral"))


@query(
    "nst_unnest_strings",
    "SELECT DISTINCT partner_id FROM (SELECT partner_id, unnest(memberships) AS m FROM partner) x WHERE m LIKE '%payment%'",
)
def _(s):
    from revtrellis.operators.partners import payment_partners

    return payment_partners(s.table("partner"))

