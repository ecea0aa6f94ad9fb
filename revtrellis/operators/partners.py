"""Leads and the partners behind them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrellis.functions.dates import as_date, days_between
from revtrellis.functions.numbers import zero_if_null
from revtrellis.functions.text import extract_or_null
from revtrellis.operators.joins import calendar_interval_join, left_join_nullable
from revtrellis.operators.sets import union_distinct
from revtrellis.operators.windows import latest_per_key
from revtrellis.params import fixed_values as V


def referring_partners(referrals: DataFrame) -> DataFrame:
    """One row per lead and referral; leads without referrals have none."""
    return referrals.select("lead_id", F.explode("referring_partners").alias("rp")).select("lead_id", "rp.*")


def consolidated_ids(leads: DataFrame, referrals: DataFrame) -> DataFrame:
    """Distinct lead ids over all sources.

    Leads known from the legacy system are found by joining back to the leads, so they are
    a subset of them and add nothing to the union.
    """
    return union_distinct([leads.select("lead_id"), referring_partners(referrals).select("lead_id")]).filter(F.col("lead_id").isNotNull())


def partner_lead_latest(partner_leads: DataFrame, ids: DataFrame) -> DataFrame:
    """Newest partner record per lead and membership."""
    rows = partner_leads.filter(F.col("reference_object") == "Lead").withColumnRenamed("reference_id", "lead_id")
    # Dealt by both keys, else the sorts and aggregates of these rows would hold their memory in the task that joins them by lead.
    rows = rows.join(ids, "lead_id", "left_semi").repartition("lead_id", "membership_id")
    return latest_per_key(rows, ["lead_id", "membership_id"], [F.desc("updated_on"), F.desc("shop_id"), F.desc("partner_id")])


def lead_owner(leads: DataFrame, users: DataFrame) -> DataFrame:
    names = users.select(F.col("user_id").alias("owner_id"), F.col("name").alias("lead_owner_name"))
    return leads.select("lead_id", "owner_id", F.col("owner_role").alias("lead_owner_role")).join(names, "owner_id", "left").drop("owner_id")


def status_latest(history: DataFrame) -> DataFrame:
    """Last end date of a status per lead."""
    return history.groupBy("lead_id").agg(F.max("end_date").alias("current_status_date"))


def region_of(label: Column) -> Column:
    return extract_or_null(label, r"^([^ -]+) -", 1)


def country_of(label: Column) -> Column:
    return F.when(label.rlike(r"^AMER - United States"), "United States").otherwise(extract_or_null(label, r" - (.+)$", 1))


def gmv_band(revenue: Column, half_open: bool = False) -> Column:
    """Verified online revenue to a band.

    The bands of the reports end one unit below the next one and leave exactly
    200 million out, so such values are 'Unknown'; ``half_open`` closes the gaps.
    """
    edges = [0, 2_000_000, 5_000_000, 40_000_000, 200_000_000]
    names = ["0-2M", "2-5M", "5-40M", "40-200M"]
    out = None
    for low, high, name in zip(edges, edges[1:], names):
        cond = ((revenue >= low) & (revenue < high)) if half_open else revenue.between(low, high - 1)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    top = revenue >= edges[-1] if half_open else revenue > edges[-1]
    return out.when(top, "200M+").otherwise("Unknown")


def revenue_total(online: Column, offline: Column) -> Column:
    """Null when either part is null."""
    return online + offline


MANAGER_PRIORITY = ["plus", "partners", "agency", "retail"]


def manager_asof(daily: DataFrame) -> DataFrame:
    """Manager per partner and day: the first programme of the priority list that has one.

    The daily history is reduced to one row per (partner, day), so looking the manager up is
    one equality join and never multiplies rows.
    """
    handle = F.lower("programme")
    kind = (
        F.when(handle.like("plus-partners%"), "plus")
        .when(handle == "partners", "partners")
        .when(handle.like("agency%"), "agency")
        .when(handle.like("retail_partnerships%"), "retail")
    )
    rows = daily.withColumn("_kind", kind).filter(F.col("_kind").isNotNull())
    per_kind = [F.min(F.when(F.col("_kind") == k, F.col("manager"))) for k in MANAGER_PRIORITY]
    plus = F.max(F.when((F.col("_kind") == "plus") & F.col("programme").like("plus-%"), 1).otherwise(0))
    return rows.groupBy("partner_id", "on_date").agg(F.coalesce(*per_kind).alias("programme_manager"), (plus == 1).alias("in_plus_programme"))


def type2_asof(df: DataFrame, history: DataFrame, key: str, day: str, out: str, as_of: date) -> DataFrame:
    """Attribute valid on a row's day; unmatched rows stay, overlapping periods multiply."""
    spans = history.select(F.col("account_id").alias(key), F.col("manager_name").alias(out), "start_date", "end_date")
    low, high = date(as_of.year - 10, 1, 1), date(as_of.year + 1, 12, 31)
    joined = calendar_interval_join(df, spans, [key], day, "start_date", "end_date", how="left", unit="year", low=low, high=high, spread_on=["lead_id"])
    return joined.drop("start_date", "end_date")


def payment_partners(partners: DataFrame, pattern: str = "%payment%") -> DataFrame:
    """Partners with a membership of the payment programmes."""
    members = partners.select("partner_id", F.explode("memberships").alias("membership"))
    return members.filter(F.col("membership").like(pattern)).select("partner_id").distinct()


def outcome_ids() -> dict[str, Column]:
    """Lead id in the column of each outcome it had."""
    pick = lambda cond: F.when(cond, F.col("lead_id"))
    return {
        "qualified_lead_id": pick(F.col("sales_ready_date").isNotNull()),
        "disqualified_id": pick(F.col("disqualified_date").isNotNull()),
        "nurture_id": pick(F.col("nurture_date").isNotNull()),
        "unworked_id": pick(F.col("sales_ready_date").isNull()),
    }


def closed_won_dates(facts: DataFrame) -> DataFrame:
    won = facts.filter((F.col("dataset") == "Actuals") & (F.col("metric") == "Closed Won") & (F.col("value_type") == "Product Deal Count"))
    return won.filter(F.col("opportunity_id").isNotNull()).groupBy("opportunity_id").agg(F.min("close_date").alias("closed_won_date"))


def lead_campaigns(source) -> DataFrame:
    """First campaign by name per lead: reports keep one row per lead and partner."""
    names = source.table("crm_campaign").select("campaign_id", "campaign_name")
    # Dealt by campaign even if the names are small enough for a broadcast: members that come dealt by lead would otherwise stay
    # in the task that joins everything by lead, with all the operators that made them.
    members = source.table("crm_campaign_member").select("lead_id", "campaign_id").repartition("campaign_id")
    return members.join(names, "campaign_id").groupBy("lead_id").agg(F.min("campaign_name").alias("campaign_name"))


def _common_columns(source, leads: DataFrame) -> DataFrame:
    """What both kinds of lead rows share: raw record, legacy record, owner, status, opportunity."""
    raw = source.table("crm_lead_raw")
    raw_cols = raw.select(
        "lead_id", "routing_segment", "is_customer", "organization_id", F.col("retail_locations").alias("_raw_locations"),
        F.col("company").alias("_raw_company"), "partner_involvement", "online_revenue_verified", "lead_grade", "mql_date", "referrer_name",
        "referrer_email", F.col("last_activity_date").alias("_raw_activity"),
    )
    legacy = source.table("legacy_lead").select(F.col("legacy_id").alias("lead_id"), F.col("company").alias("_legacy_company"), "number_of_locations", F.col("last_activity_date").alias("_legacy_activity"))
    opps = source.table("crm_opportunity").select(
        F.col("opportunity_id").alias("converted_opportunity_id"), F.col("stage_name").alias("current_stage_name"),
        F.col("offline_revenue").alias("opp_offline_revenue"), F.col("online_revenue_verified").alias("opp_online_revenue"),
        F.col("total_revenue").alias("opp_total_revenue"), "winning_partner_id",
    )
    opps = opps.join(closed_won_dates(source.table("fact_metric")).withColumnRenamed("opportunity_id", "converted_opportunity_id"), "converted_opportunity_id", "left")
    rows = leads.drop("owner_id", "legacy_id").join(lead_owner(raw, source.table("crm_user")), "lead_id", "left")
    rows = rows.join(raw_cols, "lead_id", "left").join(legacy, "lead_id", "left")
    rows = rows.join(status_latest(source.table("lead_status_history")), "lead_id", "left")
    rows = rows.join(lead_campaigns(source), "lead_id", "left")
    rows = left_join_nullable(rows, opps, ["converted_opportunity_id"], ["lead_id"])
    return rows.withColumns(
        {
            "retail_locations": F.coalesce("_raw_locations", "number_of_locations"),
            "company": F.coalesce("_raw_company", "_legacy_company"),
            "last_activity_date": F.coalesce("_raw_activity", "_legacy_activity"),
            "country_name": country_of(F.col("region_label")),
            "region": region_of(F.col("region_label")),
            "opp_total_revenue_verified": revenue_total(F.col("opp_online_revenue"), F.col("opp_offline_revenue")),
            "winning_partner": F.expr("try_cast(winning_partner_id AS BIGINT)"),
        }
    ).drop("_raw_locations", "number_of_locations", "_raw_company", "_legacy_company", "_raw_activity", "_legacy_activity", "winning_partner_id", "region_label")


def _by_partner() -> Column:
    return F.coalesce(F.col("lead_source_original").isin(*V.PARTNER_LEAD_SOURCES), F.lit(False))


def _join_through(rows: DataFrame, more: DataFrame) -> DataFrame:
    """Left join by lead for the rows that came through a partner; the others meet nothing."""
    more = more.withColumnRenamed("lead_id", "_of_lead")
    return rows.join(more, (F.col("lead_id") == F.col("_of_lead")) & F.col("_through"), "left").drop("_of_lead")


def lead_rows(source, leads: DataFrame, through_partner: Column) -> DataFrame:
    """Enriched rows of both kinds of leads in one chain of joins.

    Leads that came through a partner get one row per referral and membership, and the partner's attributes;
    the others meet none of these and keep one row.
    """
    ids = consolidated_ids(source.table("crm_lead"), source.table("partner_referral"))
    referrals = referring_partners(source.table("partner_referral")).select(
        "lead_id", F.col("partner_id").alias("_referred"), F.col("referred_on").cast("string").alias("referral_timestamp"),
        F.col("referral_index").cast("string").alias("referral_index"),
    )
    countries = source.table("geo_country").select("country_code", "sub_region", "market_maturity")
    records = partner_lead_latest(source.table("partner_lead"), ids).join(countries, "country_code", "left").select(
        "lead_id", F.col("partner_id").alias("_recorded"), F.col("shop_id").cast("string").alias("shop_id"), "sub_region", "market_maturity"
    )
    partners = source.table("partner").select(
        F.col("partner_id").alias("_pid"), "partner_name", F.col("sub_region").alias("partner_sub_region"), "management_model", "partner_type", F.lit(True).alias("_known")
    )
    managers = manager_asof(source.table("partner_manager_daily")).select(
        F.col("partner_id").alias("_managed"), F.col("on_date").alias("current_status_date"), F.col("programme_manager").alias("partner_manager"), "in_plus_programme"
    )
    accounts = source.table("crm_account").select(F.col("account_id").alias("_segment_key"), "market_segment")
    rows = leads.withColumn("_through", through_partner)
    # All joins by lead follow each other, so the rows are dealt by lead once.
    rows = _join_through(_join_through(rows, records), referrals)
    rows = _common_columns(source, rows)
    rows = rows.withColumn("partner_id", F.coalesce("_referred", "_recorded", "winning_partner"))
    rows = rows.withColumn("_pid", F.when(F.col("_through"), F.col("partner_id")))
    rows = left_join_nullable(rows, partners, ["_pid"], ["lead_id"])
    rows = rows.withColumn("_managed", F.when(F.col("_known"), F.col("_pid")))
    rows = left_join_nullable(rows, managers, ["_managed", "current_status_date"], ["lead_id"])
    rows = rows.withColumn("_segment_key", F.when(~F.col("_through"), F.col("converted_account_id")))
    rows = left_join_nullable(rows, accounts, ["_segment_key"], ["lead_id"])
    through = F.col("_through")
    return rows.withColumns(
        {
            "plus_program": F.when(through, F.when(F.col("in_plus_programme"), "Yes").otherwise("No")),
            "sales_assistance": F.when(through, F.col("partner_involvement")).otherwise(F.when(F.col("mql_date").isNotNull(), "Yes").otherwise("No")),
            "gmv_band": F.when(~through, gmv_band(F.col("online_revenue_verified"))),
            "mql_date": F.when(~through, F.col("mql_date")),
        }
    ).drop("_referred", "_recorded", "_pid", "_known", "_managed", "_segment_key", "in_plus_programme", "winning_partner", "partner_involvement", "online_revenue_verified")


def partner_lead_rows(source, leads: DataFrame | None = None) -> DataFrame:
    """Enriched row per lead, referral and partner membership; ids known from a referral alone have a row too."""
    ids = consolidated_ids(source.table("crm_lead"), source.table("partner_referral"))
    leads = ids.join(source.table("crm_lead"), "lead_id", "left") if leads is None else leads
    return lead_rows(source, leads, F.lit(True)).drop("_through")


def marketing_lead_rows(source, leads: DataFrame | None = None) -> DataFrame:
    """Enriched row per lead that did not come through a partner or outbound work."""
    leads = source.table("crm_lead") if leads is None else leads
    leads = leads.filter(~F.col("lead_source_original").isin(*V.NON_MARKETING_LEAD_SOURCES))
    return lead_rows(source, leads, F.lit(False)).drop("_through")


def lead_partner_report(rows: DataFrame, source, as_of: date, bounded: bool = True) -> DataFrame:
    """Type-2 owners, programme flags and outcomes; one row per lead and partner.

    The row is picked before the histories are joined, because they depend on the lead and partner only;
    of several overlapping periods the first name in order is kept.
    """
    one_per = ["lead_id", "partner_id"]
    rows = latest_per_key(rows, one_per, [F.asc_nulls_last("referral_index"), F.asc_nulls_last("shop_id")])
    payment = payment_partners(source.table("partner")).withColumn("_payment", F.lit(True))
    dimension = source.table("partner").join(payment, "partner_id", "left").select(
        "partner_id", F.col("partner_name").alias("_dim_name"), "partner_account_id", F.col("recruiter").alias("_dim_recruiter"), "_payment"
    )
    rows = left_join_nullable(rows, dimension, ["partner_id"], ["lead_id"])
    always = {"start_date": F.lit(date(1900, 1, 1)), "end_date": F.lit(date(9999, 12, 31))}
    for table, out in (("partner_developer_history", "_developer"), ("partner_recruiter_history", "_recruiter")):
        history = source.table(table) if bounded else source.table(table).withColumns(always)
        rows = type2_asof(rows, history, "partner_account_id", "created_date", out, as_of)
        rows = latest_per_key(rows, one_per, [F.asc_nulls_last(out)])
    return rows.withColumns(
        {
            "metric_name": F.when(F.col("_through"), "PQL").otherwise("MQL"),
            **outcome_ids(),
            "days_in_current_status": days_between(as_date(as_of), "current_status_date"),
            "opp_offline_revenue": zero_if_null(F.col("opp_offline_revenue")),
            "opp_online_revenue": zero_if_null(F.col("opp_online_revenue")),
            "partner_manager": F.coalesce("_developer", "partner_manager"),
            "partner_recruiter": F.coalesce("_recruiter", "_dim_recruiter"),
            "partner_name": F.coalesce("partner_name", "_dim_name"),
            "payment_program": F.when(F.col("_payment"), "Yes").otherwise("No"),
            "partner_region": F.col("region"),
            "partner_country": F.col("country_name"),
        }
    ).drop("_through", "_dim_name", "_dim_recruiter", "_payment", "_developer", "_recruiter")


def _marketing_leads() -> Column:
    return ~F.col("lead_source_original").isin(*V.NON_MARKETING_LEAD_SOURCES)


def partner_qualified_leads(source, as_of: date, bounded: bool = True) -> DataFrame:
    rows = lead_rows(source, source.table("crm_lead").filter(_by_partner()), F.lit(True))
    return lead_partner_report(rows, source, as_of, bounded)


def marketing_qualified_leads(source, as_of: date, bounded: bool = True) -> DataFrame:
    rows = lead_rows(source, source.table("crm_lead").filter(_marketing_leads()), F.lit(False))
    return lead_partner_report(rows, source, as_of, bounded)


def leads_with_role(source, as_of: date) -> DataFrame:
    """Both kinds of leads in one table, with the attributes of the owner's role."""
    leads = source.table("crm_lead").filter(_by_partner() | _marketing_leads())
    both = lead_partner_report(lead_rows(source, leads, _by_partner()), source, as_of)
    roles = source.table("crm_role_attribute").select(
        F.col("rep_role").alias("lead_owner_role"), "team_segment", F.col("market_segment").alias("owner_market_segment")
    )
    return left_join_nullable(both, roles, ["lead_owner_role"], ["lead_id"])
