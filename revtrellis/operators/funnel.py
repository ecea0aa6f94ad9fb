"""Lead and opportunity funnel: enrichment, full join, estimates, flags."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrellis.functions.numbers import cap, lookup
from revtrellis.functions.text import any_like
from revtrellis.operators.joins import full_outer_nullable, left_join_nullable
from revtrellis.params.fixed_values import ENRICHED_REVENUE_CAP, REVENUE_BAND_MIDPOINT


@dataclass(frozen=True)
class FunnelSpec:
    """What distinguishes one team's funnel from another's."""

    opportunities_from: date
    facts_from_year: int | None = None
    facts_from: date | None = None
    fact_columns: tuple[str, ...] = ("lead_group",)
    creation_role_patterns: tuple[str, ...] = ()
    owner_role_patterns: tuple[str, ...] = ()
    lead_role_patterns: tuple[str, ...] = ()
    lead_year_column: str | None = None
    lead_year: int | None = None
    lead_campaigns: tuple[str, ...] = ()
    leads_from: date | None = None
    leads_only: bool = False
    kept_role_patterns: tuple[str, ...] = ()
    restate_before: date | None = None
    restate_to: date | None = None
    enriched_after: date | None = None
    with_enriched: bool = False
    with_segment: bool = False
    excluded_accounts: tuple[str, ...] = field(default=())
    needs_campaigns: bool = False  # leads that come in by campaign belong to the team, so its settings are not complete without them


def band_midpoint(band: Column) -> Column:
    return lookup(band, REVENUE_BAND_MIDPOINT)


def band_midpoint_text(band: Column) -> Column:
    return lookup(band, {k: str(v) for k, v in REVENUE_BAND_MIDPOINT.items()})


def enriched_cap(revenue: Column) -> Column:
    return cap(revenue, float(ENRICHED_REVENUE_CAP))


def offline_estimate(qualified: Column, midpoint: Column, enriched: Column, after: date) -> Column:
    """Band midpoint; for leads qualified after the cut-off a missing one is the enriched value."""
    return F.when((qualified > F.lit(after)) & midpoint.isNull(), enriched).otherwise(midpoint)


def restate(day: Column, before: date, to: date) -> Column:
    """Dates before the cut-off move to one fixed date; nulls stay null."""
    return F.when(day < F.lit(before), F.lit(to)).otherwise(day)


def funnel_flags(qualified: Column) -> dict[str, Column]:
    lead, opp = F.col("lead_id"), F.col("opportunity_id")
    flag = lambda c: F.when(c, 1).otherwise(0)
    return {
        "is_lead": flag(lead.isNotNull()),
        "is_mql": flag(qualified.isNotNull()),
        "is_sql": flag(opp.isNotNull()),
        "sql_source": F.when(lead.isNull(), "Outbound")
        .when(opp.isNull(), "No SQL")
        .when(qualified.isNull(), "Lead not qualified")
        .otherwise("MQL"),
        "is_sal": flag(~F.col("opp_stage_name").isin("Pre-Qualified", "Closed Lost")),
    }


def segment_from_gaps(owner_role: Column, account: Column, band: Column) -> Column:
    """Segment of leads parked with a forecasting role, told from what is missing."""
    parked = F.lower(owner_role).like("%forecasting%role%")
    return (
        F.when(parked & account.isNotNull() & band.isNull(), "MM")
        .when(parked & account.isNull() & band.isNotNull(), "Retail")
        .when(parked & account.isNull() & band.isNull(), "D2C MM")
    )


def role_filter(first: Column, first_patterns, second: Column | None = None, second_patterns=()) -> Column:
    """Either role matches its patterns."""
    cond = any_like(first, first_patterns)
    return cond | any_like(second, second_patterns) if second is not None else cond


def enrich_opportunities(source, spec: FunnelSpec) -> DataFrame:
    """Opportunities of the team with lead group, owner role and committed revenue."""
    facts = source.table("fact_metric").filter(F.col("dataset") == "Actuals")
    if spec.facts_from_year is not None:
        facts = facts.filter(F.col("year") >= spec.facts_from_year)
    if spec.facts_from is not None:
        facts = facts.filter(F.col("full_date") >= F.lit(spec.facts_from))
    renamed = [F.col(c).alias("fact_" + c) for c in spec.fact_columns]
    facts = facts.filter(F.col("opportunity_id").isNotNull()).select("opportunity_id", *renamed).distinct()
    owners = source.table("crm_user").select(F.col("user_id").alias("owner_id"), "user_role_id")
    roles = source.table("crm_role").select("user_role_id", F.col("role_name").alias("opp_owner_role"))
    opps = (
        source.table("crm_opportunity")
        .filter(~F.col("is_deleted") & (F.col("created_date") >= F.lit(spec.opportunities_from)))
        .join(owners, "owner_id", "left")
        .join(roles, "user_role_id", "left")
    )
    if spec.creation_role_patterns:
        opps = opps.filter(role_filter(F.col("role_at_creation"), spec.creation_role_patterns, F.col("opp_owner_role"), spec.owner_role_patterns))
    return opps.join(facts, "opportunity_id", "left").select(
        "opportunity_id",
        F.col("role_at_creation").alias("sdr_role"),
        "opp_owner_role",
        F.col("created_date").alias("opp_created_date"),
        F.col("stage_name").alias("opp_stage_name"),
        F.col("offline_revenue").alias("opp_offline_revenue"),
        F.coalesce("committed_revenue", "verified_revenue").alias("opp_committed_revenue"),
        F.coalesce("fact_lead_group", F.lit("Unknown")).alias("lead_group"),
        *[F.col("fact_" + c).alias(c) for c in spec.fact_columns if c != "lead_group"],
    )


def enrich_leads(source, spec: FunnelSpec) -> DataFrame:
    """Leads of the team with owner name and account territory.

    Campaign membership only qualifies a lead here, so it is a semi-join style flag
    and does not multiply leads.
    """
    leads = source.table("crm_lead_raw").filter(~F.col("is_deleted"))
    if spec.leads_from is not None:
        leads = leads.filter(F.col("created_date") >= F.lit(spec.leads_from))
    if spec.lead_role_patterns:
        wanted = any_like(F.col("owner_role"), spec.lead_role_patterns) & (F.year(spec.lead_year_column) == spec.lead_year)
        if spec.lead_campaigns:
            named = source.table("crm_campaign").filter(F.col("campaign_name").isin(*spec.lead_campaigns)).select("campaign_id")
            listed = source.table("crm_campaign_member").join(named, "campaign_id", "left_semi").select("lead_id").distinct()
            leads = leads.join(listed.withColumn("_listed", F.lit(True)), "lead_id", "left")
            wanted = wanted | F.coalesce("_listed", F.lit(False))
        leads = leads.filter(wanted)
    accounts = source.table("crm_account").select(F.col("account_id").alias("converted_account_id"), "account_id", "territory_name")
    owners = source.table("crm_user").select(F.col("user_id").alias("owner_id"), F.col("name").alias("lead_owner_name"))
    # A repeated lead stays here: it makes equal rows, which the funnel drops after its join anyway.
    return (
        leads.join(accounts, "converted_account_id", "left")
        .join(owners, "owner_id", "left")
        .select(
            "lead_id",
            F.col("owner_role").alias("lead_owner"),
            F.col("owner_id").alias("lead_owner_id"),
            "lead_owner_name",
            "lead_source",
            "status",
            "offline_revenue_band",
            "enriched_revenue",
            "created_date",
            "mql_date",
            "sal_date",
            "region_label",
            "converted_account_id",
            "converted_opportunity_id",
            "is_customer",
            "retail_locations",
            "disqualified_reason",
            "territory_name",
            "account_id",
        )
    )


def lead_opportunity_outer(leads: DataFrame, opps: DataFrame, spec: FunnelSpec) -> DataFrame:
    """Both sides kept; a lead filter afterwards makes it a plain left join."""
    if spec.leads_only:
        joined = left_join_nullable(leads.withColumn("opportunity_id", F.col("converted_opportunity_id")), opps.withColumn("_found", F.col("opportunity_id")), ["opportunity_id"], ["lead_id"])
        joined = joined.withColumn("opportunity_id", F.col("_found")).drop("_found").select(*leads.columns, *opps.columns)
    else:
        joined = full_outer_nullable(leads, opps, "converted_opportunity_id", "opportunity_id", ["lead_id"], ["opportunity_id"])
        if spec.kept_role_patterns:
            p = spec.kept_role_patterns
            joined = joined.filter(F.col("lead_id").isNotNull() | role_filter(F.col("sdr_role"), p, F.col("opp_owner_role"), p))
    return joined.distinct()


def finish_funnel(joined: DataFrame, spec: FunnelSpec) -> DataFrame:
    """Estimates and flags on the joined rows."""
    qualified = F.col("mql_date")
    out = joined.withColumn("lead_midpoint_revenue", band_midpoint(F.col("offline_revenue_band")).cast("double"))
    if spec.with_enriched:
        out = out.withColumn("enriched_revenue_capped", enriched_cap(F.col("enriched_revenue")))
    if spec.restate_before is not None:
        out = out.withColumns(
            {
                "restated_created_date": restate(F.col("created_date"), spec.restate_before, spec.restate_to),
                "restated_mql_date": restate(F.col("mql_date"), spec.restate_before, spec.restate_to),
            }
        )
        qualified = F.col("restated_mql_date")
    if spec.with_segment:
        out = out.withColumn("segment", segment_from_gaps(F.col("lead_owner"), F.col("account_id"), F.col("offline_revenue_band")))
    estimate = F.col("lead_midpoint_revenue")
    if spec.enriched_after is not None:
        estimate = offline_estimate(qualified, estimate, F.col("enriched_revenue_capped"), spec.enriched_after)
    out = out.withColumns({"lead_estimated_offline_revenue": estimate, **funnel_flags(qualified)})
    if spec.excluded_accounts:
        out = out.filter(~F.coalesce("account_id", F.lit("")).isin(*spec.excluded_accounts))
    return out


def lead_opportunity_funnel(source, spec: FunnelSpec) -> DataFrame:
    if spec.needs_campaigns and not spec.lead_campaigns:
        raise ValueError("these settings need lead_campaigns: leads that come in by campaign would be missing")
    return finish_funnel(lead_opportunity_outer(enrich_leads(source, spec), enrich_opportunities(source, spec), spec), spec)
