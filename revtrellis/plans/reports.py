"""One function per report. Each takes a table source and returns the rows of one output table."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrellis.operators import activity, billing, cube, funnel, partners, retail, scorecard
from revtrellis.operators.funnel import FunnelSpec
from revtrellis.operators.retail import RetailSpec
from revtrellis.params import fixed_values as V

# Owner roles of the internal retail team and of the outsourced team.
INTERNAL_RETAIL_ROLES = ("%AMER-SDR-LA-RETAIL%", "%AMER-SDR-MM-RETAIL%", "%AMER-SDR-SMB-RETAIL%")
PARTNER_TEAM_AMER = ("AMER-%N3%",)
PARTNER_TEAM_EMEA = ("EMEA-%N3%",)

INTERNAL_RETAIL = FunnelSpec(
    opportunities_from=date(2024, 1, 1),
    facts_from_year=2024,
    creation_role_patterns=INTERNAL_RETAIL_ROLES[:1],
    owner_role_patterns=INTERNAL_RETAIL_ROLES[1:],
    lead_role_patterns=INTERNAL_RETAIL_ROLES,
    lead_year_column="mql_date",
    lead_year=2024,
    kept_role_patterns=INTERNAL_RETAIL_ROLES,
    enriched_after=date(2024, 2, 6),
    with_enriched=True,
)
PARTNER_AMER = FunnelSpec(
    opportunities_from=date(2024, 1, 1),
    facts_from_year=2024,
    creation_role_patterns=PARTNER_TEAM_AMER,
    owner_role_patterns=PARTNER_TEAM_AMER,
    lead_role_patterns=PARTNER_TEAM_AMER,
    lead_year_column="created_date",
    lead_year=2024,
    kept_role_patterns=PARTNER_TEAM_AMER,
    restate_before=date(2024, 1, 1),
    restate_to=date(2024, 1, 25),
    enriched_after=date(2024, 2, 6),
    with_enriched=True,
    needs_campaigns=True,
)
PARTNER_EMEA = FunnelSpec(
    opportunities_from=date(2024, 1, 1),
    facts_from_year=2024,
    creation_role_patterns=PARTNER_TEAM_EMEA,
    owner_role_patterns=PARTNER_TEAM_EMEA,
    lead_role_patterns=PARTNER_TEAM_EMEA,
    lead_year_column="created_date",
    lead_year=2024,
    kept_role_patterns=PARTNER_TEAM_EMEA,
    restate_before=date(2024, 1, 1),
    restate_to=date(2024, 1, 25),
)
TOP_OF_FUNNEL = FunnelSpec(
    opportunities_from=date(2023, 7, 1),
    facts_from=date(2023, 7, 1),
    fact_columns=("lead_group", "team_segment"),
    leads_from=date(2023, 7, 1),
    leads_only=True,
    with_segment=True,
)


@dataclass(frozen=True)
class BillingSpec:
    """Names of the caller's billing system."""

    plan_name: str = "premium"
    internal_pattern: str = "%@internal%"
    deal_url: str = "https://billing.example/deals/"
    shop_url: str = "https://billing.example/shops/"


@dataclass(frozen=True)
class ScorecardSpec:
    from_date: date = date(2024, 7, 1)
    snapshot: date = date(2025, 2, 3)
    tiers: list[str] = field(default_factory=lambda: ["Tier 1", "Tier 2", "Tier 3"])


def internal_retail(source, spec: FunnelSpec = INTERNAL_RETAIL) -> DataFrame:
    return funnel.lead_opportunity_funnel(source, spec)


def partner_team_amer(source, lead_campaigns: tuple[str, ...], excluded_accounts: tuple[str, ...], spec: FunnelSpec = PARTNER_AMER) -> DataFrame:
    """Without its campaigns the report would drop the leads that come in by them, so they are no part of the default settings."""
    if not lead_campaigns:
        raise ValueError("the campaigns whose leads the report takes in are missing")
    return funnel.lead_opportunity_funnel(source, replace(spec, lead_campaigns=tuple(lead_campaigns), excluded_accounts=tuple(excluded_accounts)))


def partner_team_emea(source, spec: FunnelSpec = PARTNER_EMEA) -> DataFrame:
    return funnel.lead_opportunity_funnel(source, spec)


def top_of_funnel(source, spec: FunnelSpec = TOP_OF_FUNNEL) -> DataFrame:
    return funnel.lead_opportunity_funnel(source, spec)


def retail_funnel(source, as_of: date, spec: RetailSpec = RetailSpec()) -> DataFrame:
    return retail.long_funnel(source, spec, as_of)


def closed_conversion(source, as_of: date, spec: RetailSpec = RetailSpec(inbound_sources=tuple(V.INBOUND_SOURCES_CONVERSION))) -> DataFrame:
    return retail.closed_conversion(source, spec, as_of)


def leads(source, as_of: date) -> DataFrame:
    return partners.leads_with_role(source, as_of)


def campaign_accounts_all(source, joined_from: date = date(2023, 1, 1), split_heavy: bool = False) -> DataFrame:
    return activity.campaign_accounts(source, joined_from=joined_from, split_heavy=split_heavy)


def campaign_accounts(source, campaign_ids: list[str], fact_campaigns: list[str], split_heavy: bool = False) -> DataFrame:
    return activity.campaign_accounts(source, campaign_ids=campaign_ids, fact_campaigns=fact_campaigns, split_heavy=split_heavy)


def outbound_activity(source, as_of: date | None, from_date: date = date(2023, 1, 1)) -> DataFrame:
    return activity.outbound_activity(source, as_of, from_date).orderBy(
        "completed_date", "task_assigned_to", "task_assigned_to_role", "market_segment", "team_segment", "sales_region", "activity_class", "on_watchlist"
    )


def influenced_opportunities(source) -> DataFrame:
    return activity.influenced_opportunities(source).orderBy("task_completed_date", "opportunity_id", "task_id")


def expired_deals(source, as_of: date, spec: BillingSpec = BillingSpec()) -> DataFrame:
    rows = billing.expired_deals(source.table("fin_deal"), source.table("fin_agreement"), as_of, spec.deal_url)
    return rows.orderBy(F.desc("active_shops"), *[c for c in rows.columns if c != "active_shops"])


def nondev_stores(source) -> DataFrame:
    return billing.nondev_stores(source.table("fin_shop"), source.table("fin_agreement"))


def orphans(source, as_of: date, spec: BillingSpec = BillingSpec()) -> DataFrame:
    rows = billing.orphan_shops(source, as_of, spec.plan_name, spec.internal_pattern, spec.shop_url)
    return rows.select("reason", "shop_url", "name", "base_price").orderBy(F.desc("base_price"), "shop_url", "reason", "name")


def orphans_managed(source, as_of: date, spec: BillingSpec = BillingSpec()) -> DataFrame:
    rows = billing.orphan_shops(source, as_of, spec.plan_name, spec.internal_pattern, spec.shop_url)
    return billing.orphan_reasons(rows, source.table("fin_shop_dimension"), source.table("crm_account"))


def quarterly_review(source) -> DataFrame:
    return cube.quarterly_review(source.table("fact_metric"))


def rep_scorecard(source, as_of: date, spec: ScorecardSpec = ScorecardSpec()) -> DataFrame:
    return scorecard.scorecard(source, as_of, spec.from_date, spec.snapshot, spec.tiers)
