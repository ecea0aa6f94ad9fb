"""Retail opportunities: buckets, actor classes, product grain, stages and counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrellis.functions.dates import days_between, whole_months_window
from revtrellis.functions.numbers import lookup
from revtrellis.functions.text import split_item
from revtrellis.operators.funnel import band_midpoint_text
from revtrellis.operators.joins import left_join_nullable
from revtrellis.operators.sets import tag, union_all
from revtrellis.params import fixed_values as V


@dataclass(frozen=True)
class RetailSpec:
    """Names that belong to the caller's business."""

    location_product: str = "Point of Sale"
    payment_product: str = "Retail Payments"
    actors_from: date = date(2023, 6, 1)
    solution_team_pattern: str = "SC"
    outsourced_pattern: str = "N3"
    inhouse_label: str = "In-house"
    outsourced_label: str = "N3"
    campaign_pattern: str = "%migration%"
    programme_labels: tuple[str, str, str] = ("Must Win", "Other", "None")
    rest_of_world: str = "Rest of the World"
    inbound_sources: Sequence[str] = tuple(V.INBOUND_SOURCES_FUNNEL)
    low_band_countries: Sequence[str] = tuple(V.LOW_BAND_COUNTRIES)

    @property
    def both_products(self) -> str:
        return f"{self.location_product} + {self.payment_product}"


def lead_source_bucket(source: Column, inbound: Sequence[str]) -> Column:
    """Outbound / Partner / Demand-Gen / Other Inbound; an unknown source is outbound."""
    text = F.lower(source)
    return (
        F.when(text.isNull() | text.isin(*V.OUTBOUND_SOURCES), "Outbound")
        .when(text.isin(*V.PARTNER_SOURCES), "Partner")
        .when(text.isin(*inbound), "Demand-Gen")
        .otherwise("Other Inbound")
    )


def lead_source_dimension(opportunities: DataFrame, inbound: Sequence[str]) -> DataFrame:
    """Lower-cased sources that occur on opportunities, each with its bucket."""
    sources = opportunities.select(F.lower("lead_source").alias("source_key")).distinct()
    return sources.withColumn("lead_source_bucket", lead_source_bucket(F.col("source_key"), inbound))


def actor_class(role: Column, created: Column, spec: RetailSpec) -> Column:
    """Rep or solution consultant, in-house or outsourced; not told apart before a date."""
    solution, outsourced = role.rlike(spec.solution_team_pattern), role.rlike(spec.outsourced_pattern)
    return (
        F.when(created < F.lit(spec.actors_from), "N/A")
        .when(~solution & ~outsourced, f"{spec.inhouse_label} Rep")
        .when(solution & ~outsourced, f"{spec.inhouse_label} SC")
        .when(outsourced & ~solution, f"{spec.outsourced_label} Rep")
        .when(outsourced & solution, f"{spec.outsourced_label} SC")
        .otherwise("OTHER")
    )


def programme_tag(must_win: Column, campaign: Column, merchant: Column, spec: RetailSpec) -> Column:
    first, other, none = spec.programme_labels
    return F.when(must_win == "Y", first).when(F.lower(campaign).like(spec.campaign_pattern) | merchant.isNotNull(), other).otherwise(none)


def normalise_region(region: Column) -> Column:
    return F.when(region == "NA", "AMER").otherwise(region)


def fold_unknown_region(region: Column) -> Column:
    return F.when(region.isin(*V.UNKNOWN_REGIONS), "Unknown Region").otherwise(normalise_region(region))


def opportunity_attributes(source, spec: RetailSpec) -> DataFrame:
    """One enriched row per opportunity."""
    merchants = source.table("programme_merchant").select(
        F.expr("try_cast(shop_id AS BIGINT)").alias("primary_shop_id"), F.col("shop_id").alias("merchant_shop"), "promo_code"
    )
    programmes = source.table("programme_list").select("promo_code", "must_win")
    campaigns = source.table("crm_campaign").select("campaign_id", "campaign_name")
    merchants = merchants.filter(F.col("primary_shop_id").isNotNull()).join(programmes, "promo_code", "left").drop("promo_code")
    return (
        source.table("crm_opportunity")
        .join(merchants, "primary_shop_id", "left")
        .join(campaigns, "campaign_id", "left")
        .select(
            "opportunity_id",
            F.col("close_date").alias("closed_date"),
            "created_date",
            "opportunity_type",
            "account_id",
            F.col("stage_name").alias("current_stage_name"),
            F.lower("lead_source").alias("lead_source"),
            lead_source_bucket(F.col("lead_source"), spec.inbound_sources).alias("lead_source_bucket"),
            "country_code",
            normalise_region(F.col("sales_region")).alias("region"),
            programme_tag(F.col("must_win"), F.col("campaign_name"), F.col("merchant_shop"), spec).alias("programme"),
            actor_class(F.col("role_at_creation"), F.col("created_date"), spec).alias("created_by"),
            actor_class(F.col("sales_rep_role"), F.col("created_date"), spec).alias("owned_by"),
            "primary_shop_id",
            "market_segment",
        )
    )


def product_grain_collapse(facts: DataFrame, spec: RetailSpec) -> DataFrame:
    """Opportunity × product rows to one row per opportunity and team."""
    return (
        facts.filter(F.col("product").isin(spec.location_product, spec.payment_product))
        .groupBy("opportunity_id", "team_segment")
        .agg(
            F.min("product").alias("any_product"),
            F.max_by("sales_price", "product").alias("amount"),
            F.min_by("total_locations", "product").alias("locations"),
            F.countDistinct("product").alias("product_count"),
        )
    )


def product_conditioned(spec: RetailSpec) -> dict[str, Column]:
    """Joint label; no locations for payments alone, no amount for locations alone."""
    single = F.col("product_count") == 1
    return {
        "product_name": F.when(single, F.col("any_product")).otherwise(spec.both_products),
        "number_of_locations": F.when(single & (F.col("any_product") == spec.payment_product), F.lit(0.0)).otherwise(F.col("locations")),
        "payments_amount": F.when(single & (F.col("any_product") == spec.location_product), F.lit(0.0)).otherwise(F.col("amount")),
    }


def sal_qualify(facts: DataFrame, spec: RetailSpec) -> DataFrame:
    """Opportunities accepted by sales and the day they were."""
    stages = ["envision_at", "solution_at", "demonstrate_at", "deal_craft_at"]
    return (
        facts.filter(F.col("product").isin(spec.location_product, spec.payment_product))
        .filter(F.coalesce(*stages).isNotNull() | F.col("is_won"))
        .groupBy("opportunity_id")
        .agg(F.min(F.coalesce(*stages, "closed_at")).alias("qualified_sal_date"))
        .withColumn("is_sal", F.lit(1))
    )


def stage_label(stage: Column, is_sal: Column) -> Column:
    """Current stage. An opportunity never accepted has a null flag, so it is not 'Not Accepted'."""
    return (
        F.when(stage == "Pre-Qualified", stage)
        .when(is_sal != 1, "Not Accepted")
        .when(stage.isin("Closed Lost", "Closed Won"), stage)
        .otherwise("In progress")
    )


def eligible_country(eligible_since: Column, value: Column, spec: RetailSpec) -> Column:
    return F.when(eligible_since.isNotNull(), value).otherwise(spec.rest_of_world)


def retail_opportunities(source, spec: RetailSpec) -> DataFrame:
    """Opportunity-grain base of both retail reports."""
    facts = source.table("fact_stage")
    countries = source.table("geo_country").select("country_code", "country_name", "eligible_since")
    base = product_grain_collapse(facts, spec).join(opportunity_attributes(source, spec), "opportunity_id")
    base = base.join(countries, "country_code", "left").join(sal_qualify(facts, spec), "opportunity_id", "left")
    return base.select(
        "opportunity_id",
        "created_date",
        "closed_date",
        "lead_source",
        "lead_source_bucket",
        "team_segment",
        eligible_country(F.col("eligible_since"), F.col("country_code"), spec).alias("country_code"),
        eligible_country(F.col("eligible_since"), F.col("country_name"), spec).alias("country_name"),
        F.col("region").alias("region_code"),
        F.coalesce("is_sal", F.lit(0)).alias("sal"),
        "qualified_sal_date",
        *[c.alias(n) for n, c in product_conditioned(spec).items()],
        "programme",
        stage_label(F.col("current_stage_name"), F.col("is_sal")).alias("current_stage"),
        "current_stage_name",
        "primary_shop_id",
        "opportunity_type",
        "created_by",
        "owned_by",
        "market_segment",
    )


FUNNEL_KEYS = [
    "region_code", "country_name", "country_code", "event_date", "current_stage", "lead_source", "lead_source_bucket",
    "opportunity_type", "product_name", "location_band", "revenue_band", "metric", "programme", "created_by", "owned_by",
    "market_segment", "team_segment",
]
FUNNEL_MEASURES = ["total_locations", "total_payments_amount", "total_leads"]


def stage_counts(base: DataFrame, metric: str, event_date: str) -> DataFrame:
    """Sums and counts of one funnel stage over the common keys."""
    rows = base.withColumn("event_date", F.col(event_date))
    rows = tag(rows, location_band="Not Applicable", revenue_band="Not Applicable", metric=metric)
    return rows.groupBy(*FUNNEL_KEYS).agg(
        F.sum("number_of_locations").alias("total_locations"),
        F.sum("payments_amount").alias("total_payments_amount"),
        F.count("opportunity_id").alias("total_leads"),
    )


def first_active(daily: DataFrame) -> DataFrame:
    """First day with activity per organisation."""
    return daily.filter(F.col("ending_active") >= 1).groupBy("organization_id").agg(F.min("snapshot_date").alias("first_active"))


def won_retail_opportunities(source, spec: RetailSpec) -> DataFrame:
    """Won opportunities with a retail product, with only what the organisation lookup needs."""
    retail = source.table("fact_stage").filter(F.col("product").isin(spec.location_product, spec.payment_product))
    won = source.table("crm_opportunity").filter(F.col("stage_name") == "Closed Won").join(retail, "opportunity_id", "left_semi")
    return won.select("opportunity_id", F.col("close_date").alias("closed_date"), F.col("primary_shop_id").alias("shop_id"))


def last_closed_per_org(won: DataFrame, shops: DataFrame, active: DataFrame) -> DataFrame:
    """Latest won opportunity of each organisation, with the organisation's first active day."""
    latest = F.max_by("opportunity_id", F.struct("closed_date", "opportunity_id")).alias("opportunity_id")
    won = won.join(shops, "shop_id", "left").groupBy("organization_id").agg(latest)
    return won.join(active, "organization_id", "left").withColumnRenamed("first_active", "first_active_date")


def location_band_text(answer: Column) -> Column:
    """Band of a lead's own answer."""
    return F.coalesce(lookup(answer, V.LOCATION_BANDS), answer, F.lit("06. Unknown"))


def location_band_number(n: Column) -> Column:
    return (
        F.when(n == 1, "01. 1")
        .when(n.between(2, 5), "02. 2-5")
        .when(n.between(6, 10), "03. 6-10")
        .when(n > 10, "04. 10+")
        .otherwise("06. Unknown")
    )


def mql_team(owner_role: Column, spec: RetailSpec) -> Column:
    return F.when(owner_role.like(f"AMER-%{spec.outsourced_pattern}%"), f"{spec.outsourced_label} Retail for MQL only").otherwise("Internal for MQL only")


NOT_FOR_MQL = {
    "current_stage": "Not Applicable for MQLs",
    "opportunity_type": "Not Applicable for MQLs",
    "product_name": "Not Applicable for MQLs",
    "programme": "Not Applicable for MQLs",
    "created_by": "Not Applicable for MQLs",
    "owned_by": "Not Applicable for MQLs",
    "market_segment": "Not Applicable for MQLs",
    "metric": "01. Marketing qualified leads",
}


def mql_counts(source, spec: RetailSpec) -> DataFrame:
    """Marketing-qualified leads by region, band and source."""
    raw = source.table("crm_lead_raw").filter(~F.col("is_deleted")).select("lead_id", "offline_revenue_band", "retail_locations", F.col("owner_role").alias("raw_owner_role"))
    legacy = source.table("legacy_lead").select(F.col("legacy_id").alias("lead_id"), F.col("revenue_band").alias("legacy_band"))
    leads = source.table("crm_lead").filter((F.col("product_interest") == spec.location_product) & ~F.col("lead_source").like("%partner%"))
    countries = source.table("geo_country").select("country_name", F.col("country_code"))
    rows = leads.join(raw, "lead_id").join(legacy, "lead_id", "left")
    rows = rows.withColumns(
        {
            "_region": split_item(F.col("region_label"), " - ", 0),
            "country_name": split_item(F.col("region_label"), " - ", 1),
            "_band": F.coalesce("offline_revenue_band", "legacy_band"),
        }
    )
    rows = left_join_nullable(rows, countries, ["country_name"], ["lead_id"])
    qualifying = F.col("_band").isin(*V.QUALIFYING_BANDS) | (F.col("country_code").isin(*spec.low_band_countries) & F.col("_band").isin(*V.LOW_BANDS))
    buckets = lead_source_dimension(source.table("crm_opportunity"), spec.inbound_sources)
    rows = rows.filter(qualifying).withColumn("source_key", F.lower("lead_source")).join(buckets, "source_key", "left").select(
        F.when(F.col("_region").isin("AMER", "APAC", "EMEA", "LATAM"), F.col("_region")).otherwise("Unknown Region").alias("region_code"),
        "country_name",
        "country_code",
        F.col("sales_ready_date").alias("event_date"),
        "lead_source",
        F.coalesce("lead_source_bucket", F.lit("Outbound")).alias("lead_source_bucket"),
        location_band_text(F.col("retail_locations")).alias("location_band"),
        band_midpoint_text(F.col("offline_revenue_band")).alias("revenue_band"),
        mql_team(F.col("raw_owner_role"), spec).alias("team_segment"),
    )
    counts = tag(rows, **NOT_FOR_MQL).groupBy(*FUNNEL_KEYS).agg(F.count("*").alias("total_leads"))
    return counts.withColumns({"total_locations": F.lit(0.0), "total_payments_amount": F.lit(0.0)}).select(*FUNNEL_KEYS, *FUNNEL_MEASURES)


def inbound_call_mql(base: DataFrame) -> DataFrame:
    """Opportunities from inbound calls, counted once more as qualified leads."""
    rows = base.filter(F.col("lead_source") == "inbound sales inquiry").withColumns(
        {
            "event_date": F.col("created_date"),
            "location_band": location_band_number(F.col("number_of_locations")),
            "total_locations": F.coalesce("number_of_locations", F.lit(0.0)),
            "total_payments_amount": F.coalesce("payments_amount", F.lit(0.0)),
        }
    )
    rows = tag(rows, **NOT_FOR_MQL)
    rows = tag(rows, lead_source="inbound call", revenue_band="Not Available for Inbound Calls", team_segment="Not Applicable for MQLs")
    return rows.groupBy(*FUNNEL_KEYS, "total_locations", "total_payments_amount").agg(F.count("*").alias("total_leads"))


def long_funnel(source, spec: RetailSpec, as_of) -> DataFrame:
    """All stages in one long table, from 14 months back to the end of the quarter ahead.

    The stages and the inbound calls are variants of one base row, so the base is expanded once and
    aggregated once; dates outside the window never reach the aggregation. Inbound calls are grouped by their
    locations and amount instead of summing them.
    """
    base = retail_opportunities(source, spec)
    org = last_closed_per_org(won_retail_opportunities(source, spec), source.table("org_shop"), first_active(source.table("org_daily")))
    activated = org.filter(F.col("first_active_date").isNotNull()).select("opportunity_id", "first_active_date")
    own = ["current_stage", "opportunity_type", "product_name", "programme", "created_by", "owned_by", "market_segment", "lead_source", "team_segment"]
    stage_texts = {**{c: F.col(c) for c in own}, "location_band": F.lit("Not Applicable"), "revenue_band": F.lit("Not Applicable")}
    call_texts = {
        **{k: F.lit(v) for k, v in NOT_FOR_MQL.items() if k != "metric"},
        "lead_source": F.lit("inbound call"),
        "team_segment": F.lit("Not Applicable for MQLs"),
        "location_band": location_band_number(F.col("number_of_locations")),
        "revenue_band": F.lit("Not Available for Inbound Calls"),
    }
    names = [*own, "location_band", "revenue_band"]

    def variant(metric: str, day: str, texts: dict[str, Column], by_size: bool) -> Column:
        size = {
            "_locations": F.when(F.lit(by_size), F.coalesce("number_of_locations", F.lit(0.0))),
            "_amount": F.when(F.lit(by_size), F.coalesce("payments_amount", F.lit(0.0))),
        }
        parts = {"metric": F.lit(metric), "event_date": F.col(day), **{n: texts[n] for n in names}, **size}
        return F.struct(*[v.alias(k) for k, v in parts.items()])

    variants = F.array(
        variant("02. Sales qualified lead", "created_date", stage_texts, False),
        F.when(F.col("sal") == 1, variant("03. Sales accepted lead", "closed_date", stage_texts, False)),
        F.when(F.col("current_stage") == "Closed Won", variant("04. Closed won", "closed_date", stage_texts, False)),
        F.when(F.col("first_active_date").isNotNull(), variant("05. Retail FWAS", "first_active_date", stage_texts, False)),
        F.when(F.col("lead_source") == "inbound sales inquiry", variant(NOT_FOR_MQL["metric"], "created_date", call_texts, True)),
    )
    window = whole_months_window(F.col("event_date"), as_of, 14, 3)
    kept = ["region_code", "country_name", "country_code", "lead_source_bucket", "opportunity_id", "number_of_locations", "payments_amount"]
    rows = base.join(activated, "opportunity_id", "left").select(*kept, F.explode(variants).alias("_v")).filter(F.col("_v").isNotNull())
    rows = rows.select(*kept, "_v.*").filter(window)
    staged = rows.groupBy(*FUNNEL_KEYS, "_locations", "_amount").agg(
        F.coalesce("_locations", F.sum("number_of_locations")).alias("total_locations"),
        F.coalesce("_amount", F.sum("payments_amount")).alias("total_payments_amount"),
        F.count("opportunity_id").alias("total_leads"),
    )
    return union_all([mql_counts(source, spec).filter(window), staged.select(*FUNNEL_KEYS, *FUNNEL_MEASURES)])


def opportunity_revenue_max(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("opportunity_id").agg(
        F.max("total_revenue").alias("total_revenue"),
        F.max("product_profit").alias("product_profit"),
        F.max("product_attach_count").alias("product_attach_count"),
        F.max("subscription_revenue").alias("subscription_revenue"),
        F.max("sales_accepted").alias("sales_accepted"),
    )


def cycle_days() -> dict[str, Column]:
    """Summed days between stages; only closed (and accepted) opportunities count."""
    closed, accepted = F.col("is_closed"), (F.col("sal") == 1) & F.col("is_closed")
    total = lambda cond, days: F.sum(F.when(cond, days).otherwise(0))
    return {
        "sql_to_sal_days": total(accepted, days_between("qualified_sal_date", "created_date")),
        "sal_to_closed_days": total(accepted, days_between("closed_date", "qualified_sal_date")),
        "sql_to_closed_days": total(closed, days_between("closed_date", "created_date")),
        "sql_to_won_days": total(F.col("is_won"), days_between("closed_date", "created_date")),
    }


def conversion_counts(spec: RetailSpec) -> dict[str, Column]:
    won = F.col("is_won")
    money = lambda c: F.sum(F.when(won, F.col(c)).otherwise(F.lit(0.0)))
    flag = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    return {
        "total_opportunities": F.count("opportunity_id"),
        "closed_count": flag(F.col("is_closed")),
        "sal_count": flag((F.col("sal") == 1) & F.col("is_closed")),
        "won_count": flag(won),
        "payments_amount_won": money("payments_amount"),
        "locations_won": money("number_of_locations"),
        "product_profit_won": money("product_profit"),
        "both_products_won": flag(won & (F.col("product_name") == spec.both_products)),
        "location_product_won": flag(won & F.col("product_name").isin(spec.both_products, spec.location_product)),
    }


CONVERSION_KEYS = [
    "closed_date", "created_date", "opportunity_type", "opportunity_id", "lead_source_bucket", "lead_source", "product_name",
    "region_code", "country_name", "programme", "created_by", "owned_by", "market_segment", "team_segment",
]


def conversion_base(source, spec: RetailSpec) -> DataFrame:
    stage = F.col("current_stage_name")
    return retail_opportunities(source, spec).withColumns(
        {
            "is_closed": F.coalesce(stage.isin("Closed Lost", "Closed Won"), F.lit(False)),
            "is_won": F.coalesce(stage == "Closed Won", F.lit(False)),
            "region_code": fold_unknown_region(F.col("region_code")),
        }
    )


def closed_conversion(source, spec: RetailSpec, as_of) -> DataFrame:
    """Conversion and cycle time of closed opportunities, from 20 months back to this month."""
    base = conversion_base(source, spec).filter(whole_months_window(F.col("closed_date"), as_of, 20, 1))
    joined = base.join(opportunity_revenue_max(source.table("fact_opportunity_revenue")), "opportunity_id", "left")
    measures = {**cycle_days(), **conversion_counts(spec)}
    return joined.groupBy(*CONVERSION_KEYS).agg(*[c.alias(n) for n, c in measures.items()])
