"""Billing exceptions: expired deals, live agreements, shops that pay without a live deal."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrellis.functions.dates import as_date
from revtrellis.functions.text import record_url
from revtrellis.operators.joins import anti_join_null_aware

DEAD_DEALS = "Something is wrong"
NO_DEAL = "No billing deal at all"


def live_on(terminated: Column, as_of, inclusive: bool) -> Column:
    day = as_date(as_of)
    return terminated.isNull() | ((terminated >= day) if inclusive else (terminated > day))


def active_shops(agreements: DataFrame, as_of) -> DataFrame:
    """Live agreements per deal."""
    live = agreements.filter(~F.col("is_deleted") & live_on(F.col("terminated_on"), as_of, inclusive=False))
    return live.groupBy("deal_id").agg(F.count("*").alias("active_shops"))


def expired_deals(deals: DataFrame, agreements: DataFrame, as_of: date, base_url: str) -> DataFrame:
    """Deals past their end, neither terminated nor renewed, with the shops still on them."""
    renewed = deals.filter(~F.col("is_deleted") & F.col("original_deal_id").isNotNull()).select(F.col("original_deal_id").alias("deal_id"))
    expired = deals.filter(F.col("terminated_on").isNull() & (F.col("end_date") < as_date(as_of)) & ~F.col("is_deleted"))
    expired = anti_join_null_aware(expired, renewed, "deal_id").join(active_shops(agreements, as_of), "deal_id", "left")
    return expired.select(
        record_url(base_url, F.col("deal_id")).alias("billing_deal"), "name", "start_date", "end_date", F.coalesce("active_shops", F.lit(0)).alias("active_shops")
    )


def nondev_stores(shops: DataFrame, agreements: DataFrame, dev_reason: str = "Development/Staging shop") -> DataFrame:
    """Live agreements of shops that are not development shops."""
    live = agreements.filter((F.col("reason") != dev_reason) & F.col("terminated_on").isNull() & ~F.col("is_deleted"))
    return live.join(shops.select("shop_id", "name", "domain"), "shop_id").select("name", "domain", "shop_id", "reason", "deal_id")


def plan_sets(deals: DataFrame, agreements: DataFrame, as_of) -> dict[str, DataFrame]:
    """Shops of ended plans, of live plans, and of any live agreement."""
    deal_cols = deals.select("deal_id", F.col("terminated_on").alias("deal_terminated_on"), F.col("is_deleted").alias("deal_deleted"))
    both = agreements.select("deal_id", "shop_id", "terminated_on", "is_deleted").join(deal_cols, "deal_id")
    ended = F.col("deal_terminated_on").isNotNull() & F.col("terminated_on").isNotNull() & ~F.col("is_deleted") & ~F.col("deal_deleted")
    live = live_on(F.col("deal_terminated_on"), as_of, True) & live_on(F.col("terminated_on"), as_of, True)
    return {
        "inactive": both.filter(ended).select("shop_id"),
        "active": both.filter(live).select("shop_id"),
        "any": agreements.filter(live_on(F.col("terminated_on"), as_of, True)).select("shop_id"),
    }


def paying_shops(source, plan_name: str, internal_pattern: str) -> DataFrame:
    """Shops on the paid plan; internal e-mail addresses and missing ones are left out."""
    subscriptions = source.table("fin_subscription").filter(F.col("plan_name") == plan_name).select("subscription_id", "base_price")
    accounts = source.table("fin_account").withColumnRenamed("current_subscription_id", "subscription_id").join(subscriptions, "subscription_id")
    shops = source.table("fin_shop").filter(~F.col("email").like(internal_pattern))
    return shops.join(accounts.select("billing_account_id", "base_price"), "billing_account_id").select("shop_id", "name", "base_price")


def shop_plan_flags(deals: DataFrame, agreements: DataFrame, as_of) -> DataFrame:
    """Per shop: has it an ended plan, a live plan, any live agreement. One join, combined before the shuffle."""
    deal_cols = deals.select("deal_id", F.col("terminated_on").alias("deal_terminated_on"), F.col("is_deleted").alias("deal_deleted"), F.lit(True).alias("_deal"))
    both = agreements.select("deal_id", "shop_id", "terminated_on", "is_deleted").join(deal_cols, "deal_id", "left")
    ended = F.col("deal_terminated_on").isNotNull() & F.col("terminated_on").isNotNull() & ~F.col("is_deleted") & ~F.col("deal_deleted")
    live_agreement = live_on(F.col("terminated_on"), as_of, True)
    live_plan = F.col("_deal") & live_on(F.col("deal_terminated_on"), as_of, True) & live_agreement
    any_of = lambda cond: F.max(F.when(cond, 1).otherwise(0)) == 1
    return both.groupBy("shop_id").agg(any_of(ended).alias("has_ended"), any_of(live_plan).alias("has_live"), any_of(live_agreement).alias("has_any"))


def orphan_shops(source, as_of, plan_name: str, internal_pattern: str, base_url: str) -> DataFrame:
    """Paying shops whose deals all ended, and paying shops without any live agreement.

    The three shop lists are flags of one aggregate. ``NOT IN`` keeps no shop at all when the list holds a
    null shop, which two scalar subqueries over the null rows tell.
    """
    flags = shop_plan_flags(source.table("fin_deal"), source.table("fin_agreement"), as_of)
    unknown = flags.filter(F.col("shop_id").isNull())
    null_in_live = unknown.agg(F.count(F.when(F.col("has_live"), 1)).alias("n")).scalar()
    null_in_any = unknown.agg(F.count(F.when(F.col("has_any"), 1)).alias("n")).scalar()
    known = flags.filter(F.col("shop_id").isNotNull())
    rows = paying_shops(source, plan_name, internal_pattern).join(known, "shop_id", "left")
    dead = F.col("has_ended") & ~F.col("has_live") & (null_in_live == 0)
    none = ~F.coalesce("has_any", F.lit(False)) & (null_in_any == 0)
    reasons = F.array_compact(F.array(F.when(dead, DEAD_DEALS), F.when(none, NO_DEAL)))
    rows = rows.withColumn("_reasons", reasons).withColumn("reason", F.explode("_reasons"))
    return rows.select("reason", "shop_id", record_url(base_url, F.col("shop_id")).alias("shop_url"), "name", "base_price")


def orphan_reasons(orphans: DataFrame, shop_dimension: DataFrame, accounts: DataFrame) -> DataFrame:
    """Reasons of a shop in one text, with the success manager of its account."""
    joined = orphans.groupBy("shop_url", "shop_id", "name", "base_price").agg(
        F.array_join(F.array_sort(F.collect_set("reason")), ", ").alias("reasons")
    )
    dims = shop_dimension.select("shop_id", "account_id")
    managers = accounts.select("account_id", F.col("success_manager").alias("current_manager"))
    return joined.join(dims, "shop_id").join(managers, "account_id").drop("account_id")
