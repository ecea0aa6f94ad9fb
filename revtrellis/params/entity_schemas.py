"""The columns that the reports read, per entity, as declared types."""

from __future__ import annotations

import functools

from pyspark.sql import types as T

_COLUMNS = {
    "crm_user": """user_id bigint, name string, email string, employee_id bigint, manager_name string, user_role_id bigint, user_role string, source_system string, guid
        bigint""",
    "crm_role": """user_role_id bigint, role_name string""",
    "crm_role_attribute": """rep_role string, market_segment string, team_segment string, sales_region string""",
    "hr_worker": """worker_id bigint, worker_name string, country string, tenure_days string, manager_id bigint, is_active boolean""",
    "hr_worker_daily": """worker_id bigint, worker_name string, effective_on date, discipline string, subdiscipline string, team string, manager_id bigint""",
    "hr_quota": """payee_id bigint, period string, attribute_id string, quota double""",
    "crm_account": """account_id string, account_key bigint, name string, named_account_code string, market_segment string, territory_name string, region_label string,
        annual_revenue double, platform_group string, success_manager string, is_deleted boolean""",
    "crm_opportunity": """opportunity_id bigint, opportunity_name string, account_id string, owner_id bigint, owner_name string, role_at_creation string, sales_rep_role string,
        created_date date, close_date date, stage_name string, lead_source string, opportunity_type string, country_code string, sales_region string,
        primary_shop_id bigint, market_segment string, team_segment string, campaign_id bigint, total_revenue double, offline_revenue double,
        online_revenue_verified double, committed_revenue double, verified_revenue double, product_profit double, contract_value double, winning_partner_id
        string, is_deleted boolean""",
    "fact_metric": """dataset string, metric string, value_type string, value double, opportunity_id bigint, year int, quarter string, snapshot_date date, account_id
        string, opportunity_owner string, owner_manager string, market_segment string, team_segment string, sales_region string, sales_sub_region string,
        lead_group string, full_date date, term_length string, product_name string, next_step string, is_unified boolean, qualified_date date, created_date
        date, close_date date, campaign string, platform_group string, age bigint, current_stage string, verified_online_revenue double, annual_revenue
        double, created_by_function string, created_by string, sales_owner_role string, account_name string, account_campaign string, opportunity_url string,
        opportunity_name string, fact_product_name string""",
    "fact_stage": """opportunity_id bigint, product string, team_segment string, sales_price double, total_locations double, envision_at date, solution_at date,
        demonstrate_at date, deal_craft_at date, closed_at date, is_won boolean""",
    "fact_opportunity_revenue": """opportunity_id bigint, total_revenue double, product_profit double, product_attach_count bigint, subscription_revenue double, sales_accepted int""",
    "partner_relationship": """opportunity_id bigint, is_coselling boolean""",
    "geo_country": """country_code string, country_name string, eligible_since date, market_maturity string, sub_region string""",
    "programme_merchant": """shop_id string, promo_code string""",
    "programme_list": """promo_code string, must_win string""",
    "org_shop": """shop_id bigint, organization_id bigint""",
    "org_daily": """organization_id bigint, snapshot_date date, ending_active bigint""",
    "crm_lead": """lead_id bigint, owner_id bigint, owner_role string, lead_source string, lead_source_original string, status string, disqualified_reason string,
        region_label string, product_interest string, product_interest_at_creation string, enriched_revenue double, converted_contact_id bigint,
        sales_accepted_date date, created_date date, sales_ready_date date, disqualified_date date, nurture_date date, opportunity_date date,
        converted_opportunity_id bigint, converted_account_id string, legacy_id bigint, online_revenue double, offline_revenue double""",
    "crm_lead_raw": """lead_id bigint, owner_id bigint, owner_role string, lead_source string, status string, offline_revenue_band string, enriched_revenue double,
        created_date date, mql_date date, sal_date date, region_label string, converted_account_id string, converted_opportunity_id bigint, is_customer
        boolean, retail_locations string, disqualified_reason string, is_deleted boolean, routing_segment string, organization_id bigint, company string,
        partner_involvement string, online_revenue_verified double, lead_grade string, referrer_name string, referrer_email string, last_activity_date date""",
    "legacy_lead": """legacy_id bigint, eligibility_segment string, revenue_band string, company string, number_of_locations string, last_activity_date date""",
    "partner_lead": """reference_id bigint, reference_object string, membership_id bigint, partner_id bigint, shop_id bigint, country_code string, updated_on date""",
    "partner_referral": """lead_id bigint, referring_partners array<struct<partner_id:bigint,partner_name:string,referred_on:date,referral_index:int>>""",
    "partner": """partner_id bigint, partner_name string, region string, country_name string, sub_region string, management_model string, partner_type string,
        partner_account_id string, recruiter string, memberships array<string>""",
    "partner_manager_daily": """partner_id bigint, on_date date, programme string, manager string""",
    "partner_developer_history": """account_id string, manager_name string, start_date date, end_date date""",
    "partner_recruiter_history": """account_id string, manager_name string, start_date date, end_date date""",
    "lead_status_history": """lead_id bigint, status string, end_date date""",
    "act_event": """id bigint, account_ref string, activity_day date, event_day date, created_day date, created_by bigint, owner bigint, deleted boolean, type string,
        dialler_type string, subject string, click_count bigint, related_id bigint, sub_type string, call_disposition string, call_minutes double,
        call_sentiment string, cadence_name string, connected_count bigint, email_template string, replies_count bigint, unique_click_count bigint,
        unique_reply_count bigint, unique_view_count bigint, view_count bigint, description string""",
    "act_task": """id bigint, account_ref string, activity_day date, completed_day date, created_day date, created_by bigint, owner bigint, deleted boolean, type string,
        dialler_type string, subject string, click_count bigint, related_id bigint, sub_type string, call_disposition string, call_minutes double,
        call_sentiment string, cadence_name string, connected_count bigint, email_template string, replies_count bigint, unique_click_count bigint,
        unique_reply_count bigint, unique_view_count bigint, view_count bigint, description string""",
    "crm_campaign": """campaign_id bigint, campaign_name string, start_date date, end_date date, is_deleted boolean""",
    "crm_campaign_member": """campaign_id bigint, account_id string, lead_id bigint, joined_date date, is_deleted boolean""",
    "account_watchlist": """account_prefix string""",
    "act_email": """id bigint, created_date date, sender struct<id:bigint>, counts struct<replies:bigint>, view_tracking boolean""",
    "act_call": """id bigint, created_date date, sender struct<id:bigint>, disposition string, sentiment string""",
    "act_cadence": """id bigint, created_date date, owner struct<id:bigint>, counts struct<meetings_booked:bigint,people_acted_on:bigint>""",
    "act_meeting": """id bigint, calendar_id string, created_date date, start_time timestamp_ntz, end_time timestamp_ntz, no_show boolean, cadence struct<id:bigint>,
        attendees array<struct<email:string,status:string>>""",
    "act_conversation": """id bigint, created_date date, user_guid string, duration_ms int""",
    "act_recorded_meeting": """event_id bigint, owner_name string, activity_date date, recording_url string""",
    "account_activity": """account_id string, activity_date date, activity_group string, activity_type string, opportunity_id bigint, opportunity_owner string, activity_owner
        string""",
    "account_snapshot": """account_id string, snapshot_date date, territory_name string, tier string""",
    "territory_rep": """rep_name string, territory_name string, quarter_end date""",
    "fin_shop": """shop_id bigint, name string, domain string, email string, billing_account_id bigint""",
    "fin_deal": """deal_id bigint, name string, original_deal_id bigint, start_date date, end_date date, terminated_on date, is_deleted boolean""",
    "fin_agreement": """deal_id bigint, shop_id bigint, terminated_on date, is_deleted boolean, reason string""",
    "fin_account": """billing_account_id int, current_subscription_id int""",
    "fin_subscription": """subscription_id int, plan_name string, base_price double""",
    "fin_shop_dimension": """shop_id bigint, account_id string""",
    "scorecard_metric": """team_group string, system string, metric string, points double, unit string, metric_group string, metric_subgroup string""",
}


@functools.cache
def entity_schemas() -> dict[str, T.StructType]:
    """Entity -> schema. Spark parses the text, so a session has to exist."""
    return {name: T.StructType.fromDDL(" ".join(columns.split())) for name, columns in _COLUMNS.items()}
