"""Fixed values.

Names, code lists, rates, thresholds and texts that have to equal those of the systems whose payloads
are read and of the reports that are reproduced. They are data, kept together and in natural order.
"""

from decimal import Decimal

# --- fixed values: platforms ------------------------------------------------------------------
SHOP_PLATFORMS = ("shopee", "lazada", "tiktok_shop")
AD_PLATFORMS = ("facebook_ads", "google_ads", "tiktok_ads", "line_ads", "shopee_ads", "lazada_ads")
ALL_SHOPS = "all"

# Shop platform an advertising platform sells for; ALL_SHOPS when it is not tied to one shop.
ADS_TO_SHOP = {
    "shopee_ads": "shopee",
    "lazada_ads": "lazada",
    "facebook_ads": "all",
    "google_ads": "all",
    "tiktok_ads": "tiktok_shop",
    "line_ads": "all",
}

# --- fixed values: order status ---------------------------------------------------------------
ORDER_STATUS = {
    "shopee": {
        "unpaid": "pending",
        "ready_to_ship": "confirmed",
        "processed": "confirmed",
        "shipped": "shipped",
        "to_confirm_receive": "shipped",
        "completed": "completed",
        "cancelled": "cancelled",
        "to_return": "return_pending",
        "in_cancel": "cancel_pending",
    },
    "lazada": {
        "pending": "pending",
        "unpaid": "pending",
        "packed": "confirmed",
        "ready_to_ship": "confirmed",
        "ready_to_ship_pending": "confirmed",
        "shipped": "shipped",
        "delivered": "completed",
        "closed": "completed",
        "cancelled": "cancelled",
        "returned": "returned",
        "failed": "failed",
    },
    "tiktok_shop": {
        "unpaid": "pending",
        "awaiting_shipment": "confirmed",
        "awaiting_collection": "confirmed",
        "in_transit": "shipped",
        "delivered": "completed",
        "completed": "completed",
        "cancelled": "cancelled",
        "on_hold": "on_hold",
    },
}

# --- fixed values: ads status and campaign type -----------------------------------------------
ADS_STATUS = {
    "facebook_ads": {
        "active": "active",
        "paused": "paused",
        "deleted": "deleted",
        "archived": "archived",
        "pending_review": "pending",
        "disapproved": "rejected",
        "preapproved": "pending",
        "campaign_paused": "paused",
        "adset_paused": "paused",
    },
    "google_ads": {
        "enabled": "active",
        "paused": "paused",
        "removed": "deleted",
        "unknown": "unknown",
    },
    "tiktok_ads": {
        "enable": "active",
        "disable": "paused",
        "delete": "deleted",
        "status_enable": "active",
        "status_disable": "paused",
        "status_delete": "deleted",
    },
}

CAMPAIGN_TYPE = {
    "facebook_ads": {
        "link_clicks": "traffic",
        "conversions": "conversions",
        "app_installs": "app_install",
        "brand_awareness": "awareness",
        "reach": "reach",
        "video_views": "video",
        "lead_generation": "leads",
        "messages": "messages",
        "engagement": "engagement",
        "store_traffic": "store_visits",
        "catalog_sales": "sales",
        "outcome_awareness": "awareness",
        "outcome_engagement": "engagement",
        "outcome_leads": "leads",
        "outcome_sales": "sales",
        "outcome_traffic": "traffic",
        "outcome_app_promotion": "app_install",
    },
    "google_ads": {
        "search": "search",
        "display": "display",
        "shopping": "shopping",
        "video": "video",
        "multi_channel": "performance_max",
        "smart": "smart",
        "local": "local",
        "hotel": "hotel",
        "performance_max": "performance_max",
        "demand_gen": "demand_gen",
    },
    "tiktok_ads": {
        "traffic": "traffic",
        "conversions": "conversions",
        "app_install": "app_install",
        "reach": "reach",
        "video_views": "video",
        "lead_generation": "leads",
        "catalog_sales": "sales",
    },
}

# Action types that count as conversions, and those that carry a cost per conversion.
CONVERSION_ACTIONS = (
    "purchase",
    "complete_registration",
    "lead",
    "add_to_cart",
    "add_payment_info",
    "initiate_checkout",
)
COSTED_ACTIONS = ("purchase", "complete_registration", "lead")

# --- fixed values: web-analytics channel grouping, first match wins ---------------------------
DIRECT_SOURCES = ("(direct)", "direct")
DIRECT_MEDIUMS = ("(none)", "(not set)", "")
# Channel, its mediums, and the sources that make it the channel whatever the medium.
CHANNELS = (
    ("Organic Search", ("organic",), ()),
    ("Paid Search", ("cpc", "ppc", "paidsearch"), ()),
    ("Display", ("display", "cpm", "banner"), ()),
    ("Paid Social", ("paid_social", "paidsocial", "paid-social"), ()),
    ("Social", ("social",), ("facebook", "instagram", "twitter", "linkedin", "tiktok", "youtube", "pinterest")),
    ("Email", ("email",), ()),
    ("Affiliates", ("affiliate",), ()),
    ("Referral", ("referral",), ()),
    ("Video", ("video",), ()),
    ("Audio", ("audio",), ()),
    ("SMS", ("sms",), ()),
    ("Mobile Push", ("push", "mobile", "notification"), ()),
)

# --- fixed values: currencies -----------------------------------------------------------------
HOME_CURRENCY = "THB"
USD_TO_THB = 35.0
EXCHANGE_RATES = {
    ("USD", "THB"): Decimal("35.00"),
    ("EUR", "THB"): Decimal("38.00"),
    ("GBP", "THB"): Decimal("44.00"),
    ("JPY", "THB"): Decimal("0.24"),
    ("CNY", "THB"): Decimal("4.90"),
    ("SGD", "THB"): Decimal("26.00"),
    ("MYR", "THB"): Decimal("7.50"),
    ("IDR", "THB"): Decimal("0.0022"),
    ("VND", "THB"): Decimal("0.0014"),
    ("PHP", "THB"): Decimal("0.63"),
    ("THB", "USD"): Decimal("0.0286"),
    ("THB", "EUR"): Decimal("0.0263"),
}
CURRENCY_SYMBOLS = {"THB": "฿", "USD": "$", "EUR": "€", "GBP": "£", "JPY": "¥", "CNY": "¥"}
SYMBOL_BEFORE_AMOUNT = ("USD", "EUR", "GBP")
SYMBOL_CURRENCY = {"฿": "THB", "$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY"}

# --- fixed values: alert rules ----------------------------------------------------------------
# name, alert type, condition, comparison, threshold, severity
DEFAULT_RULES = (
    ("Low ROAS - Critical", "low_roas", "ROAS < 1.5", "lt", 1.5, "critical"),
    ("Low ROAS - Warning", "low_roas", "ROAS < 2.0", "lt", 2.0, "warning"),
    ("High CPA - Critical", "high_cpa", "CPA > 500 THB", "gt", 500.0, "critical"),
    ("High CPA - Warning", "high_cpa", "CPA > 300 THB", "gt", 300.0, "warning"),
    ("Revenue Drop - Critical", "revenue_drop", "Revenue drop > 30% WoW", "lt", -0.30, "critical"),
    ("Revenue Drop - Warning", "revenue_drop", "Revenue drop > 20% WoW", "lt", -0.20, "warning"),
    ("Low Conversion Rate", "low_conversion_rate", "Conversion rate < 1%", "lt", 0.01, "warning"),
    ("High Cancellation Rate", "high_cancellation_rate", "Cancellation rate > 15%", "gt", 0.15, "warning"),
    ("Spend Spike", "spend_anomaly", "Spend increase > 50% vs average", "gt", 0.50, "info"),
    ("Campaign Underperforming", "campaign_underperforming", "ROAS < 50% of benchmark", "lt", 0.50, "warning"),
)
SEVERITIES = ("critical", "warning", "info")
ALERT_STATUSES = ("active", "acknowledged", "resolved")

# --- fixed values: staging keys ---------------------------------------------------------------
STAGING_KEYS = {
    "stg_orders": ("order_id",),
    "stg_order_items": ("item_id", "order_id", "platform"),
    "stg_ads": ("record_id", "date"),
    "stg_ga4_sessions": ("record_id",),
    "stg_ga4_traffic": ("record_id",),
    "stg_ga4_pages": ("record_id",),
    "stg_products": ("product_id", "sku"),
    "stg_sku_mappings": ("master_sku", "platform", "platform_sku"),
}
