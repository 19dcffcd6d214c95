"""Dimension data: categories, priorities, sampling rates, address ranges, agent rules.

All of it is small, fixed-size data (at most a few hundred rows), so every DataFrame
built here has a proven size bound and may be broadcast safely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES - these must equal the source system's configuration for results to
# match.  Kept as plain text, in their original order.
# ---------------------------------------------------------------------------

# Category -> (description, event types).  The first seven categories are the set the
# live transformer uses; "navigation" and "communication" exist only in the YAML config.
CATEGORIES: list[tuple[str, str, list[str]]] = [
    ("engagement", "User engagement and interaction events", [
        "page_view", "button_click", "scroll", "hover", "focus", "blur", "resize", "search",
        "filter", "sort", "video_play", "video_pause", "video_complete", "audio_play",
        "download", "print", "bookmark", "copy", "select_text"]),
    ("conversion", "Events that indicate user conversion", [
        "signup", "form_submit", "newsletter_signup", "trial_start", "demo_request",
        "contact_submit", "quote_request", "callback_request", "whitepaper_download",
        "webinar_registration"]),
    ("revenue", "Events related to revenue generation", [
        "purchase", "subscription_start", "subscription_renew", "subscription_upgrade",
        "subscription_downgrade", "refund_request", "payment_method_add", "billing_update",
        "invoice_paid", "plan_change"]),
    ("ecommerce", "E-commerce specific events", [
        "cart_add", "cart_remove", "cart_view", "cart_clear", "wishlist_add", "wishlist_remove",
        "product_view", "product_compare", "checkout_start", "checkout_complete", "coupon_apply",
        "coupon_remove", "shipping_select", "payment_select"]),
    ("social", "Social interaction events", [
        "share", "like", "unlike", "comment", "reply", "follow", "unfollow", "mention", "tag",
        "rate", "review", "recommend", "report", "block"]),
    ("authentication", "User authentication events", [
        "login", "logout", "password_reset", "password_change", "email_verify", "phone_verify",
        "two_factor_enable", "two_factor_disable", "account_lock", "account_unlock",
        "profile_update", "privacy_update"]),
    ("technical", "Technical and system events", [
        "error", "exception", "timeout", "api_call", "database_query", "cache_hit", "cache_miss",
        "file_upload", "file_process", "batch_process", "system_alert", "performance_issue",
        "security_event"]),
    ("navigation", "Website navigation events", [
        "page_load", "page_unload", "navigation_click", "breadcrumb_click", "menu_open",
        "menu_close", "tab_switch", "modal_open", "modal_close", "accordion_toggle",
        "dropdown_select"]),
    ("communication", "Communication and messaging events", [
        "email_send", "email_open", "email_click", "sms_send", "sms_receive",
        "push_notification_send", "push_notification_click", "chat_message", "chat_start",
        "chat_end", "call_start", "call_end"]),
]
# Categories used by the live transformer (the parity default).
CODE_CATEGORIES = ["engagement", "conversion", "revenue", "ecommerce", "social", "authentication", "technical"]
DEFAULT_CATEGORY = "other"

# Seed rows of the category table: (event_type, category, description), is_active = 1.
CATEGORY_SEED: list[tuple[str, str, str]] = [
    ("page_view", "engagement", "User viewed a page"),
    ("button_click", "engagement", "User clicked a button"),
    ("form_submit", "conversion", "User submitted a form"),
    ("purchase", "revenue", "User made a purchase"),
    ("signup", "conversion", "User signed up"),
    ("login", "authentication", "User logged in"),
    ("logout", "authentication", "User logged out"),
    ("search", "engagement", "User performed a search"),
    ("video_play", "engagement", "User played a video"),
    ("download", "engagement", "User downloaded a file"),
    ("share", "social", "User shared content"),
    ("like", "social", "User liked content"),
    ("comment", "social", "User posted a comment"),
    ("cart_add", "ecommerce", "User added item to cart"),
    ("cart_remove", "ecommerce", "User removed item from cart"),
    ("checkout_start", "ecommerce", "User started checkout"),
    ("payment_failed", "ecommerce", "Payment failed"),
    ("subscription_start", "revenue", "User started subscription"),
    ("subscription_cancel", "revenue", "User cancelled subscription"),
    ("error", "technical", "Application error occurred"),
]

# Processing priority per event type; unlisted types are "low".
PRIORITIES: list[tuple[str, list[str]]] = [
    ("high", ["purchase", "error", "security_event", "payment_failed", "subscription_cancel"]),
    ("medium", ["signup", "login", "form_submit", "cart_add", "checkout_start"]),
    ("low", ["page_view", "button_click", "scroll", "hover"]),
]
PRIORITY_RANK = {"high": 0, "medium": 1, "low": 2}

# Sampling rate per event type; unlisted types are kept whole.
SAMPLING_RATES: list[tuple[str, float]] = [
    ("page_view", 0.1), ("scroll", 0.05), ("hover", 0.01),
    ("button_click", 1.0), ("purchase", 1.0), ("error", 1.0),
]

# Mock geo lists picked by an md5 prefix of the address text.
GEO_COUNTRIES = ["US", "UK", "DE", "FR", "JP", "AU", "CA", "BR", "IN", "CN"]
GEO_REGIONS = ["CA", "NY", "TX", "FL", "WA", "London", "Berlin", "Tokyo"]
GEO_CITIES = ["San Francisco", "New York", "Los Angeles", "Chicago", "Seattle"]
PRIVATE_LABEL = "Private"

# IPv4 blocks counted as private (Python 3.13 `ipaddress` is_private), and the two
# exceptions inside them that are not private.
PRIVATE_V4_BLOCKS = [
    "0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12",
    "192.0.0.0/24", "192.0.0.170/31", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15",
    "198.51.100.0/24", "203.0.113.0/24", "240.0.0.0/4", "255.255.255.255/32",
]
PRIVATE_V4_EXCEPTIONS = ["192.0.0.9/32", "192.0.0.10/32"]

# Document enrichment version tag.
PROCESSED_VERSION = "1.0"

# Histogram bucket upper bounds (seconds) of the processing-duration metric.
DURATION_BUCKETS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]

# ---------------------------------------------------------------------------
# User-agent rule table (our own; the parsing library of the source is not available).
# Each rule: (label, pattern that must match, pattern that must not match or None).
# First matching rule wins.  Patterns use the regex subset shared by Java and RE2.
# ---------------------------------------------------------------------------
AGENT_BROWSER_RULES: list[tuple[str, str, str | None]] = [
    ("Googlebot", r"Googlebot", None),
    ("bingbot", r"bingbot", None),
    ("YandexBot", r"YandexBot", None),
    ("DuckDuckBot", r"DuckDuckBot", None),
    ("Baiduspider", r"Baiduspider", None),
    ("Edge", r"Edg(e|A|iOS)?/", None),
    ("Opera", r"(OPR/|Opera)", None),
    ("Samsung Internet", r"SamsungBrowser/", None),
    ("Chrome Mobile iOS", r"CriOS/", None),
    ("Firefox iOS", r"FxiOS/", None),
    ("Chrome Mobile", r"Chrome/[0-9.]+ Mobile", None),
    ("Chrome", r"Chrome/", None),
    ("Firefox Mobile", r"Android.*Firefox/", None),
    ("Firefox", r"Firefox/", None),
    ("Mobile Safari", r"(iPhone|iPad|iPod).*Version/[0-9.]+.*Safari/", None),
    ("Mobile Safari UI/WKWebView", r"(iPhone|iPad|iPod).*AppleWebKit/", None),
    ("Safari", r"Version/[0-9.]+.*Safari/", None),
    ("IE", r"(MSIE |Trident/)", None),
]
AGENT_OS_RULES: list[tuple[str, str, str | None]] = [
    ("Windows", r"Windows", None),
    ("iOS", r"(iPhone|iPad|iPod)", None),
    ("Mac OS X", r"(Mac OS X|Macintosh)", None),
    ("Android", r"Android", None),
    ("Chrome OS", r"CrOS", None),
    ("Ubuntu", r"Ubuntu", None),
    ("Linux", r"Linux", None),
]
AGENT_DEVICE_RULES: list[tuple[str, str, str | None]] = [
    ("mobile", r"(iPhone|iPod|Windows Phone|BlackBerry|Opera Mini|IEMobile|Android.*Mobile)", None),
    ("tablet", r"(iPad|Kindle|Silk/|Tablet|Android)", r"Mobile Safari/|Android.*Mobile"),
    ("bot", r"(?i)(bot|crawler|spider|slurp)", None),
]
AGENT_DEFAULT_BROWSER = "Other"
AGENT_DEFAULT_OS = "Other"
AGENT_DEFAULT_DEVICE = "desktop"


# ---------------------------------------------------------------------------
# DataFrames
# ---------------------------------------------------------------------------

def category_dim(spark: SparkSession, source: str = "code") -> DataFrame:
    """Type -> category dimension.

    source="code": the seven live categories (parity default);
    source="config": all nine config categories;
    source="all": config categories plus seed-only types, with a `source` column.
    """
    rows = []
    for cat, desc, types in CATEGORIES:
        if source == "code" and cat not in CODE_CATEGORIES:
            continue
        for t in types:
            rows.append((t, cat, desc, "config" if cat not in CODE_CATEGORIES else "code"))
    if source == "all":
        known = {r[0] for r in rows}
        for t, cat, desc in CATEGORY_SEED:
            if t not in known:
                rows.append((t, cat, desc, "seed"))
    schema = "event_type string, category string, description string, source string"
    return spark.createDataFrame(rows, schema)


def category_seed(spark: SparkSession) -> DataFrame:
    """The 20 seed rows of the category table (is_active = 1)."""
    return spark.createDataFrame(
        [(t, c, d, 1) for t, c, d in CATEGORY_SEED],
        "event_type string, category string, description string, is_active int")


def priority_dim(spark: SparkSession) -> DataFrame:
    rows = [(t, p, PRIORITY_RANK[p]) for p, types in PRIORITIES for t in types]
    return spark.createDataFrame(rows, "event_type string, priority string, priority_rank int")


def sampling_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SAMPLING_RATES, "event_type string, rate double")


def _v4_to_long(addr: str) -> int:
    a, b, c, d = (int(x) for x in addr.split("."))
    return (a << 24) | (b << 16) | (c << 8) | d


def cidr_bounds(block: str) -> tuple[int, int]:
    addr, bits = block.split("/")
    lo = _v4_to_long(addr)
    size = 1 << (32 - int(bits))
    return lo, lo + size - 1


def private_ranges(spark: SparkSession) -> DataFrame:
    """Private IPv4 blocks as (lo, hi, private) rows; exceptions carry private=false."""
    rows = [(b, *cidr_bounds(b), True) for b in PRIVATE_V4_BLOCKS]
    rows += [(b, *cidr_bounds(b), False) for b in PRIVATE_V4_EXCEPTIONS]
    return spark.createDataFrame(rows, "block string, lo long, hi long, private boolean")


def _sql_literal(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, float):
        return f"{v!r}D"          # a DOUBLE literal, as F.lit(float) gives
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_literal(pairs) -> F.Column:
    """A literal MAP column from (key, value) pairs; for tiny fixed lookups inside codegen.

    Written as one SQL `map(...)` literal, so building it is one call into the JVM rather
    than one per key and value (hundreds for the category map, on every query built).
    """
    body = ", ".join(f"{_sql_literal(k)}, {_sql_literal(v)}" for k, v in pairs)
    return F.expr(f"map({body})")

