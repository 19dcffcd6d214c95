"""Fixed schemas of the event layers."""

from __future__ import annotations

from pyspark.sql import types as T

REQUIRED_FIELDS = ["event_id", "user_id", "event_type", "timestamp"]
OPTIONAL_FIELDS = ["session_id", "ip_address", "user_agent", "referrer", "page_url", "properties"]
RAW_FIELDS = REQUIRED_FIELDS + OPTIONAL_FIELDS

# Raw event as read from a message: every leaf is text; JSON types are checked
# separately from the VARIANT form of the payload (see operators.validate).
RAW = T.StructType([T.StructField(f, T.StringType(), True) for f in RAW_FIELDS])

# Flat analytic row (columnar table), in table order; processed_at is added at write time.
FLAT_COLUMNS = ["event_id", "user_id", "event_type", "event_date", "timestamp", "hour_of_day",
                "day_of_week", "is_weekend", "event_category", "session_id", "ip_address",
                "user_agent", "referrer", "page_url", "properties"]
ENRICH_COLUMNS = ["browser", "os", "device_type", "country", "region", "city"]

# Stream / topic metadata columns carried next to the payload.
SOURCE_META = ["topic", "partition", "offset"]
