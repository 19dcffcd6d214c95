"""Helpers of the core tests: table folders and raw rows."""

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

RAW_COLS = ["event_id", "user_id", "event_type", "timestamp", "session_id", "ip_address", "user_agent",
            "referrer", "page_url", "properties"]

SAMPLE = {
    "event_id": "ev-7f", "user_id": "4711", "event_type": "page_view",
    "timestamp": "2024-01-15T10:30:00.000Z", "session_id": "s-4711-a", "ip_address": "10.20.30.40",
    "user_agent": "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36",
    "referrer": "https://search.example/q", "page_url": "https://shop.example/list?page=2",
    "properties": '{"button": "next", "depth": 3}',
}


def raw_df(spark, rows):
    """Raw text rows (dicts; absent keys -> NULL) as a RAW DataFrame."""
    from eventmill.schemas import RAW
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLS) for r in rows], RAW)


def sample(**kw):
    d = dict(SAMPLE)
    for k, v in kw.items():
        if v is ...:
            d.pop(k, None)
        else:
            d[k] = v
    return d
