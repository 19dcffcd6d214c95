"""Time fields, category, address, agent and properties enrichment."""

import datetime as dt

import pytest

from core_helpers import raw_df, sample
from eventmill.operators.transform import to_document, to_flat, transform


def one(spark, **kw):
    return transform(raw_df(spark, [sample(**kw)])).first()


def test_iso_z_parse_and_hour(spark):
    r = one(spark, timestamp="2024-01-15T10:30:00.000Z")
    assert r["event_date"] == dt.date(2024, 1, 15) and r["hour_of_day"] == 10


def test_monday_and_saturday(spark):
    mon = one(spark, timestamp="2024-01-15T10:30:00")
    sat = one(spark, timestamp="2024-01-13T15:00:00")
    assert (mon["day_of_week"], mon["is_weekend"]) == (0, False)
    assert (sat["day_of_week"], sat["is_weekend"]) == (5, True)


def test_offset_modes(spark):
    utc = transform(raw_df(spark, [sample(timestamp="2024-01-15T10:30:00+05:00")])).first()
    wall = transform(raw_df(spark, [sample(timestamp="2024-01-15T10:30:00+05:00")]), offset_mode="wall").first()
    assert utc["timestamp"] == dt.datetime(2024, 1, 15, 5, 30)
    assert wall["timestamp"] == dt.datetime(2024, 1, 15, 10, 30)


@pytest.mark.parametrize("etype,cat", [("page_view", "engagement"), ("purchase", "revenue"),
                                       ("unknown_event", "other"), ("PAGE_VIEW", "engagement")])
def test_category(spark, etype, cat):
    r = one(spark, event_type=etype)
    assert r["event_category"] == cat and r["event_type"] == etype.lower()


@pytest.mark.parametrize("ip,geo", [
    ("10.20.30.40", ("Private", "Private", "Private")),
    ("203.0.113.9", ("Private", "Private", "Private")),
    # md5 prefix value 1090471129 -> country 9, region 1, city 4
    ("8.8.8.8", ("CN", "NY", "Seattle")),
    ("", (None, None, None)),
    ("not-an-ip", (None, None, None)),
    ("256.1.1.1", (None, None, None)),
    ("01.2.3.4", (None, None, None)),
])
def test_geo(spark, ip, geo):
    r = one(spark, ip_address=ip)
    assert (r["country"], r["region"], r["city"]) == geo


def test_private_ranges_match_stdlib(spark):
    import ipaddress
    ips = ["10.1.2.3", "100.64.0.1", "127.0.0.1", "169.254.3.4", "172.16.0.1", "172.32.0.1", "192.0.0.9",
           "192.0.0.10", "192.0.0.8", "192.0.2.1", "198.18.0.1", "198.51.100.7", "240.0.0.1",
           "255.255.255.255", "0.0.0.0", "1.1.1.1", "8.8.4.4", "192.0.0.170", "192.0.0.172"]
    from pyspark.sql import functions as F
    from eventmill.functions.ipaddr import ipv4_num, private_v4
    df = spark.createDataFrame([(i,) for i in ips], "ip string")
    got = {r["ip"]: r["p"] for r in df.select("ip", private_v4(ipv4_num(F.col("ip"))).alias("p")).collect()}
    assert got == {i: ipaddress.ip_address(i).is_private for i in ips}


@pytest.mark.parametrize("ua,expected", [
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
     ("Chrome", "Windows", "desktop")),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
     "Version/17.2 Mobile/15E148 Safari/604.1", ("Mobile Safari", "iOS", "mobile")),
    ("Mozilla/5.0 (iPad; CPU OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
     "Version/17.2 Mobile/15E148 Safari/604.1", ("Mobile Safari", "iOS", "tablet")),
    ("Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0", ("Firefox", "Linux", "desktop")),
    ("Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)", ("Googlebot", "Other", "bot")),
    ("Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0 Mobile Safari/537.36",
     ("Chrome Mobile", "Android", "mobile")),
    ("", (None, None, None)),
])
def test_agent_rules(spark, ua, expected):
    r = one(spark, user_agent=ua)
    assert (r["browser"], r["os"], r["device_type"]) == expected


@pytest.mark.parametrize("props,flat,doc", [
    (None, "{}", "{}"),
    ('{"button": "subscribe"}', '{"button": "subscribe"}', '{"button":"subscribe"}'),
    ("bad json", '{"raw_properties": "bad json"}', '{"raw_properties":"bad json"}'),
    ("{}", "{}", "{}"),
    ("5", "5", "5"),
])
def test_properties(spark, props, flat, doc):
    from pyspark.sql import functions as F
    t = transform(raw_df(spark, [sample(properties=props)]))
    assert to_flat(t).first()["properties"] == flat
    assert to_document(t).select(F.to_json("properties").alias("j")).first()["j"] == doc


def test_optional_defaults_and_flat_shape(spark):
    t = transform(raw_df(spark, [sample(session_id=..., referrer=..., page_url=...)]))
    f = to_flat(t).first()
    assert f["session_id"] == "" and f["referrer"] == "" and f["page_url"] == "" and f["is_weekend"] == 0
    assert t.first()["referrer"] is None
    assert len(to_flat(t).columns) == 15


def test_document_enrichment_struct(spark):
    d = to_document(transform(raw_df(spark, [sample(ip_address="8.8.8.8")]))).first()
    assert d["timestamp"] == "2024-01-15T10:30:00Z"
    assert d["enrichment"]["geo_enriched"] and d["enrichment"]["user_agent_parsed"]
    assert d["enrichment"]["processed_version"] == "1.0" and d["_id"] == "ev-7f"


def test_ipv6_matches_stdlib(spark):
    import ipaddress
    import random

    from pyspark.sql import functions as F

    from eventmill.functions.ipaddr import ipv6_hex, private_v6
    rnd = random.Random(4)
    texts = ["0:0:0:0:0:0:0:1", "::1", "::", "2001:3::1", "2001:20::1", "2001:4:112::1", "100::1:0:0:0:0", "100::1", "::ffff:1.2.3.4",
             "::ffff:10.0.0.1", "fe80::1%eth0", "1:2:3:4:5:6:7::8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::8::9", ":1:2:3:4:5:6:7:8",
             "12345::", "g::1", "fc00::", "febf::1", "fec0::1", "2001:db8::5", "2002::1", "64:ff9b:1::1", "1:2:3:4:5:6:1.2.3.4",
             "::1.2.3.256", "1:2", "", ":::", "::00001", "1.2.3.4", "2001:1::1", "2001:1::3"]
    for _ in range(100):
        a = ipaddress.IPv6Address(rnd.getrandbits(128) >> rnd.choice([0, 64, 100, 120]))
        texts += [str(a), a.exploded]
    df = spark.createDataFrame([(t,) for t in texts], "ip string").withColumn("h", ipv6_hex(F.col("ip"))).withColumn("p", private_v6(F.col("h")))
    for r in df.collect():
        try:
            a = ipaddress.IPv6Address(r["ip"])
            want = (f"{int(a) & (2**128 - 1):032x}", a.is_private)
        except ValueError:
            want = (None, None)
        assert (r["h"], r["p"]) == want, r["ip"]


def test_switches_leave_rules_or_enrichment_out(spark):
    rows = raw_df(spark, [sample(), sample(event_id="bad", timestamp="garbage")])
    assert transform(rows, validate=False).where("reject_reason is not null").count() == 0
    bare = transform(rows, enrich=False).where("event_id = 'ev-7f'").first()
    assert bare["browser"] is None and bare["country"] is None and bare["event_category"] == "engagement"
