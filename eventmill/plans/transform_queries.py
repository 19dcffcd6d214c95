"""Registered keys of the raw-event chain: validation, enrichment, dedup, shapes (A2, B4-B8,
C1-C10, D1, D5, D12, E1-E7, F1, F2, G16, I4, I7, K19, K21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventmill import dims
from eventmill.functions.agent import agent_struct
from eventmill.functions.ipaddr import V4_REGEX, ipv4_num, with_geo
from eventmill.functions.props import property_get, props_flat_text, props_variant
from eventmill.operators import lookups as L
from eventmill.operators.dedup import duplicate_report, new_rows_anti, stored_rows_semi
from eventmill.operators.enrich import category_join, ip_private_ranges, sample_by_type
from eventmill.operators.netmatch import longest_prefix
from eventmill.operators.transform import (fill_nulls, to_document, to_flat, transform,
                                           transform_events, transform_stats)
from eventmill.operators.validate import decode_json, reject_reasons, user_id_int, validate_events
from eventmill.plans.registry import register
from eventmill.plans.sqlgen import accepted_sql, category_case, q, transform_sql
from eventmill.schemas import RAW_FIELDS
from eventmill.session import scratch_dir
from eventmill.sinks.clustered import write_clustered
from eventmill.sinks.topic import partition_batch_counts, to_topic_rows
from eventmill.sources.raw import raw_events, raw_events_sql, to_json_messages
from eventmill.sources.stage import staged

RAW = raw_events_sql()
TR = transform_sql(RAW)
ACC = accepted_sql(RAW)

EVENT_OUT = ["event_id", "user_id", "event_type", "event_date", "timestamp", "hour_of_day", "day_of_week",
             "is_weekend", "event_category", "session_id", "ip_address", "user_agent", "referrer", "page_url",
             "properties_text", "browser", "os", "device_type", "country", "region", "city"]
EVENT_OUT_SQL = ", ".join(f'"{c}"' for c in EVENT_OUT)

# Fixed parameters of registered lookups / modelled loads.
STORED_BEFORE = "2024-01-15"          # the "already stored" load: events before this day
SESSION_LOOKUP = "s-7-20240115-1"
COUNTRY_LOOKUP = "US"
TOPIC = "events_raw"
N_PARTITIONS = 6


def _accepted(spark, sf):
    return transform_events(raw_events(spark, sf))


@register("transform_events", f"SELECT {EVENT_OUT_SQL} FROM {ACC} a")
def q_transform_events(spark, sf):
    return _accepted(spark, sf).select(*EVENT_OUT)


@register("user_id_cast", f"""SELECT DISTINCT user_id AS user_id_text,
  CASE WHEN regexp_matches(regexp_replace(regexp_replace(user_id, '^\\s+', ''), '\\s+$', ''), '^[+-]?[0-9]+(_[0-9]+)*$')
  THEN TRY_CAST(replace(regexp_replace(regexp_replace(user_id, '^\\s+', ''), '\\s+$', ''), '_', '') AS BIGINT) END AS user_id
  FROM {RAW} r""")
def q_user_id_cast(spark, sf):
    r = raw_events(spark, sf)
    return r.select(F.col("user_id").alias("user_id_text"), user_id_int(F.col("user_id")).alias("user_id")).distinct()


@register("time_fields", f"""SELECT event_id, "timestamp", event_date, hour_of_day, day_of_week, is_weekend FROM {ACC} a""")
def q_time_fields(spark, sf):
    return _accepted(spark, sf).select("event_id", "timestamp", "event_date", "hour_of_day", "day_of_week", "is_weekend")


@register("flat_rows", f"""SELECT event_id, user_id, event_type, event_date,
  date_trunc('millisecond', "timestamp") AS "timestamp", hour_of_day, day_of_week, CAST(is_weekend AS INTEGER) AS is_weekend,
  event_category, session_id, ip_address, user_agent, coalesce(referrer, '') AS referrer, page_url,
  properties_text AS properties FROM {ACC} a""")
def q_flat_rows(spark, sf):
    return to_flat(_accepted(spark, sf))


@register("document_rows", f"""SELECT event_id AS _id, event_id, user_id, event_type, CAST(event_date AS VARCHAR) AS event_date,
  strftime("timestamp", '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime("timestamp", '%f') <> '000000'
    THEN '.' || strftime("timestamp", '%f') ELSE '' END || 'Z' AS "timestamp",
  hour_of_day, day_of_week, is_weekend, event_category, session_id, ip_address, user_agent, referrer, page_url,
  CASE WHEN properties_text = '{{}}' AND src.properties IS NULL THEN '{{}}'
       WHEN json_valid(src.properties) THEN CAST(json(CASE WHEN json_valid(src.properties) THEN src.properties END) AS VARCHAR)
       ELSE '{{"raw_properties":' || CAST(to_json(src.properties) AS VARCHAR) || '}}' END AS properties_json,
  browser, os, device_type, country, region, city,
  coalesce(country, '') <> '' AS geo_enriched, coalesce(browser, '') <> '' AS user_agent_parsed,
  {q(dims.PROCESSED_VERSION)} AS processed_version
  FROM {ACC} a JOIN (SELECT src_id AS sid, delivery AS dv, properties FROM {RAW} rr) src
  ON src.sid = a.src_id AND src.dv = a.delivery""")
def q_document_rows(spark, sf):
    d = to_document(_accepted(spark, sf))
    return d.select(*[c for c in d.columns if c not in ("properties", "processed_at", "enrichment")],
                    F.to_json(F.col("properties")).alias("properties_json"),
                    "enrichment.geo_enriched", "enrichment.user_agent_parsed", "enrichment.processed_version")


NULL_FILL_COLS = ["event_id", "user_id", "event_type", "hour_of_day", "day_of_week", "session_id", "referrer",
                  "user_agent", "page_url", "browser", "os", "device_type", "country", "region", "city"]


@register("null_fill", f"""SELECT coalesce(event_id, '') AS event_id, coalesce(user_id, 0) AS user_id,
  coalesce(event_type, '') AS event_type, coalesce(hour_of_day, 0) AS hour_of_day, coalesce(day_of_week, 0) AS day_of_week,
  session_id, coalesce(referrer, '') AS referrer, user_agent, page_url, coalesce(browser, '') AS browser,
  coalesce(os, '') AS os, coalesce(device_type, '') AS device_type, coalesce(country, '') AS country,
  coalesce(region, '') AS region, coalesce(city, '') AS city FROM {TR} t""")
def q_null_fill(spark, sf):
    return fill_nulls(transform(raw_events(spark, sf)).select(*NULL_FILL_COLS))


@register("validate_events", f"""SELECT event_id, "timestamp", reject_reason IS NULL AS is_valid, reject_reason
  FROM (SELECT r.event_id, r."timestamp", t.reject_reason FROM {TR} t
        JOIN {RAW} r ON r.src_id = t.src_id AND r.delivery = t.delivery) x""")
def q_validate_events(spark, sf):
    return validate_events(raw_events(spark, sf))


@register("reject_reasons", f"SELECT reject_reason, count(*) AS n FROM {TR} t WHERE reject_reason IS NOT NULL GROUP BY 1")
def q_reject_reasons(spark, sf):
    return reject_reasons(raw_events(spark, sf))


@register("dedup_events", f'SELECT event_id, user_id, event_type, "timestamp" FROM {ACC} a')
def q_dedup_events(spark, sf):
    return _accepted(spark, sf).select("event_id", "user_id", "event_type", "timestamp")


@register("duplicate_report", f"""SELECT event_id, count(*) AS count FROM {TR} t WHERE reject_reason IS NULL
  GROUP BY 1 HAVING count(*) > 1""")
def q_duplicate_report(spark, sf):
    ok = transform(raw_events(spark, sf)).where(F.col("reject_reason").isNull())
    return duplicate_report(ok, "event_id")


@register("category_lookup", f"""SELECT DISTINCT event_type AS event_type_raw, lower(event_type) AS event_type,
  {category_case('event_type')} AS event_category
  FROM {RAW} r""")
def q_category_lookup(spark, sf):
    from eventmill.functions.category import category_of
    r = raw_events(spark, sf)
    return r.select(F.col("event_type").alias("event_type_raw"), F.lower("event_type").alias("event_type"),
                    category_of(F.col("event_type")).alias("event_category")).distinct()


def _seed_values_sql() -> str:
    rows = ", ".join(f"({q(t)}, {q(c)}, {q(d)}, 1)" for t, c, d in dims.CATEGORY_SEED)
    return f"(VALUES {rows}) AS s(event_type, category, description, is_active)"


@register("category_join", f"""SELECT a.event_type, s.category, s.description, s.is_active, count(*) AS event_count
  FROM {ACC} a LEFT JOIN {_seed_values_sql()} ON a.event_type = s.event_type GROUP BY ALL""")
def q_category_join(spark, sf):
    ev = _accepted(spark, sf)
    return (category_join(ev, dims.category_seed(spark))
            .groupBy("event_type", "category", "description", "is_active")
            .agg(F.count(F.lit(1)).alias("event_count")))


def _with_stored(spark, sf):
    """All accepted events, and the ids of those before a day as a document store holds them."""
    from eventmill.session import scratch_dir
    from eventmill.sinks.files import read_documents, write_document
    path = scratch_dir(spark, "stored")
    ev = _accepted(spark, sf)
    write_document(spark, ev.where(F.col("event_date") < F.lit(STORED_BEFORE).cast("date")), path)
    return ev.select("event_id", "event_date"), read_documents(spark, path).select(F.col("_id").alias("event_id"))


@register("new_events_anti", f"""SELECT a.event_id, a.event_date FROM {ACC} a
  WHERE NOT EXISTS (SELECT 1 FROM {ACC} s WHERE s.event_date < DATE '{STORED_BEFORE}' AND s.event_id = a.event_id)""")
def q_new_events_anti(spark, sf):
    ev, stored = _with_stored(spark, sf)
    return new_rows_anti(ev, stored).select("event_id", "event_date")


@register("skipped_events_semi", f"""SELECT a.event_id, a.event_date FROM {ACC} a
  WHERE EXISTS (SELECT 1 FROM {ACC} s WHERE s.event_date < DATE '{STORED_BEFORE}' AND s.event_id = a.event_id)""")
def q_skipped_events_semi(spark, sf):
    ev, stored = _with_stored(spark, sf)
    return stored_rows_semi(ev, stored).select("event_id", "event_date")


def _private_sql() -> str:
    rows = [f"({lo}, {hi}, true)" for lo, hi in map(dims.cidr_bounds, dims.PRIVATE_V4_BLOCKS)]
    rows += [f"({lo}, {hi}, false)" for lo, hi in map(dims.cidr_bounds, dims.PRIVATE_V4_EXCEPTIONS)]
    return f"(VALUES {', '.join(rows)}) AS p(lo, hi, private)"


@register("ip_private_range", f"""WITH ips AS (SELECT DISTINCT ip_address,
  CAST(split_part(ip_address, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip_address, '.', 2) AS BIGINT) * 65536
  + CAST(split_part(ip_address, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip_address, '.', 4) AS BIGINT) AS ip_num
  FROM {RAW} r WHERE regexp_matches(coalesce(ip_address, ''), {q(V4_REGEX)}))
SELECT ip_address, ip_num, coalesce(bool_or(p.private), false) AND NOT coalesce(bool_or(NOT p.private), false) AS is_private
FROM ips LEFT JOIN {_private_sql()} ON ips.ip_num BETWEEN p.lo AND p.hi GROUP BY ip_address, ip_num""")
def q_ip_private_range(spark, sf):
    r = raw_events(spark, sf)
    ips = (r.select("ip_address", ipv4_num(F.col("ip_address")).alias("ip_num"))
           .where(F.col("ip_num").isNotNull()).distinct())
    return ip_private_ranges(ips, dims.private_ranges(spark))


_V4_PART = "split_part(ip_address, '.', {})"
_FIXED_NETS = [*dims.PRIVATE_V4_BLOCKS, *dims.PRIVATE_V4_EXCEPTIONS]
_NUM_SQL = " + ".join(f"CAST(split_part({{0}}, '.', {i}) AS BIGINT) * {256 ** (4 - i)}" for i in range(1, 5))


@register("ip_longest_prefix", f"""WITH ips AS (SELECT DISTINCT ip_address FROM {RAW} r WHERE regexp_matches(coalesce(ip_address, ''), {q(V4_REGEX)})),
nets AS (SELECT DISTINCT {_V4_PART.format(1)} || '.0.0.0/8' AS network FROM ips
  UNION SELECT {_V4_PART.format(1)} || '.' || {_V4_PART.format(2)} || '.0.0/16' FROM ips WHERE CAST({_V4_PART.format(2)} AS INT) % 2 = 0
  UNION SELECT {_V4_PART.format(1)} || '.' || {_V4_PART.format(2)} || '.' || {_V4_PART.format(3)} || '.0/24' FROM ips WHERE CAST({_V4_PART.format(3)} AS INT) % 3 = 0
  UNION SELECT unnest([{', '.join(q(b) for b in _FIXED_NETS)}])),
sized AS (SELECT network, CAST(split_part(network, '/', 2) AS INT) AS bits, {_NUM_SQL.format("split_part(network, '/', 1)")} AS lo FROM nets)
SELECT ip_address, arg_max(network, bits) AS network FROM (SELECT ip_address, {_NUM_SQL.format("ip_address")} AS num FROM ips) i
LEFT JOIN sized ON num >= lo AND num < lo + (1::BIGINT << (32 - bits)) GROUP BY ip_address""")
def q_ip_longest_prefix(spark, sf):
    """Every distinct IPv4 address with the longest of the networks seen (nested /8, /16, /24) and the fixed blocks."""
    ips = raw_events(spark, sf).select("ip_address").where(F.col("ip_address").rlike(V4_REGEX)).distinct()
    octet = [F.split("ip_address", r"\.")[i] for i in range(3)]
    zero = F.lit("0")
    seen = ips.select(F.explode(F.array(
        F.concat(F.concat_ws(".", octet[0], zero, zero, zero), F.lit("/8")),
        F.when(octet[1].cast("int") % 2 == 0, F.concat(F.concat_ws(".", octet[0], octet[1], zero, zero), F.lit("/16"))),
        F.when(octet[2].cast("int") % 3 == 0, F.concat(F.concat_ws(".", *octet, zero), F.lit("/24"))))).alias("network"))
    fixed = spark.createDataFrame([(b,) for b in _FIXED_NETS], "network string")
    return longest_prefix(ips, seen.where(F.col("network").isNotNull()).union(fixed))


@register("geo_hash", f"SELECT DISTINCT ip_address, country, region, city FROM {TR} t")
def q_geo_hash(spark, sf):
    r = raw_events(spark, sf).select(F.coalesce(F.col("ip_address"), F.lit("")).alias("ip_address")).distinct()
    return with_geo(r)


@register("agent_rules", f"SELECT DISTINCT user_agent, browser, os, device_type FROM {TR} t")
def q_agent_rules(spark, sf):
    r = raw_events(spark, sf).select(F.coalesce(F.col("user_agent"), F.lit("")).alias("user_agent")).distinct()
    return r.select("user_agent", agent_struct(F.col("user_agent")).alias("a")).select("user_agent", "a.*")


@register("sanitize_properties", f"""SELECT DISTINCT r.properties AS properties_raw, t.properties_text,
  CASE WHEN r.properties IS NULL THEN '{{}}'
       WHEN json_valid(r.properties) THEN CAST(json(CASE WHEN json_valid(r.properties) THEN r.properties END) AS VARCHAR)
       ELSE '{{"raw_properties":' || CAST(to_json(r.properties) AS VARCHAR) || '}}' END AS properties_json
  FROM {TR} t JOIN {RAW} r ON r.src_id = t.src_id AND r.delivery = t.delivery""")
def q_sanitize_properties(spark, sf):
    r = raw_events(spark, sf).select(F.col("properties").alias("properties_raw")).distinct()
    return r.select("properties_raw", props_flat_text(F.col("properties_raw")).alias("properties_text"),
                    F.to_json(props_variant(F.col("properties_raw"))).alias("properties_json"))


@register("property_extract", f"""SELECT a.event_id, TRY_CAST(json_extract(CASE WHEN json_valid(r.properties) THEN r.properties END, '$.k') AS INTEGER) AS k
  FROM {ACC} a JOIN {RAW} r ON r.src_id = a.src_id AND r.delivery = a.delivery""")
def q_property_extract(spark, sf):
    return _accepted(spark, sf).select("event_id", property_get(F.col("properties"), "k", "int").alias("k"))


@register("dead_letter", f"""SELECT r.event_id, r.user_id, r.event_type, r."timestamp", t.reject_reason
  FROM {TR} t JOIN {RAW} r ON r.src_id = t.src_id AND r.delivery = t.delivery WHERE t.reject_reason IS NOT NULL""")
def q_dead_letter(spark, sf):
    from eventmill.sinks.files import dead_letter_rows
    return dead_letter_rows(raw_events(spark, sf)).select("event_id", "user_id", "event_type", "timestamp",
                                                          "reject_reason")


@register("transform_stats", f"""SELECT count(*) AS processed,
  count(*) FILTER (WHERE reject_reason IS NULL) - count(DISTINCT CASE WHEN reject_reason IS NULL THEN event_id END) AS duplicates,
  count(*) FILTER (WHERE reject_reason IS NOT NULL) AS errors,
  count(*) FILTER (WHERE reject_reason IS NOT NULL) AS validation_errors,
  count(DISTINCT CASE WHEN reject_reason IS NULL AND (browser IS NOT NULL OR country IS NOT NULL) THEN event_id END) AS enriched
  FROM {TR} t""")
def q_transform_stats(spark, sf):
    return transform_stats(transform(raw_events(spark, sf)))


@register("decode_json", f"""SELECT event_id, user_id, event_type, "timestamp", properties,
  CASE WHEN regexp_matches(user_id, '^-?[0-9]{{1,18}}$') THEN 'BIGINT' WHEN user_id IS NULL THEN 'VOID' ELSE 'STRING' END AS user_id_json_type,
  CASE WHEN properties IS NULL THEN 'null' ELSE 'string' END AS props_kind,
  CASE WHEN event_id IS NULL THEN 'type:event_id' WHEN user_id IS NULL THEN 'type:user_id'
       WHEN event_type IS NULL THEN 'type:event_type' WHEN "timestamp" IS NULL THEN 'type:timestamp' END AS null_reason
  FROM {RAW} r""")
def q_decode_json(spark, sf):
    msgs = staged(spark, to_json_messages(raw_events(spark, sf)), "messages")
    d = decode_json(msgs)
    nulls = None
    for f in ["event_id", "user_id", "event_type", "timestamp"]:
        cond = F.col("_jtypes").getField(f) == "VOID"
        nulls = F.when(cond, F.lit(f"type:{f}")) if nulls is None else nulls.when(cond, F.lit(f"type:{f}"))
    return d.select("event_id", "user_id", "event_type", "timestamp", "properties",
                    F.col("_jtypes.user_id").alias("user_id_json_type"), F.col("_props_kind").alias("props_kind"),
                    nulls.alias("null_reason"))


def _encode_json_sql() -> str:
    # B7 in DuckDB: compact JSON with nulls kept, fields in RAW order; a numeric user_id
    # unquoted, as the Spark serialiser writes it
    cols = [f'"{f}"' if f == "timestamp" else f for f in RAW_FIELDS]
    fields = ", ".join(f"'{f}', {c}" for f, c in zip(RAW_FIELDS, cols))
    return f"""SELECT CASE WHEN regexp_matches(user_id, '^-?[0-9]{{1,18}}$')
    THEN regexp_replace(j, '"user_id":"(-?[0-9]+)"', '"user_id":\\1', 'g') ELSE j END AS value
  FROM (SELECT user_id, CAST(json_object({fields}) AS VARCHAR) AS j FROM {RAW} r)"""


@register("encode_json", _encode_json_sql())
def q_encode_json(spark, sf):
    return to_json_messages(raw_events(spark, sf))


#: The fixed rates under the driver's type names, so that rows are sampled away.
TEST_RATES = [*dims.SAMPLING_RATES, ("view", 0.1), ("click", 0.05), ("signup", 0.5)]
_RATE = "(CASE event_type " + " ".join(f"WHEN {q(t)} THEN {r}" for t, r in TEST_RATES) + " ELSE NULL END)"


@register("sample_by_type", f"""SELECT event_id, event_type FROM {ACC} a
  WHERE {_RATE} IS NULL OR (CAST(('0x' || substr(md5(event_id), 1, 8)) AS BIGINT) % 10000) < {_RATE} * 10000""")
def q_sample_by_type(spark, sf):
    rates = spark.createDataFrame(TEST_RATES, "event_type string, rate double")
    return sample_by_type(_accepted(spark, sf), rates).select("event_id", "event_type")


@register("topic_rows", f"""SELECT '{TOPIC}' AS topic, event_id AS key, CAST(user_id % {N_PARTITIONS} AS INTEGER) AS partition,
  CAST(to_json({{'event_id': event_id, 'user_id': user_id, 'event_type': event_type, 'session_id': session_id}}) AS VARCHAR) AS value,
  octet_length(CAST(to_json({{'event_id': event_id, 'user_id': user_id, 'event_type': event_type, 'session_id': session_id}}) AS VARCHAR)::BLOB) AS bytes
  FROM {ACC} a""")
def q_topic_rows(spark, sf):
    ev = _accepted(spark, sf).select("event_id", "user_id", "event_type", "session_id")
    return to_topic_rows(ev, TOPIC, key="event_id",
                         partition=lambda d: F.pmod(F.col("user_id"), F.lit(N_PARTITIONS)).cast("int")).drop("headers")


@register("partition_batch_counts", f"""SELECT CAST(user_id % {N_PARTITIONS} AS INTEGER) AS partition, count(*) AS sent,
  CAST(0 AS BIGINT) AS failed, count(*) AS total FROM {ACC} a GROUP BY 1 ORDER BY 1""")
def q_partition_batch_counts(spark, sf):
    ev = _accepted(spark, sf).select("event_id", "user_id", "event_type", "session_id")
    rows = to_topic_rows(ev, TOPIC, key="event_id",
                         partition=lambda d: F.pmod(F.col("user_id"), F.lit(N_PARTITIONS)).cast("int"))
    return partition_batch_counts(rows)


_STORED: dict[tuple[str, str], str] = {}


def _stored_events(spark, sf):
    """The accepted events as one clustered table for all lookups, written once per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        path = scratch_dir(spark, "events-clustered")
        write_clustered(_accepted(spark, sf).select(*EVENT_OUT), path, ["user_id", "country", "event_date", "event_type"],
                        bloom=("user_id", "session_id"))
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


@register("country_timeline", f"""SELECT {EVENT_OUT_SQL} FROM {ACC} a WHERE country IS NOT NULL AND country = '{COUNTRY_LOOKUP}'
  ORDER BY "timestamp" DESC, event_id LIMIT 100""")
def q_country_timeline(spark, sf):
    return L.country_timeline(_stored_events(spark, sf), COUNTRY_LOOKUP)


@register("session_timeline", f"""SELECT {EVENT_OUT_SQL} FROM {ACC} a WHERE session_id = '{SESSION_LOOKUP}'
  ORDER BY "timestamp", event_id""")
def q_session_timeline(spark, sf):
    return L.session_timeline(_stored_events(spark, sf), SESSION_LOOKUP)


@register("reject_ratio_gate", f"""SELECT src_id // 1000 AS batch_id, count(*) AS n,
  count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejects,
  round(avg(CASE WHEN reject_reason IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS reject_ratio,
  avg(CASE WHEN reject_reason IS NOT NULL THEN 1.0 ELSE 0.0 END) > 0.5 AS failed
  FROM {TR} t GROUP BY 1""")
def q_reject_ratio_gate(spark, sf):
    from eventmill.operators.metrics import reject_ratio_gate
    t = transform(raw_events(spark, sf)).withColumn("batch_id", F.floor(F.col("src_id") / 1000))
    return reject_ratio_gate(t, "batch_id", threshold=0.5)
