"""Helpers that render the fixed dimension data as ANSI SQL for the DuckDB oracle."""

from __future__ import annotations

from eventmill import dims


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def category_case(expr: str, source: str = "code") -> str:
    whens = []
    for cat, _d, types in dims.CATEGORIES:
        if source == "code" and cat not in dims.CODE_CATEGORIES:
            continue
        whens += [f"WHEN {q(t)} THEN {q(cat)}" for t in types]
    return f"(CASE lower({expr}) {' '.join(whens)} ELSE {q(dims.DEFAULT_CATEGORY)} END)"


def priority_case(expr: str) -> str:
    whens = [f"WHEN {q(t)} THEN {q(p)}" for p, types in dims.PRIORITIES for t in types]
    return f"(CASE lower({expr}) {' '.join(whens)} ELSE 'low' END)"


def priority_rank_case(expr: str) -> str:
    whens = [f"WHEN {q(t)} THEN {dims.PRIORITY_RANK[p]}" for p, types in dims.PRIORITIES for t in types]
    return f"(CASE lower({expr}) {' '.join(whens)} ELSE {dims.PRIORITY_RANK['low']} END)"


# The flat event view over the driver table, in DuckDB SQL.
EVENTS_VIEW = f"""(SELECT event_id, user_id, event_type, ts AS "timestamp", CAST(ts AS DATE) AS event_date,
  CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  {category_case('event_type')} AS event_category,
  's-' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') || '-' || CAST(hour(ts) // 8 AS VARCHAR) AS session_id,
  value, props FROM events)"""

AS_OF = "(SELECT max(ts) FROM events)"
TODAY = f"CAST({AS_OF} AS DATE)"


# ---------------------------------------------------------------------------
# The transform chain in DuckDB SQL (oracle of the C/D/E/F/K keys).
# ---------------------------------------------------------------------------

def _strip(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '^\\s+', ''), '\\s+$', '')"


def _rule_case(expr: str, rules, default: str) -> str:
    parts = []
    for label, must, must_not in rules:
        cond = f"regexp_matches({expr}, {q(must)})"
        if must_not:
            cond += f" AND NOT regexp_matches({expr}, {q(must_not)})"
        parts.append(f"WHEN {cond} THEN {q(label)}")
    return f"(CASE {' '.join(parts)} ELSE {q(default)} END)"


def _agent(expr: str, rules, default: str) -> str:
    return f"(CASE WHEN coalesce({expr}, '') = '' THEN NULL ELSE {_rule_case(expr, rules, default)} END)"


def _private_v4(num: str) -> str:
    ins = " OR ".join(f"{num} BETWEEN {lo} AND {hi}" for lo, hi in map(dims.cidr_bounds, dims.PRIVATE_V4_BLOCKS))
    exc = " OR ".join(f"{num} BETWEEN {lo} AND {hi}" for lo, hi in map(dims.cidr_bounds, dims.PRIVATE_V4_EXCEPTIONS))
    return f"(({ins}) AND NOT ({exc}))"


def _pick(values, h: str) -> str:
    arr = "[" + ", ".join(q(v) for v in values) + "]"
    return f"list_extract({arr}, CAST({h} % {len(values)} + 1 AS INTEGER))"


def transform_sql(raw_sql: str) -> str:
    """Tagged, enriched events (one row per raw row) as DuckDB SQL."""
    from eventmill.functions.ipaddr import V4_REGEX
    from eventmill.functions.timefn import COMPACT_GUARD, COMPACT_PATTERN, ISO_GUARD
    from eventmill.functions.props import FALSY_JSON
    assert COMPACT_PATTERN == "yyyyMMdd'T'HHmmss"
    ip = "coalesce(ip_address, '')"
    num = (f"(CAST(split_part({ip}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({ip}, '.', 2) AS BIGINT) * 65536"
           f" + CAST(split_part({ip}, '.', 3) AS BIGINT) * 256 + CAST(split_part({ip}, '.', 4) AS BIGINT))")
    falsy = ", ".join(q(x) for x in FALSY_JSON)
    return f"""(WITH r AS {raw_sql},
s1 AS (SELECT *,
  CASE WHEN regexp_matches("timestamp", {q(ISO_GUARD)}) THEN TRY_CAST("timestamp" AS TIMESTAMPTZ) AT TIME ZONE 'UTC'
       WHEN regexp_matches("timestamp", {q(COMPACT_GUARD)}) THEN try_strptime("timestamp", '%Y%m%dT%H%M%S') END AS _ts,
  CASE WHEN regexp_matches({_strip('user_id')}, '^[+-]?[0-9]+(_[0-9]+)*$')
       THEN TRY_CAST(replace({_strip('user_id')}, '_', '') AS BIGINT) END AS _uid,
  json_valid(properties) AS _pj_ok,
  CASE WHEN json_valid(properties) THEN properties END AS _pj_text,
  CASE WHEN regexp_matches({ip}, {q(V4_REGEX)}) THEN {num} END AS _ipn,
  false AS _v6,  -- the driver's addresses hold no IPv6; a test holds those against Python's ipaddress
  CAST(('0x' || substr(md5({ip}), 1, 8)) AS BIGINT) AS _h
  FROM r),
s2 AS (SELECT *,
  CASE WHEN event_id IS NULL THEN 'missing:event_id'
       WHEN user_id IS NULL THEN 'missing:user_id'
       WHEN _uid IS NULL THEN 'type:user_id'
       WHEN event_type IS NULL THEN 'missing:event_type'
       WHEN "timestamp" IS NULL THEN 'missing:timestamp'
       WHEN {_strip('event_id')} = '' THEN 'empty:event_id'
       WHEN _ts IS NULL THEN 'format:timestamp' END AS reject_reason,
  ({ip} <> '' AND (_ipn IS NOT NULL OR _v6)) AS _ip_valid,
  CASE WHEN _ipn IS NOT NULL THEN {_private_v4('_ipn')} ELSE false END AS _ip_private
  FROM s1)
SELECT src_id, delivery, reject_reason, event_id, _uid AS user_id, lower(event_type) AS event_type,
  CAST(_ts AS DATE) AS event_date, _ts AS "timestamp", CAST(hour(_ts) AS INTEGER) AS hour_of_day,
  CAST(isodow(_ts) - 1 AS INTEGER) AS day_of_week, isodow(_ts) >= 6 AS is_weekend,
  {category_case('event_type')} AS event_category,
  coalesce(session_id, '') AS session_id, coalesce(ip_address, '') AS ip_address,
  coalesce(user_agent, '') AS user_agent, referrer, coalesce(page_url, '') AS page_url,
  CASE WHEN properties IS NULL THEN '{{}}'
       WHEN _pj_ok THEN CASE WHEN CAST(json(_pj_text) AS VARCHAR) IN ({falsy}) THEN '{{}}' ELSE trim(properties) END
       ELSE '{{"raw_properties": ' || CAST(to_json(properties) AS VARCHAR) || '}}' END AS properties_text,
  {_agent('user_agent', dims.AGENT_BROWSER_RULES, dims.AGENT_DEFAULT_BROWSER)} AS browser,
  {_agent('user_agent', dims.AGENT_OS_RULES, dims.AGENT_DEFAULT_OS)} AS os,
  {_agent('user_agent', dims.AGENT_DEVICE_RULES, dims.AGENT_DEFAULT_DEVICE)} AS device_type,
  CASE WHEN NOT _ip_valid THEN NULL WHEN _ip_private THEN {q(dims.PRIVATE_LABEL)} ELSE {_pick(dims.GEO_COUNTRIES, '_h')} END AS country,
  CASE WHEN NOT _ip_valid THEN NULL WHEN _ip_private THEN {q(dims.PRIVATE_LABEL)} ELSE {_pick(dims.GEO_REGIONS, '_h')} END AS region,
  CASE WHEN NOT _ip_valid THEN NULL WHEN _ip_private THEN {q(dims.PRIVATE_LABEL)} ELSE {_pick(dims.GEO_CITIES, '_h')} END AS city
FROM s2)"""


def accepted_sql(raw_sql: str) -> str:
    """Accepted events, first delivery per event_id."""
    return f"""(SELECT * EXCLUDE (reject_reason) FROM {transform_sql(raw_sql)} t WHERE reject_reason IS NULL
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY delivery, src_id) = 1)"""
