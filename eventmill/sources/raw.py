"""Raw events derived from the driver `events` table.

The driver table holds clean, typed events; the engine's input is raw JSON messages
with bad rows and repeats.  `raw_events` derives such input deterministically from the
whole table (every row, plus a second delivery of some rows) so that validation,
de-duplication and enrichment have real work; the same formula is written in DuckDB
SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.schemas import RAW_FIELDS
from eventmill.sources.tables import read_table

# FIXED VALUES of the derivation: six user agents picked by id % 6.
FIXTURE_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.2 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (iPad; CPU OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.2 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
    "",
]
# Rows whose id % DUP_MOD == DUP_REM are delivered twice.
DUP_MOD, DUP_REM = 50, 7


def _s(c: Column) -> Column:
    return c.cast("string")


def raw_events(spark: SparkSession, sf_dir: str, with_meta: bool = True) -> DataFrame:
    """Raw (all-text) events: the whole table plus a repeat delivery of 1 row in 50.

    Meta columns (with_meta): `src_id` (driver id) and `delivery` (0 first, 1 repeat),
    which give the arrival order used for "first delivery wins".
    """
    e = read_table(spark, sf_dir, "events")
    both = (e.withColumn("delivery", F.lit(0))
            .unionByName(e.where(F.col("event_id") % DUP_MOD == DUP_REM).withColumn("delivery", F.lit(1))))
    i, u, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    cols = {
        "event_id": F.when(i % 97 == 13, F.lit(" ")).otherwise(_s(i)),
        "user_id": F.when(i % 89 == 11, F.lit("not_a_number")).otherwise(_s(u)),
        "event_type": (F.when(i % 79 == 3, F.lit(None).cast("string"))
                       .when(i % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type"))),
        "timestamp": F.when(i % 83 == 5, F.lit("garbage"))
                      .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
        "session_id": F.concat(F.lit("s-"), _s(u), F.lit("-"), F.date_format(ts, "yyyyMMdd"),
                               F.lit("-"), _s(F.floor(F.hour(ts) / 8))),
        "ip_address": (F.when(i % 5 == 0, F.concat(F.lit("192.168.1."), _s(u % 256)))
                       .when(i % 5 == 1, F.lit(None).cast("string"))
                       .when(i % 5 == 4, F.lit("not-an-ip"))
                       .otherwise(F.concat(F.lit("8."), _s(u % 256), F.lit("."), _s(i % 256), F.lit(".7")))),
        "user_agent": F.element_at(F.array(*[F.lit(a) for a in FIXTURE_AGENTS]), (i % 6 + 1).cast("int")),
        "referrer": F.when(i % 3 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("https://ref"), _s(i % 10), F.lit(".example"))),
        "page_url": F.concat(F.lit("https://site"), _s(i % 4), F.lit(".example/p/"), _s(i % 20)),
        "properties": F.when(i % 71 == 2, F.lit("bad json")).otherwise(F.col("props")),
    }
    out = [cols[f].alias(f) for f in RAW_FIELDS]
    if with_meta:
        out += [i.alias("src_id"), F.col("delivery")]
    return both.select(*out)


def raw_events_sql() -> str:
    """The same derivation in DuckDB SQL (a sub-select named by the caller)."""
    agents = ", ".join("'" + a.replace("'", "''") + "'" for a in FIXTURE_AGENTS)
    return f"""(SELECT
  CASE WHEN event_id % 97 = 13 THEN ' ' ELSE CAST(event_id AS VARCHAR) END AS event_id,
  CASE WHEN event_id % 89 = 11 THEN 'not_a_number' ELSE CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN event_id % 79 = 3 THEN NULL WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS event_type,
  CASE WHEN event_id % 83 = 5 THEN 'garbage' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS "timestamp",
  's-' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') || '-' || CAST(hour(ts) // 8 AS VARCHAR) AS session_id,
  CASE event_id % 5 WHEN 0 THEN '192.168.1.' || CAST(user_id % 256 AS VARCHAR) WHEN 1 THEN NULL
       WHEN 4 THEN 'not-an-ip' ELSE '8.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) || '.7' END AS ip_address,
  list_extract([{agents}], CAST(event_id % 6 + 1 AS INTEGER)) AS user_agent,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'https://ref' || CAST(event_id % 10 AS VARCHAR) || '.example' END AS referrer,
  'https://site' || CAST(event_id % 4 AS VARCHAR) || '.example/p/' || CAST(event_id % 20 AS VARCHAR) AS page_url,
  CASE WHEN event_id % 71 = 2 THEN 'bad json' ELSE props END AS properties,
  event_id AS src_id, delivery
FROM (SELECT *, 0 AS delivery FROM events UNION ALL SELECT *, 1 AS delivery FROM events WHERE event_id % {DUP_MOD} = {DUP_REM}))"""


def to_json_messages(raw: DataFrame, keep_meta: bool = False) -> DataFrame:
    """Serialise raw rows to one JSON text per message (`value`).

    NULL fields are written as JSON null (ignoreNullFields=false) so a null referrer
    stays present, like the source serialiser; `user_id` is written as a JSON number
    when it is all digits, else as text.
    """
    body = F.to_json(F.struct(*[F.col(f) for f in RAW_FIELDS]), {"ignoreNullFields": "false"})
    # A numeric user_id is written as a JSON number (the usual producer form); other
    # text stays a JSON string.
    body = F.when(F.col("user_id").rlike(r"^-?[0-9]{1,18}$"),
                  F.regexp_replace(body, r'"user_id":"(-?[0-9]+)"', '"user_id":$1')).otherwise(body)
    out = [body.alias("value")]
    if keep_meta:
        out += [c for c in raw.columns if c not in RAW_FIELDS]
    return raw.select(*out)
