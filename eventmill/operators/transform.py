"""The event transform chain (C1-C10) and the two output shapes.

`transform` tags every raw row with a reject reason and builds the typed, enriched
event columns in one projection; `split` separates accepted from rejected rows and
de-duplicates the accepted ones.  Everything is one Catalyst plan: a single scan, a
projection chain fused by whole-stage codegen, and one shuffle (the key aggregate of
de-duplication).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill import dims
from eventmill.functions.agent import agent_struct
from eventmill.functions.category import category_of
from eventmill.functions.ipaddr import GEO_COLUMNS, with_geo
from eventmill.functions.props import props_flat_text, props_variant
from eventmill.functions.timefn import iso_z_text, parse_ts
from eventmill.operators.dedup import dedup
from eventmill.operators.validate import reject_reason, user_id_int
from eventmill.schemas import ENRICH_COLUMNS, FLAT_COLUMNS, RAW_FIELDS

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "event_date", "timestamp", "hour_of_day",
                 "day_of_week", "is_weekend", "event_category", "session_id", "ip_address",
                 "user_agent", "referrer", "page_url", "properties_text", "properties"] + ENRICH_COLUMNS


def tag(raw: DataFrame, *, validate: bool = True, offset_mode: str = "utc") -> DataFrame:
    """Rules only: raw columns, meta columns, `_ts` and `_uid` (parsed once) and `reject_reason`."""
    meta = [c for c in raw.columns if c not in RAW_FIELDS and not c.startswith("_")]
    hidden = [c for c in raw.columns if c.startswith("_")]
    kind = [c for c in hidden if c == "_props_kind"]
    parsed = raw.select(*meta, *hidden, *RAW_FIELDS, parse_ts(F.col("timestamp"), offset_mode).alias("_ts"),
                        user_id_int(F.col("user_id")).alias("_uid"))
    rr = reject_reason(parsed, offset_mode, F.col("_ts"), F.col("_uid")) if validate else F.lit(None).cast("string")
    return parsed.select(*meta, *kind, *RAW_FIELDS, "_ts", "_uid", rr.alias("reject_reason"))


def shape(tagged: DataFrame, *, enrich: bool = True, category_source: str = "code") -> DataFrame:
    """Tagged raw rows -> typed, enriched event columns (and `reject_reason` if it is there).

    Built in projections so every costly expression (JSON parse, address facts, md5) is
    computed once per row; Catalyst keeps the stages apart rather than inlining an
    expensive expression twice, and drops those that a query does not select.
    """
    meta = [c for c in tagged.columns if c not in RAW_FIELDS and not c.startswith("_")]
    kind = F.col("_props_kind") if "_props_kind" in tagged.columns else None
    kind_for_text = F.when(kind == "other", F.lit("other")) if kind is not None else None
    s1 = tagged.withColumn("_pj", F.try_parse_json(F.col("properties")))
    if enrich:
        s1 = with_geo(s1, "ip_address")
    opt = {f: F.coalesce(F.col(f), F.lit("")) for f in ["session_id", "ip_address", "user_agent", "page_url"]}
    c = F.col("_ts")
    s2 = s1.select(
        *meta,
        F.col("event_id"),
        F.col("_uid").alias("user_id"),
        F.lower(F.col("event_type")).alias("event_type"),
        F.to_date(c).alias("event_date"),
        c.alias("timestamp"),
        F.hour(c).alias("hour_of_day"), F.weekday(c).alias("day_of_week"),
        (F.weekday(c) >= 5).alias("is_weekend"),
        category_of(F.col("event_type"), category_source).alias("event_category"),
        *[opt[f].alias(f) for f in ["session_id", "ip_address", "user_agent"]],
        F.col("referrer"),
        opt["page_url"].alias("page_url"),
        props_flat_text(F.col("properties"), kind_for_text, F.col("_pj")).alias("properties_text"),
        props_variant(F.col("properties"), kind_for_text, F.col("_pj")).alias("properties"),
        (agent_struct(F.coalesce(F.col("user_agent"), F.lit(""))) if enrich else F.lit(None)).alias("_ua"),
        *([F.col(g) for g in GEO_COLUMNS] if enrich else [F.lit(None).cast("string").alias(g) for g in GEO_COLUMNS]),
    )
    base = [x for x in s2.columns if x not in ("_ua", *GEO_COLUMNS)]
    if enrich:
        return s2.select(*base, "_ua.browser", "_ua.os", "_ua.device_type", *GEO_COLUMNS)
    return s2.select(*base, *[F.lit(None).cast("string").alias(x) for x in ["browser", "os", "device_type"]],
                     *GEO_COLUMNS)


def transform(raw: DataFrame, *, validate: bool = True, enrich: bool = True,
              offset_mode: str = "utc", category_source: str = "code") -> DataFrame:
    """C1 (row part): raw text events -> tagged typed events.

    Output: `reject_reason` (NULL when accepted) and the event columns; meta columns of the
    input (e.g. arrival order, source offsets) pass through.  Values of rejected rows are
    best effort.  validate=False / enrich=False switch the rule set or the enrichment off.
    """
    return shape(tag(raw, validate=validate, offset_mode=offset_mode), enrich=enrich, category_source=category_source)


def split(tagged: DataFrame, *, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """C2 + F1: (accepted and de-duplicated, rejected)."""
    ok = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = tagged.where(F.col("reject_reason").isNotNull())
    return dedup(ok, "event_id", order), bad


def accepted_dedup(tagged: DataFrame, order: str | None = None, key: str = "event_id") -> DataFrame:
    """Accepted rows, one per key, in a single aggregate over all tagged rows.

    Rejected rows get a NULL ordering and `min_by` ignores NULL orderings, so no filter
    on the computed `reject_reason` is needed before the shuffle (such a filter would be
    pushed below the parse stage and repeat the parsing per row).  Partial aggregation
    collapses a hot key inside each map task.
    """
    ok = F.col("reject_reason").isNull()
    rank = F.when(ok, F.col(order) if order else F.lit(0))
    others = [c for c in tagged.columns if c not in (key, "reject_reason")]
    w = F.min_by(F.struct(*[F.col(c) for c in others]), rank)
    return (tagged.groupBy(key).agg(w.alias("_w"))
            .where(F.col("_w").isNotNull())
            .select(key, *[F.col(f"_w.{c}").alias(c) for c in others]))


def transform_events(raw: DataFrame, *, order: str | None = None, validate: bool = True, enrich: bool = True,
                     offset_mode: str = "utc", category_source: str = "code") -> DataFrame:
    """Accepted, de-duplicated, enriched events (first delivery wins when the input
    carries an arrival order `delivery`).

    The rules and the de-duplication see the raw columns; agent rules, address facts and
    JSON run after the shuffle, once per kept row, and only for the columns a query reads.
    """
    tagged = tag(raw, validate=validate, offset_mode=offset_mode)
    if order is None and "src_id" in tagged.columns and "delivery" in tagged.columns:
        tagged = tagged.withColumn("_seq", F.col("delivery") * F.lit(1 << 40) + F.col("src_id"))
        order = "_seq"
    return shape(accepted_dedup(tagged, order), enrich=enrich, category_source=category_source)


def to_flat(events: DataFrame, *, wide: bool = False, text_times: bool = False) -> DataFrame:
    """The 15 flat columns (processed_at is added by the sink).

    timestamp truncated to milliseconds (timestamp_ntz, or text 'yyyy-MM-dd HH:mm:ss.SSS'
    with text_times=True), is_weekend 0/1, NULL optional text -> '', properties as JSON
    text.  wide=True keeps the enrichment columns too.
    """
    ts = F.date_trunc("millisecond", F.col("timestamp")).cast("timestamp_ntz")
    if text_times:
        ts = F.date_format(F.col("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS")
    cols = {
        "event_id": F.col("event_id"), "user_id": F.col("user_id"), "event_type": F.col("event_type"),
        "event_date": F.col("event_date"), "timestamp": ts,
        "hour_of_day": F.col("hour_of_day"), "day_of_week": F.col("day_of_week"),
        "is_weekend": F.col("is_weekend").cast("int"), "event_category": F.col("event_category"),
        "session_id": F.col("session_id"), "ip_address": F.col("ip_address"),
        "user_agent": F.col("user_agent"), "referrer": F.coalesce(F.col("referrer"), F.lit("")),
        "page_url": F.col("page_url"), "properties": F.col("properties_text"),
    }
    out = [cols[c].alias(c) for c in FLAT_COLUMNS]
    if wide:
        out += [F.col(c) for c in ENRICH_COLUMNS]
    return events.select(*out)


def to_document(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Nested document form: all fields, ISO-Z times, VARIANT properties and an
    `enrichment` struct; `_id` is the unique key (= event_id)."""
    pa = processed_at if processed_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return events.select(
        F.col("event_id").alias("_id"), "event_id", "user_id", "event_type",
        F.col("event_date").cast("string").alias("event_date"),
        iso_z_text(F.col("timestamp")).alias("timestamp"),
        "hour_of_day", "day_of_week", "is_weekend", "event_category", "session_id", "ip_address",
        "user_agent", "referrer", "page_url", "properties", *ENRICH_COLUMNS,
        iso_z_text(pa).alias("processed_at"),
        F.struct(
            (F.coalesce(F.col("country"), F.lit("")) != "").alias("geo_enriched"),
            (F.coalesce(F.col("browser"), F.lit("")) != "").alias("user_agent_parsed"),
            F.lit(dims.PROCESSED_VERSION).alias("processed_version"),
        ).alias("enrichment"),
    )


# NULL fill per column of the insert path.
NULL_FILL_TEXT = ["referrer", "user_agent", "page_url", "properties"]
NULL_FILL_ZERO = ["user_id", "hour_of_day", "day_of_week", "is_weekend"]


def fill_nulls(df: DataFrame) -> DataFrame:
    """Text columns -> '', four numeric columns -> 0, any other text column -> ''."""
    zero = {c: 0 for c in NULL_FILL_ZERO if c in df.columns}
    text = {f.name: "" for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.na.fill(zero).na.fill(text)


def transform_stats(tagged: DataFrame) -> DataFrame:
    """G16 + G27: processed, duplicates, errors, validation_errors, enriched.

    One row of counts per id first (partial aggregation collapses repeats), then a sum;
    duplicates = accepted rows - distinct accepted ids, enriched counts distinct accepted
    ids with a browser or a country.
    """
    ok = F.col("reject_reason").isNull()
    enriched = ok & (F.col("browser").isNotNull() | F.col("country").isNotNull())
    per = tagged.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_ok"),
                                         F.count_if(enriched).alias("n_enriched"))
    errors = F.sum(F.col("n") - F.col("n_ok"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("n_ok") - F.count_if(F.col("n_ok") > 0), F.lit(0)).alias("duplicates"),
        F.coalesce(errors, F.lit(0)).alias("errors"),
        F.coalesce(errors, F.lit(0)).alias("validation_errors"),
        F.count_if(F.col("n_enriched") > 0).alias("enriched"),
    )
