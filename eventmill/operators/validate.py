"""Validation: one reject reason per row, first failing rule wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.timefn import parse_ts
from eventmill.schemas import RAW_FIELDS, REQUIRED_FIELDS

# JSON types allowed per required field (VARIANT type names).
ALLOWED_JSON_TYPES = {
    "event_id": ["STRING"],
    "user_id": ["STRING", "BIGINT"],
    "event_type": ["STRING"],
    "timestamp": ["STRING"],
}


def strip_ws(c: Column) -> Column:
    """Strip leading and trailing whitespace (blanks, tabs, newlines)."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def user_id_int(text: Column) -> Column:
    """Integer text -> BIGINT, NULL when not an integer.

    Accepts surrounding whitespace, a sign and digit-group underscores ("1_000"), like an
    integer parse; refuses "1.0", "" and words.
    """
    s = strip_ws(text)
    return F.when(s.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"),
                  F.regexp_replace(s, "_", "").try_cast("long"))


def decode_json(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """A2: JSON message text -> RAW text columns + JSON type facts.

    Adds `_jtypes` (VARIANT type name per required field; NULL when the key is absent,
    VOID for a JSON null), `_props_kind` (null / object / string / other) and
    `_decode_ok` (false when the text is not a JSON object).  All built-in expressions:
    one pass, no Python.
    """
    keep = [c for c in messages.columns if c != value_col]
    # Stage 1: parse once; stage 2: one variant per field; stage 3: text and type facts.
    d = messages.select(*keep, F.try_parse_json(F.col(value_col)).alias("_v"))
    d = d.select(*keep, "_v", *[F.try_variant_get(F.col("_v"), f"$.{f}", "variant").alias(f"_f_{f}")
                                for f in RAW_FIELDS])
    d = d.select(*keep, "_v", *[F.col(f"_f_{f}") for f in RAW_FIELDS],
                 *[F.schema_of_variant(F.col(f"_f_{f}")).alias(f"_k_{f}") for f in RAW_FIELDS])

    def text_of(name):
        fv, kind = F.col(f"_f_{name}"), F.col(f"_k_{name}")
        return (F.when(fv.isNull() | (kind == "VOID"), F.lit(None).cast("string"))
                .when(kind == "STRING", F.try_variant_get(fv, "$", "string"))
                .otherwise(F.to_json(fv)))
    pk = F.col("_k_properties")
    props_kind = (F.when(F.col("_f_properties").isNull() | (pk == "VOID"), F.lit("null"))
                  .when(pk.startswith("OBJECT"), F.lit("object"))
                  .when(pk == "STRING", F.lit("string"))
                  .otherwise(F.lit("other")))
    jtypes = F.struct(*[F.col(f"_k_{f}").alias(f) for f in REQUIRED_FIELDS])
    ok = F.col("_v").isNotNull() & F.schema_of_variant(F.col("_v")).startswith("OBJECT")
    return d.select(*keep, *[text_of(f).alias(f) for f in RAW_FIELDS],
                    jtypes.alias("_jtypes"), props_kind.alias("_props_kind"), ok.alias("_decode_ok"))


def reject_reason(df: DataFrame, offset_mode: str = "utc", parsed_ts: Column | None = None,
                  user_id_num: Column | None = None) -> Column:
    """CASE chain of the rules, in the source's order.

    Per required field: presence, then JSON type; then a non-blank event_id, then a valid
    timestamp.  For text-only input (no `_jtypes`), NULL means missing and only the
    user_id integer test applies as a type rule.
    """
    has_types = "_jtypes" in df.columns
    if parsed_ts is None:
        parsed_ts = parse_ts(F.col("timestamp"), offset_mode)
    if user_id_num is None:
        user_id_num = user_id_int(F.col("user_id"))
    rules: list[tuple[Column, str]] = []
    if "_decode_ok" in df.columns:
        rules.append((~F.col("_decode_ok"), "decode:json"))
    for f in REQUIRED_FIELDS:
        if has_types:
            jt = F.col("_jtypes").getField(f)
            rules.append((jt.isNull(), f"missing:{f}"))
            bad = ~jt.isin(*ALLOWED_JSON_TYPES[f])
        else:
            rules.append((F.col(f).isNull(), f"missing:{f}"))
            bad = F.lit(False)
        if f == "user_id":
            bad = bad | user_id_num.isNull()
        rules.append((bad, f"type:{f}"))
    rules.append((strip_ws(F.col("event_id")) == "", "empty:event_id"))
    rules.append((parsed_ts.isNull(), "format:timestamp"))
    out = None
    for cond, reason in rules:
        out = F.when(cond, F.lit(reason)) if out is None else out.when(cond, F.lit(reason))
    return out


def with_reject_reason(df: DataFrame, offset_mode: str = "utc") -> DataFrame:
    staged = df.select("*", parse_ts(F.col("timestamp"), offset_mode).alias("_pts"),
                       user_id_int(F.col("user_id")).alias("_uid"))
    rr = reject_reason(staged, offset_mode, F.col("_pts"), F.col("_uid"))
    return staged.withColumn("reject_reason", rr).drop("_pts", "_uid")


def validate_events(raw: DataFrame, offset_mode: str = "utc") -> DataFrame:
    """(event_id, timestamp, is_valid, reject_reason) per raw row."""
    t = with_reject_reason(raw, offset_mode)
    return t.select("event_id", "timestamp", F.col("reject_reason").isNull().alias("is_valid"), "reject_reason")


def reject_reasons(raw: DataFrame, offset_mode: str = "utc") -> DataFrame:
    """Count of rows per reject reason."""
    t = with_reject_reason(raw, offset_mode)
    return (t.where(F.col("reject_reason").isNotNull())
            .groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n")))

