"""Properties sanitising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON texts of falsy values: stored as '{}' in the flat row.
FALSY_JSON = ["{}", "[]", "0", "0.0", '""', "false", "null"]


def json_string_literal(text: Column) -> Column:
    """text -> its JSON string literal ("..." with escapes)."""
    arr = F.to_json(F.array(text))
    return F.substring(arr, F.lit(2), F.length(arr) - 2)


def props_variant(text: Column, kind: Column | None = None, parsed: Column | None = None) -> Column:
    """K19 as VARIANT: NULL -> {}; JSON text -> parsed; bad text -> {"raw_properties": text};
    a non-text, non-object JSON value (kind='other') -> {"value": text}."""
    parsed = F.try_parse_json(text) if parsed is None else parsed
    raw = F.parse_json(F.concat(F.lit('{"raw_properties":'), json_string_literal(text), F.lit("}")))
    val = F.parse_json(F.concat(F.lit('{"value":'), json_string_literal(text), F.lit("}")))
    out = (F.when(text.isNull(), F.parse_json(F.lit("{}")))
           .when(parsed.isNotNull(), parsed).otherwise(raw))
    if kind is not None:
        out = F.when(kind == F.lit("other"), val).otherwise(out)
    return out


def props_flat_text(text: Column, kind: Column | None = None, parsed: Column | None = None) -> Column:
    """K19 + K20 as text for the flat row.

    Valid JSON keeps its original text (no re-serialisation, so number and key forms are
    kept); falsy values and NULL become '{}'; bad text becomes {"raw_properties": "..."}.
    """
    t = F.trim(text)
    parsed = F.try_parse_json(text) if parsed is None else parsed
    canon = F.to_json(parsed)
    raw = F.concat(F.lit('{"raw_properties": '), json_string_literal(text), F.lit("}"))
    out = (F.when(text.isNull(), F.lit("{}"))
           .when(parsed.isNotNull(), F.when(canon.isin(*FALSY_JSON), F.lit("{}")).otherwise(t))
           .otherwise(raw))
    if kind is not None:
        out = F.when(kind == F.lit("other"),
                     F.concat(F.lit('{"value": '), json_string_literal(text), F.lit("}"))).otherwise(out)
    return out


def property_get(props: Column, key: str, type_name: str = "string") -> Column:
    """One field of the properties object, typed, NULL when absent or not castable."""
    return F.try_variant_get(props, f"$.{key}", type_name)
