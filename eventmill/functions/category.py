"""Event type -> category as an inline map lookup (codegen, no join)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmill import dims


def category_map(source: str = "code") -> Column:
    pairs = []
    for cat, _desc, types in dims.CATEGORIES:
        if source == "code" and cat not in dims.CODE_CATEGORIES:
            continue
        pairs += [(t, cat) for t in types]
    return dims.map_literal(pairs)


def category_of(event_type: Column, source: str = "code") -> Column:
    """Case-insensitive lookup; unknown or NULL types map to the default category."""
    return F.coalesce(F.try_element_at(category_map(source), F.lower(event_type)),
                      F.lit(dims.DEFAULT_CATEGORY))


def priority_of(event_type: Column) -> Column:
    pairs = [(t, p) for p, types in dims.PRIORITIES for t in types]
    return F.coalesce(F.try_element_at(dims.map_literal(pairs), F.lower(event_type)), F.lit("low"))


def priority_rank_of(event_type: Column) -> Column:
    pairs = [(t, dims.PRIORITY_RANK[p]) for p, types in dims.PRIORITIES for t in types]
    return F.coalesce(F.try_element_at(dims.map_literal(pairs), F.lower(event_type)),
                      F.lit(dims.PRIORITY_RANK["low"]))
