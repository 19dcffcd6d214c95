"""User agent -> browser, os, device type from the ordered rule table.

Rules compile to CASE WHEN ... rlike chains (codegen; no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmill import dims


_META = set(".^$*+?{}[]\\|()")


def _match(ua: Column, pattern: str) -> Column:
    """Regex test; a plain literal or a group of literal alternatives becomes substring
    tests (much cheaper than a regex scan per row)."""
    body = pattern[1:-1] if pattern.startswith("(") and pattern.endswith(")") else pattern
    alts = body.split("|")
    if all(a and not (_META & set(a)) for a in alts) and ("(" not in body and ")" not in body):
        cond = None
        for a in alts:
            c = ua.contains(a)
            cond = c if cond is None else cond | c
        return cond
    return ua.rlike(pattern)


def _rule_case(ua: Column, rules, default: str) -> Column:
    out = None
    for label, must, must_not in rules:
        cond = _match(ua, must)
        if must_not:
            cond = cond & ~_match(ua, must_not)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def agent_struct(ua: Column) -> Column:
    """struct(browser, os, device_type); all NULL for an empty or NULL agent.

    Device precedence follows the source: mobile > tablet > bot > desktop.
    """
    empty = ua.isNull() | (ua == "")

    def guard(c):
        return F.when(empty, F.lit(None).cast("string")).otherwise(c)
    return F.struct(
        guard(_rule_case(ua, dims.AGENT_BROWSER_RULES, dims.AGENT_DEFAULT_BROWSER)).alias("browser"),
        guard(_rule_case(ua, dims.AGENT_OS_RULES, dims.AGENT_DEFAULT_OS)).alias("os"),
        guard(_rule_case(ua, dims.AGENT_DEVICE_RULES, dims.AGENT_DEFAULT_DEVICE)).alias("device_type"),
    )
