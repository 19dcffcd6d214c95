"""Address parsing, private-range test and hash-based mock geo."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill import dims

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Strict dotted quad: four decimal octets 0-255 without leading zeros.
V4_REGEX = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
# IPv6 blocks counted as private, and the ones inside them that are not.
PRIVATE_V6_BLOCKS = ["::1/128", "::/128", "64:ff9b:1::/48", "100::/64", "2001::/23", "2001:db8::/32",
                     "2002::/16", "fc00::/7", "fe80::/10"]
PRIVATE_V6_EXCEPTIONS = ["2001:1::1/128", "2001:1::2/128", "2001:3::/32", "2001:4:112::/48", "2001:20::/28", "2001:30::/28"]


def ipv4_num(ip: Column) -> Column:
    """Dotted quad -> LONG, NULL when not a strict IPv4 address."""
    parts = F.split(ip, r"\.")
    num = None
    for i in range(4):   # plain arithmetic (no higher-order function): stays in codegen
        o = F.get(parts, i).cast("long")
        num = o if num is None else num * 256 + o
    return F.when(ip.rlike(V4_REGEX), num)


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body names it (also in a filter that is
    pushed down, where a column's expression would be repeated)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ipv6_hex(ip: Column) -> Column:
    """IPv6 address -> its 32 hex digits, NULL when it is none.

    A zone (%eth0) is left out, a dotted IPv4 tail counts as two groups, and '::' stands
    for the one or more zero groups that are missing.  Text without a colon is not looked at.
    """
    tail = rf"^(.*:)({V4_REGEX[1:-1]})$"
    groups = r"^([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)?$"

    def spelt(bare: Column) -> Column:
        def with_tail(n: Column) -> Column:
            v4 = F.lower(F.lpad(F.hex(n), 8, "0"))
            return F.when(n.isNotNull(), F.concat(F.regexp_extract(bare, tail, 1), v4.substr(1, 4), F.lit(":"), v4.substr(5, 4))).otherwise(bare)
        return _let(ipv4_num(F.regexp_extract(bare, tail, 2)), with_tail)

    def count(part: Column) -> Column:
        return F.when(part == "", 0).otherwise(F.size(F.split(part, ":")))

    def padded(part: Column) -> Column:  # zeros in front of each group, then the last four digits of each
        zeros = F.concat(F.lit("000"), F.regexp_replace(part, ":", ":000"))
        return F.when(part == "", F.lit("")).otherwise(F.regexp_replace(F.regexp_replace(zeros, r"0*([0-9a-f]{4})(?=:|$)", "$1"), ":", ""))

    def joined(p: Column) -> Column:
        a, b = p["a"], p["b"]
        return F.concat(a, F.repeat(F.lit("0"), F.lit(32) - F.length(a) - F.length(b)), b)

    def digits(s: Column) -> Column:
        gap = F.instr(s, "::")
        sides = F.struct((gap > 0).alias("gap"), F.when(gap > 0, s.substr(F.lit(1), gap - 1)).otherwise(s).alias("l"),
                         F.when(gap > 0, s.substr(gap + 2, F.length(s))).otherwise(F.lit("")).alias("r"))

        def checked(p: Column) -> Column:
            n = count(p["l"]) + count(p["r"])
            ok = p["l"].rlike(groups) & p["r"].rlike(groups) & F.when(p["gap"], n <= 7).otherwise(n == 8)
            return F.when(ok, _let(F.struct(padded(p["l"]).alias("a"), padded(p["r"]).alias("b")), joined))
        return _let(sides, checked)
    return F.when(ip.contains(":"), _let(_let(F.lower(F.regexp_replace(ip, r"%[^%/]+$", "")), spelt), digits))


def private_v6(digits: Column) -> Column:
    """Private-range test on the 32 hex digits; a mapped IPv4 address is as private as that address."""
    def test(d: Column) -> Column:
        def within(block: str) -> Column:
            net = ipaddress.ip_network(block)
            return d.between(f"{int(net.network_address):032x}", f"{int(net.broadcast_address):032x}")
        inside = F.lit(False)
        for b in PRIVATE_V6_BLOCKS:
            inside = inside | within(b)
        for b in PRIVATE_V6_EXCEPTIONS:
            inside = inside & ~within(b)
        mapped = d.startswith("0" * 20 + "ffff")
        return F.when(mapped, private_v4(F.conv(d.substr(25, 8), 16, 10).cast("long"))).otherwise(inside)
    return F.when(digits.isNotNull(), _let(digits, test))


def private_v4(num: Column) -> Column:
    """Private-range containment as a compiled predicate over the fixed block list."""
    inside = F.lit(False)
    for b in dims.PRIVATE_V4_BLOCKS:
        lo, hi = dims.cidr_bounds(b)
        inside = inside | num.between(lo, hi)
    for b in dims.PRIVATE_V4_EXCEPTIONS:
        lo, hi = dims.cidr_bounds(b)
        inside = inside & ~num.between(lo, hi)
    return inside


def md5_prefix_num(text: Column) -> Column:
    """First 8 hex digits of md5(text) as a number (0 .. 2^32-1)."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _pick(values: list[str], h: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(h, F.lit(len(values))) + 1).cast("int"))


GEO_COLUMNS = ["country", "region", "city"]


def with_geo(df: DataFrame, ip_col: str = "ip_address") -> DataFrame:
    """E5 + E6 as three projections: parse once, classify once, then pick.

    A parsed address referenced by every range test is kept as its own column (Catalyst
    does not inline an expensive column into many uses), so the parse, the md5 and the
    range tests each run once per row.  empty / NULL / not an address -> NULLs;
    private -> 'Private' x3; otherwise mock geo by md5 prefix modulo list size.
    """
    ip = F.coalesce(F.col(ip_col), F.lit(""))
    keep = df.columns
    d = df.select(*keep, ipv4_num(ip).alias("_ipn"), ipv6_hex(ip).alias("_v6"), md5_prefix_num(ip).alias("_h"))
    ipc = F.coalesce(F.col(ip_col), F.lit(""))
    d = d.select(*keep, "_h",
                 ((ipc != "") & (F.col("_ipn").isNotNull() | F.col("_v6").isNotNull())).alias("_valid"),
                 F.when(F.col("_ipn").isNotNull(), private_v4(F.col("_ipn")))
                  .otherwise(private_v6(F.col("_v6"))).alias("_private"))
    p = F.lit(dims.PRIVATE_LABEL)

    def pick(values):
        return F.when(~F.col("_valid"), F.lit(None).cast("string")).when(F.col("_private"), p) \
                .otherwise(_pick(values, F.col("_h")))
    return d.select(*keep, pick(dims.GEO_COUNTRIES).alias("country"), pick(dims.GEO_REGIONS).alias("region"),
                    pick(dims.GEO_CITIES).alias("city"))
