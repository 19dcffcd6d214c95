"""Longest-prefix match of IPv4 and IPv6 addresses against a table of networks (E5).

An address is (family, hi, lo): its 128 bits as two longs, an IPv4 address in the top 32 of them.  A network is the same
with its host bits cleared, plus a prefix length.  Every distinct address is cut to each prefix length that the networks of
its family have (at most 33 and 129 of them) and met with the networks by equality, so there is no nested loop, and the
longest network that meets it wins.  AQE splits a very common network (0.0.0.0/0 meets every address).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.ipaddr import ipv4_num, ipv6_hex

_PARTS = ["family", "hi", "lo"]


def _address_bits(df: DataFrame, ip: Column) -> DataFrame:
    """df with _family (4, 6, NULL when the text is no address), _hi and _lo."""
    def half(first: int) -> Column:
        return F.conv(F.col("_hex").substr(first, 16), 16, -10).cast("long")
    keep = df.columns
    d = df.select(*keep, ipv4_num(ip).alias("_num"), ipv6_hex(ip).alias("_hex"))
    v4, v6 = F.col("_num").isNotNull(), F.col("_hex").isNotNull()
    return d.select(*keep, F.when(v4, 4).when(v6, 6).alias("_family"),
                    F.when(v4, F.shiftleft("_num", 32)).when(v6, half(1)).alias("_hi"),
                    F.when(v4, F.lit(0).cast("long")).when(v6, half(17)).alias("_lo"))


def _cut(bits: Column, n: Column) -> Column:
    """The first n of 64 bits, the others zero (all for n >= 64, none for n <= 0)."""
    mask = F.call_function("shiftleft", F.lit(-1).cast("long"), (F.lit(64) - n).cast("int"))
    return F.when(n <= 0, F.lit(0).cast("long")).when(n >= 64, bits).otherwise(bits.bitwiseAND(mask))


def parse_networks(networks: DataFrame, col: str = "network") -> DataFrame:
    """(family, hi, lo, bits, network): one row per distinct network in CIDR notation.

    Host bits are cleared, an address without a length is a network of one, other texts and lengths that do not fit
    the family are left out.  Of several spellings of a network the least is kept.
    """
    text = F.trim(F.col(col))
    size = F.when(text.contains("/"), F.regexp_extract(text, r"/([0-9]{1,3})$", 1)).otherwise("full")
    d = _address_bits(networks.select(F.col(col).alias("network"), F.split(text, "/")[0].alias("_ip"), size.alias("_size")), F.col("_ip"))
    width = F.when(F.col("_family") == 4, 32).otherwise(128)
    bits = F.when(F.col("_size") == "full", width).when(F.col("_size") != "", F.col("_size").try_cast("int"))
    d = d.select("*", bits.alias("bits")).where(F.col("_family").isNotNull() & F.col("bits").between(0, width))
    return (d.select(F.col("_family").alias("family"), _cut(F.col("_hi"), F.col("bits")).alias("hi"),
                     _cut(F.col("_lo"), F.col("bits") - 64).alias("lo"), "bits", "network")
            .groupBy(*_PARTS, "bits").agg(F.min("network").alias("network")))


def longest_prefix(addresses: DataFrame, networks: DataFrame, ip_col: str = "ip_address", net_col: str = "network",
                   into: str = "network") -> DataFrame:
    """Every row of `addresses` with the longest of `networks` that holds its address, NULL where none does or the text
    is no address.  A mapped address (::ffff:a.b.c.d) is an IPv6 address.  Repeated rows stay."""
    nets = parse_networks(networks, net_col)
    sizes = nets.groupBy("family").agg(F.collect_set("bits").alias("sizes"))     # two rows of at most 33 and 129 numbers
    ips = _address_bits(addresses.select(F.col(ip_col).alias("_ip")).distinct(), F.col("_ip")).where(F.col("_family").isNotNull())
    tried = (ips.join(F.broadcast(sizes), F.col("_family") == F.col("family"))
             .select("_ip", "family", "_hi", "_lo", F.explode("sizes").alias("bits"))
             .select("_ip", "family", "bits", _cut(F.col("_hi"), F.col("bits")).alias("hi"),
                     _cut(F.col("_lo"), F.col("bits") - 64).alias("lo")))
    best = (tried.join(nets, [*_PARTS, "bits"]).groupBy("_ip").agg(F.max_by("network", "bits").alias("_network")))
    out = addresses.drop(into) if into in addresses.columns else addresses
    return out.join(best, out[ip_col] == best["_ip"], "left").select(*[out[c] for c in out.columns], F.col("_network").alias(into))
