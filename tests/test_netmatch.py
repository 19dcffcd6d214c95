"""Longest-prefix match against `ipaddress` (E5)."""

import ipaddress
import random

from eventmill.operators.netmatch import longest_prefix, parse_networks


def _random_networks(rnd):
    nets = {"0.0.0.0/0", "10.0.0.0/8", "::/0", "2001:db8::/32", "::1/128", "255.255.255.255/32"}
    for _ in range(150):
        nets.add(str(ipaddress.ip_network((rnd.choice([10, 11, 200]) << 24 | rnd.getrandbits(24), rnd.randint(1, 32)), strict=False)))
        base = 0x20010DB8 << 96 | rnd.getrandbits(8) << 88 | rnd.getrandbits(88)
        nets.add(str(ipaddress.ip_network((base, rnd.choice([33, 48, 63, 64, 65, 96, 127, 128])), strict=False)))
    return sorted(nets)


def test_longest_prefix_matches_ipaddress_on_nested_networks(spark):
    rnd = random.Random(7)
    nets = _random_networks(rnd)
    ips = {"10.0.0.1", "8.8.8.8", "255.255.255.255", "::1", "::", "fe80::1", "::ffff:10.0.0.1", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff"}
    for n in map(ipaddress.ip_network, nets):
        ips.add(str(n[rnd.randrange(n.num_addresses)]))
        ips.add(str(n[-1]))
    for _ in range(200):
        ips.add(str(ipaddress.ip_address(rnd.getrandbits(32))))
    parsed = [ipaddress.ip_network(n) for n in nets]
    want = {}
    for ip in ips:
        a = ipaddress.ip_address(ip)
        held = [n for n in parsed if n.version == a.version and a in n]
        want[ip] = str(max(held, key=lambda n: n.prefixlen)) if held else None
    got = longest_prefix(spark.createDataFrame([(i,) for i in sorted(ips)], "ip_address string"),
                         spark.createDataFrame([(n,) for n in nets], "network string"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert {r["ip_address"]: r["network"] for r in got.collect()} == want


def test_odd_rows(spark):
    rows = [(1, "10.1.2.3", "x"), (1, "10.1.2.3", "x"), (2, None, "x"), (3, "", "x"), (4, "10.1.2", "x"), (5, "11.0.0.1", None)]
    ips = spark.createDataFrame(rows, "family int, ip_address string, bits string")      # names that the operator uses too
    nets = spark.createDataFrame([("10.1.2.9/24",), ("10.1.2.0/24",), ("10.0.0.0/33",), ("nonsense",), ("10.0.0.0/",), (None,),
                                  ("11.0.0.1",)], "network string")
    got = sorted(tuple(r) for r in longest_prefix(ips, nets).select("family", "network").collect())
    assert got[:2] == [(1, "10.1.2.0/24")] * 2 and [g[1] for g in got[2:5]] == [None] * 3 and got[5] == (5, "11.0.0.1")
    assert parse_networks(nets).count() == 2
    none = spark.createDataFrame([], "network string")
    assert [r["network"] for r in longest_prefix(ips, none).collect()] == [None] * 6
    assert longest_prefix(ips.limit(0), nets).count() == 0
