import ipaddress
import random

import pytest
from samples import requests

from ramparts import geo_blocked, ip_set_hits, uri_pattern_hits
from ramparts.operators.lists import narrowest_range, owners_of_clients, range_set, with_ip_set_flag
from ramparts.sources import allowed_countries, blocked_ranges, uri_patterns


def test_ip_set_edges(spark, rows):
    clients = ["10.0.0.5", "10.0.0.16", "10.0.0.77", "10.0.1.200", "::1", None, "bad"]
    asked = requests(spark, *({"clientip": c} for c in clients))
    # The last three entries are no ranges; 10.0.0.0/28 and 10.0.0.5 overlap.
    cidrs = ["10.0.0.0/28", "10.0.0.5", "10.0.0.77/32", "10.0.1.0/24", "10.0.0.0/33", "x", "::1/128"]
    hits = ip_set_hits(asked, blocked_ranges(spark, cidrs))
    assert hits.columns == asked.columns and rows(hits, "request_id") == [("0",), ("2",), ("3",)]
    flags = with_ip_set_flag(asked, blocked_ranges(spark, cidrs), "f")
    assert flags.columns == [*asked.columns, "f"]
    assert flags.count() == len(clients) and flags.filter("f").count() == 3
    narrow = narrowest_range(asked, blocked_ranges(spark, [*cidrs, "0.0.0.0/1"]))
    assert rows(narrow, "request_id", "prefix_length") == [("0", 32), ("1", 1), ("2", 32), ("3", 24)]
    assert ip_set_hits(asked, blocked_ranges(spark, [])).count() == 0
    assert rows(ip_set_hits(asked, blocked_ranges(spark, ["0.0.0.0/0"])), "request_id") == [("0",), ("1",), ("2",), ("3",)]


def test_ip_set_against_ipaddress(spark):
    draw = random.Random(5)
    cidrs = [f"10.{draw.randrange(4)}.{draw.randrange(4)}.0/{draw.choice([9, 14, 22, 24, 27, 30])}" for _ in range(40)]
    clients = [f"10.{draw.randrange(8)}.{draw.randrange(6)}.{draw.randrange(256)}" for _ in range(300)]
    networks = [ipaddress.ip_network(c, strict=False) for c in cidrs]
    asked = requests(spark, *({"clientip": c} for c in clients))
    got = sorted(row.clientip for row in ip_set_hits(asked, blocked_ranges(spark, cidrs)).collect())
    assert got == sorted(c for c in clients if any(ipaddress.ip_address(c) in n for n in networks))


def test_nested_ranges_in_one_bin_and_across_bins(spark):
    """Of all ranges that hold an address the least owner counts, and the narrowest range is the longest prefix."""
    draw = random.Random(8)
    cidrs = [f"{draw.choice([9, 10])}.{draw.randrange(3)}.{draw.randrange(256)}.{draw.randrange(256)}/{draw.randrange(4, 33)}" for _ in range(400)]
    clients = [f"{draw.choice([9, 10])}.{draw.randrange(4)}.{draw.randrange(256)}.{draw.randrange(256)}" for _ in range(300)]
    clients += [c.partition("/")[0] for c in cidrs[:50]]
    networks = [(ipaddress.ip_network(c, strict=False), draw.randrange(1000)) for c in cidrs]
    asked = requests(spark, *({"clientip": c} for c in clients))
    ranges = range_set(spark.createDataFrame([(c, o) for c, (_, o) in zip(cidrs, networks)], "cidr string, owner int"), "owner")
    found = {r.clientip: r.owner for r in owners_of_clients(asked, ranges).collect()}
    holding = {c: [(o, n.prefixlen) for n, o in networks if ipaddress.ip_address(c) in n] for c in clients}
    assert found == {c: min(h)[0] for c, h in holding.items() if h}
    narrow = {r.clientip: r.prefix_length for r in narrowest_range(asked, blocked_ranges(spark, cidrs)).collect()}
    assert narrow == {c: max(p for _, p in h) for c, h in holding.items() if h}


def test_ranges_are_met_by_equality(spark, plan, sf_dir):
    from ramparts.plans import QUERIES

    text = plan(QUERIES["ip_set_hits"](spark, sf_dir))
    assert "Cartesian" not in text and "NestedLoop" not in text
    asked = requests(spark, {"clientip": "10.0.0.1"})
    text = plan(ip_set_hits(asked, blocked_ranges(spark, ["10.0.0.0/28"])))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_geo(spark, rows):
    asked = requests(spark, *({"country": c} for c in ["US", "CN", None, "GB"]))
    assert rows(geo_blocked(asked, allowed_countries(spark)), "country") == [("CN",), (None,)]
    assert geo_blocked(asked, allowed_countries(spark, [])).count() == 0
    assert rows(geo_blocked(asked, allowed_countries(spark, ["us", " gb "])), "country") == [("CN",), (None,)]
    for wrong in ("USA", "", "U1"):
        with pytest.raises(ValueError):
            geo_blocked(asked, allowed_countries(spark, ["US", wrong]))


def test_country_test_reaches_the_scan(spark, tmp_path, plan):
    requests(spark, {"country": "US"}).write.parquet(str(tmp_path / "r"))
    text = plan(geo_blocked(spark.read.parquet(str(tmp_path / "r")), allowed_countries(spark)))
    assert "In(country, [CA,GB,US])" in text.split("PushedFilters")[1]


PATTERNS = ["etc/passwd", "user/login", "Admin/Backdoor", "é", "/rest/pr", "/rest/products/search", "aa", "", "a"]
PATHS = ["/ETC/passwd", "/rest/user/login", "/rest/products/search", "/Admin/Backdoor", "/%C3%A9", "aaa", "", None, "/%zz"]


def test_uri_patterns(spark, rows):
    asked = requests(spark, *({"uri": p} for p in PATHS))
    hits = rows(uri_pattern_hits(asked, uri_patterns(spark, PATTERNS)))
    decoded = ["/etc/passwd", "/rest/user/login", "/rest/products/search", "/admin/backdoor", "/é", "aaa", "", None, "/%zz"]
    expected = [(str(i), p) for i, d in enumerate(decoded) if d is not None for p in PATTERNS if p and p in d]
    assert hits == sorted(expected, key=repr)
    lowered = uri_pattern_hits(asked, uri_patterns(spark, PATTERNS), normalize_pattern=True)
    assert ("3", "admin/backdoor") in rows(lowered)


def test_long_list_has_no_cross_join(spark, plan):
    hits = uri_pattern_hits(requests(spark, *({"uri": p} for p in PATHS)), uri_patterns(spark, PATTERNS))
    text = plan(hits)
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_no_patterns(spark, rows):
    assert rows(uri_pattern_hits(requests(spark, {"uri": "/a"}), uri_patterns(spark, ["", None]))) == []


def test_a_range_is_judged_once(spark, plan):
    """However often the parsed range mentions its text, the judgement of the text stands in the plan a few times only."""
    ranges = range_set(spark.createDataFrame([("10.0.0.9/24",), ("10.0.0.300",), (None,)], "cidr string"))
    assert [tuple(r) for r in ranges.collect()] == [(10 << 24, 24)]
    assert plan(ranges).upper().count("RLIKE(") < 50
