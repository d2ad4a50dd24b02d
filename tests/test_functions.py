import ipaddress

import pytest
from pyspark.sql import functions as F

from ramparts.functions import (
    acl_part,
    acl_scope_of,
    byte_match,
    html_entity_decode,
    ipv4_number,
    is_ipv4_range,
    query_arguments_text,
    range_key,
    rate_half_up,
    to_range,
    url_decode,
)


def over(spark, values, function):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row[0] for row in frame.orderBy("i").select(function(F.col("v"))).collect()]


def test_url_decode(spark):
    cases = {
        "%27%20OR%201=1--": "' OR 1=1--",
        "a+b": "a+b",
        "a%2Bb": "a+b",
        "%%%": "%%%",
        "a%20%zz": "a %zz",
        "100%": "100%",
        "%2527": "%27",
        "%C3%A9": "é",
        "": "",
        None: None,
    }
    assert over(spark, list(cases), url_decode) == list(cases.values())


def test_html_entity_decode(spark):
    cases = {
        "&quot;&lt;b&gt;&apos;": "\"<b>'",
        "&amp;lt;": "&lt;",
        "&#39; OR 1=1--": "' OR 1=1--",
        "&#x27;&#X27;&#039;": "'''",
        "a&b": "a&b",
        "a&b;c": "a&b;c",
        "&#7;&#9;&#x0A;": "\a\t\n",
        "&#200;&#233;&#x3bb;": "Èéλ",
        "&#128512;&#x1F600;&#1114111;": "😀😀\U0010ffff",
        "&#xD800;&#1114112;&#0;": "&#xD800;&#1114112;&#0;",
        "x&nbsp;y": "x\u00a0y",
        "&;": "&;",
        "&lt": "&lt",
        "": "",
        None: None,
    }
    assert over(spark, list(cases), html_entity_decode) == list(cases.values())


def test_arguments_are_split_before_decoding(spark):
    def decoded(text):
        return url_decode(query_arguments_text(text))

    assert over(spark, ["a=1&b=2", "a=1%26 whoami", "a=%zz&b=%27"], decoded) == ["a=1\nb=2", "a=1& whoami", "a=%zz\nb='"]


def test_byte_match(spark):
    def exactly(text):
        return byte_match(text, "/rest", ["LOWERCASE"], "EXACTLY")

    assert over(spark, ["/REST", "/rest/", None], exactly) == [True, False, False]
    assert over(spark, ["xRESTx"], lambda t: byte_match(t, "rest")) == [False]
    assert over(spark, ["x%72estx"], lambda t: byte_match(t, "rest", ["NONE", "URL_DECODE"])) == [True]
    with pytest.raises(ValueError):
        byte_match(F.lit("a"), "a", [], "STARTS")


ADDRESSES = ["10.0.0.1", "255.255.255.255", "0.0.0.0", "010.1.2.3", "256.1.1.1", "1.2.3", "::1", "1.2.3.4\n", "", None]


def test_ipv4_number(spark):
    assert over(spark, ADDRESSES, ipv4_number) == [
        int(ipaddress.ip_address("10.0.0.1")), 2**32 - 1, 0, int(ipaddress.ip_address("10.1.2.3")),
        None, None, None, None, None, None,
    ]


def test_ranges(spark):
    values = ["192.0.2.0/24", "192.0.2.44", "1.2.3.4/33", "1.2.3.4/", "256.1.1.1", "1.2.3.4\n", "::1", None]
    assert over(spark, values, is_ipv4_range) == [True, True, False, False, False, False, False, False]
    assert over(spark, ["1.2.3.4", "1.2.3.0/24"], to_range) == ["1.2.3.4/32", "1.2.3.0/24"]


@pytest.mark.parametrize("length", [0, 1, 8, 24, 31, 32])
def test_range_key_agrees_with_ipaddress(spark, length):
    inside = ipaddress.ip_network(f"10.200.30.40/{length}", strict=False)
    probes = ["10.200.30.40", "10.200.30.41", "10.200.31.0", "11.0.0.0", "200.0.0.1"]
    frame = spark.createDataFrame([(p,) for p in probes], "ip string")
    key = range_key(ipv4_number(F.col("ip")), length)
    own = range_key(ipv4_number(F.lit("10.200.30.40")), F.lit(length))
    got = [row[0] for row in frame.select(key == own).collect()]
    assert got == [ipaddress.ip_address(p) in inside for p in probes]


def test_rates_round_half_up(spark):
    frame = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 5), (5, 5), (1, 0), (None, 3)], "b bigint, n bigint")
    two = [row[0] for row in frame.select(rate_half_up(F.col("b"), F.col("n"), 2)).collect()]
    one = [row[0] for row in frame.select(rate_half_up(F.col("b"), F.col("n"), 1)).collect()]
    assert two == [12.5, 33.33, 66.67, 0.0, 100.0, None, None]
    assert one == [12.5, 33.3, 66.7, 0.0, 100.0, None, None]


def test_acl_parts(spark):
    arns = [
        "arn:aws:wafv2:us-east-1:1:regional/webacl/app/id1",
        "arn:aws:wafv2:us-east-1:1:global/webacl/app/id2",
        "arn:aws:wafv2:us-east-1:1:other/webacl/app/id3",
        "arn:aws:wafv2:us-east-1:1:regional/webacl",
        None,
    ]
    assert over(spark, arns, acl_scope_of) == ["REGIONAL", "CLOUDFRONT", "REGIONAL", None, None]
    assert over(spark, arns, lambda a: acl_part(a, 2)) == ["app", "app", "app", None, None]
    assert over(spark, arns, lambda a: acl_part(a, 3)) == ["id1", "id2", "id3", None, None]
