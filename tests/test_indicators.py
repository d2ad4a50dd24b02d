import pytest

from ramparts import acl_scope, merge_indicators, validate_indicators
from samples import log_rows

FEED = "name string, ip string, uri_pattern string"


@pytest.mark.parametrize(
    "ip, pattern, reason, cidr",
    [
        ("192.0.2.44", None, None, "192.0.2.44/32"),
        ("192.0.2.0/24", None, None, "192.0.2.0/24"),
        ("10.0.0.0/8", "", None, "10.0.0.0/8"),
        ("256.1.1.1", None, "invalid range", None),
        ("1.2.3.4/33", None, "invalid range", None),
        ("1.2.3.4/05", None, "invalid range", None),
        ("1.2.3.0/0", None, None, "1.2.3.0/0"),
        ("1.2.3.4\n", None, "invalid range", None),
        ("::1", None, "invalid range", None),
        ("0.0.0.0/0", None, "protected range", None),
        ("127.0.0.0/8", None, "protected range", None),
        ("169.254.0.0/16", None, "protected range", None),
        ("224.0.0.0/4", None, "protected range", None),
        ("0.0.0.0/1", None, None, "0.0.0.0/1"),
        (None, "admin/backdoor", None, None),
        (None, "a", "pattern length", None),
        (None, "/", "pattern length", None),
        (None, ".*", "pattern too broad", None),
        (None, ".+", "pattern too broad", None),
        (None, "x" * 200, None, None),
        (None, "x" * 201, "pattern length", None),
        (None, None, "no indicator", None),
        ("", "", "no indicator", None),
        ("1.2.3.4", "admin", "range and pattern", None),
    ],
)
def test_validation(spark, ip, pattern, reason, cidr):
    row = validate_indicators(spark.createDataFrame([("n", ip, pattern)], FEED)).first()
    assert (row.reason, row.valid, row.cidr) == (reason, reason is None, cidr)


def test_merge(spark, rows):
    existing = spark.createDataFrame([("old", "1.1.1.1", None)], FEED)
    feed = spark.createDataFrame(
        [(2, "new", "3.3.3.3", None), (1, "new", "2.2.2.2", None), (3, "old", "4.4.4.4", None), (4, "uri", None, "xy")],
        f"seq int, {FEED}",
    )
    merged = merge_indicators(feed, existing, order="seq")
    assert merged.columns == ["name", "ip", "uri_pattern"]
    assert rows(merged) == [("new", "2.2.2.2", None), ("old", "1.1.1.1", None), ("uri", None, "xy")]
    again = merge_indicators(feed.drop("seq"), merged)
    assert rows(again) == rows(merged)
    unordered = merge_indicators(feed.drop("seq"), existing)
    assert rows(unordered) == rows(merged)


def test_acl_scope(spark, rows):
    logs = log_rows(spark, {"webaclid": "arn:aws:wafv2:r:1:global/webacl/a/i"}, {"webaclid": "short"})
    assert rows(acl_scope(logs), "scope", "acl_name", "acl_id") == [("CLOUDFRONT", "a", "i"), (None, None, None)]
