"""Block-indicator feeds: validation of each entry, and merging into a list.

A feed has name, ip, uri_pattern; a list has the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ramparts.functions.acl import acl_part, acl_scope_of
from ramparts.functions.network import is_ipv4_range, to_range

# What must never be blocked as a whole.
PROTECTED_RANGES = ("0.0.0.0/0", "127.0.0.0/8", "169.254.0.0/16", "224.0.0.0/4")
BROAD_PATTERNS = ("/", "*", ".*", ".+")
PATTERN_LENGTHS = (2, 200)

NOTHING, BAD_RANGE, PROTECTED = "no indicator", "invalid range", "protected range"
BAD_LENGTH, TOO_BROAD, BOTH = "pattern length", "pattern too broad", "range and pattern"


def rejection(ip: Column, pattern: Column) -> Column:
    """Why an indicator is refused, NULL if it is not. Empty text counts as not given."""
    no_pattern = F.coalesce(F.length(pattern) == 0, F.lit(True))
    of_range = (
        F.when(~no_pattern, F.lit(BOTH))
        .when(~is_ipv4_range(ip), F.lit(BAD_RANGE))
        .when(ip.isin(*PROTECTED_RANGES), F.lit(PROTECTED))
    )
    of_pattern = (
        F.when(no_pattern, F.lit(NOTHING))
        .when(~F.length(pattern).between(*PATTERN_LENGTHS), F.lit(BAD_LENGTH))
        .when(pattern.isin(*BROAD_PATTERNS), F.lit(TOO_BROAD))
    )
    return F.when(F.length(ip) > 0, of_range).otherwise(of_pattern)


def validate_indicators(feed: DataFrame) -> DataFrame:
    """Add ``valid``, ``reason`` and ``cidr``, the range to block with a bare address as /32."""
    # Unpacked from an array of one, the verdict counts as a stored value: it is not made anew at each mention.
    reason = F.explode(F.array(rejection(F.col("ip"), F.col("uri_pattern")))).alias("reason")
    valid = F.col("reason").isNull()
    return feed.select("*", reason).withColumns({"valid": valid, "cidr": F.when(valid, to_range(F.col("ip")))})


def merge_indicators(feed: DataFrame, existing: DataFrame, order: str | None = None) -> DataFrame:
    """``existing`` followed by the feed's new names, each once.

    Of several entries with one name the first by ``order`` is kept, or the least
    by value if the feed has no order. Entries of one name are reduced before the shuffle.
    """
    fields = [name for name in feed.columns if name not in ("name", order)]
    values = F.struct(*fields)
    kept = F.min(values) if order is None else F.min_by(values, order)
    fresh = feed.groupBy("name").agg(kept.alias("_kept")).select("name", "_kept.*")
    added = fresh.join(existing.select("name"), "name", "left_anti")
    return existing.unionByName(added, allowMissingColumns=True)


def acl_scope(logs: DataFrame) -> DataFrame:
    """Add scope, name and id of the web ACL that logged each row; NULL for a malformed name."""
    arn = F.col("webaclid")
    return logs.withColumns({"scope": acl_scope_of(arn), "acl_name": acl_part(arn, 2), "acl_id": acl_part(arn, 3)})
