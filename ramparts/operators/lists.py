"""Requests against sets: blocked address ranges, allowed countries, emergency path patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ramparts.functions.network import ipv4_number, is_ipv4_range, range_key, to_range
from ramparts.functions.text import lowercase
from ramparts.operators.detection import decoded_path

# Characters by which a pattern is first looked up.
ANCHOR_LENGTH = 8
# Addresses and ranges meet by the leading bits of a /16: such a bin holds 65,536 addresses and twice as many ranges.
BIN_BITS = 16


def range_set(cidrs: DataFrame, *keep: str) -> DataFrame:
    """The valid IPv4 ranges among ``cidr`` as (number, prefix_length) of their first address, beside the columns to keep.

    A bare address counts as /32. Unpacked from an array of one, first the text found valid and then the parsed range count
    as stored values, so that no later expression judges or parses it again. Written into one expression, the judgement
    stood in it at each mention of the text, in a method too long for the JVM to compile.
    """
    text = F.when(is_ipv4_range(F.col("cidr")), to_range(F.col("cidr")))
    valid = cidrs.select(*keep, F.explode(F.array(text)).alias("_range")).filter(F.col("_range").isNotNull())
    length = F.substring_index("_range", "/", -1).cast("int")
    parsed = F.struct(ipv4_number(F.substring_index("_range", "/", 1)).alias("number"), length.alias("prefix_length"))
    ranges = valid.select(*keep, F.inline(F.array(parsed)))
    free = F.lit(32) - F.col("prefix_length")
    first = F.call_function("shiftleft", F.call_function("shiftright", F.col("number"), free), free)
    return ranges.withColumn("number", first)


def _leading(number: Column, length: int) -> Column:
    return F.shiftright(number, 32 - length)


def owners(addresses: DataFrame, ranges: DataFrame) -> DataFrame:
    """``addresses`` (with ``number``) that a range holds, with ``owner``, the least owner of the ranges that hold it.

    ``ranges`` has number, prefix_length and owner; ranges may nest or be repeated. A sweep over each bin meets ranges and
    addresses in their order. Ranges of one length lie apart, so of each length the last one begun is the only one that
    can hold an address, and the sweep carries these sixteen. Ranges wider than a bin are joined to the bins of the
    addresses, of which there are 65,536 at most. So an address is one row throughout, however many ranges hold it.
    """
    fields = addresses.columns
    kept = ranges.groupBy("number", "prefix_length").agg(F.min("owner").alias("owner"))
    binned = F.shiftright("number", 32 - BIN_BITS)
    address = F.struct(*fields).alias("address")
    narrow = kept.filter(F.col("prefix_length") > BIN_BITS).select(
        binned.alias("bin"), "number", "prefix_length", "owner", F.lit(None).cast(addresses.schema).alias("address")
    )
    asked = addresses.select(
        binned.alias("bin"), "number", F.lit(None).cast("int").alias("prefix_length"),
        F.lit(None).cast(kept.schema["owner"].dataType).alias("owner"), address,
    )
    sweep = Window.partitionBy("bin").orderBy("number", F.col("address").isNotNull())
    sweep = sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lengths = range(BIN_BITS + 1, 33)
    begun = {
        f"_{n}": F.last(F.when(F.col("prefix_length") == n, F.struct("number", "owner")), ignorenulls=True).over(sweep)
        for n in lengths
    }
    swept = narrow.unionByName(asked).withColumns(begun).filter(F.col("address").isNotNull())
    holding = [
        F.when(_leading(F.col("number"), n) == _leading(F.col(f"_{n}.number"), n), F.col(f"_{n}.owner")) for n in lengths
    ]
    wide = kept.filter(F.col("prefix_length") <= BIN_BITS).select(range_key(F.col("number"), F.col("prefix_length")).alias("key"), "owner")
    bins = addresses.select(binned.alias("bin")).distinct()
    keys = F.array(*[range_key(F.shiftleft("bin", 32 - BIN_BITS), n) for n in range(BIN_BITS + 1)])
    over = bins.select("bin", F.explode(keys).alias("key")).join(wide, "key").groupBy("bin").agg(F.min("owner").alias("over"))
    owned = swept.join(F.broadcast(over), "bin", "left").select("address.*", F.least(*holding, "over").alias("owner"))
    return owned.filter(F.col("owner").isNotNull())


def owners_of_clients(requests: DataFrame, ranges: DataFrame) -> DataFrame:
    """(clientip, owner) for each distinct client address that a range of ``ranges`` holds."""
    addresses = requests.select("clientip").distinct().select("clientip", F.explode(F.array(ipv4_number(F.col("clientip")))).alias("number"))
    return owners(addresses.filter(F.col("number").isNotNull()), ranges).select("clientip", "owner")


def _ranges_of_clients(requests: DataFrame, cidrs: DataFrame) -> DataFrame:
    """(clientip, prefix_length): the narrowest range that holds each distinct client address, where one does."""
    ranges = range_set(cidrs.select("cidr").distinct()).withColumn("owner", -F.col("prefix_length"))
    return owners_of_clients(requests, ranges).select("clientip", (-F.col("owner")).alias("prefix_length"))


def with_ip_set_flag(requests: DataFrame, cidrs: DataFrame, flag: str) -> DataFrame:
    """Add a boolean: the client address lies in one of the ranges. NULL or non-IPv4 clients do not."""
    known = _ranges_of_clients(requests, cidrs).select("clientip", F.lit(True).alias(flag))
    flagged = requests.join(known, "clientip", "left")
    return flagged.select(*requests.columns, F.coalesce(flag, F.lit(False)).alias(flag))


def narrowest_range(requests: DataFrame, cidrs: DataFrame) -> DataFrame:
    """Requests whose client address lies in one of the ranges, with the length of the narrowest."""
    return requests.join(_ranges_of_clients(requests, cidrs), "clientip").select(*requests.columns, "prefix_length")


def ip_set_hits(requests: DataFrame, cidrs: DataFrame) -> DataFrame:
    """Requests whose client address lies in one of the ranges, each once."""
    return narrowest_range(requests, cidrs).drop("prefix_length")


def _country_codes(countries: DataFrame) -> list[str]:
    """The set's codes in upper case. Anything that is no two-letter code is refused, as leaving it out would
    change what the rule blocks; so there are 676 codes at most."""
    codes = countries.select(F.upper(F.trim("country")).alias("country")).distinct()
    wrong = codes.filter(~F.coalesce(F.col("country").rlike(r"\A[A-Z]{2}\z"), F.lit(False))).take(1)
    if wrong:
        raise ValueError(f"not a country code: {wrong[0].country!r}")
    return sorted(row["country"] for row in codes.collect())


def outside_countries(countries: DataFrame) -> Column:
    """Predicate: the request's country is not in the set. A missing country is outside.

    With an empty set there is no such rule, so nothing is outside.
    """
    codes = _country_codes(countries)
    if not codes:
        return F.lit(False)
    return F.col("country").isNull() | ~F.col("country").isin(codes)


def geo_blocked(requests: DataFrame, countries: DataFrame) -> DataFrame:
    """Requests from outside the allowed countries; the test is pushed to the scan."""
    return requests.filter(outside_countries(countries))


def _anchor_lengths(patterns: DataFrame) -> list[int]:
    """The lengths at which the patterns' first characters are looked up: eight at most."""
    lengths = patterns.select(F.least(F.length("pattern"), F.lit(ANCHOR_LENGTH)).alias("n")).distinct()
    return sorted(row["n"] for row in lengths.collect())


def patterns_of_paths(requests: DataFrame, patterns: DataFrame, normalize_pattern: bool = False) -> DataFrame:
    """(uri, pattern) for each distinct path and each distinct pattern contained in it, decoded and lower-cased.

    A pattern is looked up by its first few characters, then by all of them. The first lookup brings the lengths to
    try at that place, not the patterns: however many of them begin alike, a place in a path gives at most one row
    per length. Only those anchor lengths are tried that some pattern has.
    """
    pattern = lowercase(F.col("pattern")) if normalize_pattern else F.col("pattern")
    wanted = patterns.select(pattern.alias("pattern")).filter(F.length("pattern") > 0).distinct()
    anchored = wanted.withColumn("anchor", F.substring("pattern", 1, ANCHOR_LENGTH))
    anchors = anchored.groupBy("anchor").agg(F.collect_set(F.length("pattern")).alias("lengths"))
    paths = requests.select("uri").distinct().select("uri", F.explode(F.array(decoded_path(F.col("uri")))).alias("_path"))
    sizes = _anchor_lengths(wanted)
    places = F.sequence(F.lit(1), F.length("_path"))
    placed = paths.filter(F.length("_path") > 0).select("uri", "_path", F.explode(places).alias("at"))
    pieces = F.array_distinct(F.array(*[F.substr("_path", F.col("at"), F.lit(size)) for size in sizes or [ANCHOR_LENGTH]]))
    tried = (
        placed.select("uri", "_path", "at", F.explode(pieces).alias("anchor"))
        .join(anchors, "anchor")
        .select("uri", "_path", "at", F.explode("lengths").alias("length"))
        .select("uri", F.substr("_path", F.col("at"), F.col("length")).alias("pattern"))
        .distinct()
    )
    return tried.join(wanted, "pattern", "left_semi").select("uri", "pattern")


def uri_pattern_hits(requests: DataFrame, patterns: DataFrame, normalize_pattern: bool = False) -> DataFrame:
    """(request_id, pattern) for each distinct pattern contained in the decoded, lower-cased path."""
    found = patterns_of_paths(requests, patterns, normalize_pattern)
    return requests.select("request_id", "uri").join(found, "uri").select("request_id", "pattern")
