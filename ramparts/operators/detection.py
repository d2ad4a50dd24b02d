"""Signature rules as Column predicates, and what the log says of emergency rules.

Everything here is row-local: no rule causes a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ramparts.functions.text import byte_match, lowercase, query_arguments_text, transformed, url_decode

# What the signature rules look for.
SEARCH_PATH = "/rest/products/search"
SQL_PROBE = "' OR 1=1--"
REMOTE_PREFIXES = ("http://", "https://")
PARENT_STEP, PASSWORD_FILE = "../", "/etc/passwd"
SHELL_STEPS = ("; cat", "; ls", "| cat", "& whoami")
HEADER_BYTES = 4096
COUNTED_RULES = ("SizeRestrictions_BODY",)
EMERGENCY_WITHIN, EMERGENCY_WORD = 100, "Emergency"
EMERGENCY_TRANSFORMS = ("URL_DECODE", "LOWERCASE")

# Limits past which headers are too large to inspect, which counts as a match.
INSPECTED_BYTES, INSPECTED_HEADERS = 8192, 200


def any_of(*conditions: Column) -> Column:
    hit = F.lit(False)
    for condition in conditions:
        hit = hit | F.coalesce(condition, F.lit(False))
    return hit


def all_of(*conditions: Column) -> Column:
    hit = F.lit(True)
    for condition in conditions:
        hit = hit & F.coalesce(condition, F.lit(False))
    return hit


def none_of(*conditions: Column) -> Column:
    return ~any_of(*conditions)


def search_query(uri: Column, args: Column) -> Column:
    """Decoded query string of a request to the search path, NULL for other requests."""
    return F.when(byte_match(uri, SEARCH_PATH, ["LOWERCASE"], "EXACTLY"), url_decode(args))


def sql_probe(query: Column) -> Column:
    """Case-sensitive probe in a decoded query string of the search path."""
    return byte_match(query, SQL_PROBE, ["HTML_ENTITY_DECODE"])


def path_traversal(path: Column) -> Column:
    """Looks at the decoded path."""
    return any_of(byte_match(path, PARENT_STEP), byte_match(path, PASSWORD_FILE, ["LOWERCASE"]))


def remote_inclusion(args: Column) -> Column:
    """Looks at the query string as sent: an encoded ``http%3A%2F%2F`` is not a match."""
    return any_of(*(byte_match(args, prefix, ["LOWERCASE"]) for prefix in REMOTE_PREFIXES))


def decoded_arguments(args: Column) -> Column:
    """Query arguments, decoded and lower-cased, set apart so that none runs into the next."""
    return lowercase(url_decode(query_arguments_text(args)))


def command_injection(arguments: Column) -> Column:
    """Any one of the decoded arguments holds a shell step."""
    return any_of(*(arguments.contains(step) for step in SHELL_STEPS))


def large_header(
    headers: Column,
    limit: int = HEADER_BYTES,
    inspected_bytes: int = INSPECTED_BYTES,
    inspected_headers: int = INSPECTED_HEADERS,
) -> Column:
    """A header name or value above ``limit`` bytes, or headers too large to inspect."""
    names = F.octet_length(F.array_join(headers["name"], "", ""))
    values = F.octet_length(F.array_join(headers["value"], "", ""))
    too_long = F.exists(
        headers, lambda h: F.greatest(F.octet_length(h["name"]), F.octet_length(h["value"])) > limit
    )
    # A single part above the limit makes the joined text longer than the limit,
    # so most rows never look at their headers one by one.
    return any_of(
        names + values > inspected_bytes,
        F.size(headers) > inspected_headers,
        F.when((names > limit) | (values > limit), too_long),
    )


def emergency_uri(uri: Column, pattern: str | Column, normalize_pattern: bool = False) -> Column:
    """Decoded, lower-cased path contains the pattern.

    The pattern itself is taken as written, so one with upper case never
    matches; ``normalize_pattern`` lower-cases it first.
    """
    if normalize_pattern:
        pattern = pattern.lower() if isinstance(pattern, str) else F.lower(pattern)
    return byte_match(uri, pattern, EMERGENCY_TRANSFORMS)


def decoded_path(uri: Column) -> Column:
    """Path in the form that emergency patterns are looked up in."""
    return transformed(uri, EMERGENCY_TRANSFORMS)


SIGNATURE_RULES = (
    "JuiceShopSQLiRule",
    "PathTraversalRule",
    "RFIProtectionRule",
    "CommandInjectionRule",
    "LargeHeaderRule",
)


def rule_flags(requests: DataFrame) -> DataFrame:
    """Add one boolean column per signature rule, named after the rule.

    Decoded text that several matches look at is a column of its own, so that it is decoded once per row.
    """
    uri, args = F.col("uri"), F.col("args")
    decoded = {
        "_path": url_decode(uri),
        "_query": search_query(uri, args),
        "_arguments": decoded_arguments(args),
    }
    flags = (
        sql_probe(F.col("_query")),
        path_traversal(F.col("_path")),
        remote_inclusion(args),
        command_injection(F.col("_arguments")),
        large_header(F.col("headers")),
    )
    return requests.withColumns(decoded).withColumns(dict(zip(SIGNATURE_RULES, flags))).drop(*decoded)


def override_actions(matches: DataFrame, counted: tuple[str, ...] = COUNTED_RULES) -> DataFrame:
    """Replace the action of the listed rules by COUNT, in rows with ``ruleid`` and ``action``."""
    action = F.when(F.col("ruleid").isin(*counted), F.lit("COUNT")).otherwise(F.col("action"))
    return matches.withColumn("action", action)


def emergency_rules(rules: DataFrame) -> DataFrame:
    return rules.filter((F.col("priority") <= EMERGENCY_WITHIN) & F.col("name").contains(EMERGENCY_WORD))


def emergency_blocks(logs: DataFrame, rules: DataFrame) -> DataFrame:
    """Every emergency rule, with its metric where it is known, and the number of log rows it terminated, 0 included.

    Rows of other rules are dropped at the scan by the word their names lack, and the
    rest is reduced to one row per rule before it meets the rule list.
    """
    hits = (
        logs.filter(F.col("terminatingruleid").contains(EMERGENCY_WORD))
        .groupBy("terminatingruleid")
        .agg(F.count(F.lit(1)).alias("blocks"))
    )
    shown = ["name", "priority", "action", *[c for c in rules.columns if c == "metric_name"]]
    listed = emergency_rules(rules).select(*shown)
    return listed.join(hits, listed["name"] == hits["terminatingruleid"], "left").select(
        *shown, F.coalesce("blocks", F.lit(0).cast("bigint")).alias("blocks")
    )
