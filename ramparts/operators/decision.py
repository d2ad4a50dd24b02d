"""Which rule decides each request: rules are rows, and the one of least priority number that a request meets terminates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ramparts.operators.indicators import merge_indicators, validate_indicators
from ramparts.operators.lists import owners_of_clients, patterns_of_paths, range_set

# Actions that end the evaluation, and what holds where no rule does.
TERMINATING = ("BLOCK", "ALLOW")
DEFAULT_RULE, DEFAULT_ACTION = "Default_Action", "ALLOW"
# Emergency rules come before all others, and block.
EMERGENCY_PRIORITY, EMERGENCY_ACTION = 50, "BLOCK"

RANK = "struct<priority: int, name: string, action: string>"


def with_emergency_rules(rules: DataFrame, feed: DataFrame, order: str | None = None) -> DataFrame:
    """``rules`` (name, priority, action) and the valid indicators of a feed as rules: name, priority, action, cidr,
    uri_pattern. A name that ``rules`` has keeps its rule; of several entries with one name the first by ``order`` counts.
    """
    fields = ["name", "cidr", "uri_pattern", *([order] if order else [])]
    valid = validate_indicators(feed).filter("valid").select(*fields)
    listed = rules.select("name", "priority", "action")
    nothing = F.lit(None).cast("string")
    names = listed.select("name", nothing.alias("cidr"), nothing.alias("uri_pattern"))
    fresh = merge_indicators(valid, names.filter("name IS NULL"), order).join(listed.select("name"), "name", "left_anti")
    emergency = fresh.select(
        "name", F.lit(EMERGENCY_PRIORITY).alias("priority"), F.lit(EMERGENCY_ACTION).alias("action"), "cidr", "uri_pattern"
    )
    return listed.withColumns({"cidr": nothing, "uri_pattern": nothing}).unionByName(emergency)


def _rank() -> Column:
    return F.struct(F.col("priority").cast("int").alias("priority"), "name", "action").cast(RANK)


def _flag_rules(flags: DataFrame, rules: DataFrame) -> list:
    """The terminating rules that columns of ``flags`` evaluate, each name once; any other raises."""
    best = rules.groupBy("name").agg(F.min(_rank()).alias("rank")).select("rank.*").limit(len(flags.columns) + 1).collect()
    missing = sorted(row["name"] or "" for row in best if row["name"] not in flags.columns)
    if missing:
        raise ValueError(f"nothing evaluates these terminating rules: {', '.join(missing[:5])}")
    return best


def rule_hits(flags: DataFrame, rules: DataFrame) -> DataFrame:
    """``flags`` with ``_hit``, the best (priority, name, action) among the rules that the request meets, or NULL.

    A rule is met by address if it has a ``cidr``, by path if it has a ``uri_pattern``, and otherwise by the boolean column
    of its name; a terminating rule with none of these raises. Rules by address are reduced to the best for each distinct
    client, rules by path to the best for each distinct path, before either meets the requests. However many
    rules a request meets, it stays one row.
    """
    fields = {name: F.col(name) if name in rules.columns else F.lit(None).cast("string") for name in ("cidr", "uri_pattern")}
    ending = rules.filter(F.col("action").isin(*TERMINATING)).select("name", "priority", "action", *[c.alias(n) for n, c in fields.items()])
    hits = [
        F.when(F.coalesce(F.col(f"`{row['name']}`"), F.lit(False)), F.struct(*[F.lit(v).alias(k) for k, v in row.asDict().items()]).cast(RANK))
        for row in _flag_rules(flags, ending.filter("cidr IS NULL AND uri_pattern IS NULL"))
    ]
    found = flags
    if "cidr" in rules.columns:
        ranked = range_set(ending.filter("cidr IS NOT NULL").select("cidr", _rank().alias("owner")), "owner")
        clients = owners_of_clients(flags, ranked).withColumnRenamed("owner", "_by_address")
        found, hits = found.join(clients, "clientip", "left"), [*hits, F.col("_by_address")]
    if "uri_pattern" in rules.columns:
        ranked = ending.filter("uri_pattern IS NOT NULL").groupBy(F.col("uri_pattern").alias("pattern")).agg(F.min(_rank()).alias("r"))
        met = patterns_of_paths(flags, ranked.select("pattern")).join(ranked, "pattern")
        paths = met.groupBy("uri").agg(F.min("r").alias("_by_path"))
        found, hits = found.join(paths, "uri", "left"), [*hits, F.col("_by_path")]
    best = F.lit(None).cast(RANK) if not hits else hits[0] if len(hits) == 1 else F.least(*hits)
    return found.select(*[F.col(f"`{c}`") for c in flags.columns], best.alias("_hit"))


def rule_decision(flags: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``terminatingruleid`` and ``action``: of the rules that a request meets, the one of least priority number
    decides, then the least name.

    ``rules`` has name, priority, action, and may have cidr and uri_pattern (see ``rule_hits``). A COUNT rule does not
    terminate. Without a match the request is allowed.
    """
    decided = rule_hits(flags, rules)
    return decided.select(
        *[F.col(f"`{c}`") for c in flags.columns],
        F.coalesce("_hit.name", F.lit(DEFAULT_RULE)).alias("terminatingruleid"),
        F.coalesce("_hit.action", F.lit(DEFAULT_ACTION)).alias("action"),
    )
