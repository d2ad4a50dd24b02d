"""Unnesting of the arrays inside a log row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ramparts.sources.schema import MATCH_DETAIL, lower_names

REQUEST_ID = "httprequest.requestid"


def _fields(array: str, *names: str) -> Column:
    """Array of only these fields, so that a columnar scan reads no others."""
    return F.arrays_zip(*[F.col(f"{array}.{name}") for name in names])


def rule_matches(logs: DataFrame) -> DataFrame:
    """One row per non-terminating match: request_id, ruleid, action."""
    return logs.select(
        F.col(REQUEST_ID).alias("request_id"),
        F.inline(_fields("nonterminatingmatchingrules", "ruleid", "action")).alias("ruleid", "action"),
    )


def count_matches_by_rule(logs: DataFrame) -> DataFrame:
    """COUNT matches per rule."""
    matches = logs.select(F.inline(_fields("nonterminatingmatchingrules", "ruleid", "action")).alias("ruleid", "action"))
    return matches.filter(F.col("action") == "COUNT").groupBy("ruleid").agg(F.count(F.lit(1)).alias("matches"))


def rule_group_matches(logs: DataFrame) -> DataFrame:
    """One row per rule group and inner non-terminating rule, the latter NULL where there is none.

    Requests without rule groups give no row.
    """
    groups = logs.select(
        F.col(REQUEST_ID).alias("request_id"),
        F.inline(
            _fields(
                "rulegrouplist",
                "rulegroupid",
                "terminatingrule.ruleid",
                "terminatingrule.action",
                "nonterminatingmatchingrules",
            )
        ).alias("rulegroupid", "ruleid", "action", "inner_rules"),
    )
    return groups.select(
        "request_id", "rulegroupid", "ruleid", "action", F.explode_outer("inner_rules").alias("inner")
    ).select(
        "request_id",
        "rulegroupid",
        "ruleid",
        "action",
        F.col("inner.ruleid").alias("inner_ruleid"),
        F.col("inner.action").alias("inner_action"),
    )


# What a place of match details is known by, and what is carried down to it from the structs around it.
DETAIL = lower_names(MATCH_DETAIL)
OWNERS = ("rulegroupid", "ruleid")
FOUND = T.StructType([T.StructField(name, T.StringType()) for name in ("source", *OWNERS)] + DETAIL.fields)


def _holds_details(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return kind == DETAIL or any(_holds_details(f.dataType) for f in kind)
    return isinstance(kind, T.ArrayType) and _holds_details(kind.elementType)


def _details_in(value: Column, kind: T.DataType, path: str, owners: dict[str, Column]) -> Column:
    """Array of all match details below ``value``, each with its path and the rule and group it belongs to."""
    none = F.array().cast(T.ArrayType(FOUND))
    if isinstance(kind, T.ArrayType) and kind.elementType == DETAIL:
        parts = [F.lit(path).alias("source"), *[owners[name].alias(name) for name in OWNERS]]
        found = F.transform(value, lambda d: F.struct(*parts, *[d[f.name].alias(f.name) for f in DETAIL]))
    elif isinstance(kind, T.ArrayType):
        found = F.flatten(F.transform(value, lambda item: _details_in(item, kind.elementType, path, owners)))
    else:
        around = owners | {name: value[name] for name in OWNERS if name in kind.names}
        found = F.concat(
            *[
                _details_in(value[f.name], f.dataType, f"{path}.{f.name}", around)
                for f in kind.fields
                if _holds_details(f.dataType)
            ]
        )
    return F.coalesce(found.cast(T.ArrayType(FOUND)), none)


def match_details(logs: DataFrame) -> DataFrame:
    """One row per match detail, wherever the declared type of the log has one: request_id, terminatingruleid, source (the
    path of the place), rulegroupid and ruleid of the rule that matched, and the detail's fields.

    The places are found by a walk over the schema, and one generator unnests them all, so a log is read once and not
    once for each place. A missing array gives no rows.
    """
    unknown = F.lit(None).cast("string")
    owners = {"rulegroupid": unknown, "ruleid": unknown}
    places = []
    for field in logs.schema:
        if _holds_details(field.dataType):
            known = owners | {"ruleid": F.col("terminatingruleid")} if field.name.startswith("terminatingrule") else owners
            places.append(_details_in(F.col(field.name), field.dataType, field.name, known))
    return logs.select(F.col(REQUEST_ID).alias("request_id"), "terminatingruleid", F.inline(F.concat(*places)))


def matched_data(logs: DataFrame) -> DataFrame:
    """One row per matched datum, of terminating and other rules, outside and inside rule groups."""
    details = match_details(logs)
    return details.select(*[c for c in details.columns if c != "matcheddata"], F.explode("matcheddata").alias("datum"))


def excluded_rules(logs: DataFrame) -> DataFrame:
    """One row per rule that a rule group left out: request_id, rulegroupid, exclusiontype, ruleid. The log has them as
    JSON text; text that is no list of them gives no row."""
    groups = logs.select(
        F.col(REQUEST_ID).alias("request_id"),
        F.inline(_fields("rulegrouplist", "rulegroupid", "excludedrules")).alias("rulegroupid", "excluded"),
    )
    listed = F.from_json("excluded", "array<struct<exclusionType: string, ruleId: string>>")
    rows = groups.select("request_id", "rulegroupid", F.inline(listed).alias("exclusiontype", "ruleid"))
    return rows.filter(F.col("ruleid").isNotNull())


def rate_rules(logs: DataFrame) -> DataFrame:
    """Requests per rate rule, key and limit."""
    return (
        logs.select(F.inline("ratebasedrulelist"))
        .groupBy("ratebasedruleid", "limitkey", "maxrateallowed")
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def label_counts(logs: DataFrame) -> DataFrame:
    """Requests per label."""
    return (
        logs.select(F.explode("labels.name").alias("label"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def with_label(logs: DataFrame, label: str) -> DataFrame:
    """Rows that carry the label."""
    return logs.filter(F.array_contains("labels.name", label))
