"""What is logged and what is hidden before a log is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Headers whose values are not logged, and the text put in their place.
REDACTED_HEADERS = ("authorization", "cookie", "x-api-key")
REDACTED = "REDACTED"


def has_count_match() -> Column:
    matched = F.exists("nonterminatingmatchingrules", lambda match: match["action"] == "COUNT")
    return F.coalesce(matched, F.lit(False))


def filter_logged(df: DataFrame) -> DataFrame:
    """Drop plain ALLOW rows; keep BLOCK, COUNT, anything unnamed, and an ALLOW that some rule counted."""
    return df.filter((F.coalesce("action", F.lit("")) != "ALLOW") | has_count_match())


def redacted(headers: Column, names: Sequence[str] = REDACTED_HEADERS) -> Column:
    lowered = [name.lower() for name in names]
    return F.transform(
        headers,
        lambda h: F.struct(
            h["name"].alias("name"),
            F.when(F.lower(h["name"]).isin(lowered), F.lit(REDACTED)).otherwise(h["value"]).alias("value"),
        ),
    )


def redact(df: DataFrame, names: Sequence[str] = REDACTED_HEADERS) -> DataFrame:
    """Hide the values of sensitive headers, whatever the case of their names."""
    if "httprequest" in df.columns:
        headers = redacted(F.col("httprequest.headers"), names)
        return df.withColumn("httprequest", F.col("httprequest").withField("headers", headers))
    return df.withColumn("headers", redacted(F.col("headers"), names))
