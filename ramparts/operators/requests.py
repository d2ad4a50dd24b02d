"""Access to the request inside a log row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

REQUEST_FIELDS = {
    "requestid": "request_id",
    "clientip": "clientip",
    "country": "country",
    "httpmethod": "method",
    "uri": "uri",
    "args": "args",
    "headers": "headers",
}


def as_requests(logs: DataFrame, *keep: str) -> DataFrame:
    """Flat requests: request_id, clientip, country, method, uri, args, headers, ts_ms.

    Only the fields that are used later are read from a columnar log.
    """
    fields = [F.col(f"httprequest.{name}").alias(alias) for name, alias in REQUEST_FIELDS.items()]
    return logs.select(*fields, "ts_ms", *keep)


def header_value(headers: Column, name: str) -> Column:
    """First value of a header, found without regard to case; NULL if there is none."""
    wanted = name.lower()
    found = F.filter(headers, lambda h: F.lower(h["name"]) == wanted)
    return F.get(found, F.lit(0))["value"]
