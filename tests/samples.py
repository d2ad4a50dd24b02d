"""Small hand-made log rows."""

from __future__ import annotations

from ramparts.sources.schema import CONTRACT


def log_rows(spark, *records: dict):
    """Contract rows from partial records; ``httprequest`` may be partial too."""
    request_names = CONTRACT["httprequest"].dataType.names
    filled = []
    for record in records:
        row = {name: record.get(name) for name in CONTRACT.names}
        if row["httprequest"] is not None:
            row["httprequest"] = {name: record["httprequest"].get(name) for name in request_names}
        filled.append(tuple(row[name] for name in CONTRACT.names))
    return spark.createDataFrame(filled, CONTRACT)


REQUEST = (
    "request_id string, clientip string, country string, method string, uri string, args string, "
    "headers array<struct<name:string,value:string>>, ts_ms bigint"
)


def requests(spark, *records: dict):
    names = ["request_id", "clientip", "country", "method", "uri", "args", "headers", "ts_ms"]
    filled = [
        tuple({"request_id": str(i), "uri": "/", "args": "", "ts_ms": 0, **record}.get(name) for name in names)
        for i, record in enumerate(records)
    ]
    return spark.createDataFrame(filled, REQUEST)
