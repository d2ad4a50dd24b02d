"""The decision-log schema, in two spellings.

*Wire*: camelCase keys as they stand in the JSON lines. Spark's JSON reader
matches keys case-sensitively, so this spelling is the one to read and write with.

*Contract*: lower-case names that all operators use. ``timestamp`` is called
``ts_ms`` there. Every column is nullable and nothing is ever inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

PARTITIONS = ("year", "month", "day", "hour")
CORRUPT = "_corrupt_record"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()

MATCH_DETAIL = _struct(
    conditionType=_TEXT, sensitivityLevel=_TEXT, location=_TEXT, matchedData=T.ArrayType(_TEXT)
)
RULE_MATCH = _struct(ruleId=_TEXT, action=_TEXT, ruleMatchDetails=T.ArrayType(MATCH_DETAIL))
RULE_GROUP = _struct(
    ruleGroupId=_TEXT,
    terminatingRule=RULE_MATCH,
    nonTerminatingMatchingRules=T.ArrayType(RULE_MATCH),
    excludedRules=_TEXT,
)
RATE_RULE = _struct(rateBasedRuleId=_TEXT, limitKey=_TEXT, maxRateAllowed=_INT)
HTTP_REQUEST = _struct(
    clientIp=_TEXT,
    country=_TEXT,
    headers=T.ArrayType(_struct(name=_TEXT, value=_TEXT)),
    uri=_TEXT,
    args=_TEXT,
    httpVersion=_TEXT,
    httpMethod=_TEXT,
    requestId=_TEXT,
)
WIRE = _struct(
    timestamp=_LONG,
    formatVersion=_INT,
    webaclId=_TEXT,
    terminatingRuleId=_TEXT,
    terminatingRuleType=_TEXT,
    action=_TEXT,
    terminatingRuleMatchDetails=T.ArrayType(MATCH_DETAIL),
    httpSourceName=_TEXT,
    httpSourceId=_TEXT,
    ruleGroupList=T.ArrayType(RULE_GROUP),
    rateBasedRuleList=T.ArrayType(RATE_RULE),
    nonTerminatingMatchingRules=T.ArrayType(RULE_MATCH),
    requestHeadersInserted=_TEXT,
    responseCodeSent=_TEXT,
    httpRequest=HTTP_REQUEST,
    labels=T.ArrayType(_struct(name=_TEXT)),
)
PARTITION_FIELDS = [T.StructField(name, _TEXT) for name in PARTITIONS]


def lower_names(kind: T.DataType) -> T.DataType:
    """The same type with every field name in lower case."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name.lower(), lower_names(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(lower_names(kind.elementType))
    return kind


def contract_name(wire_name: str) -> str:
    return "ts_ms" if wire_name == "timestamp" else wire_name.lower()


CONTRACT = T.StructType([T.StructField(contract_name(f.name), lower_names(f.dataType)) for f in WIRE])
