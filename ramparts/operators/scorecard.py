"""Recorded detection results against expected outcomes.

A result history has one row per response: url, run_ts, test_name, actual_status,
response_time, response_headers, body, error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ramparts.functions.rounding import rate_half_up
from ramparts.sources.reference_sets import RATE_CASE

# Signs that a response came from the firewall.
BLOCKED_STATUS = 403
FIREWALL_HEADERS = ("x-amzn-waf", "x-amz-cf-id", "x-cache")
FIREWALL_TEXTS = ("request blocked", "access denied", "waf", "cloudfront")
# Fixed value: blocked responses that a rate probe needs to pass.
PROBE_BLOCKS = 3

RUN = ["url", "run_ts"]
# Fixed value: what the result of the rate probe says of itself.
PROBE_TEXT = "Rate limiting test - %d/%d requests blocked"
NOT_BLOCKED, FALSE_POSITIVE = "attack not blocked", "false positive"
RESULT_COLUMNS = [
    "test_name",
    "description",
    "expected_status",
    "actual_status",
    "response_time",
    "passed",
    "error",
    "response_headers",
    "blocked_by_waf",
]


def blocked_by_firewall(status: Column, headers: Column, body: Column) -> Column:
    """Status 403, a telltale header, or a telltale text in the body.

    Deliberately broad: any cached response and any body with ``waf`` in it counts.
    """
    names = F.transform(F.map_keys(headers), lambda name: F.lower(name))
    header_found = F.arrays_overlap(names, F.array(*[F.lit(name) for name in FIREWALL_HEADERS]))
    text = F.lower(body)
    text_found = F.lit(False)
    for sign in FIREWALL_TEXTS:
        text_found = text_found | text.contains(sign)
    no = F.lit(False)
    return F.coalesce(status == BLOCKED_STATUS, no) | F.coalesce(header_found, no) | F.coalesce(text_found, no)


def score_results(cases: DataFrame, results: DataFrame, rate_case: str = RATE_CASE) -> DataFrame:
    """Every result with its description, expectation, verdict and firewall sign.

    The responses of the rate probe are one result with the probe's own verdict. A case without a result in a run
    is added with status 0, which means no answer and fails; so is a probe that got no response recorded.
    Which cases a run has is gathered as a set, at most as large as the case list.
    """
    told = F.col("description") if "description" in cases.columns else F.lit(None).cast("string")
    expected = cases.select("test_name", "expected_status", told.alias("description"))
    single = results.filter(F.col("test_name") != rate_case)
    scored = single.join(expected, "test_name").select(
        *RUN,
        "test_name",
        "description",
        "expected_status",
        "actual_status",
        "response_time",
        F.coalesce(F.col("actual_status") == F.col("expected_status"), F.lit(False)).alias("passed"),
        "error",
        "response_headers",
        blocked_by_firewall(F.col("actual_status"), F.col("response_headers"), F.col("body")).alias("blocked_by_waf"),
    )
    probes = rate_probe(results, rate_case).withColumns(
        {
            "test_name": F.lit(rate_case),
            "description": F.format_string(PROBE_TEXT, "blocked_count", "sent"),
            "error": F.lit(None).cast("string"),
            "response_headers": F.lit(None).cast("map<string,string>"),
        }
    )
    probes = probes.join(expected.select("test_name"), "test_name", "left_semi").select(*scored.columns)
    listed = cases.groupBy().agg(F.collect_set("test_name").alias("m")).scalar()
    absent = (
        results.join(expected, "test_name", "left_semi")
        .groupBy(*RUN)
        .agg(F.collect_set("test_name").alias("seen"))
        .select(*RUN, F.explode(F.array_except(listed, F.col("seen"))).alias("test_name"))
        .join(expected, "test_name")
        .select(
            *RUN,
            "test_name",
            "description",
            "expected_status",
            F.lit(0).alias("actual_status"),
            F.lit(None).cast("double").alias("response_time"),
            F.lit(False).alias("passed"),
            F.lit("no result recorded").alias("error"),
            F.lit(None).cast("map<string,string>").alias("response_headers"),
            F.lit(False).alias("blocked_by_waf"),
        )
    )
    return scored.unionByName(probes).unionByName(absent)


def _passed() -> Column:
    return F.count_if("passed")


def run_summary(scored: DataFrame) -> DataFrame:
    """Per run: totals, time spent in seconds, success rate in percent to one decimal."""
    total = F.count(F.lit(1))
    return scored.groupBy(*RUN).agg(
        total.alias("total_tests"),
        _passed().alias("passed_tests"),
        (total - _passed()).alias("failed_tests"),
        # Summed as decimals, so that the order of the rows does not show in the result.
        F.coalesce(F.sum(F.col("response_time").cast("decimal(18,6)")).cast("double"), F.lit(0.0)).alias(
            "execution_time"
        ),
        rate_half_up(_passed(), total, 1).alias("success_rate"),
    )


def category_summary(scored: DataFrame) -> DataFrame:
    """Per run: passed and total, apart for requests to be let in and to be blocked."""
    return (
        scored.filter(F.col("expected_status").isin(200, BLOCKED_STATUS))
        .groupBy(*RUN, "expected_status")
        .agg(_passed().alias("passed_tests"), F.count(F.lit(1)).alias("total_tests"))
    )


def outcome(expected: Column, actual: Column) -> Column:
    return F.when((expected == BLOCKED_STATUS) & (actual == 200), F.lit(NOT_BLOCKED)).when(
        (expected == 200) & (actual == BLOCKED_STATUS), F.lit(FALSE_POSITIVE)
    )


def missed_attacks(scored: DataFrame) -> DataFrame:
    """Failed results that let an attack in or kept a good request out."""
    labelled = scored.filter(~F.col("passed")).withColumn(
        "outcome", outcome(F.col("expected_status"), F.col("actual_status"))
    )
    return labelled.filter(F.col("outcome").isNotNull())


def rate_probe(results: DataFrame, test_name: str = RATE_CASE, needed: int = PROBE_BLOCKS) -> DataFrame:
    """Verdict per rate probe, which is all responses of ``test_name`` in a run."""
    status = F.col("actual_status")
    blocked = F.count_if((status == BLOCKED_STATUS) | status.between(500, 599))
    return (
        results.filter(F.col("test_name") == test_name)
        .groupBy(*RUN)
        .agg(
            F.count(F.lit(1)).alias("sent"),
            blocked.alias("blocked_count"),
            # Summed as decimals, so that the order of the rows does not show in the result.
            F.sum(F.col("response_time").cast("decimal(18,6)")).cast("double").alias("response_time"),
        )
        .withColumn("passed", F.col("blocked_count") >= needed)
        .withColumn("expected_status", F.when(F.col("passed"), BLOCKED_STATUS).otherwise(200))
        .withColumn("actual_status", F.when(F.col("blocked_count") > 0, BLOCKED_STATUS).otherwise(200))
        .withColumn("blocked_by_waf", F.col("blocked_count") > 0)
    )


def run_severity(scored: DataFrame) -> DataFrame:
    """Per run: 2 if an attack test failed, 1 if any other did, else 0."""
    failed = ~F.col("passed")
    level = F.when(failed & (F.col("expected_status") == BLOCKED_STATUS), 2).when(failed, 1).otherwise(0)
    return scored.groupBy(*RUN).agg(F.max(level).alias("severity"))


def suite_documents(scored: DataFrame) -> DataFrame:
    """One nested document per run: its totals, and its results as an array.

    A run has one result per case, the probe's many responses being one, so the case list bounds the array.
    """
    total, passed = F.count(F.lit(1)), _passed()
    return scored.groupBy(*RUN).agg(
        total.alias("total_tests"),
        passed.alias("passed_tests"),
        (total - passed).alias("failed_tests"),
        F.coalesce(F.sum(F.col("response_time").cast("decimal(18,6)")).cast("double"), F.lit(0.0)).alias(
            "execution_time"
        ),
        F.collect_list(F.struct(*RESULT_COLUMNS)).alias("tests"),
    ).withColumnRenamed("run_ts", "timestamp")


def write_suites(scored: DataFrame, path: str, mode: str = "overwrite") -> None:
    suite_documents(scored).write.mode(mode).option("ignoreNullFields", "false").json(path)
