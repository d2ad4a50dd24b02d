"""Analytics over HTTP request and web-firewall decision logs, as Spark DataFrames and streams."""

from ramparts.operators.decision import rule_decision, rule_hits, with_emergency_rules
from ramparts.operators.detection import (
    emergency_blocks,
    emergency_rules,
    emergency_uri,
    override_actions,
    rule_flags,
)
from ramparts.operators.governance import filter_logged, redact
from ramparts.operators.indicators import acl_scope, merge_indicators, validate_indicators
from ramparts.operators.kpi import attack_label, core_metrics, kpi_report, top_attack_vectors
from ramparts.operators.kpi_states import (
    hourly_states,
    kpi_report_from_states,
    read_hourly_states,
    refresh_hourly_states,
    write_hourly_states,
)
from ramparts.operators.lists import geo_blocked, ip_set_hits, uri_pattern_hits
from ramparts.operators.nested import (
    count_matches_by_rule,
    label_counts,
    matched_data,
    rate_rules,
    rule_group_matches,
)
from ramparts.operators.rate import rate_limit_breaches
from ramparts.operators.requests import as_requests, header_value
from ramparts.operators.scorecard import (
    category_summary,
    missed_attacks,
    rate_probe,
    run_severity,
    run_summary,
    score_results,
    suite_documents,
    write_suites,
)
from ramparts.operators.series import blocked_by_rule, traffic_overview
from ramparts.sources.logs import (
    compact_logs,
    read_compacted,
    read_logs,
    register_log_table,
    register_logs,
    retain,
    write_logs,
    write_retained,
)
from ramparts.streaming.ingest import ingest
from ramparts.streaming.live import stream_rate_limit

__all__ = [
    "acl_scope",
    "as_requests",
    "attack_label",
    "blocked_by_rule",
    "category_summary",
    "compact_logs",
    "core_metrics",
    "count_matches_by_rule",
    "emergency_blocks",
    "emergency_rules",
    "emergency_uri",
    "filter_logged",
    "geo_blocked",
    "header_value",
    "hourly_states",
    "ingest",
    "ip_set_hits",
    "kpi_report",
    "kpi_report_from_states",
    "label_counts",
    "matched_data",
    "merge_indicators",
    "missed_attacks",
    "override_actions",
    "rate_limit_breaches",
    "rate_probe",
    "rate_rules",
    "read_compacted",
    "read_hourly_states",
    "read_logs",
    "redact",
    "refresh_hourly_states",
    "register_log_table",
    "register_logs",
    "retain",
    "rule_decision",
    "rule_hits",
    "rule_flags",
    "rule_group_matches",
    "run_severity",
    "run_summary",
    "score_results",
    "stream_rate_limit",
    "suite_documents",
    "top_attack_vectors",
    "traffic_overview",
    "uri_pattern_hits",
    "validate_indicators",
    "write_hourly_states",
    "write_logs",
    "write_retained",
    "write_suites",
    "with_emergency_rules",
]
