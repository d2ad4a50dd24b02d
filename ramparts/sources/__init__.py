"""Log scans and sinks, the fixed reference sets, and logs derived from event tables."""

from ramparts.sources.logs import (
    append_hours,
    compact_logs,
    error_records,
    parse_lines,
    read_compacted,
    read_logs,
    register_log_table,
    register_logs,
    retain,
    to_lines,
    visible_partitions,
    with_hour_partition,
    write_errors,
    write_logs,
    write_retained,
)
from ramparts.sources.reference_sets import (
    allowed_countries,
    blocked_ranges,
    literal_table,
    rule_list,
    request_cases,
    uri_patterns,
)

__all__ = [
    "allowed_countries",
    "append_hours",
    "blocked_ranges",
    "compact_logs",
    "error_records",
    "literal_table",
    "parse_lines",
    "read_compacted",
    "read_logs",
    "register_log_table",
    "register_logs",
    "request_cases",
    "retain",
    "rule_list",
    "to_lines",
    "uri_patterns",
    "visible_partitions",
    "with_hour_partition",
    "write_errors",
    "write_logs",
    "write_retained",
]
