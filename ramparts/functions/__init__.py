"""Column functions: text transforms, IPv4 arithmetic, rounding, ARN parts."""

from ramparts.functions.acl import acl_part, acl_scope_of
from ramparts.functions.network import ipv4_number, is_ipv4_range, range_key, to_range
from ramparts.functions.rounding import rate_half_up
from ramparts.functions.text import (
    byte_match,
    html_entity_decode,
    lowercase,
    query_arguments_text,
    unchanged,
    url_decode,
)

__all__ = [
    "acl_part",
    "acl_scope_of",
    "byte_match",
    "html_entity_decode",
    "ipv4_number",
    "is_ipv4_range",
    "lowercase",
    "query_arguments_text",
    "range_key",
    "rate_half_up",
    "to_range",
    "unchanged",
    "url_decode",
]
