"""Structured Streaming jobs: log ingest, live series, live rate limit."""

from ramparts.streaming.ingest import ingest, line_stream
from ramparts.streaming.live import drained, stream_rate_limit, to_files
from ramparts.streaming.rates import rocksdb, stream_request_rates

__all__ = ["drained", "ingest", "line_stream", "rocksdb", "stream_rate_limit", "stream_request_rates", "to_files"]
