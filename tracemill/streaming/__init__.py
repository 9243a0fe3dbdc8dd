"""Row-local operators under Structured Streaming, and deduplication against a table of kept shingle sets."""

from tracemill.streaming.adapters import DedupSink, read_traces, row_local

__all__ = ["DedupSink", "read_traces", "row_local"]
