"""Incremental ingestion of monthly export files with Structured Streaming."""

from homestats.streaming.ingest import flag_stream, ingest_once  # noqa: F401
