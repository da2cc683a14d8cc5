"""Structured Streaming jobs: incremental ingest and live sessions."""
