"""Structured Streaming: incremental ingest of record dumps (S6 re-aimed)."""
