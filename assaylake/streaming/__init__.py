"""Structured Streaming versions of ingest, routing and progress."""
