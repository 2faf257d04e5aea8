"""Structured Streaming: continuous ingest and scheduled catch-up of new files."""
