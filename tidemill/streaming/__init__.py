"""Structured Streaming: continuous ingest, windows and topic-to-table loading."""
