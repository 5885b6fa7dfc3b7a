"""Structured Streaming jobs: ingestion, silver batches and stateful alerts."""
