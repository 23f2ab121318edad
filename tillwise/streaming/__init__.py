"""Structured Streaming ingest of landing-folder batches."""
