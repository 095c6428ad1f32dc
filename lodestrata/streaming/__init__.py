"""Structured Streaming: parsing, enrichment, windows, sinks and query health."""
