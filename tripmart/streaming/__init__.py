"""Triggered incremental refresh of the Bronze layer with Structured Streaming."""
