"""Structured Streaming ingest of trip-event messages."""
