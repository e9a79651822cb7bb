"""Structured Streaming: artifact arrival, chained loads, cycles and late rows."""
