"""Structured Streaming: recommendation requests served in micro-batches."""
