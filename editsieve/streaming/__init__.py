"""Structured Streaming services composed from the batch operators."""
