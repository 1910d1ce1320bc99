"""Incremental propagation of new bronze batches (Structured Streaming)."""
