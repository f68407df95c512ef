"""Structured Streaming: the batch operators on streams, with replay-safe table sinks."""
