"""Streaming: scoring a stream with a fitted model (the reference has no streaming operator)."""
