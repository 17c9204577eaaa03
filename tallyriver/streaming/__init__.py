"""Structured Streaming: sinks, keyed state, metrics and run control."""
