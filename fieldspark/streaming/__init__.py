"""Structured Streaming: upserting sinks, cursors, newest row per key."""
