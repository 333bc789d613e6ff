"""Streaming: incremental batches applied through Structured Streaming."""

from keelson.streaming.incremental import stream_apply

__all__ = ["stream_apply"]
