"""Structured Streaming parts: table sink, discard sink, keyed-state
enrichment in arrival order, enrichment watermark."""

from rivulet.streaming.sinks import append_sink, discard_sink, trigger_options  # noqa: F401
