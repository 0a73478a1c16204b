"""Incremental runs of the flows over a landing folder (Structured Streaming)."""

from civic_indicators.streaming.landing import curated_rows, registration_stream

__all__ = ["curated_rows", "registration_stream"]
