"""Structured Streaming entry points."""

from .landing_stream import landing_stream, start_landing_stream

__all__ = ["landing_stream", "start_landing_stream"]
