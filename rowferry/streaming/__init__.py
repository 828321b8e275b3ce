"""Structured Streaming sinks and run control. Stream sources are those of `rowferry.sources`."""

from rowferry.streaming.joins import interval_join
from rowferry.streaming.sinks import run_stream, start_stream

__all__ = ["interval_join", "run_stream", "start_stream"]
