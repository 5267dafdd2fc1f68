"""Structured Streaming jobs."""

from tagloom.streaming.events import deduplicated, event_batches, file_stream, queue_stream, start
from tagloom.streaming.grid import GridStream
from tagloom.streaming.keyed import closing, keyed_grid
from tagloom.streaming.requests import request_batches

__all__ = [
    "GridStream", "closing", "deduplicated", "event_batches", "file_stream", "keyed_grid", "queue_stream", "request_batches", "start",
]
