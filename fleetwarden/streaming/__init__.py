"""Structured Streaming variants: continuous two-hour slicing and event-log appends."""

from fleetwarden.streaming.commits import committed
from fleetwarden.streaming.eventlog import append_events_once, append_events_stream
from fleetwarden.streaming.slicer import SliceLedgerStream
from fleetwarden.streaming.slices import run_slice_stream, slice_stream, slice_windows

__all__ = ["slice_stream", "slice_windows", "run_slice_stream", "append_events_stream", "append_events_once", "committed", "SliceLedgerStream"]
