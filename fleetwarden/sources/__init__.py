"""Readers: driver tables, catalog snapshots and log-directory listings."""

from fleetwarden.sources.catalog import Snapshot
from fleetwarden.sources.logdir import list_log_dir, read_jsonlog, read_jsonlog_stream, read_stderr_log
from fleetwarden.sources.sinks import append_ledger, current_state, write_slices
from fleetwarden.sources.tables import read_jdbc, read_table

__all__ = ["Snapshot", "read_table", "read_jdbc", "list_log_dir", "read_jsonlog", "read_jsonlog_stream", "read_stderr_log", "append_ledger", "current_state", "write_slices"]
