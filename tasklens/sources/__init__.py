"""Readers and writers."""

from tasklens.sources.deltas import delta_columns, number_polls, read_deltas
from tasklens.sources.extracts import add_inbox, drop_meta, slim
from tasklens.sources.files import drop_account, read_jsonl, read_replica, write_jsonl, write_replica

__all__ = [
    "add_inbox", "delta_columns", "drop_account", "drop_meta", "number_polls", "read_deltas", "read_jsonl", "read_replica", "slim",
    "write_jsonl", "write_replica",
]
