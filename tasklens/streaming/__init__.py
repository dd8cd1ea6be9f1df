"""Streaming merge of change payloads."""

from tasklens.sources.commits import Store
from tasklens.streaming.replica_stream import compact, current_replica, purge_account, start_merge, stream_cycles, stream_stats

__all__ = ["Store", "compact", "current_replica", "purge_account", "start_merge", "stream_cycles", "stream_stats"]
