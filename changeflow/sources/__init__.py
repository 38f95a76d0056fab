"""Reading change logs, typed tables and topics."""

from changeflow.sources.changelog import (
    filter_tables,
    key_ranges,
    read_changelog,
    read_outbox,
    snapshot_jdbc,
    snapshot_then_log,
    stream_changelog,
    write_changelog,
)
from changeflow.sources.snapshot import ChunkedSnapshot
from changeflow.sources.tables import TableSpec, read_parquet_stream, read_parquet_table, read_table
from changeflow.sources.topics import count_matching, first_match, poll

__all__ = [
    "ChunkedSnapshot",
    "TableSpec",
    "count_matching",
    "filter_tables",
    "first_match",
    "key_ranges",
    "poll",
    "read_changelog",
    "read_outbox",
    "read_parquet_stream",
    "read_parquet_table",
    "read_table",
    "snapshot_jdbc",
    "snapshot_then_log",
    "stream_changelog",
    "write_changelog",
]
