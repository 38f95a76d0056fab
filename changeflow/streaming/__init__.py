"""Streaming sinks, versioned upsert state, live state, alerts, parity, delivery and progress metrics."""

from changeflow.streaming.alerts import alert_live, alert_transitions_live
from changeflow.streaming.delivery import from_headers, newer_only, with_headers
from changeflow.streaming.live import (
    counter_growth_live,
    counter_segments,
    lifecycle_live,
    lifecycle_ordered,
    read_state,
    silence_live,
    write_state,
)
from changeflow.streaming.parity import parity_live, parity_outbox_live
from changeflow.streaming.progress import ProgressMetrics
from changeflow.streaming.sinks import (
    FileTarget,
    KafkaTarget,
    Statement,
    StreamOptions,
    read_committed,
    read_topic,
    read_upsert,
    resume,
    run_statement_set,
    write_append,
    write_keyed,
    write_routed,
    write_upsert,
)
from changeflow.streaming.versioned import VersionedState

__all__ = [
    "FileTarget",
    "KafkaTarget",
    "ProgressMetrics",
    "Statement",
    "StreamOptions",
    "VersionedState",
    "alert_live",
    "alert_transitions_live",
    "counter_growth_live",
    "counter_segments",
    "from_headers",
    "lifecycle_live",
    "lifecycle_ordered",
    "newer_only",
    "parity_live",
    "parity_outbox_live",
    "read_committed",
    "read_state",
    "read_topic",
    "read_upsert",
    "resume",
    "run_statement_set",
    "silence_live",
    "with_headers",
    "write_append",
    "write_keyed",
    "write_routed",
    "write_state",
    "write_upsert",
]
