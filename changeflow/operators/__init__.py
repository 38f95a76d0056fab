"""DataFrame-to-DataFrame operators on change events."""

from changeflow.operators.audit import (
    Contract,
    connector_contract,
    continuity,
    contract_report,
    evolution_report,
    exactly_once,
    field_report,
    lifecycle_violations,
    malformed,
    malformed_report,
    null_report,
    order_violations,
    parity,
    parity_digest,
    parity_hash,
    parity_outbox,
    routing_report,
    sink_completeness,
)
from changeflow.operators.changelog import (
    as_append,
    compact,
    current_state,
    dedup_events,
    diff_states,
    evolve,
    evolve_tables,
    ordered,
    state_as_of,
    update_delta,
)
from changeflow.operators.enrich import enrich_json, enrich_map, enrich_struct, project_tagged, tag_event
from changeflow.operators.envelope import (
    extract_row,
    op_image,
    parse_envelope,
    parse_flat,
    to_envelope,
    to_upsert_record,
)
from changeflow.operators.history import SchemaHistory, observed_fields
from changeflow.operators.monitor import (
    AlertRule,
    alert,
    alert_state,
    alert_transitions,
    checkpoint_summary,
    counter_growth,
    increase,
    job_health,
    metric_latest,
    metric_series,
    metric_sketches,
    offset_lag,
    silence,
    sketch_quantiles,
    source_lag,
)
from changeflow.operators.route import (
    add_routing,
    destination_of,
    fan_out,
    route_by_table,
    route_outbox,
    route_outbox_single,
    table_of,
    topic_catalog,
)

__all__ = [
    "AlertRule",
    "Contract",
    "SchemaHistory",
    "add_routing",
    "alert",
    "alert_state",
    "alert_transitions",
    "as_append",
    "checkpoint_summary",
    "compact",
    "connector_contract",
    "continuity",
    "contract_report",
    "counter_growth",
    "current_state",
    "dedup_events",
    "destination_of",
    "diff_states",
    "enrich_json",
    "enrich_map",
    "enrich_struct",
    "evolution_report",
    "evolve",
    "evolve_tables",
    "exactly_once",
    "extract_row",
    "fan_out",
    "field_report",
    "increase",
    "job_health",
    "lifecycle_violations",
    "malformed",
    "malformed_report",
    "metric_latest",
    "metric_series",
    "metric_sketches",
    "null_report",
    "observed_fields",
    "offset_lag",
    "op_image",
    "order_violations",
    "ordered",
    "parity",
    "parity_digest",
    "parity_hash",
    "parity_outbox",
    "parse_envelope",
    "parse_flat",
    "project_tagged",
    "route_by_table",
    "route_outbox",
    "route_outbox_single",
    "routing_report",
    "silence",
    "sink_completeness",
    "sketch_quantiles",
    "source_lag",
    "state_as_of",
    "table_of",
    "tag_event",
    "to_envelope",
    "to_upsert_record",
    "topic_catalog",
    "update_delta",
]
