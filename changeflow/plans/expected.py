"""SQL for the derived inputs, as common table expressions for the stated results."""

from __future__ import annotations

_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "f_ord": (
        (),
        """SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
                  o_orderstatus AS status, o_orderdate AS created_at FROM orders""",
    ),
    "f_cust": (
        (),
        """SELECT c_custkey AS id, c_name AS name,
                  lower(replace(c_name, '#', '.')) || '@example.com' AS email FROM customer""",
    ),
    "f_out": (
        (),
        """SELECT event_id AS id, event_type AS destination, props AS payload, ts AS created_at, value
           FROM events""",
    ),
    "f_log": (
        (),
        """SELECT event_id AS pos, ts, user_id AS id,
                  CASE WHEN event_type = 'error' THEN 'd' WHEN pt IS NULL OR pt = 'error' THEN 'c' ELSE 'u' END AS op,
                  CASE WHEN pt IS NULL OR pt = 'error' THEN NULL ELSE CAST(pv AS DECIMAL(10,2)) END AS before_amount,
                  CASE WHEN pt IS NULL OR pt = 'error' THEN NULL ELSE pt END AS before_status,
                  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS DECIMAL(10,2)) END AS after_amount,
                  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS after_status,
                  epoch_us(ts) // 1000 AS ts_ms
           FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS pt,
                        lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS pv FROM events) b
           WHERE NOT (event_type = 'error' AND (pt IS NULL OR pt = 'error'))""",
    ),
    "f_raw": (
        (),
        """SELECT event_id AS pos, ts, event_type AS destination, props AS payload,
                  CASE event_type
                    WHEN 'click' THEN '{"id": ' || event_id || ', "destination": "' || event_type || '", "payload": ' || props || '}'
                    WHEN 'signup' THEN '{"id":' || event_id || ',"destination":"' || event_type || '","payload":' || props
                    WHEN 'error' THEN '}'
                    ELSE '{"id":' || event_id || ',"destination":"' || event_type || '","payload":' || props || '}'
                  END AS value
           FROM events""",
    ),
    "f_emit": (
        ("f_ord",),
        """SELECT id, customer_id, amount,
                  CASE WHEN amount BETWEEN 250000 AND 252000 THEN status || '!' ELSE status END AS status,
                  id * 10 + unnest(CASE WHEN amount >= 495000 THEN [0, 1] ELSE [0] END) AS off
           FROM f_ord WHERE amount >= 3000""",
    ),
    "f_emit_out": (
        ("f_out",),
        """SELECT id, destination, payload, created_at,
                  id * 10 + CASE WHEN value BETWEEN 100 AND 110 THEN 35 ELSE 0 END
                    + unnest(CASE WHEN value >= 200 THEN [0, 1] ELSE [0] END) AS off
           FROM f_out WHERE value >= 0.5""",
    ),
    "f_met": (
        (),
        """SELECT 'job_' || CAST(user_id % 5 AS VARCHAR(10)) AS job_name,
                  TIMESTAMP '2024-01-01 00:00:00' + event_id * INTERVAL '5' SECOND AS ts,
                  SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id % 5, event_id // 400 ORDER BY event_id) AS num_restarts,
                  SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id % 5 ORDER BY event_id) AS num_failed_checkpoints,
                  SUM(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id % 5 ORDER BY event_id) AS num_completed_checkpoints,
                  CASE WHEN event_id % 1000 < 60 THEN 200000 ELSE CAST(round(value * 100) AS BIGINT) END
                    AS last_checkpoint_duration
           FROM events""",
    ),
}


def with_inputs(*names: str, select: str) -> str:
    """``select`` with the named derived inputs in scope."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _PARTS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = ",\n".join(f"{name} AS ({_PARTS[name][1]})" for name in ordered)
    body = select.strip()
    # A query with tables of its own joins its WITH list to this one.
    return f"WITH {parts},\n{body[5:]}" if body[:5].upper() == "WITH " else f"WITH {parts}\n{body}"
