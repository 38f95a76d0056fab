"""Parity of two running outputs: both are streams, compared key by key as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.jsonvalue import canonical_json
from changeflow.operators.audit import compared


def parity_live(a: DataFrame, b: DataFrame, key: str, fields: list[str], ts: str, delay: str) -> DataFrame:
    """Compare two streams of records: ``key, verdict, differing``, as the batch form gives them.

    A key is compared once both sides have it. One that only one side has is reported when the watermark of both has passed the
    record by ``delay``, which is also how far the two may be apart in event time, so what is kept is what arrives in that time. The
    first record of a key within ``delay`` stands for it; repeated ones are dropped. A record without a key is a heartbeat:
    it matches nothing and only moves the watermark.
    """
    if not (a.isStreaming and b.isStreaming):
        raise ValueError("parity_live takes streams; parity takes batches")
    left, right = _side(a, key, fields, ts, delay, "a"), _side(b, key, fields, ts, delay, "b")
    near = F.col("_ts_a").between(F.col("_ts_b") - F.expr(f"INTERVAL {delay}"), F.col("_ts_b") + F.expr(f"INTERVAL {delay}"))
    both = left.join(right, (F.col("_key_a") == F.col("_key_b")) & near, "full_outer")
    return compared(both.withColumn(key, F.coalesce("_key_a", "_key_b")), key, fields).where(F.col(key).isNotNull())


def _side(df: DataFrame, key: str, fields: list[str], ts: str, delay: str, name: str) -> DataFrame:
    rows = df.select(
        F.col(key).alias(f"_key_{name}"), F.struct(*fields).alias(f"_{name}"), F.col(ts).cast("timestamp").alias(f"_ts_{name}")
    )
    return rows.withWatermark(f"_ts_{name}", delay).dropDuplicatesWithinWatermark([f"_key_{name}"])


def parity_outbox_live(a: DataFrame, b: DataFrame, ts: str, delay: str) -> DataFrame:
    """Live parity of a single-topic and a fanned-out outbox: destination, and payload as canonical JSON."""
    sides = [side.withColumn("payload", canonical_json(F.col("payload"))) for side in (a, b)]
    return parity_live(*sides, key="id", fields=["destination", "payload"], ts=ts, delay=delay)
