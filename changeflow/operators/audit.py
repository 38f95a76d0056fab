"""Data-quality and parity audits of emitted records.

Where two sides are compared by counts alone, they are united and aggregated instead of joined: each task reduces its
input before the shuffle, so neither duplicates nor a hot key multiply rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.functions.jsonvalue import JsonObject, canonical_json, json_object
from changeflow.functions.topics import topic_name
from changeflow.operators.changelog import compact
from changeflow.operators.keyed_order import CHUNK_WIDTH, position_chunk, previous_in_key


def _count(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def _found() -> JsonObject:
    return JsonObject(F.col("_object"))


# --- parity -------------------------------------------------------------------------------------------------------


def parity(a: DataFrame, b: DataFrame, key: str, fields: list[str], order: str | None = None) -> DataFrame:
    """Compare two outputs key by key: ``key, verdict, differing``.

    ``verdict`` is ``equal``, ``changed``, ``only_a`` or ``only_b``; ``differing`` lists the fields that differ. With
    ``order`` the latest record of a key stands for it; without, keys are unique.
    """
    left, right = (_one_per_key(side, key, fields, order) for side in (a, b))
    both = left.withColumnRenamed("_image", "_a").join(right.withColumnRenamed("_image", "_b"), key, "full_outer")
    return compared(both, key, fields)


def compared(both: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, verdict, differing`` of rows that hold the images ``_a`` and ``_b`` of a key, one of which may be null."""
    differs = [F.when(~F.col("_a")[f].eqNullSafe(F.col("_b")[f]), F.lit(f)) for f in fields]
    in_both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    differing = F.when(in_both, F.array_compact(F.array(*differs)))
    verdict = (
        F.when(F.col("_b").isNull(), F.lit("only_a"))
        .when(F.col("_a").isNull(), F.lit("only_b"))
        .when(F.size("differing") > 0, F.lit("changed"))
        .otherwise(F.lit("equal"))
    )
    return both.withColumn("differing", differing).select(
        key, verdict.alias("verdict"), F.array_join("differing", ",").alias("differing")
    )


def _one_per_key(df: DataFrame, key: str, fields: list[str], order: str | None) -> DataFrame:
    if order:
        df = compact(df.select(key, *fields, order), [key], order)
    return df.select(key, F.struct(*fields).alias("_image"))


def parity_outbox(a: DataFrame, b: DataFrame, order: str | None = None) -> DataFrame:
    """Parity of a single-topic and a fanned-out outbox: destination, and payload as canonical JSON."""
    sides = [side.withColumn("payload", canonical_json(F.col("payload"))) for side in (a, b)]
    return parity(*sides, key="id", fields=["destination", "payload"], order=order)


def parity_hash(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Whole-record parity: per key, both sides hold the same records equally often.

    A record becomes two independent 64-bit hashes of its JSON text, and the records of a key their count and sums, so
    that the comparison shuffles fixed-width numbers whatever the records hold.
    """

    both = _signed_hashes(a, key, fields, 1).unionAll(_signed_hashes(b, key, fields, 0))
    return _judged(both, key)


def _judged(both: DataFrame, key: str) -> DataFrame:
    """Per key the records of each side, and whether they are the same ones equally often."""
    counted = both.groupBy(key).agg(
        F.sum("_in_a").alias("n_a"), F.sum("_in_b").alias("n_b"), F.sum("_h1").alias("_h1"), F.sum("_h2").alias("_h2")
    )
    verdict = (
        F.when(F.col("n_b") == 0, F.lit("only_a"))
        .when(F.col("n_a") == 0, F.lit("only_b"))
        .when((F.col("n_a") == F.col("n_b")) & (F.col("_h1") == 0) & (F.col("_h2") == 0), F.lit("equal"))
        .otherwise(F.lit("changed"))
    )
    return counted.select(key, "n_a", "n_b", verdict.alias("verdict"))


def _signed_hashes(df: DataFrame, key: str, fields: list[str], in_a: int) -> DataFrame:
    """``key, _in_a, _in_b, _h1, _h2``: two hashes of each record, negative on the second side, so equal sides sum up to zero."""
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    hashes = [F.xxhash64(text), F.xxhash64(F.concat(F.lit("\u0001"), text))]
    # Sums of 38 digits hold more records of one key than there can be.
    signed = [h.cast("decimal(38,0)") if in_a else -h.cast("decimal(38,0)") for h in hashes]
    return df.select(
        key, F.lit(in_a).alias("_in_a"), F.lit(1 - in_a).alias("_in_b"), signed[0].alias("_h1"), signed[1].alias("_h2")
    )


def parity_digest(a: DataFrame, b: DataFrame, key: str, fields: list[str], buckets: int = 4096, levels: int = 2) -> DataFrame:
    """``parity_hash`` of the keys that differ, found by descending a tree of digests: ``key, n_a, n_b, verdict``.

    A bucket of keys has a digest on each side: how many records, and the sums of their hashes. Buckets whose digests differ are
    cut into ``buckets`` smaller ones on the next of ``levels``, and only records of buckets that differ on the last are shuffled by
    key. Sides that are equal are read once and move one row for each bucket and task, whatever they hold; few differences
    move the records of as many small buckets. Each level reads both sides again, without what the level above has ruled out.
    """
    # The key is hashed with its record, or a record under another key of its bucket would go unseen.
    whole = list(dict.fromkeys([key, *fields]))
    both = _signed_hashes(a, key, whole, 1).unionAll(_signed_hashes(b, key, whole, 0))
    place = F.xxhash64(F.lit("bucket"), F.col(key))
    names = []
    for level in range(levels):
        names.append(f"_bucket_{level}")
        both = both.withColumn(names[-1], F.pmod(F.xxhash64(place, F.lit(level)), F.lit(buckets)).cast("int"))
        digests = both.groupBy(*names).agg(
            (F.sum("_in_a") - F.sum("_in_b")).alias("_n"), F.sum("_h1").alias("_s1"), F.sum("_h2").alias("_s2")
        )
        differ = digests.where("_n <> 0 OR _s1 <> 0 OR _s2 <> 0").select(*names)
        # On the first level there are no more than ``buckets`` of them.
        both = both.join(F.broadcast(differ) if level == 0 else differ, names, "left_semi")
    return _judged(both, key).where(F.col("verdict") != "equal")


# --- exactly once, completeness, continuity -----------------------------------------------------------------------


def exactly_once(expected: DataFrame, emitted: DataFrame, key: str, group: list[str] | None = None) -> DataFrame:
    """Emissions per key with a verdict: ``once``, ``missing``, ``duplicate`` or ``unexpected``.

    ``group`` are columns of ``expected`` to carry along; they depend on the key.
    """
    group = group or []
    wanted = expected.select(key, *group, F.lit(1).alias("_wanted"), F.lit(0).alias("_got"))
    got = emitted.select(
        key, *[F.lit(None).cast(expected.schema[g].dataType).alias(g) for g in group], F.lit(0).alias("_wanted"), F.lit(1).alias("_got")
    )
    counted = wanted.unionAll(got).groupBy(key).agg(
        F.sum("_wanted").alias("wanted"),
        F.sum("_got").cast("bigint").alias("emissions"),
        *[F.max(g).alias(g) for g in group],
    )
    verdict = (
        F.when(F.col("wanted") == 0, F.lit("unexpected"))
        .when(F.col("emissions") == 0, F.lit("missing"))
        .when(F.col("emissions") == 1, F.lit("once"))
        .otherwise(F.lit("duplicate"))
    )
    return counted.select(key, *group, "emissions", verdict.alias("verdict"))


def sink_completeness(pairs: dict[str, tuple[DataFrame, DataFrame]], key: str) -> DataFrame:
    """Per sink: source rows, rows that arrived, rows that did not. ``pairs`` maps a sink to (source, sink)."""
    reports = []
    for sink, (source, arrived) in pairs.items():
        per_key = exactly_once(source, arrived, key).where(F.col("verdict") != "unexpected")
        reports.append(
            per_key.agg(
                F.count("*").cast("bigint").alias("expected"),
                _count(F.col("emissions") > 0).alias("arrived"),
                _count(F.col("emissions") == 0).alias("missing"),
            ).select(F.lit(sink).alias("sink"), "expected", "arrived", "missing")
        )
    return reduce(DataFrame.unionAll, reports)


def continuity(
    expected: DataFrame, emitted: DataFrame, key: str, ts: str, stream: str, bucket: str, burst_rows: int
) -> DataFrame:
    """Exactly-once counts per stream and phase: ``burst``, ``after_quiet`` or ``steady``.

    Time is cut into buckets. A bucket of at least ``burst_rows`` rows is a burst; another one that follows an empty
    bucket comes after a quiet period. Rows are counted per bucket before buckets are compared, so the window sees one
    row per bucket.
    """
    placed = expected.withColumn("_bucket", F.window(ts, bucket)["start"])
    per_key = exactly_once(placed, emitted, key, group=[stream, "_bucket"]).where(F.col("verdict") != "unexpected")
    buckets = per_key.groupBy(stream, "_bucket").agg(
        F.count("*").alias("expected"),
        _count(F.col("verdict") == "missing").alias("missing"),
        _count(F.col("verdict") == "duplicate").alias("duplicate"),
    )
    before = F.lag("_bucket").over(Window.partitionBy(stream).orderBy("_bucket"))
    follows_quiet = before.isNotNull() & (F.col("_bucket") > before + F.expr(f"INTERVAL {bucket}"))
    phase = (
        F.when(F.col("expected") >= burst_rows, F.lit("burst"))
        .when(F.col("_quiet"), F.lit("after_quiet"))
        .otherwise(F.lit("steady"))
    )
    return (
        buckets.withColumn("_quiet", follows_quiet)
        .withColumn("phase", phase)
        .groupBy(stream, "phase")
        .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("expected", "missing", "duplicate")])
    )


# --- order and lifecycle ------------------------------------------------------------------------------------------


def order_violations(
    df: DataFrame, part: list[str], offset: str, marker: str, width: int = CHUNK_WIDTH
) -> DataFrame:
    """Records whose marker does not rise with the offset: ``part, prev_offset, offset, prev_marker, marker``."""
    rows = df.select(*part, offset, marker)
    paired = previous_in_key(rows, part, offset, [offset, marker], position_chunk(offset, width))
    return paired.where(F.col(f"prev_{marker}").isNotNull() & (F.col(marker) <= F.col(f"prev_{marker}")))


def lifecycle_violations(df: DataFrame, key: list[str], pos: str, op: str = "op", width: int = CHUNK_WIDTH) -> DataFrame:
    """Changes that do not fit the one before them in their key; legal is ``c u* d``, then ``c`` again.

    A snapshot read counts as a create. ``prev_op`` is null for the first change of a key.
    """
    paired = previous_in_key(df.select(*key, pos, op), key, pos, [op], position_chunk(pos, width))
    live = F.col(f"prev_{op}").isin("c", "r", "u")
    creates = F.col(op).isin("c", "r")
    legal = F.when(F.coalesce(live, F.lit(False)), F.col(op).isin("u", "d")).otherwise(creates)
    return paired.where(~legal)


# --- fields, nulls, tags, routing ---------------------------------------------------------------------------------


def field_report(df: DataFrame, required: list[str], value: str = "value", by: str = "topic") -> DataFrame:
    """Per topic and required field: records, valid JSON objects, and how many carry the field."""
    parsed = df.select(by, json_object(F.col(value)).column.alias("_object"))
    carried = parsed.groupBy(by).agg(
        F.count("*").cast("bigint").alias("records"),
        _count(F.col("_object").isNotNull()).alias("objects"),
        *[_count(_found().has(name)).alias(f"_has_{i}") for i, name in enumerate(required)],
    )
    per_field = F.array(
        *[F.struct(F.lit(name).alias("field"), F.col(f"_has_{i}").alias("present")) for i, name in enumerate(required)]
    )
    return carried.select(by, "records", "objects", F.inline(per_field)).withColumn(
        "absent", F.col("records") - F.col("present")
    )


def null_report(df: DataFrame, field: str, value: str = "value", by: str = "topic") -> DataFrame:
    """Per topic: objects where the field is absent, present with a null, and present with a value."""
    # Counted, not filtered: a filter on the parsed object would be pushed down and parse every text twice.
    parsed = df.select(by, json_object(F.col(value)).column.alias("_object"))
    has, is_null = _found().has(field), _found().has_null(field)
    return parsed.groupBy(by).agg(
        _count(_found().exists() & ~has).alias("absent"),
        _count(has & is_null).alias("explicit_null"),
        _count(has & ~is_null).alias("with_value"),
    )


@dataclass(frozen=True)
class Contract:
    """Fields a topic's records must carry, with their value where it is fixed, and fields they must not carry."""

    required: dict[str, str | None]
    forbidden: tuple[str, ...] = ()


# The tags each kind of job writes.
STREAM_CONTRACT = Contract({"variant": "datastream-cdc", "topic": None}, ("job_variant",))
TABLE_CONTRACT = Contract({"job_variant": "table-api"}, ("variant",))
SQL_CONTRACT = Contract({"job_variant": "sql-api"}, ("variant",))
PLAIN_CONTRACT = Contract({}, ("variant", "job_variant"))


def connector_contract(variant: str) -> Contract:
    return Contract({"variant": variant, "topic": None, "transformed_at": None}, ("job_variant",))


def contract_report(df: DataFrame, contracts: dict[str, Contract], value: str = "value") -> DataFrame:
    """Per topic with a contract: records and records that break it. Tombstones carry no fields and are not counted."""
    parsed = df.where(F.col("topic").isin(*contracts)).select(
        "topic", F.col(value).isNotNull().alias("_record"), json_object(F.col(value)).column.alias("_object")
    )
    kept = F.lit(False)
    for topic, contract in contracts.items():
        rules = [F.col("_object").isNotNull()]
        for name, fixed in contract.required.items():
            found = _found().text(name, default=None)
            rules.append(found.isNotNull() if fixed is None else found.eqNullSafe(F.lit(fixed)))
        rules += [~_found().has(name) for name in contract.forbidden]
        kept = F.when(F.col("topic") == topic, reduce(Column.__and__, rules)).otherwise(kept)
    return (
        parsed.withColumn("_kept", F.coalesce(kept, F.lit(False)))
        .groupBy("topic")
        .agg(
            _count(F.col("_record")).alias("records"), _count(F.col("_record") & ~F.col("_kept")).alias("violations")
        )
    )


def evolution_report(df: DataFrame, field: str, changed: Column, value: str = "value") -> DataFrame:
    """Before and after a schema change: objects, those with the field, and those that should not be as they are.

    ``changed`` is true for records written after the change.
    """
    parsed = df.select(
        F.when(changed, F.lit("after")).otherwise(F.lit("before")).alias("phase"),
        json_object(F.col(value)).column.alias("_object"),
    )
    has = _found().has(field)
    return parsed.groupBy("phase").agg(
        _count(_found().exists()).alias("records"),
        _count(has).alias("with_field"),
        _count(_found().exists() & (has != (F.col("phase") == "after"))).alias("violations"),
    )


def routing_report(df: DataFrame, prefix: str, destination: str = "destination") -> DataFrame:
    """Per topic: records, and records whose destination belongs in another topic."""
    wrong = F.col("topic") != topic_name(prefix, F.col(destination))
    return df.groupBy("topic").agg(
        F.count("*").cast("bigint").alias("records"), _count(F.coalesce(wrong, F.lit(True))).alias("misrouted")
    )


def malformed(df: DataFrame, value: str = "value") -> DataFrame:
    """The records whose value is text but no JSON object."""
    return df.where(F.col(value).isNotNull() & ~json_object(F.col(value)).exists())


def malformed_report(df: DataFrame, ts: str, bucket: str, offset: str = "offset", value: str = "value") -> DataFrame:
    """Malformed records per topic and time bucket, with the first and the last offset to look them up by."""
    return (
        malformed(df, value)
        .groupBy("topic", F.window(ts, bucket)["start"].alias("bucket_start"))
        .agg(
            F.count("*").cast("bigint").alias("malformed"),
            F.min(offset).alias("first_offset"),
            F.max(offset).alias("last_offset"),
        )
    )
