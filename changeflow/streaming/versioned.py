"""Upsert state kept in versions: folded buckets, the deltas since, and a manifest that says what a version consists of.

``base/gen=<g>/bucket=<b>`` holds one row a key, tombstones included; ``delta/slot=<s>/bucket=<b>`` the last record of each key
of one batch. A batch writes a delta and then a manifest, whose appearance commits both. When there are ``limit`` deltas, or
they hold ``ratio`` times as many rows as the base, the buckets they touch are folded into the other generation of those buckets
and the next manifest points there; buckets that no delta touches stay as they are. So a row is written again about
``1 / ratio`` times for each doubling of the state, and a read costs one generation and few deltas, however long the
history.

Manifests take turns in two places, generations in two, deltas in twice ``limit``: what a new version writes over has not been part
of the last one, so a reader of the current or the last version is not disturbed, and nothing old is left to remove. A read
that lasts longer than two compactions of a bucket fails and is run again.

A batch that runs again after a failure writes over its own slot; one that has been committed is skipped. Records fold by
position, so late and repeated ones change nothing. One stream writes a state; any number may read it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.changelog import compact

RECORD = "key STRING, offset BIGINT, value STRING"
MANIFEST = "version BIGINT, batch_id BIGINT, buckets INT, bucket INT, gen INT, slot INT, n_rows BIGINT"


@dataclass
class Version:
    """What a manifest says: rows of each bucket's generation, and of each delta's buckets."""

    version: int = -1
    batch_id: int = -1
    base: dict[int, tuple[int, int]] = field(default_factory=dict)
    deltas: dict[int, dict[int, int]] = field(default_factory=dict)

    @property
    def touched(self) -> list[int]:
        return sorted({bucket for held in self.deltas.values() for bucket in held})

    @property
    def pending(self) -> int:
        return sum(n for held in self.deltas.values() for n in held.values())

    @property
    def settled(self) -> int:
        return sum(n for _, n in self.base.values())


@dataclass(frozen=True)
class VersionedState:
    """The state of one keyed topic below ``path``.

    ``buckets`` is how many tasks fold the state, at most; a state keeps the number it was made with.
    """

    path: str
    buckets: int = 16
    limit: int = 16
    ratio: float = 0.5

    # --- reading --------------------------------------------------------------------------------------------------

    def current(self, spark: SparkSession) -> Version | None:
        """The newest committed version; None before the first. Reads at most two manifests."""
        try:
            # The place that is being written may lose its old manifest under this read.
            reader = spark.read.schema(f"{MANIFEST}, place INT").option("ignoreMissingFiles", "true")
            rows = reader.parquet(f"{self.path}/manifest").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        newest = max((r["version"] for r in rows), default=None)
        if newest is None:
            return None
        now = Version()
        for r in (r for r in rows if r["version"] == newest):
            if r["buckets"] != self.buckets:
                raise ValueError(f"{self.path} has {r['buckets']} buckets, not {self.buckets}")
            now.version, now.batch_id = r["version"], r["batch_id"]
            if r["gen"] is not None:
                now.base[r["bucket"]] = (r["gen"], r["n_rows"])
            elif r["slot"] is not None:
                now.deltas.setdefault(r["slot"], {})[r["bucket"]] = r["n_rows"]
        return now

    def _base(self, spark: SparkSession, version: Version, buckets: list[int]) -> DataFrame | None:
        """Rows of the generations that a version names; only their directories are read."""
        wanted = {gen: [b for b in buckets if version.base.get(b, (None,))[0] == gen] for gen in (0, 1)}
        parts = [(F.col("gen") == gen) & F.col("bucket").isin(held) for gen, held in wanted.items() if held]
        if not parts:
            return None
        condition = parts[0] if len(parts) == 1 else parts[0] | parts[1]
        rows = spark.read.schema(f"{RECORD}, gen INT, bucket INT").parquet(f"{self.path}/base")
        return rows.where(condition).select("key", "offset", "value", "bucket")

    def _deltas(self, spark: SparkSession, version: Version) -> DataFrame | None:
        if not version.deltas:
            return None
        rows = spark.read.schema(f"{RECORD}, slot INT, bucket INT").parquet(f"{self.path}/delta")
        return rows.where(F.col("slot").isin(sorted(version.deltas))).select("key", "offset", "value", "bucket")

    def _folded(self, spark: SparkSession, version: Version) -> DataFrame | None:
        """The last record of each key of the buckets that deltas touch."""
        deltas, base = self._deltas(spark, version), self._base(spark, version, version.touched)
        if deltas is None:
            return None
        return compact(deltas if base is None else base.unionByName(deltas), ["bucket", "key"], "offset")

    def records(self, spark: SparkSession, version: Version | None = None) -> DataFrame:
        """The last record ``key, offset, value`` of every key, tombstones included.

        Buckets without deltas are scanned, the others are folded once; without deltas nothing is shuffled.
        """
        version = version or self.current(spark) or Version()
        still = [b for b in version.base if b not in set(version.touched)]
        found = [part for part in (self._base(spark, version, still), self._folded(spark, version)) if part is not None]
        if not found:
            return spark.createDataFrame([], RECORD)
        rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        return rows.select("key", "offset", "value")

    def live(self, spark: SparkSession) -> DataFrame:
        """The records of keys that are not deleted."""
        return self.records(spark).where(F.col("value").isNotNull())

    # --- writing --------------------------------------------------------------------------------------------------

    def apply(self, records: DataFrame, batch_id: int) -> Version:
        """Fold a batch of records ``key, offset, value`` into the state; its number decides whether it is new."""
        spark = records.sparkSession
        now = self.current(spark) or Version()
        if batch_id <= now.batch_id:
            return now
        after = Version(now.version + 1, batch_id, dict(now.base), dict(now.deltas))
        # Folded by key first, so that a hot key is one row before the rows of a bucket meet.
        bucket = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")
        folded = compact(records.select("key", "offset", "value"), ["key"], "offset").withColumn("bucket", bucket)
        if not now.base:
            after.base = self._write_base(folded, dict.fromkeys(range(self.buckets), 0))
        else:
            slot = after.version % (2 * self.limit)
            path = f"{self.path}/delta/slot={slot}"
            folded.repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
            held = _counts(spark.read.schema(f"{RECORD}, bucket INT").parquet(path))
            if held:
                after.deltas[slot] = held
            if len(after.deltas) >= self.limit or after.pending > self.ratio * after.settled:
                after = self._compact(spark, after)
        self._commit(spark, after)
        return after

    def _compact(self, spark: SparkSession, version: Version) -> Version:
        touched = version.touched
        if not touched:
            return version
        gens = {b: 1 - version.base[b][0] if b in version.base else 0 for b in touched}
        base = {**version.base, **self._write_base(self._folded(spark, version), gens)}
        return Version(version.version, version.batch_id, base, {})

    def _write_base(self, rows: DataFrame, gens: dict[int, int]) -> dict[int, tuple[int, int]]:
        """Write whole buckets into the given generations, replacing what these held; generation and rows of each."""
        spark = rows.sparkSession
        gen = F.element_at(F.array(*[F.lit(gens.get(b, 0)) for b in range(self.buckets)]), F.col("bucket") + 1)
        rows = rows.withColumn("gen", gen).repartition(self.buckets, "bucket")
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("gen", "bucket")
        writer.parquet(f"{self.path}/base")
        written = Version(base={b: (gen, 0) for b, gen in gens.items()})
        held = self._base(spark, written, sorted(gens))
        return {b: (gens[b], n) for b, n in _counts(held).items()}

    def _commit(self, spark: SparkSession, version: Version) -> None:
        head = (version.version, version.batch_id, self.buckets)
        rows = [(*head, None, None, None, None)]
        rows += [(*head, bucket, gen, None, n) for bucket, (gen, n) in version.base.items()]
        rows += [(*head, bucket, None, slot, n) for slot, held in version.deltas.items() for bucket, n in held.items()]
        manifest = spark.createDataFrame(rows, MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.path}/manifest/place={version.version % 2}")


def _counts(rows: DataFrame) -> dict[int, int]:
    """Rows of each bucket; only file footers are read."""
    return {r["bucket"]: r["count"] for r in rows.groupBy("bucket").count().collect()}
