"""Resharding by minimum-cost flow.

From the bytes of the old shards and the capacities of the new ones one flow that moves the fewest bytes is solved on the
graph of shards. Old shards are cut into blocks; a block goes where the flow sends its bytes, and only a block on a border
between two targets is split, at a row. Each border is cut in small rows of the shard that gives, if it has any. Shards that
neither give nor receive keep their files.

The law is ``bytes``: sizes are in proportion to the capacities, by default equal, but for about one row at each border. Null texts
have the size of the overhead alone. Repeated rows are placed row by row. An empty table gives no rows. Other columns are not
looked at.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut

OVERHEAD = 8
BLOCKS = 256
#: Share of all bytes that counts as small rows, which even out borders; the order of rows in a block.
FILLING = 0.2
ORDER = "doc_id, text_crc32, size"


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """``flow[i][j]`` from supply i to capacity j of least cost, by cheapest augmenting paths over shards.

    ``sum(supply)`` must not exceed ``sum(capacity)``. The graph has one node a shard, so its size does not follow the data.
    """
    n, m = len(supply), len(capacity)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        # Cheapest way to each target, over edges that have flow to give back (Bellman-Ford).
        reach_i: list[float] = [0 if left[i] else float("inf") for i in range(n)]
        reach_j: list[float] = [float("inf")] * m
        from_j, from_i = [-1] * m, [-1] * n
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    if reach_i[i] + cost[i][j] < reach_j[j]:
                        reach_j[j], from_j[j], changed = reach_i[i] + cost[i][j], i, True
            for j in range(m):
                for i in range(n):
                    if flow[i][j] and reach_j[j] - cost[i][j] < reach_i[i]:
                        reach_i[i], from_i[i], changed = reach_j[j] - cost[i][j], j, True
        target = min((j for j in range(m) if room[j]), key=lambda j: (reach_j[j], j))
        path, j, amount = [], target, room[target]
        while True:
            i = from_j[j]
            path.append((i, j, from_i[i]))
            if from_i[i] < 0:
                amount = min(amount, left[i])
                break
            amount = min(amount, flow[i][from_i[i]])
            j = from_i[i]
        for i, j, back in path:
            flow[i][j] += amount
            if back >= 0:
                flow[i][back] -= amount
        left[path[-1][0]] -= amount
        room[target] -= amount
    return flow


def goals(total: int, capacities: list[int]) -> list[int]:
    """Parts of ``total`` in proportion to the capacities."""
    ends = [total * at // sum(capacities) for at in accumulate(capacities)]
    return [end - start for start, end in zip([0, *ends], ends)]


def _placed(rows: DataFrame, parts: list[list[int]]) -> DataFrame:
    """``rows`` (doc_id, size, text_crc32, old, block) with their new shard; ``parts[i][j]`` bytes of old shard i go to j."""
    # Segments of an old shard's bytes: first what stays, then what goes to each new shard. At most shards * shards rows.
    segments = []
    for i, row in enumerate(parts):
        at = 0
        for j in sorted((j for j, f in enumerate(row) if f), key=lambda j: (j != i, j)):
            segments.append((i, at, at + row[j], j))
            at += row[j]
    targets = rows.sparkSession.createDataFrame(segments, "old_shard int, low long, high long, shard int")
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    sums = rows.groupBy("old", "block").agg(F.sum("size").alias("bytes"))
    starts = sums.selectExpr("old", "block", f"coalesce(sum(bytes) OVER (PARTITION BY old ORDER BY block {before}), 0) AS block_at")
    at = rows.selectExpr("*", f"coalesce(sum(size) OVER (PARTITION BY old, block ORDER BY {ORDER} {before}), 0) AS row_at")
    # A row goes where its middle falls.
    at = at.join(starts, ["old", "block"]).withColumn("at", F.col("block_at") + F.col("row_at") + F.floor(F.col("size") / 2))
    inside = (F.col("old") == F.col("old_shard")) & (F.col("at") >= F.col("low")) & (F.col("at") < F.col("high"))
    return at.join(F.broadcast(targets), inside).select("doc_id", "size", "text_crc32", "old", "block", "shard")


def _large_parts(flow: list[int], own: int, large: int, small: int, most: int) -> list[int]:
    """What of a shard's flow its large rows take: of each part that moves so much less that small rows fill the border."""
    moving = [j for j, f in enumerate(flow) if f and j != own]
    spare, left, parts = min(most, small // max(1, len(moving))), large, [0] * len(flow)
    for j in moving:
        parts[j] = min(left, max(0, flow[j] - spare))
        left -= parts[j]
    if left:
        parts[own if own < len(flow) else max(moving, key=lambda j: flow[j])] += left
    return parts


def _small_parts(flow: list[int], own: int, got: list[int], small: int) -> list[int]:
    """What is left of a shard's flow for its small rows; where large rows went over a border, what stays or the largest part gives way."""
    parts = [max(0, f - g) for f, g in zip(flow, got)]
    over = sum(parts) - small
    for j in sorted(range(len(parts)), key=lambda j: (j != own, -parts[j])):
        part = min(parts[j], over)
        parts[j], over = parts[j] - part, over - part
    return parts


def reshard(docs: DataFrame, old: Column, shards: int, blocks: int = BLOCKS, capacities: list[int] | None = None) -> DataFrame:
    """Rows (doc_id, size, text_crc32, old, shard, slot) for each row of ``docs``; ``old`` is its shard so far, from 0.

    ``capacities``, one a new shard, say in which proportion they share all bytes. The driver gets the bytes of large and small rows
    of each old shard, and of the large rows between each two shards.
    """
    capacities = [1] * shards if capacities is None else capacities
    if len(capacities) != shards or min(capacities) < 0 or not sum(capacities):
        raise ValueError("one capacity a shard, not all of them zero")
    text = F.coalesce("text", F.lit(""))
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
            F.coalesce(old, F.lit(0)).cast("int").alias("old"),
            F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)).cast("int").alias("block"),
        )
    )
    found = rows.groupBy("old", F.length(F.bin("size")).alias("bits")).agg(F.sum("size").alias("bytes"), F.max("size").alias("most")).collect()
    if not found:
        return rows.selectExpr("doc_id", "size", "text_crc32", "old", "0 AS shard", "0L AS slot").limit(0)
    count, total = max(r["old"] for r in found) + 1, sum(r["bytes"] for r in found)
    # Rows under a power of two are small; the least one that gives them their share.
    bits = next(b for b in sorted({r["bits"] for r in found}) if sum(r["bytes"] for r in found if r["bits"] <= b) >= FILLING * total)
    small, large = ([sum(r["bytes"] for r in found if r["old"] == i and (r["bits"] <= bits) == s) for i in range(count)] for s in (True, False))
    cost = [[int(i != j) for j in range(shards)] for i in range(count)]
    flow = min_cost_flow([s + g for s, g in zip(small, large)], goals(total, capacities), cost)
    most = max(r["most"] for r in found)
    first = cut(_placed(rows.filter(F.col("size") >= 1 << bits), [_large_parts(f, i, large[i], small[i], most) for i, f in enumerate(flow)]))
    got = [[0] * shards for _ in range(count)]
    for r in first.groupBy("old", "shard").agg(F.sum("size").alias("bytes")).collect():
        got[r["old"]][r["shard"]] = r["bytes"]
    rest = _placed(rows.filter(F.col("size") < 1 << bits), [_small_parts(f, i, got[i], small[i]) for i, f in enumerate(flow)])
    placed = cut(first.unionByName(rest))
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    counts = placed.groupBy("shard", "old", "block").agg(F.count("*").alias("n"))
    offsets = counts.selectExpr("shard", "old", "block", f"coalesce(sum(n) OVER (PARTITION BY shard ORDER BY old, block {before}), 0) AS first")
    ranked = placed.selectExpr("*", f"row_number() OVER (PARTITION BY shard, old, block ORDER BY {ORDER}) - 1 AS row")
    return ranked.join(offsets, ["shard", "old", "block"]).select(
        "doc_id", "size", "text_crc32", "old", "shard", (F.col("first") + F.col("row")).cast("long").alias("slot")
    )


def rewrite(layout: DataFrame, docs: DataFrame, folder: str) -> None:
    """Write the rows of shards that give or receive below ``folder``, as ``shard=N``; folders of other shards stay.

    The folder of a shard that gave all its rows is removed, after the others are written. ``docs`` and ``layout`` are joined by
    doc_id, which must be unique.
    """
    moved = layout.filter("old <> shard")
    affected = moved.select(F.explode(F.array("old", "shard")).alias("shard")).distinct()
    touched = layout.join(affected, "shard", "left_semi").select("doc_id", "shard", "slot")
    emptied = moved.select(F.col("old").alias("shard")).distinct().join(layout, "shard", "left_anti").collect()
    out = docs.join(touched, "doc_id").repartition("shard").sortWithinPartitions("shard", "slot")
    out.write.partitionBy("shard").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(folder)
    spark = docs.sparkSession
    for (shard,) in emptied:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/shard={shard}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
