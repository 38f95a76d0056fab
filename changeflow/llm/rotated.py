"""Largest inner products by randomly rotated one-bit codes, exact after reranking.

A vector is centred, scaled to length one and turned by a random rotation into ``bits`` dimensions; its code keeps one sign a
dimension. With the code's own inner product ``a`` with what it stands for, ``<signs, turned query> / a`` estimates the inner
product without bias, and its error stays within ``SLACK`` deviations of ``length * sqrt(1 - a * a) / (a * sqrt(bits - 1))``
for each unit of the query's length. So a code comes with two scalars, and every estimate has a bound above.

Queries and codes meet in blocks, twice. First the largest estimates of a query are reranked: the exact score of the last one it
needs is a score that no result may fall short of. Then all entries are reranked whose upper bound reaches it. Reranking computes
the inner product of the original vectors in double precision. What is lost lies beyond ``SLACK`` deviations; tests measure
the recall.

Equal vectors are one entry with its least ids, as many as a result can hold, so thousands of copies of a vector cost one estimate.
Work grows with queries times entries at the price of a code, which is what a stated query set against all rows asks for.

Vectors that are null, empty, zero or hold null or non-finite components and rows without an id take no part. Of several
rows of one id the least vector counts. Vectors meet only those of as many dimensions. Ties go to the smaller id. An empty
table, or a single vector, gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import batches_of, cut

#: Deviations that a bound leaves above an estimate; entries and queries of a block; queries estimated at a time.
SLACK, ENTRIES, QUERIES, TOGETHER = 3.5, 8192, 4096, 256
#: Least number of bits of a code; vectors of more dimensions have a bit for each.
LEAST_BITS = 512
SEED = 42
KEY = ["k1", "k2"]


def bits_for(dims: int) -> int:
    """Bits of a code, a multiple of 8."""
    return max(LEAST_BITS, -(-dims // 8) * 8)


@functools.cache
def rotation(dims: int) -> np.ndarray:
    """Orthonormal columns in random directions, the same in every task."""
    turned, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((bits_for(dims), dims)))
    return turned


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, and for each vector the factor of an estimate and the bound of its error for queries of length one."""
    off = vectors - centre
    length = np.linalg.norm(off, axis=1)
    turned = (off / np.where(length > 0, length, 1)[:, None]) @ rotation(vectors.shape[1]).T
    bits = turned.shape[1]
    own = np.abs(turned).sum(axis=1) / np.sqrt(bits)
    own = np.where(own > 0, own, 1)
    error = length * np.sqrt(np.maximum(0, 1 - own * own)) / own / np.sqrt(bits - 1)
    return np.packbits(turned > 0, axis=1), length / own / np.sqrt(bits), error


def estimates(codes: np.ndarray, factor: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """Inner products of turned queries with the vectors behind the codes, one row a query."""
    signs = np.unpackbits(codes, axis=1).astype(np.float32)
    signs *= 2
    signs -= 1
    return (turned.astype(np.float32) @ signs.T) * factor.astype(np.float32)


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _packed(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _coded(centres: dict[int, np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("e").value_lengths().to_numpy()
            for dims in np.unique(sizes):
                own = batch.filter(pa.array(sizes == dims))
                codes, factor, error = encode(_matrix(own.column("e")), centres[int(dims)])
                packed = pa.array([c.tobytes() for c in codes], pa.binary())
                columns = [own.column("eid"), pa.array(np.full(len(codes), dims, np.int32)), packed, pa.array(factor), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, ["eid", "dims", "code", "factor", "error"])

    return run


def _met(centres: dict[int, np.ndarray], best: int | None) -> Callable:
    """Rows (k1, k2, eid, guess) of what a block of queries takes from a block of codes.

    With ``best`` these are so many of the largest estimates of each query, else all whose upper bound reaches ``enough``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, asked, held in zip(batch.column("dims").to_pylist(), batch.column("asked"), batch.column("held")):
                asked, held = asked.values, held.values
                queries = _matrix(asked.field("e"))
                k1, k2, enough = (asked.field(k).to_numpy(zero_copy_only=False) for k in (*KEY, "enough"))
                eid, factor, error = (held.field(k).to_numpy() for k in ("eid", "factor", "error"))
                codes = _packed(held.field("code"))
                length, turned, middle = np.linalg.norm(queries, axis=1), queries @ rotation(dims).T, queries @ centres[dims]
                for at in range(0, len(queries), TOGETHER):
                    part = slice(at, at + TOGETHER)
                    guess = estimates(codes, factor, turned[part]) + middle[part, None].astype(np.float32)
                    if best is None:
                        # The error of the code, and the rounding of single precision.
                        reach = SLACK * error[None] * length[part, None] + 1e-5 * (np.abs(guess) + 1e-3)
                        i, j = np.nonzero(guess + reach >= enough[part, None])
                    else:
                        j = np.argpartition(-guess, min(best, len(eid)) - 1, axis=1)[:, :best].ravel()
                        i = np.repeat(np.arange(len(guess)), min(best, len(eid)))
                    columns = [k1[at + i], k2[at + i], eid[j], guess[i, j].astype(float)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*KEY, "eid", "guess"])

    return run


def usable(vectors: DataFrame, of: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Rows (id, e, k1, k2): one row an id, its vector in double precision and a key of 128 bits."""
    e = F.col(of).cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.filter(F.col(key).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(key).cast("long").alias("id"), e.alias("e"))
    rows = rows.groupBy("id").agg(F.min("e").alias("e"))
    return rows.withColumns({"k1": F.xxhash64("e"), "k2": F.xxhash64(F.lit(1), "e")})


def folded(rows: DataFrame, ids: int) -> DataFrame:
    """Rows (eid, e, ids): each different vector with its least ids, the first of which names it."""
    least = Window.partitionBy(*KEY).orderBy("id")
    rows = rows.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= ids)
    rows = rows.groupBy(*KEY).agg(F.first("e").alias("e"), F.array_sort(F.collect_list("id")).alias("ids"))
    return rows.select(F.col("ids")[0].alias("eid"), "e", "ids")


def _centres(entries: DataFrame) -> tuple[int, dict[int, np.ndarray]]:
    """Number of entries, and the mean vector for each number of dimensions: what reaches the driver is one vector each."""
    parts = entries.select(F.size("e").alias("dims"), F.posexplode("e").alias("at", "x")).groupBy("dims", "at")
    means: dict[int, dict[int, float]] = {}
    n: dict[int, int] = {}
    for r in parts.agg(F.avg("x").alias("x"), F.count("*").alias("n")).collect():
        means.setdefault(r["dims"], {})[r["at"]] = r["x"]
        n[r["dims"]] = r["n"]
    return sum(n.values()), {d: np.array([m[i] for i in range(d)]) for d, m in means.items()}


def _tiles(held: DataFrame, queries: DataFrame, blocks: int, groups: int) -> DataFrame:
    """Rows (dims, held, asked): each block of codes with each group of queries of as many dimensions."""
    asked = queries.groupBy(F.size("e").alias("dims"), F.pmod("k1", F.lit(groups)).cast("int").alias("group")).agg(
        F.collect_list(F.struct(*KEY, "e", "enough")).alias("asked")
    )
    held = held.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return held.join(asked, ["dims", "block", "group"]).select("dims", "held", "asked")


def inner_product(a: Column, b: Column) -> Column:
    """In double precision, summed from the first component on."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def reranked(pairs: DataFrame, entries: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Rows (k1, k2, n, vec_id, score): for each query the first ``k`` of the ids behind its pairs by exact score."""
    both = pairs.select(*KEY, "eid").join(entries.select("eid", F.col("e").alias("f"), "ids"), "eid").join(queries.select(*KEY, "e"), KEY)
    scored = both.select(*KEY, inner_product(F.col("e"), F.col("f")).alias("score"), "ids")
    first = Window.partitionBy(*KEY).orderBy(F.desc("score"), "vec_id")
    each = scored.select(*KEY, F.explode("ids").alias("vec_id"), "score")
    return each.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k)


def search(entries: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``reranked`` for the queries (k1, k2, e) over all ``entries`` (eid, e, ids)."""
    spark = entries.sparkSession
    total, centres = _centres(entries)
    codes = entries.select("eid", "e").mapInArrow(_coded(centres), "eid long, dims int, code binary, factor double, error double")
    blocks, groups = -(-total // ENTRIES) or 1, -(-queries.count() // QUERIES) or 1
    block = F.pmod(F.xxhash64("eid"), F.lit(blocks)).cast("int").alias("block")
    held = cut(codes.groupBy("dims", block).agg(F.collect_list(F.struct("eid", "code", "factor", "error")).alias("held")))
    schema = "k1 long, k2 long, eid long, guess double"
    with batches_of(spark, 4):
        tiles = _tiles(held, queries.withColumn("enough", F.lit(None).cast("double")), blocks, groups)
        guessed = cut(tiles.mapInArrow(_met(centres, k), schema))
        # The score that the k-th of the best by estimate has is one that no result may fall short of.
        best = Window.partitionBy(*KEY).orderBy(F.desc("guess"))
        likely = guessed.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= 2 * k)
        enough = reranked(likely, entries, queries, k).filter(F.col("n") == k).select(*KEY, F.col("score").alias("enough"))
        bound = cut(queries.join(enough, KEY, "left").withColumn("enough", F.coalesce("enough", F.lit(float("-inf")))))
        reach = cut(_tiles(held, bound, blocks, groups).mapInArrow(_met(centres, None), schema))
    return reranked(reach, entries, queries, k)


def nearest(vectors: DataFrame, asks: Column, k: int = 20, of: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` largest inner products of each row that ``asks`` with the other rows.

    ``asks`` is a condition on the column ``id``.
    """
    rows = cut(usable(vectors, of, key))
    entries = cut(folded(rows, k + 1))
    asking = rows.filter(asks)
    queries = cut(asking.groupBy(*KEY).agg(F.first("e").alias("e")))
    # One more than asked for, since the nearest may be the query itself.
    each = search(entries, queries, k + 1)
    lists = each.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("found"))
    answer = asking.select(F.col("id").alias("query_id"), *KEY).join(lists, KEY)
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    answer = answer.select("query_id", F.posexplode(others).alias("at", "hit"))
    return answer.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
