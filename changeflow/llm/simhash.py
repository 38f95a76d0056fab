"""Near duplicates by SimHash: exact Hamming search in tiles with exclusive-or and bit counts.

Equal fingerprints are folded first, so a group of copies is one entry. Entries fall into cells by the population counts
of their parts; the sum of the differences of those counts is a lower bound of the Hamming distance, so tile pairs whose cells
differ by more than the radius are skipped. Cells are dealt into tiles of a bounded number of entries. A tile pair gives
links between the components of its two tiles only, at most one less than the entries it holds, and these links join the
same entries as all close pairs would; no group of near copies is expanded into its pairs.

Null texts count as empty. Texts without words have fingerprint zero and are linked like others. Repeated rows and repeated
ids fall together. An empty table gives no rows. Other columns are passed on by ``one_of_each`` and not looked at.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import batches_of, cut
from changeflow.llm.components import components

SEED = 42
#: Words and digits, whatever their case and the marks around them.
LETTERS = re.compile(r"\w+")


def ascii_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def plain_words(text: str) -> list[bytes]:
    """Runs of letters and digits in lower case."""
    return [w.encode() for w in LETTERS.findall(text.lower())]


@dataclass(frozen=True)
class Settings:
    """What makes two texts near duplicates.

    ``words`` words a shingle, ``bits`` a multiple of 64, links at ``radius`` differing bits or fewer. ``parts`` population
    counts name a cell; ``ratio``, if given, also asks that the smaller number of words be at least so much of the larger.
    """

    split: Callable[[str], list[bytes]] = ascii_words
    words: int = 3
    bits: int = 64
    radius: int = 3
    parts: int = 4
    ratio: float | None = None
    tile: int = 2048

    @property
    def step(self) -> int:
        """Population counts are told apart in steps of this size: 1 while neighbours are few, else over the radius."""
        return 1 if self.radius <= 4 else self.radius + 1

    def offsets(self) -> list[list[int]]:
        """From a cell to those that may hold entries within the radius; of two opposite ones the later."""
        reach = range(-math.ceil(self.radius / self.step), math.ceil(self.radius / self.step) + 1)
        near = [o for o in itertools.product(reach, repeat=self.parts) if self.step > 1 or sum(map(abs, o)) <= self.radius]
        bands = (-1, 0, 1) if self.ratio else (0,)
        return [[*o, b] for o in near for b in bands if (*o, b) >= (0,) * (self.parts + 1)]


def fingerprint(words: list[bytes], settings: Settings) -> np.ndarray:
    """One 64-bit integer a word of the fingerprint.

    A bit is set if it is set in over half of the shingles' hashes, repeats included. Fewer words than a shingle make one
    shingle; no words give zero.
    """
    wide = settings.bits // 64
    if not words:
        return np.zeros(wide, np.int64)
    n = settings.words
    if len(words) <= n:
        grams: Iterator[bytes] = iter((b" ".join(words),))
    else:
        grams = map(b" ".join, zip(*(itertools.islice(words, k, None) for k in range(n))))
    ones, total = np.zeros((wide, 64), np.int64), 0
    while block := list(itertools.islice(grams, 1 << 16)):
        for k in range(wide):
            hashes = b"".join(map(xxhash.xxh64_digest, block, itertools.repeat(SEED + k)))
            bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
            ones[k] += bits.sum(axis=0, dtype=np.int64)
        total += len(block)
    return np.packbits(2 * ones > total, axis=1).view(">i8").astype(np.int64).ravel()


def with_fingerprint(docs: DataFrame, settings: Settings) -> DataFrame:
    """Rows (id, fp, band): the fingerprint as 64-bit integers and the band of the number of words."""
    kind = T.StructType([T.StructField("fp", T.ArrayType(T.LongType(), False)), T.StructField("band", T.IntegerType())])
    scale = math.log(1 / settings.ratio) if settings.ratio else None

    @F.pandas_udf(kind)
    def of(texts: pd.Series) -> pd.DataFrame:
        fps, bands = [], []
        for text in texts:
            words = settings.split(text)
            fps.append(fingerprint(words, settings))
            bands.append(int(math.log(len(words) + 1) / scale) if scale else 0)
        return pd.DataFrame({"fp": pd.Series(fps, dtype=object), "band": bands})

    return docs.select(F.col("doc_id").alias("id"), of(F.coalesce("text", F.lit(""))).alias("f")).select("id", "f.fp", "f.band")


def _stars(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` entries the least one that the links a-b join it to."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        new = label.copy()
        np.minimum.at(new, la, low)
        np.minimum.at(new, lb, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _close(x: np.ndarray, y: np.ndarray, radius: int, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of entries of x and y that differ in at most ``radius`` bits, a block of rows at a time."""
    x, y = x.view(np.uint64), y.view(np.uint64)  # of signed integers numpy counts the bits of the absolute value
    for at in range(0, len(x), rows):
        away = np.bitwise_count(x[at : at + rows, None, 0] ^ y[None, :, 0])
        for k in range(1, x.shape[1]):
            away = away + np.bitwise_count(x[at : at + rows, None, k] ^ y[None, :, k])
        i, j = np.nonzero(away <= radius)
        yield i + at, j


def _lists(column: pa.Array, wide: int = 1) -> list[np.ndarray]:
    """The rows of a list column as arrays of ``wide`` columns; elements may be lists of that many."""
    inner = column.flatten()
    flat = np.ascontiguousarray((inner.flatten() if pa.types.is_list(inner.type) else inner).to_numpy(zero_copy_only=False)).reshape(-1, wide)
    ends = column.offsets.to_numpy() - column.offsets[0].as_py()
    return [flat[i:j] for i, j in zip(ends[:-1], ends[1:])]


def _inside(settings: Settings) -> Callable:
    """For each tile the label of every entry: the least id of those it is linked with inside the tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = []
            for ids, fps in zip(_lists(batch.column("ids")), _lists(batch.column("fps"), settings.bits // 64)):
                order = np.argsort(ids[:, 0])
                links = [(i[i < j], j[i < j]) for i, j in _close(fps[order], fps[order], settings.radius)]
                star = _stars(*(np.concatenate(x) for x in zip(*links)), len(ids))
                label = np.empty(len(ids), np.int64)
                label[order] = ids[order, 0][star]
                labels.append(label)
            lists = pa.array(labels, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "labels"])

    return run


def _between(settings: Settings) -> Callable:
    """Links (a, b) between the labels of tiles and of a tile they are compared with, each once.

    The join sorts by that second tile, so what is compared with it comes in runs; a run is one comparison.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = settings.bits // 64
        for batch in batches:
            out: list[np.ndarray] = []
            rows = zip(*(_lists(batch.column(c), w) for c, w in (("fps", wide), ("labels", 1), ("fps_b", wide), ("labels_b", 1))))
            for _, same in itertools.groupby(zip(batch.column("key").to_pylist(), rows), key=lambda r: r[0]):
                xs, labels_x, ys, labels_y = zip(*(r[1] for r in same))
                x, y = np.concatenate(xs), ys[0]
                kx, at_x = np.unique(np.concatenate(labels_x)[:, 0], return_inverse=True)
                ky, at_y = np.unique(labels_y[0][:, 0], return_inverse=True)
                found = [np.unique(at_x[i] * len(ky) + at_y[j]) for i, j in _close(x, y, settings.radius) if len(i)]
                if found:
                    codes = np.unique(np.concatenate(found))
                    out.append(np.column_stack([kx[codes // len(ky)], ky[codes % len(ky)]]))
            both = np.concatenate(out) if out else np.empty((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return run


def links(entries: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between ids of ``entries`` (id, fp, band) that join the same ids as all pairs within the radius."""
    spark = entries.sparkSession
    width = settings.bits // settings.parts
    if width > 64:
        counts = [" + ".join(f"bit_count(fp[{w}])" for w in range(p * width // 64, (p + 1) * width // 64)) for p in range(settings.parts)]
    else:
        bits = [(p * width // 64, p * width % 64) for p in range(settings.parts)]
        mask = (1 << width) - 1 if width < 64 else -1
        counts = [f"bit_count(shiftrightunsigned(fp[{w}], {at}) & {mask}L)" for w, at in bits]
    cell = F.expr("array(" + ", ".join(f"CAST(floor(({c}) / {settings.step}) AS INT)" for c in counts) + ", band)")
    cells = entries.withColumn("cell", cell)
    # At most (width + 1) ** parts cells for each of the few dozen bands, whatever the input: small enough to send to all.
    full = cut(cells.groupBy("cell").agg(F.ceil(F.count("*") / settings.tile).cast("int").alias("tiles")))
    dealt = cells.join(F.broadcast(full), "cell").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    tiles = dealt.groupBy("cell", "tile").agg(F.collect_list(F.struct("id", "fp")).alias("e"))
    tiles = tiles.select("cell", "tile", F.col("e.id").alias("ids"), F.col("e.fp").alias("fps"))
    with batches_of(spark, 256):
        schema = T.StructType(tiles.schema.fields + [T.StructField("labels", T.ArrayType(T.LongType()))])
        tiles = cut(tiles.mapInArrow(_inside(settings), schema))
    inside = tiles.select(F.explode(F.arrays_zip("ids", "labels")).alias("e")).select(F.col("e.ids").alias("a"), F.col("e.labels").alias("b"))
    own = tiles.filter(F.size("ids") > 0).select("cell", "tile", "fps", "labels")
    offsets = F.array(*[F.array(*[F.lit(x) for x in o]) for o in settings.offsets()])
    near = own.withColumn("offset", F.explode(offsets)).withColumn("cell_b", F.expr("zip_with(cell, offset, (c, o) -> c + o)"))
    near = near.join(F.broadcast(full.withColumnRenamed("cell", "cell_b")), "cell_b")
    pairs = near.withColumn("tile_b", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pairs = pairs.filter("cell <> cell_b OR tile < tile_b").select("fps", "labels", "cell_b", "tile_b")
    other = own.select(*[F.col(c).alias(f"{c}_b") for c in own.columns])
    both = pairs.join(other, ["cell_b", "tile_b"])
    both = both.select("fps", "labels", "fps_b", "labels_b", F.xxhash64("cell_b", "tile_b").alias("key"))
    with batches_of(spark, 256):
        between = cut(both.mapInArrow(_between(settings), "a long, b long"))
    return inside.filter("a <> b").unionByName(between)


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows (doc_id, fp, component_id) for each row of ``docs``: its fingerprint and the least id it is linked with."""
    marked = cut(with_fingerprint(docs, settings))
    entries = marked.filter("id IS NOT NULL").groupBy("fp", "band").agg(F.min("id").alias("id"))
    stars = components(links(entries, settings))
    placed = entries.join(stars.withColumnRenamed("node", "id"), "id", "left").select("fp", "band", F.coalesce("least", "id").alias("component_id"))
    return marked.join(placed, ["fp", "band"], "left").select(F.col("id").alias("doc_id"), "fp", "component_id")


def one_of_each(docs: DataFrame, settings: Settings) -> DataFrame:
    """The row with the least id of each group of near duplicates; rows without an id stay."""
    kept = near_duplicates(docs, settings).filter("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    one = docs.join(kept, docs["doc_id"] == kept["_kept"], "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.filter("doc_id IS NULL"))
