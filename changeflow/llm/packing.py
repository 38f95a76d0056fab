"""Sequence packing: shortest pack first over the length histogram.

Documents are tokenised and end with one closing id. Full sequences are cut off first; what is left of a document is shorter
than a sequence. The histogram of those lengths, at most one count for each length below the capacity, is packed on the
driver: lengths longest first, always into the pattern of packs with the most room, counts at a time. Once as many packs
are open as the tokens need, a length that fits nowhere is cut at the room left, so all packs together have less room left than
one sequence. The patterns are joined back to documents by length and rank.

Null and empty texts are documents of the closing id alone. Repeated rows are packed row by row. An empty table gives no rows.
Other columns are not looked at.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import batches_of, cut

CAPACITY = 2048
END = 1
#: Pieces that a worker learns before it lets go of those it has not met since the last time.
REMEMBERED = 200_000
# The pieces that the tokenizer encodes one by one, once a text is in lower case. The first pattern is for ASCII texts.
SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
ASCII_PIECE = re.compile(SHORT + r"|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
# In the letters of SAFE below; six of them are numbers without being digits.
PIECE = re.compile(SHORT + r"|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w \t-\r\xa0]|_)+")
LETTERS = regex.compile(r"\p{L}+")
#: Latin and Cyrillic letters, numbers and marks, which all versions of Unicode class alike.
SAFE = re.compile("[\x00-\x7f\xa0-\u024f\u0400-\u045f\u2010-\u2027\u20ac]*")


class Pieces(dict):
    """Ids of pieces as little-endian 32-bit integers, found when a piece is first asked for."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.merges = tokenizer, tokenizer.model
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = self.ids_of(piece)
        self[piece] = ids
        return ids

    def ids_of(self, piece: str) -> bytes:
        """A run of letters goes straight to the merges, in the alphabet of its bytes; nothing else would change or cut it."""
        if not LETTERS.fullmatch(piece):
            return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        if not piece.isascii():
            ((piece, _),) = self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)
        return array("I", [t.id for t in self.merges.tokenize(piece)]).tobytes()

    def turn_over(self) -> None:
        """Keep what has been met since the last time for one more turn, so frequent pieces are not learnt again."""
        self.before = dict(self)
        self.clear()


class WordTokenizer:
    """Ids of a text as little-endian 32-bit integers, piece by piece, remembering pieces; equal to encoding the whole text.

    Texts with a special token's string or with other scripts, of which the tokenizer may know another version, are encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Pieces(self.tokenizer)

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if "<|" in text or not SAFE.fullmatch(text):
            return self.encode(text)
        if text.isascii():
            pieces = ASCII_PIECE.findall(text.lower())
        else:
            pieces = PIECE.findall(unicodedata.normalize("NFC", text).lower())
        ids = b"".join(map(self.known.__getitem__, pieces))
        if len(self.known) > REMEMBERED:
            self.known.turn_over()
        return ids


@functools.cache
def tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, whose tasks share what it remembers."""
    return WordTokenizer(path)


def tokenized(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Rows (doc_id, n, full, tail): number of ids, checksums of the full sequences cut off, and the ids that are left.

    ``tail`` holds little-endian 32-bit ids, fewer than ``capacity`` of them.
    """
    schema = "doc_id long, n long, full array<long>, tail binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokenizer(path), END.to_bytes(4, "little")
        for batch in batches:
            n, full, tail = [], [], []
            for text in batch.column("text"):
                ids = encode(text.as_py() or "") + end
                whole = len(ids) // (4 * capacity) * 4 * capacity
                n.append(len(ids) // 4)
                full.append([zlib.crc32(ids[at : at + 4 * capacity]) for at in range(0, whole, 4 * capacity)])
                tail.append(ids[whole:])
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(full, pa.list_(pa.int64())), pa.array(tail, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "full", "tail"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


@dataclass(frozen=True)
class Placement:
    """Tails of ``length`` ids with rank in [low, high): ``size`` ids from ``start`` go to sequence ``first + rank - low``."""

    length: int
    low: int
    high: int
    start: int
    size: int
    first: int
    offset: int


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[int, list[Placement]]:
    """Number of packs and placements for a histogram of lengths below ``capacity``.

    Packs that are equally full are one entry with a count, so the work follows the number of lengths, not of documents.
    """
    limit = -(-sum(length * n for length, n in histogram.items()) // capacity)
    # Runs of tails still to be placed: (-size, length, low, high, start); packs: (used, first sequence, count).
    runs = [(-length, length, 0, n, 0) for length, n in histogram.items() if length and n]
    heapq.heapify(runs)
    packs: list[tuple[int, int, int]] = []
    opened, out = 0, []
    while runs:
        size, length, low, high, start = heapq.heappop(runs)
        size, n = -size, high - low
        if packs and packs[0][0] + size <= capacity:
            used, first, count = heapq.heappop(packs)
            piece = size
        elif opened < limit:
            used, first, count = 0, opened, min(n, limit - opened)
            opened += count
            piece = size
        else:
            used, first, count = heapq.heappop(packs)
            piece = capacity - used
        took = min(n, count)
        out.append(Placement(length, low, low + took, start, piece, first, used))
        if piece < size:
            heapq.heappush(runs, (piece - size, length, low, low + took, start + piece))
        if took < n:
            heapq.heappush(runs, (-size, length, low + took, high, start))
        if used + piece < capacity:
            heapq.heappush(packs, (used + piece, first, took))
        if took < count:
            heapq.heappush(packs, (used, first + took, count - took))
    return opened, out


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Ranks within a length are numbered in two steps, inside slices of a length and across the slices' counts, so a length that
    most documents share is spread over as many tasks as there are shuffle partitions.
    """
    slices = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = tokenized(docs, path, capacity).withColumn("left", (F.col("n") % capacity).cast("int"))
    with batches_of(docs.sparkSession, 500):
        own = cut(own.withColumn("slice", F.pmod(F.xxhash64("doc_id", "tail"), F.lit(slices)).cast("int")))
    sums = cut(own.groupBy("left", "slice").agg(F.count("*").alias("rows"), F.sum(F.size("full")).alias("cut")))
    histogram = {r["left"]: r["rows"] for r in sums.groupBy("left").agg(F.sum("rows").alias("rows")).collect()}
    opened, placements = shortest_pack_first(histogram, capacity)

    # At most slices * capacity rows. Full sequences come after the packs, numbered by length, slice and rank.
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    offsets = sums.selectExpr(
        "left", "slice",
        f"coalesce(sum(rows) OVER (PARTITION BY left ORDER BY slice {before}), 0) AS rows_before",
        f"coalesce(sum(cut) OVER (PARTITION BY left ORDER BY slice {before}), 0) AS cut_before",
    )
    totals = {r["left"]: r["cut"] for r in sums.groupBy("left").agg(F.sum("cut").alias("cut")).collect()}
    base, at = {}, opened
    for left in sorted(totals):
        base[left] = at
        at += totals[left]
    ranked = own.selectExpr(
        "*",
        "row_number() OVER (PARTITION BY left, slice ORDER BY doc_id, tail) - 1 AS row",
        f"coalesce(sum(size(full)) OVER (PARTITION BY left, slice ORDER BY doc_id, tail {before}), 0) AS cut_row",
    )
    ranked = ranked.join(offsets, ["left", "slice"]).selectExpr(
        "doc_id", "n", "full", "tail", "left", "CAST(row + rows_before AS BIGINT) AS rank", "CAST(cut_row + cut_before AS BIGINT) AS first"
    )
    by_length: dict[int, dict[int, list[Placement]]] = {}
    for p in placements:
        by_length.setdefault(p.length, {}).setdefault(p.start, []).append(p)
    for starts in by_length.values():
        for places in starts.values():
            places.sort(key=lambda p: p.low)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def place(length: int, rank: int) -> Iterator[Placement]:
        for start, places in sorted(by_length.get(length, {}).items()):
            p = places[bisect.bisect_right(places, rank, key=lambda x: x.low) - 1]
            if p.low <= rank < p.high:
                yield p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            rows: list[tuple] = []
            for r in batch.to_pylist():
                first = base[r["left"]] + r["first"]
                for k, crc in enumerate(r["full"]):
                    rows.append((r["doc_id"], k * capacity, capacity, crc, r["n"], first + k, 0))
                done = len(r["full"]) * capacity
                for p in place(r["left"], r["rank"]):
                    crc = zlib.crc32(r["tail"][4 * p.start : 4 * (p.start + p.size)])
                    rows.append((r["doc_id"], done + p.start, p.size, crc, r["n"], p.first + r["rank"] - p.low, p.offset))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    return ranked.mapInArrow(run, schema)
