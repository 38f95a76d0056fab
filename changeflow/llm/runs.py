"""Periodic runs of words: longest common extensions from a difference cover drive an enumeration on harmonic grids.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, of at least ``max(12, 2 * q)``
words. For each period p the words at multiples of p are compared with the words p further on: a run of two periods or more
covers two neighbouring points of that grid, so each run is met, and all grids together have n log n points. Where both words are
equal, the longest common extensions to both sides give the whole run.

An extension is found from the suffixes that start at positions of a difference cover modulo ``MODULUS``. Any two positions reach
such a pair after fewer than ``MODULUS`` words, which are compared one by one; most extensions end there. The rest is the least
common prefix between two sampled suffixes in sorted order, read from a sparse table of minima. Only sampled suffixes are
sorted: by their first ``MODULUS`` words, then by doubling, which stays within the sample. Extensions to the left are those
of the reversed words.

Texts are taken together, up to a bound on their words, a longer text alone; each ends with a number of its own, so no extension
leaves a text. The memory of a task is in proportion to that bound or to its longest text.

Null and empty texts have no words and no runs. Repeated rows are judged row by row, an empty table gives no rows, and other columns
are not looked at.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import batches_of

#: Words a run has at least; words of texts that are taken together; grid points compared at a time.
LEAST, TOGETHER, POINTS = 12, 400_000, 2_000_000
# A difference cover, of whose members two differ by any number modulo 31.
MODULUS = 31
COVER = (0, 1, 3, 8, 12, 18)


def _shifts() -> np.ndarray:
    """For two residues the least shift that takes both into the cover."""
    member = np.zeros(MODULUS, bool)
    member[list(COVER)] = True
    least = np.full((MODULUS, MODULUS), -1, np.int64)
    for shift in reversed(range(MODULUS)):
        inside = np.roll(member, -shift)
        least[np.ix_(inside, inside)] = shift
    return least


SHIFTS = _shifts()


class Extensions:
    """Longest common prefixes of suffixes of ``words``, whose last one differs from all others."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.n = words, len(words)
        # What lies beyond the end differs from all words; the padding is never reached by two suffixes alike.
        self.padded = np.concatenate([words, np.full(2 * MODULUS, -1, words.dtype)])
        self.table: list[np.ndarray] | None = None

    def _sort_sample(self) -> None:
        sampled = np.zeros(self.n, bool)
        for residue in COVER:
            sampled[residue::MODULUS] = True
        at = np.flatnonzero(sampled)
        self.index = np.cumsum(sampled) - 1
        windows = np.lib.stride_tricks.sliding_window_view(self.padded, MODULUS)
        # Big-endian words, so that the order of bytes is the order of words.
        keys = np.ascontiguousarray(windows[at] + 1).astype(">u4").view(f"S{4 * MODULUS}").ravel()
        ranks = [np.unique(keys, return_inverse=True)[1]]
        del keys
        reach = MODULUS
        # A position's residue stays when it moves on by a multiple of the modulus, so the next one is sampled too.
        while ranks[-1].max(initial=0) + 1 < len(at):
            after = np.zeros(len(at), np.int64)
            inside = at + reach < self.n
            after[inside] = ranks[-1][self.index[at[inside] + reach]] + 1
            ranks.append(np.unique(ranks[-1].astype(np.int64) * (len(at) + 1) + after, return_inverse=True)[1])
            reach *= 2
        order = np.argsort(ranks[-1])
        self.rank = np.empty(len(at), np.int64)
        self.rank[order] = np.arange(len(at))
        # Common prefixes of neighbours: equal ranks of a level are as many equal words as the level compares.
        a, b, common = at[order[:-1]], at[order[1:]], np.zeros(max(len(at) - 1, 0), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            x, y = a + common, b + common
            inside = (x < self.n) & (y < self.n)
            same = np.zeros(len(a), bool)
            same[inside] = ranks[level][self.index[x[inside]]] == ranks[level][self.index[y[inside]]]
            common[same] += MODULUS << level
        common += self._few(a + common, b + common, np.full(len(a), MODULUS))
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _few(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, ``most`` at most."""
        common, alive = np.zeros(len(i), np.int64), np.arange(len(i))
        for step in range(MODULUS + 1):
            alive = alive[(most[alive] > step) & (i[alive] + step < self.n) & (j[alive] + step < self.n)]
            alive = alive[self.padded[i[alive] + step] == self.padded[j[alive] + step]]
            if not len(alive):
                break
            common[alive] = step + 1
        return common

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The number of equal words from i and from j on, i and j being different."""
        shift = SHIFTS[i % MODULUS, j % MODULUS]
        common = self._few(i, j, shift)
        far = np.flatnonzero((common == shift) & (i + shift < self.n) & (j + shift < self.n))
        if len(far):
            if self.table is None:
                self._sort_sample()
            x, y = (self.rank[self.index[p[far] + shift[far]]] for p in (i, j))
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((high - low).astype(float))[1] - 1
            best = np.empty(len(far), np.int64)
            for k in np.unique(level):
                own = level == k
                best[own] = np.minimum(self.table[k][low[own]], self.table[k][high[own] - (1 << int(k))])
            common[far] += best
        return common


def _grid(starts: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Points i and periods p of all grids with equal words at i and i + p inside a text, some at a time."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for p in range(1, int(lengths[0]) // 2 + 1 if len(lengths) else 1):
        # Texts of fewer than two periods hold no run of this period.
        texts = int(np.searchsorted(-lengths, -2 * p, side="right"))
        points = (lengths[:texts] - 1) // p
        first = np.repeat(starts[:texts] - p * (np.cumsum(points) - points), points)
        i = first + p * np.arange(points.sum())
        i = i[words[i] == words[i + p]]
        if len(i):
            found.append((i, np.full(len(i), p)))
            held += len(i)
        if held > POINTS:
            yield tuple(map(np.concatenate, zip(*found)))
            found, held = [], 0
    if found:
        yield tuple(map(np.concatenate, zip(*found)))


def runs(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start in the text, length and period of all runs, by text, start and period.

    ``words`` holds the texts one after the other, each followed by a number that occurs nowhere else; ``lengths`` are without it.
    """
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    right, left, n = Extensions(words), Extensions(np.ascontiguousarray(words[::-1])), len(words)
    out = [np.empty((0, 3), np.int64)]
    for i, p in _grid(starts, lengths, words):
        ahead = right(i, i + p)
        # Before i and i + p: the reversed words from there on; nothing lies before the first word.
        back = np.zeros(len(i), np.int64)
        inner = i > 0
        back[inner] = left(n - i[inner], n - i[inner] - p[inner])
        fits = (back + ahead >= p) & (back + ahead + p >= LEAST)
        start, end = (i - back)[fits], (i + p + ahead)[fits]
        some = np.column_stack([start, end, p[fits]])
        out.append(np.unique(some, axis=0))
    every = np.concatenate(out)
    # A stretch is met once for each of its grid points and for multiples of its period: its least period names it.
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    new = np.ones(len(every), bool)
    new[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    start, end, period = every[new].T
    text = np.searchsorted(starts, start, side="right") - 1
    order = np.lexsort((period, start))
    return tuple(x[order] for x in (text, start - starts[text], end - start, period))


def covered(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """True for the words of a text that lie in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:n]) > 0


def together(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, each text followed by a number of its own, and the lengths of the texts."""
    known: dict[bytes, int] = defaultdict(count().__next__)
    numbers = [np.fromiter(map(known.__getitem__, t), np.int64, len(t)) for t in texts]
    ends = len(known) + np.arange(len(texts))
    parts = [x for pair in zip(numbers, np.split(ends, len(texts))) for x in pair] if texts else [np.empty(0, np.int64)]
    return np.concatenate(parts), np.array([len(t) for t in texts], np.int64)


Found = tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]


def of_texts(texts: list[list[bytes]]) -> Iterator[Found]:
    """For each text its words and the start, length and period of its runs."""
    words, lengths = together(texts)
    text, start, length, period = runs(words, lengths)
    ends = np.searchsorted(text, np.arange(len(texts) + 1))
    for k, own in enumerate(texts):
        part = slice(ends[k], ends[k + 1])
        yield own, start[part], length[part], period[part]


def grouped(texts: Iterator[list[bytes]]) -> Iterator[list[list[bytes]]]:
    """Texts in groups of a bounded number of words."""
    group: list[list[bytes]] = []
    held = 0
    for text in texts:
        if group and held + len(text) > TOGETHER:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def words_of(doc_id: int | None, text: str | None) -> list[bytes]:
    """Words between ASCII white space."""
    return (text or "").encode().split()


def periodic_runs(docs: DataFrame, words: Callable[[int | None, str | None], list[bytes]] = words_of) -> DataFrame:
    """One row a document: doc_id, n_words, runs and collapsed.

    ``runs`` holds (start, length, period) by start and period, ``collapsed`` the words that no run contains after its first
    period. ``words`` gives the words of an id and a text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, done = batch.column("doc_id").to_pylist(), 0
            for group in grouped(words(i, t.as_py()) for i, t in zip(ids, batch.column("text"))):
                found = list(of_texts(group))
                parts = [np.concatenate([f[k] for f in found]) for k in (1, 2, 3)]
                ends = np.cumsum([0, *(len(f[1]) for f in found)])
                spans = pa.StructArray.from_arrays([pa.array(p, pa.int64()) for p in parts], ["start", "length", "period"])
                kept = [b" ".join(itertools.compress(w, ~covered(len(w), *r))) if len(r[0]) else b" ".join(w) for w, *r in found]
                columns = [
                    pa.array(ids[done : done + len(group)], pa.int64()),
                    pa.array([len(w) for w in group], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans),
                    pa.array([k.decode() for k in kept], pa.string()),
                ]
                done += len(group)
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    with batches_of(docs.sparkSession, 500):
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
