"""Toxicity by nearest labelled examples.

Terms that tell the labels apart are selected from a bounded sample of labelled texts. Texts are TF-IDF vectors over these terms,
with document frequencies of the whole corpus. For each text the nearest examples by exact cosine are found in a block-max
inverted index: blocks are visited in the order of their upper bounds until no further block can hold a nearer example. Votes are
weighted by distance and smoothed with the rate of the sample; the nearest examples are the evidence.

Null and empty texts, and texts without any of the terms, get the smoothed rate of such examples. Repeated rows are scored row
by row, repeated labels of a document count once (the highest), labels that are null are not used. Without labels every score
is the smoothing's. Language, source and id are never inputs of a score. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut

#: Examples at most, selected terms at most, least distance from chance of a term in standard deviations.
EXAMPLES, TERMS, LEAST_Z = 4000, 2048, 5.0
NEIGHBOURS, BLOCK, SOFT, SMOOTH = 12, 64, 0.1, 1.0
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Index:
    """Postings of unit vectors by term, cut into blocks of examples, with the highest weight of each term in each block."""

    ids: np.ndarray
    labels: np.ndarray
    postings: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    highest: np.ndarray
    idf: np.ndarray

    @staticmethod
    def build(examples: list[tuple[int, int, dict[int, int]]], idf: np.ndarray) -> Index:
        """``examples``: (id, label, term counts). They are ordered by heaviest term, so that blocks hold like examples."""
        rows = []
        for i, y, counts in examples:
            if counts:
                vector = unit(counts, idf)
                rows.append((max(vector, key=lambda t: (vector[t], t)), i, y, vector))
        rows.sort(key=lambda r: r[:2])
        lists: dict[int, list[tuple[int, float]]] = {}
        for at, (_, _, _, vector) in enumerate(rows):
            for term, weight in vector.items():
                lists.setdefault(term, []).append((at, weight))
        blocks = -(-len(rows) // BLOCK)
        highest, postings = np.zeros((blocks, len(idf))), {}
        for term, entries in lists.items():
            at, weights = np.array([e[0] for e in entries]), np.array([e[1] for e in entries])
            np.maximum.at(highest[:, term], at // BLOCK, weights)
            postings[term] = (at, weights, np.searchsorted(at, np.arange(blocks + 1) * BLOCK))
        return Index(np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows]), postings, highest, idf)

    def nearest(self, counts: dict[int, int], k: int) -> list[tuple[float, int]]:
        """(similarity, row) of the k nearest examples; of equal ones the first rows."""
        query = unit(counts, self.idf)
        bounds = self.highest[:, list(query)] @ np.array(list(query.values()))
        best: list[tuple[float, int]] = []
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or len(best) == k and bounds[block] < best[0][0] - 1e-12:
                break
            sums = np.zeros(BLOCK)
            for term, weight in query.items():
                if term in self.postings:
                    at, weights, ends = self.postings[term]
                    part = slice(ends[block], ends[block + 1])
                    sums[at[part] - block * BLOCK] += weight * weights[part]
            for row in np.nonzero(sums)[0]:
                entry = (round(float(sums[row]), 9), -int(row + block * BLOCK))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(s, -r) for s, r in sorted(best, reverse=True)]


def unit(counts: dict[int, int], idf: np.ndarray) -> dict[int, float]:
    weights = {t: (1 + math.log(n)) * float(idf[t]) for t, n in sorted(counts.items())}
    length = math.sqrt(sum(w * w for w in weights.values())) or 1.0
    return {t: w / length for t, w in weights.items()}


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """Rows (doc_id, y, text) of about ``most`` labelled documents that are not held out, chosen by a hash of the id."""
    own = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    own = own.filter(~_held_out())
    n = own.count()
    if n > most:
        own = own.filter(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < most)
    # About ``most`` ids, whatever the input.
    one = docs.join(F.broadcast(own), "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.max("text").alias("text"))
    return cut(one)


def select_terms(examples: DataFrame, most: int = TERMS) -> list[str]:
    """Terms whose share of texts differs between the labels by many standard deviations, the strongest first."""
    words = F.array_distinct(F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^\\p{L}\\p{N}_]+"), ""))
    n1, n0 = (examples.filter(F.col("y") == y).count() for y in (1, 0))
    if not n1 or not n0:
        return []
    seen = examples.select("y", F.explode(words).alias("term")).groupBy("term").agg(F.sum("y").alias("a"), F.count("*").alias("n"))
    p = F.col("n") / (n1 + n0)
    z = (F.col("a") / n1 - (F.col("n") - F.col("a")) / n0) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
    top = seen.filter("n >= 4").withColumn("z", F.abs(z)).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "term").limit(most)
    return [r["term"] for r in top.collect()]


def vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Rows (doc_id, terms, counts): numbers of the selected terms in each whole text."""
    number = {t: k for k, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter(filter(number.__contains__, WORD.findall((t.as_py() or "").lower()))) for t in batch.column("text")]
            rows = [sorted((number[w], n) for w, n in c.items()) for c in found]
            lists = [pa.array([[r[k] for r in row] for row in rows], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, terms array<long>, counts array<long>")


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted, evidence); evidence lists the ids of the nearest examples.

    The driver gets the selected terms with their frequencies and the examples' vectors, all bounded by parameters.
    """
    examples = sample(docs, labels)
    terms = select_terms(examples)
    own = cut(vectors(docs, terms))
    total = own.count()
    seen = {r["term"]: r["n"] for r in own.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
    idf = np.array([math.log(1 + total / seen.get(k, 1)) for k in range(len(terms))])
    learned = vectors(examples, terms).join(examples.select("doc_id", "y"), "doc_id").collect()
    rows = sorted((r["doc_id"], r["y"], dict(zip(r["terms"], r["counts"]))) for r in learned)
    rate = (sum(r[1] for r in rows) + SMOOTH / 2) / (len(rows) + SMOOTH)
    none = [r[1] for r in rows if not r[2]]
    plain = (sum(none) + SMOOTH * rate) / (len(none) + SMOOTH)
    index = Index.build(rows, idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, why = [], []
            for row in batch.to_pylist():
                near = index.nearest(dict(zip(row["terms"], row["counts"])), NEIGHBOURS) if row["terms"] else []
                weights = [1 / (1 - s + SOFT) for s, _ in near]
                vote = sum(w * float(index.labels[r]) for w, (_, r) in zip(weights, near))
                points.append((vote + SMOOTH * plain) / (sum(weights) + SMOOTH))
                why.append(",".join(str(index.ids[r]) for _, r in near))
            columns = [batch.column("doc_id"), pa.array(points, pa.float64()), pa.array(why, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "evidence"])

    scored = own.mapInArrow(run, "doc_id long, score double, evidence string").withColumn("score", F.round("score", 6))
    return scored.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
