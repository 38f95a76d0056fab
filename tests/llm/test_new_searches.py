"""One-bit codes, periodic runs and collocations against brute force, and on nulls, empty tables, ties and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import reduce
from operator import add

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import phrases, queries, rotated, runs
from changeflow.llm.common import table


# --- nearest by inner product ---------------------------------------------------------------------------------------


def brute_nearest(rows, asks, k):
    ids = np.array([r[0] for r in rows])
    every = np.array([r[1] for r in rows], float)
    out = {}
    for at in np.flatnonzero([asks(i) for i in ids]):
        scores = [reduce(add, (x * y for x, y in zip(every[at].tolist(), v)), 0.0) for v in every.tolist()]
        order = sorted((-s, int(i)) for s, i in zip(scores, ids) if i != ids[at])
        out[int(ids[at])] = [(i, -s) for s, i in order[:k]]
    return out


def found_lists(frame):
    out = defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return dict(out)


def test_nearest_equals_brute_force_on_the_table(spark, small):
    rows = [(r[0], r[1]) for r in table(spark, small, "embeddings").select("vec_id", "embedding").collect()]
    got = found_lists(queries.op11(spark, small))
    want = brute_nearest(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.99 * sum(map(len, want.values()))
    scores = {(q, i): s for q, found in want.items() for i, s in found}
    assert all(scores.get((q, i), s) == s for q, found in got.items() for i, s in found)


def test_nearest_over_many_blocks_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(rotated, "ENTRIES", 64)
    monkeypatch.setattr(rotated, "QUERIES", 8)
    draw = np.random.default_rng(3)
    # Groups around few centres, of lengths that differ a hundredfold.
    centres = draw.standard_normal((5, 24))
    every = (centres[draw.integers(0, 5, 600)] + 0.3 * draw.standard_normal((600, 24))) * draw.choice([0.1, 1, 10], 600)[:, None]
    rows = [(i, v) for i, v in enumerate(every.tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = found_lists(rotated.nearest(frame, F.col("id") % 9 == 0, 5)), brute_nearest(rows, lambda i: i % 9 == 0, 5)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.99 * sum(map(len, want.values()))


def test_bounds_hold():
    draw = np.random.default_rng(4)
    every, centre = draw.standard_normal((3000, 32)), np.full(32, 0.1)
    asked = draw.standard_normal((50, 32))
    codes, factor, error = rotated.encode(every, centre)
    guess = rotated.estimates(codes, factor, asked @ rotated.rotation(32).T) + (asked @ centre)[:, None]
    off = np.abs(guess - asked @ every.T) / (error * np.linalg.norm(asked, axis=1)[:, None])
    assert codes.shape == (3000, rotated.bits_for(32) // 8)
    assert (off > rotated.SLACK).mean() < 0.001 and 0.9 < off.std() / 0.6 < 1.1


def test_nearest_of_odd_rows(spark):
    same = [1.0, 2.0, 0.0]
    rows = [(20 * k if k < 3 else k, same) for k in range(60)]  # copies: ties go to the smaller id
    rows += [(100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [1.0, None, 2.0]), (180, [float("nan"), 1.0, 1.0])]
    rows += [(200, [float("inf"), 1.0, 1.0]), (None, same), (20, same), (220, [1.0, 1.0]), (7, same)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS e", "3 AS score", "4 AS rank")
    got = found_lists(rotated.nearest(frame, F.col("id") % 20 == 0, 3))
    assert got == {0: [(3, 5.0), (4, 5.0), (5, 5.0)], 20: [(0, 5.0), (3, 5.0), (4, 5.0)], 40: [(0, 5.0), (3, 5.0), (4, 5.0)]}
    assert rotated.nearest(frame.limit(0), F.col("id") % 20 == 0).count() == 0
    assert rotated.nearest(frame.filter("vec_id = 220"), F.col("id") % 20 == 0).count() == 0


# --- periodic runs --------------------------------------------------------------------------------------------------


def brute_runs(w):
    out = []
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(12, 2 * p) and not any(all(w[x] == w[x + q] for x in range(i, j + p - q)) for q in range(1, p)):
                out.append((i, j + p - i, p))
            i = max(j, i) + 1
    return sorted(out)


def word_lists():
    draw, out = random.Random(5), []
    for _ in range(150):
        n = draw.choice([0, 1, 11, 12, 13, 40, 90, 200])
        w = [str(draw.randrange(draw.choice([1, 2, 3, 12]))) for _ in range(n)]
        if n and draw.random() < 0.7:
            a, p = draw.randrange(n), draw.randrange(1, n // 2 + 2)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            if draw.random() < 0.4:
                w[draw.randrange(n)] = "other"
        out.append(w)
    a, b = ["a"], ["a", "b"]
    while len(b) < 300:
        a, b = b, b + a
    return [*out, b, ["x", "y", "z"] * 100, ["x"] * 250, [str(i % 70) for i in range(300)]]


@pytest.mark.parametrize("words_together", [1, 500, 10**6])
def test_runs_equal_brute_force(monkeypatch, words_together):
    monkeypatch.setattr(runs, "TOGETHER", words_together)
    monkeypatch.setattr(runs, "POINTS", 200)
    texts = [[w.encode() for w in t] for t in word_lists()]
    n = 0
    for group in runs.grouped(iter(texts)):
        for words, *found in runs.of_texts(group):
            assert list(zip(*(f.tolist() for f in found))) == brute_runs(words)
            n += 1
    assert n == len(texts)


def test_cover_meets_every_pair_of_residues():
    assert runs.SHIFTS.min() >= 0 and len({(a - b) % runs.MODULUS for a in runs.COVER for b in runs.COVER}) == runs.MODULUS


def test_runs_query(spark, small):
    texts = {r["doc_id"]: r["text"] for r in table(spark, small, "documents").collect()}
    some = 0
    for r in queries.op12(spark, small).collect():
        w = re.findall("[^\x20\x09-\x0d]+", texts[r["doc_id"]])
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        elif len(w) > 1500:
            continue  # brute force takes long; planted ones are kept
        found = brute_runs(w)
        best = min(((-x[1], x[0], x[2]) for x in found), default=None)
        got = (r["start"], r["length"], r["period"], r["exponent_milli"])
        assert got == ((best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert r["n_runs"] == len(found)
        assert r["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        some += len(found)
    assert some


def test_runs_of_odd_rows(spark):
    long = "ab cd " * 60_000
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "x " * 20), (5, long), (5, long), (6, "é" * 3 + " z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "2 AS n_words", "3 AS collapsed")
    got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(frame).collect()))
    twice = (5, 120_000, [(0, 120_000, 2)], "ab cd")
    assert got == [(0, 20, [(0, 20, 1)], "x"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), twice, twice, (6, 2, [], "ééé z")]
    assert runs.periodic_runs(frame.limit(0)).count() == 0


# --- collocations ---------------------------------------------------------------------------------------------------


def brute_collocations(rows, support, first=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if a >= support}
        inside = {q for p, a in found.items() for q in (p[1:], p[:-1]) if found.get(q) == a}
        scored = []
        for p, a in found.items():
            if len(p) > 1 and p not in inside:
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for at, (score, a, p, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, at, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def as_tuples(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("support, sample", [(5, 8), (20, 8), (3, 1000)])
def test_collocations_equal_brute_force(spark, small, monkeypatch, support, sample):
    # A sample of next to nothing proposes nothing: the border and the expansion find every phrase all the same.
    monkeypatch.setattr(phrases, "SAMPLE", sample)
    monkeypatch.setattr(phrases, "TOGETHER", 20_000)
    docs = table(spark, small, "documents")
    want = brute_collocations([(r["lang"], r["text"]) for r in docs.collect()], support)
    assert as_tuples(phrases.collocations(docs, support)) == want


def test_small_tables_change_nothing(spark, small, monkeypatch):
    monkeypatch.setattr(phrases, "BITS", 1 << 15)
    monkeypatch.setattr(phrases, "BUCKETS", 1 << 15)
    docs = table(spark, small, "documents").limit(120)
    want = brute_collocations([(r["lang"], r["text"]) for r in docs.collect()], 6)
    assert as_tuples(phrases.collocations(docs, 6)) == want


def test_bitmap_holds_its_members(spark):
    rows = [("en", f"word{i} and {i}") for i in range(3000)]
    held = phrases.members(spark.createDataFrame(rows, "lang string, phrase string"))

    def hashes(lang):
        own = np.full(len(rows), phrases.xxhash.xxh64_intdigest(lang.encode(), phrases.SEED), np.uint64)
        for words in zip(*(p.encode().split() for _, p in rows)):
            own = phrases.chained(phrases.word_hashes(words), own)
        return own

    assert held.holds(hashes("en")).all() and held.holds(hashes("fr")).mean() < 0.01


def test_collocations_of_odd_rows(spark):
    rows = [(1, None, None), (2, "", "en"), (3, "A b, a B! c\x0b\x0ca\tb", None), (3, "A b, a B! c\x0b\x0ca\tb", None), (None, "Öl öl Öl öl", "de"), (4, "x " * 90_000, "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS phrase", "2 AS n", "3 AS words", "4 AS h")
    want = brute_collocations([(lang, t) for _, t, lang in rows], 2)
    assert as_tuples(phrases.collocations(frame, 2)) == want and ("und", 1, "a b", 6, 6, 6, 14, 2333) in want
    assert phrases.collocations(frame.limit(0), 2).count() == 0
