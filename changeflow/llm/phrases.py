"""Collocations by Toivonen's mining: a sample proposes phrases, a full pass counts them and their negative border.

Frequent phrases of the sample, at a lowered threshold, are members. The full pass counts each phrase all whose parts of one word
less are members: these are the members and the phrases just outside, the border that occurs. Counts are exact, and if
no phrase of the border is frequent, no other phrase can be. Where some are, they become members too, and an expansion pass
counts what has not been counted: phrases whose parts are members or are counted in the same pass. Both parts of a frequent
phrase are frequent, so by induction on the number of words that pass leaves none out and closes the border.

Tasks need to know the members, whose number grows with the corpus. They get a bitmap of a fixed size in which each member has two
bits. A phrase that is taken for a member by mistake only has its extensions counted as well, so results do not depend on
the bitmap's size. Before the full pass, tasks count the phrases it would count by buckets of their hashes, a table of a fixed
size; a phrase whose bucket stays below the support is not frequent and is not sent. Tasks count by blocks and send one row for
each phrase of a block.

Null texts are empty, a null language is ``und``. Rows are counted as they are, repeated ones too. An empty table gives no
rows. Other columns are not looked at; a null id only decides whether a row is in the sample.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import batches_of, cut

#: Words of a phrase at most; one row in so many is in the sample, where half of the share of the support is enough.
LONGEST, SAMPLE, MARGIN = 5, 8, 0.5
#: Bits of the members' bitmap; buckets of hashes; words that a task counts together.
BITS, BUCKETS, TOGETHER = 1 << 25, 1 << 22, 1_000_000
SEED = 42
NO_LANGUAGE = "und"
# The marks at which texts are cut into pieces, and the white space between words.
MARKS, SPACE = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"

_PLAIN = bytes(10 if c in MARKS else 32 if c in SPACE else c + 32 if 65 <= c <= 90 else c for c in range(256))
_TOKEN = re.compile(rb"\n|[^ \n]+")
COUNTS = "lang string, phrase string, words int, n long"


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case, with a line feed wherever a piece ends."""
    return _TOKEN.findall((text or "").encode().translate(_PLAIN))


# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def chained(values: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """XXH64 of 64-bit integers with a seed each, as ``xxhash64`` of Spark chains the elements of an array."""
    x = (seeds + _P5 + np.uint64(8)) ^ (_turned(values * _P2, 31) * _P1)
    x = _turned(x, 27) * _P1 + _P4
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))


#: The hash of a phrase in a language; ``chained`` gives the same from the hashes of its words.
PHRASE_HASH = "xxhash64(lang, transform(split(phrase, ' ', -1), w -> xxhash64(w)))"


class Members:
    """The phrases that have their two bits in a bitmap."""

    def __init__(self, bitmap: np.ndarray) -> None:
        self.bitmap = bitmap

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        bits = np.uint64(8 * len(self.bitmap))
        return _bit(self.bitmap, hashes % bits) & _bit(self.bitmap, (hashes >> np.uint64(32)) % bits)


def _bit(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap_of(bits: DataFrame, size: int) -> np.ndarray:
    """A bitmap of ``size`` bits with those of the column ``bit``: that is what reaches the driver, however many rows there are.

    It comes in one job, not in one for each partition: the driver keeps a record of every job, stage and task.
    """
    parts = bits.groupBy((F.col("bit") / 32768).cast("int").alias("part"))
    bitmap = np.zeros(size // 8, np.uint8)
    for part, held in parts.agg(F.bitmap_construct_agg((F.col("bit") % 32768).cast("long"))).collect():
        bitmap[part * 4096 : (part + 1) * 4096] = np.frombuffer(held, np.uint8)
    return bitmap


def members(phrases: DataFrame) -> Members:
    """The bitmap of (lang, phrase)."""
    h = F.expr(PHRASE_HASH)
    bits = F.array(h.bitwiseAND(F.lit(BITS - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(BITS - 1)))
    return Members(bitmap_of(phrases.select(F.explode(bits).alias("bit")), BITS))


def _blocks(batches: Iterator[pa.RecordBatch], together: int) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """A language, its words and their numbers in the order of the texts, 0 standing between pieces; some texts at a time."""

    def flush() -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for lang, known in numbers.items():
            yield lang, list(known), np.concatenate([*texts[lang], [0]])

    def fresh() -> dict[bytes, int]:
        known = defaultdict(count().__next__)
        known[b"\n"]
        return known

    numbers: dict[str, dict[bytes, int]] = defaultdict(fresh)
    texts: dict[str, list[np.ndarray]] = defaultdict(list)
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            own = tokens(text.as_py())
            texts[lang] += [np.zeros(1, np.int64), np.fromiter(map(numbers[lang].__getitem__, own), np.int64, len(own))]
            held += len(own)
            if held >= together:
                yield from flush()
                numbers.clear(), texts.clear()
                held = 0
    yield from flush()


def _walk(ids: np.ndarray, words: list[bytes], lang: str, now: Members | None, before: Members | None, levels: range) -> Iterator:
    """For each level the positions of the phrases whose parts are members, their hashes, and which of them were before.

    With ``before``, phrases that were not there before are taken for members, since they may be frequent.
    """
    hashes, own = word_hashes(words)[ids], xxhash.xxh64_intdigest(lang.encode(), SEED)
    at = np.flatnonzero(ids)
    so_far, inside, old = np.full(len(ids), own, np.uint64), None, np.zeros(len(ids), bool)
    for n in range(1, levels[-1] + 1):
        was = np.full(len(at), before is not None)
        if n > 1:
            # Positions where the parts of one word less that start here and at the next word are both members.
            at = at[inside[at] & inside[at + 1]]
            was = old[at] & old[at + 1]
        h = chained(hashes[at + n - 1], so_far[at])
        so_far[at] = h
        if n in levels:
            yield n, at, h, was
        if n == levels[-1] or not len(at):
            return
        inside, old = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        inside[at] = now.holds(h)
        if before is not None:
            inside[at] |= ~was
            old[at] = was & before.holds(h)


def _distinct(ids: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For the different phrases of ``n`` words at positions ``at`` one position each, and how often they occur."""
    code, wide = ids[at], int(ids.max(initial=0)) + 1
    for k in range(1, n):
        code = np.unique(code, return_inverse=True)[1] * wide + ids[at + k]
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    return at[first], counts


def _counted(now: Members | None, before: Members | None, likely: np.ndarray | None, levels: range) -> Callable:
    """Counts of the phrases of ``levels`` words whose parts are members ``now``, a block at a time.

    With ``before``, of those that a pass with these members has not counted; with ``likely``, of those that have their bit in it.
    Rows of no words hold the number of words of a language.
    """
    together = TOGETHER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in _blocks(batches, together):
            if 1 in levels:
                yield _rows(lang, [b""], 0, np.array([np.count_nonzero(ids)]))
            for n, at, h, was in _walk(ids, words, lang, now, before, levels):
                take = ~was
                if n > 1 and likely is not None:
                    take &= _bit(likely, h % np.uint64(8 * len(likely)))
                first, counts = _distinct(ids, at[take], n)
                found = [b" ".join([words[i] for i in row]) for row in ids[first[:, None] + np.arange(n)].tolist()]
                yield _rows(lang, found, n, counts)

    return run


def _bucketed(now: Members, levels: range, buckets: int) -> Callable:
    """How often a task meets the phrases of each bucket, in slices of 4096 buckets; 255 stands for that many or more."""
    together = TOGETHER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for lang, words, ids in _blocks(batches, together):
            for _, _, h, _ in _walk(ids, words, lang, now, None, levels):
                held += np.bincount((h % np.uint64(buckets)).astype(np.int64), minlength=buckets)
        slices = np.minimum(held, 255).astype(np.uint8).reshape(-1, 4096)
        some = np.flatnonzero(slices.any(axis=1))
        columns = [pa.array(some.astype(np.int32)), pa.array([slices[k].tobytes() for k in some], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["slice", "held"])

    return run


def _bits_of(support: int) -> Callable:
    """The buckets whose sum over all tasks reaches the support."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4096, np.int64)
        for batch in batches:
            for held in batch.column("held"):
                total += np.frombuffer(held.as_py(), np.uint8)
        bits = key[0].as_py() * 4096 + np.flatnonzero(total >= min(support, 255))
        yield pa.RecordBatch.from_arrays([pa.array(bits, pa.int64())], ["bit"])

    return run


def likely_buckets(rows: DataFrame, support: int, now: Members, levels: range) -> np.ndarray:
    """A bitmap of the buckets of hashes that phrases of the pass reach ``support`` times or more together.

    A phrase of another bucket is not frequent, so the pass need not send it. The bitmap has a fixed size; the more phrases there
    are, the less it spares, and no result depends on it.
    """
    with batches_of(rows.sparkSession, 500):
        held = rows.mapInArrow(_bucketed(now, levels, BUCKETS), "slice int, held binary")
        bits = held.groupBy("slice").applyInArrow(_bits_of(support), "bit long")
        return bitmap_of(bits, BUCKETS)


def _rows(lang: str, phrases: list[bytes], words: int, counts: np.ndarray) -> pa.RecordBatch:
    n = len(phrases)
    texts = pa.array(phrases, pa.binary()).cast(pa.string())
    columns = [pa.array([lang] * n, pa.string()), texts, pa.array(np.full(n, words, np.int32)), pa.array(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "n"])


def counts(
    rows: DataFrame, least: int, now: Members | None, levels: range, before: Members | None = None, likely: np.ndarray | None = None
) -> DataFrame:
    """Rows (lang, phrase, words, n) of the phrases that a pass counts and finds ``least`` times or more, and of no words."""
    with batches_of(rows.sparkSession, 500):
        parts = rows.mapInArrow(_counted(now, before, likely, levels), COUNTS)
        return cut(parts.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(f"n >= {least} OR words = 0"))


def proposed(rows: DataFrame, support: int, longest: int) -> DataFrame:
    """Phrases of up to ``longest`` words, frequent in the sample, level by level."""
    sample = rows.filter(F.pmod("h", F.lit(SAMPLE)) == 0)
    least = max(1, int(MARGIN * support / SAMPLE))
    found: list[DataFrame] = []
    for n in range(1, longest + 1):
        now = members(reduce(DataFrame.unionByName, found)) if found else None
        found.append(counts(sample, least, now, range(n, n + 1)).filter("words > 0"))
    return reduce(DataFrame.unionByName, found)


def frequent(docs: DataFrame, support: int, longest: int = LONGEST) -> DataFrame:
    """Rows (lang, phrase, words, n) of all phrases of up to ``longest`` words that occur ``support`` times or more.

    A row of no words holds the number of words of a language.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    rows = docs.select(lang, "text", F.xxhash64("doc_id").alias("h"))
    known = cut(proposed(rows, support, longest - 1).select("lang", "phrase"))
    rows, now = rows.select("lang", "text"), members(known)
    likely = likely_buckets(rows, support, now, range(2, longest + 1))
    found = counts(rows, support, now, range(1, longest + 1), likely=likely)
    failed = found.filter(f"words BETWEEN 1 AND {longest - 1}").select("lang", "phrase").join(known, ["lang", "phrase"], "left_anti")
    failed = cut(failed)
    if failed.isEmpty():
        return found
    return found.unionByName(counts(rows, support, Members(now.bitmap | members(failed).bitmap), range(2, longest + 1), now))


def collocations(docs: DataFrame, support: int = 100, share: int = 100, first: int = 2000) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the ``first`` phrases of a language by score.

    A phrase of ``a`` occurrences is cut in two parts of ``l`` and ``r``; the cut with the least score counts. Left out are phrases
    inside a longer one that occurs at least ``share`` in a hundred times as often; all numbers are exact.
    """
    every = frequent(docs, support)
    totals = every.filter("words = 0").select("lang", F.col("n").alias("total"))
    single = every.filter("words > 0").select("lang", "phrase", "words", F.col("n").alias("a"))
    parts = F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))
    # A phrase inside a longer one is inside one of a word more that occurs no less often.
    wider = single.filter("words > 2").select("lang", F.explode(parts).alias("phrase"), F.col("a").alias("wider"))
    inside = wider.groupBy("lang", "phrase").agg(F.max("wider").alias("wider"))
    phrases = single.filter("words > 1").join(inside, ["lang", "phrase"], "left").filter(f"wider IS NULL OR 100 * wider < {share} * a")
    cuts = phrases.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - words)")})
    for side in ("left", "right"):
        cuts = cuts.join(single.select("lang", F.col("phrase").alias(side), F.col("a").alias(side[0])), ["lang", side])
    wide = "CAST({} AS DECIMAL(19, 0))".format
    score = F.expr(f"(1000 * {wide('a')} * {wide('total')}) DIV ({wide('l')} * {wide('r')})")
    scored = cuts.join(totals, "lang").withColumn("score", score)
    least = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", F.col("total").alias("n"))).alias("s"))
    ranked = least.select("lang", "phrase", "s.a", "s.l", "s.r", "s.n", "s.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
