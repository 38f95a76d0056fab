"""Personal data by candidate gradient boosting.

High-recall generators propose spans of four kinds that may overlap. Spans of the strict base patterns are always kept and
label the candidates: a candidate is positive if it is a base span. Boosted trees over format and context features, fitted on
four fifths of the texts, score the others; a threshold for each kind, calibrated on the last fifth, selects what is added.
Features take a few values each, so the counts of (features, label) that reach the driver are bounded by their product.

Null texts count as empty. Positions are code points, ends exclusive. Repeated rows are treated alike. An empty table gives no
rows, and a model without positive examples adds nothing. Other columns are passed on by ``redact`` and not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut, every_column, once

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
ROUNDS, RATE = 20, 0.5

# The base patterns. Possessive repetition and the look behind change no match; they keep long runs from being tried again
# from each of their characters. \G lets a match begin where the last one ended.
BASE = {
    "email": "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: Wider patterns: spelled-out or bracketed addresses, other separators, numbers without a plus sign.
WIDE = {
    "email": "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++\\x20?(?:@|[\\[(]at[\\])])\\x20?[A-Za-z0-9-]++"
    "(?:\\x20?(?:\\.|[\\[(]dot[\\])])\\x20?[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]{1,3}+(?:[.,:-][0-9]{1,3}+){3}",
    "card": "(?<![0-9])[0-9](?:[\\x20./-]?[0-9]){12,}+",
    "phone": "[+(]?[0-9][\\x20().0-9-]{5,}[0-9]",
}
#: A text without this has no match of the kind.
NEEDS = {"email": "t RLIKE '@|[\\\\[(]at[\\\\])]'", "ip": "digits", "card": "digits", "phone": "digits"}
SPAN = "ARRAY<STRUCT<s: INT, e: INT, m: STRING, before: STRING, after: STRING>>"

def _luhn(digits: str) -> str:
    """SQL: the check sum holds; leading zeros up to 20 digits do not change it."""
    at = [f"CAST(substr(lpad({digits}, 20, '0'), {i}, 1) AS INT)" for i in range(1, 21)]
    return "(" + " + ".join(d if i % 2 else f"2 * {d} - IF({d} > 4, 9, 0)" for i, d in enumerate(at)) + ") % 10 = 0"


_PART = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _octets(m: str) -> str:
    return f"{m} RLIKE '^{_PART}([.]{_PART}){{3}}$'"


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def valid(kind: str, m: str) -> str:
    """SQL: what a match of the base pattern must also satisfy."""
    n = f"length({_digits(m)})"
    return {
        "email": "TRUE",
        "ip": _octets(m),
        "card": f"({n} BETWEEN 16 AND 19 AND {_luhn(_digits(m))})",
        "phone": f"{n} BETWEEN 8 AND 15",
    }[kind]


def _side(c: str) -> str:
    """SQL: 0 at the edge or at white space, 1 beside a letter or digit, 2 beside anything else."""
    return f"CASE WHEN {c} = '' OR {c} RLIKE '[\\\\x20\\\\x09-\\\\x0D]' THEN 0 WHEN {c} RLIKE '[\\\\p{{L}}\\\\p{{N}}]' THEN 1 ELSE 2 END"


NAMES = ("length", "plus", "marks", "address", "checksum", "octets", "left", "right", "context")


def features(x: str) -> dict[str, str]:
    """SQL for each feature of the span ``x``; each has a handful of values."""
    m, n = f"{x}.m", f"length({_digits(x + '.m')})"
    steps = " ".join(f"WHEN {n} < {most} THEN {k}" for k, most in enumerate((7, 10, 13, 16, 17, 20)))
    sql = (
        f"CASE {steps} ELSE 6 END",
        f"IF(startswith({m}, '+'), 1, 0)",
        f"CASE WHEN {m} RLIKE '[(]' THEN 3 WHEN {m} RLIKE '[.]' THEN 2 WHEN {m} RLIKE '[^0-9A-Za-z]' THEN 1 ELSE 0 END",
        f"CASE WHEN {m} RLIKE '@' THEN 2 WHEN {m} RLIKE '[A-Za-z]' THEN 1 ELSE 0 END",
        f"IF({valid('card', m)}, 1, 0)",
        f"IF({_octets(m)}, 1, 0)",
        _side(f"right({x}.before, 1)"),
        _side(f"{x}.after"),
        f"IF(lower({x}.before) RLIKE 'mail|tel|phone|call|fax|mobil|card|visa|addr|contact|server|host', 1, 0)",
    )
    return dict(zip(NAMES, sql))


def _gaps(pattern: str, needs: str) -> str:
    """SQL: the matches of a pattern, and of each gap around them its length, last 24 characters and first one."""
    p = pattern.replace("\\", "\\\\")
    gaps = f"transform(split(t, '{p}', -1), g -> struct(length(g) AS n, right(g, 24) AS last, left(g, 1) AS first))"
    return f"IF({needs}, struct({gaps} AS gaps, regexp_extract_all(t, '{p}', 0) AS found), NULL)"


def _placed(raw: str, holds: str) -> str:
    """SQL: matches that satisfy a condition as spans in order; the lengths of the gaps between matches give their places."""
    start = f"acc.at + {raw}.gaps[i].n"
    span = f"struct({start} AS s, {start} + length({raw}.found[i]) AS e, {raw}.found[i] AS m, {raw}.gaps[i].last AS before, {raw}.gaps[i + 1].first AS after)"
    return (
        f"IF({raw} IS NULL, CAST(array() AS {SPAN}), aggregate(slice(sequence(0, size({raw}.found)), 1, size({raw}.found)),"
        f" struct(0 AS at, CAST(array() AS {SPAN}) AS out), (acc, i) -> struct({start} + length({raw}.found[i]) AS at,"
        f" IF({holds}, concat(acc.out, array({span})), acc.out) AS out), acc -> acc.out))"
    )


def spans(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` as a struct named row, text t, valid base spans by kind, and candidates with features and label y.

    Texts without a digit or an address sign are not searched.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select(F.struct(*keep).alias("row"), text.alias("t"), text.rlike("[0-9]").alias("digits"))
    raw = F.struct(*[F.expr(_gaps(p[k], NEEDS[k])).alias(k + end) for p, end in ((BASE, ""), (WIDE, "_wide")) for k in KINDS])
    placed = F.struct(
        *[F.expr(_placed(f"raw.{k}", valid(k, f"raw.{k}.found[i]"))).alias(k) for k in KINDS],
        *[F.expr(_placed(f"raw.{k}_wide", "TRUE")).alias(f"{k}_wide") for k in KINDS],
    )
    strict = [F.expr(f"transform(b.{k}, x -> struct(x.s AS s, x.e AS e))").alias(k) for k in KINDS]
    got = base.select("row", "t", once(raw).alias("raw")).select("row", "t", once(placed).alias("b"))
    got = got.select("row", "t", "b", once(F.struct(*strict)).alias("base"))
    parts = []
    for number, k in enumerate(KINDS):
        values = ", ".join(f"{sql} AS {name}" for name, sql in features("x").items())
        parts.append(
            f"transform(b.{k}_wide, x -> struct({number} AS kind, x.s AS s, x.e AS e, {values},"
            f" IF(array_contains(base.{k}, struct(x.s AS s, x.e AS e)), 1, 0) AS y))"
        )
    return got.select("row", "t", "base", once(F.expr(f"concat({', '.join(parts)})")).alias("c")).select("row", "t", "base.*", "c")


Tree = tuple  # (feature, value, below, above), or the number of a leaf


@dataclass(frozen=True)
class Boosted:
    """Trees over (kind, features), the log odds they start from, and the least score that adds a span of each kind."""

    start: float
    trees: tuple[Tree, ...]
    thresholds: dict[int, float]

    def score(self, x: Column) -> Column:
        def value(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(tree)
            name, most, below, above = tree
            return F.when(x[name] <= most, value(below)).otherwise(value(above))

        total = F.lit(self.start)
        for tree in self.trees:
            total = total + value(tree)
        return total

    def score_row(self, x: dict) -> float:
        total = self.start
        for tree in self.trees:
            while isinstance(tree, tuple):
                tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
            total += tree
        return total


def boost(cells: list[tuple[dict, float, float]]) -> tuple[float, tuple[Tree, ...]]:
    """Newton boosting of the logistic loss with trees of depth two over (features, rows, positives)."""
    rows, good = sum(c[1] for c in cells), sum(c[2] for c in cells)
    start = round(math.log((good + 1) / (rows - good + 1)), 6)
    names = ["kind", *NAMES]
    cuts = [(n, v) for n in names for v in sorted({c[0][n] for c in cells})[:-1]]
    scores, trees = [start] * len(cells), []

    def gain(at: list[int], slopes: list[tuple[float, float]]) -> float:
        g, h = sum(slopes[i][0] for i in at), sum(slopes[i][1] for i in at)
        return g * g / (h + 1)

    def grow(at: list[int], slopes: list[tuple[float, float]], depth: int):
        best, choice = gain(at, slopes) + 1e-9, None
        for name, most in cuts if depth else ():
            low = [i for i in at if cells[i][0][name] <= most]
            if 0 < len(low) < len(at):
                high = [i for i in at if cells[i][0][name] > most]
                if (g := gain(low, slopes) + gain(high, slopes)) > best:
                    best, choice = g, (name, most, low, high)
        if choice is None:
            return round(RATE * sum(slopes[i][0] for i in at) / (sum(slopes[i][1] for i in at) + 1), 6)
        name, most, low, high = choice
        return (name, most, grow(low, slopes, depth - 1), grow(high, slopes, depth - 1))

    for _ in range(ROUNDS if good else 0):
        slopes = []
        for (_, n, y), score in zip(cells, scores):
            p = 1 / (1 + math.exp(-score))
            slopes.append((y - n * p, n * p * (1 - p)))
        tree = grow(list(range(len(cells))), slopes, 2)
        trees.append(tree)
        one = Boosted(0.0, (tree,), {})
        scores = [s + one.score_row(c[0]) for s, c in zip(scores, cells)]
    return start, tuple(trees)


def fit(found: DataFrame) -> Boosted:
    """Trees from the candidates of four fifths of the texts, thresholds from those of the last fifth.

    A threshold is the least score from which on at least ``PRECISION`` of the kind's held-out candidates are positive.
    """
    names = ["kind", *NAMES]
    cells = found.select((F.pmod(F.xxhash64("t"), F.lit(5)) == 0).alias("held"), F.explode("c").alias("c"))
    cells = cells.select("held", *[F.col(f"c.{n}").alias(n) for n in names], "c.y").groupBy("held", *names).agg(F.count("*").alias("n"), F.sum("y").alias("y"))
    rows = sorted((r["held"], tuple(r[n] for n in names), r["n"], r["y"]) for r in cells.collect())
    split = {h: [(dict(zip(names, x)), n, y) for held, x, n, y in rows if held == h] for h in (False, True)}
    start, trees = boost(split[False])
    model, thresholds = Boosted(start, trees, {}), {}
    for kind in range(len(KINDS)):
        ranked = sorted(((model.score_row(x), n, y) for x, n, y in split[True] if x["kind"] == kind), reverse=True)
        seen = good = 0
        for score, n, y in ranked:
            seen, good = seen + n, good + y
            if good >= PRECISION * seen:
                thresholds[kind] = round(score - 1e-6, 6)
    return Boosted(start, trees, thresholds if trees else {})


def select_spans(found: DataFrame, model: Boosted) -> DataFrame:
    """Adds ``more``: selected candidates (kind, s, e) that overlap neither a base span nor an earlier or better selected one."""
    limit = F.create_map(*[x for k in range(len(KINDS)) for x in (F.lit(k), F.lit(model.thresholds.get(k, math.inf)))])
    base = F.concat(*KINDS)
    scored = F.transform("c", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), model.score(x).alias("score"), x["y"].alias("y")))
    chosen = F.filter(
        scored,
        lambda x: (x["y"] == 0) & (x["score"] >= limit[x["kind"]]) & ~F.exists(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])),
    )
    out = found.withColumn("chosen", F.array_sort(chosen))
    free = (
        "aggregate(chosen, struct(-1 AS end, CAST(array() AS ARRAY<STRUCT<kind: INT, s: INT, e: INT>>) AS out),"
        " (acc, x) -> IF(x.s < acc.end, acc, struct(x.e AS end, concat(acc.out, array(struct(x.kind AS kind, x.s AS s, x.e AS e))) AS out)),"
        " acc -> acc.out)"
    )
    return out.withColumn("more", F.expr(free)).drop("chosen", "c")


def _listed(k: int, with_more: bool) -> str:
    """SQL: the spans of a kind as text in order of start."""
    own = f"transform({KINDS[k]}, x -> struct(x.s AS s, x.e AS e))"
    more = f"transform(filter(more, x -> x.kind = {k}), x -> struct(x.s AS s, x.e AS e))"
    both = f"sort_array(concat({own}, {more}))" if with_more else own
    return f"transform({both}, x -> concat('{KINDS[k]}:', x.s, ':', x.e))"


def find(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, number of base spans by kind, base, spans): lists of kind:start:end by kind and start."""
    found = cut(spans(docs, [F.col("doc_id")]).drop("t").withColumn("t", F.col("row.doc_id").cast("string")))
    chosen = select_spans(found, fit(found))
    joined = [f"array_join(concat({', '.join(_listed(k, m) for k in range(len(KINDS)))}), ',')" for m in (False, True)]
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return chosen.select("row.doc_id", *counts, F.expr(joined[0]).alias("base"), F.expr(joined[1]).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one. n_chars follows the text."""
    found = spans(docs, every_column(docs))
    model = fit(found)
    named = [f"transform({k}, x -> struct(x.s AS s, x.e AS e, '{k.upper()}' AS name))" for k in KINDS]
    names = ", ".join(f"'{k.upper()}'" for k in KINDS)
    named.append(f"transform(more, x -> struct(x.s AS s, x.e AS e, element_at(array({names}), x.kind + 1) AS name))")
    out = select_spans(found, model).withColumn("all", F.expr(f"sort_array(concat({', '.join(named)}))"))
    text = F.expr(
        "IF(size(all) = 0, row.text, aggregate(all, struct(0 AS at, CAST('' AS STRING) AS out), (acc, x) -> IF(x.s < acc.at,"
        " struct(greatest(acc.at, x.e) AS at, acc.out AS out),"
        " struct(x.e AS at, concat(acc.out, substr(t, acc.at + 1, x.s - acc.at), '[', x.name, ']') AS out)),"
        " acc -> concat(acc.out, substr(t, acc.at + 1))))"
    )
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    same = [F.when(F.size("all") > 0, new[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in new else F.col("row.`" + c.replace("`", "``") + "`").alias(c) for c in docs.columns]
    return out.select(*same)
