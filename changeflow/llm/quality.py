"""Quality rules by weak supervision.

Each rule votes good or bad on a document or abstains. Expectation-maximisation over the vote patterns estimates how
often each rule gives each outcome on good and on poor documents; a document is kept if its posterior probability of being
good is at least a half, so no single rule decides. A pattern has one letter a rule, hence there are at most
``3 ** len(RULES)`` patterns however large the corpus; only their counts reach the driver.

Null texts count as empty; empty texts have no words, fail the base limits and are not kept. Repeated rows are judged row
by row. An empty table gives no rows, and its model keeps the starting values. Columns of other names are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import BREAK, cut, every_column, once

GOOD, BAD, ABSTAIN = "g", "b", "a"
MIN_WORDS = 50

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it with was on as be by this are from or an "
    "der die und das ist mit von ein eine den nicht sich auf zu "
    "de la le et les des un une du est que qui dans pour "
    "el los las y en por con para se del"
).split()

#: Name, condition of a bad vote, condition of a good vote; neither: the rule abstains.
RULES = (
    ("length", f"n_words < {MIN_WORDS}", f"n_words >= {2 * MIN_WORDS}"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    ("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    ("same_lines", "10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0"),
    ("repetition", "5 * n_repeat_words > n_words", "20 * n_repeat_words <= n_words"),
    ("shouting", "10 * n_shouts > n_words", "n_shouts = 0"),
    ("function_words", "n_stop_words < 2", "n_stop_words >= 4"),
    ("variety", "10 * n_distinct < n_words AND n_words < 2000", "2 * n_distinct >= n_words"),
)


#: SQL for the position of a packed entry.
AT = "CAST({0} & (shiftleft(1L, bits) - 1) AS INT)"


def _same_words(a: str, b: str) -> str:
    """SQL: two packed entries stand for the same three words."""
    p, q = AT.format(a), AT.format(b)
    return " AND ".join(f"words[{p} + {k}] = words[{q} + {k}]" for k in range(3))


def measures(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` as a struct named row, with counts over each whole text.

    Repeated three-word windows are found inside the row: hash and position are packed into one integer each, the integers
    are sorted, and neighbours with equal hashes are compared word by word. Nothing is shuffled. Counts that need only the
    text come first, so that the text is not carried through the steps on words.
    """
    whole = docs.select(F.struct(*keep).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    texts = whole.selectExpr(
        "row",
        "t",
        "length(bin(length(t))) AS bits",
        "CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '')) AS BIGINT) AS n_symbols",
        "CAST((length(t) - length(replace(t, '!!', ''))) / 2 AS BIGINT) AS n_shouts",
        "filter(split(t, '\\n'), line -> line RLIKE '[^\\\\x20\\\\x09-\\\\x0D]') AS lines",
    ).selectExpr(
        "row",
        "t",
        "bits",
        "n_symbols",
        "n_shouts",
        "CAST(size(lines) - size(array_distinct(lines)) AS BIGINT) AS n_dup_lines",
        "CAST(size(lines) AS BIGINT) AS n_lines",
    )
    numbers = ["bits", "n_symbols", "n_shouts", "n_dup_lines", "n_lines"]
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    words = texts.select("row", *numbers, once(F.array_remove(F.split("t", BREAK), "")).alias("words"))
    counted = words.selectExpr(
        "row",
        *numbers,
        "words",
        "CAST(size(words) AS BIGINT) AS n_words",
        "CAST(length(array_join(words, '')) AS BIGINT) AS word_chars",
        f"CAST(size(array_intersect(words, array({stop}))) AS BIGINT) AS n_stop_words",
        "CAST(size(array_distinct(words)) AS BIGINT) AS n_distinct",
    )
    numbers += ["n_words", "word_chars", "n_stop_words", "n_distinct"]
    packed = (
        "sort_array(transform(slice(words, 1, greatest(size(words) - 2, 0)), (w, i) ->"
        " shiftleft(xxhash64(w, words[i + 1], words[i + 2]), bits) | i))"
    )
    sorted_ = counted.select("row", *numbers, "words", once(F.expr(packed)).alias("s"))
    alike = (
        "filter(s, (x, i) -> shiftrightunsigned(x ^ get(s, i + 1), bits) = 0"
        " OR shiftrightunsigned(x ^ get(s, i - 1), bits) = 0)"
    )
    close = sorted_.select("row", *numbers, "words", once(F.expr(alike)).alias("s"))
    twice = (
        f"filter(s, (x, i) -> (i > 0 AND {_same_words('x', 'get(s, i - 1)')})"
        f" OR (i + 1 < size(s) AND {_same_words('x', 'get(s, i + 1)')}))"
    )
    covered = f"size(array_distinct(flatten(transform({twice}, x -> transform(array(0, 1, 2), k -> k + {AT.format('x')})))))"
    return close.selectExpr("row", *numbers, f"CAST({covered} AS BIGINT) AS n_repeat_words")


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words")


def votes() -> Column:
    """One letter a rule."""
    return F.concat(*[F.expr(f"CASE WHEN {bad} THEN '{BAD}' WHEN {good} THEN '{GOOD}' ELSE '{ABSTAIN}' END") for _, bad, good in RULES])


@dataclass(frozen=True)
class LabelModel:
    """``prior``: probability that a document is good; ``weights[rule][outcome]``: log odds that the outcome adds."""

    prior: float
    weights: tuple[dict[str, float], ...]

    def posterior(self) -> Column:
        """Probability that the document behind a vote pattern in column ``votes`` is good."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for k, weight in enumerate(self.weights):
            letter = F.substring("votes", k + 1, 1)
            odds = odds + F.when(letter == GOOD, weight[GOOD]).when(letter == BAD, weight[BAD]).otherwise(weight[ABSTAIN])
        return 1 / (1 + F.exp(-odds))


def fit_label_model(patterns: dict[str, int], rules: int = len(RULES), rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over vote patterns and how often each occurs.

    It starts from patterns with a bad vote being poor with probability 0.9 and others with 0.05. Counts are smoothed by one
    a cell, so an outcome never seen has finite weight.
    """
    ordered = sorted(patterns.items())
    good = {p: 0.1 if BAD in p else 0.95 for p, _ in ordered}
    prior, tables = 0.9, [{o: (1 / 3, 1 / 3) for o in (GOOD, BAD, ABSTAIN)} for _ in range(rules)]
    for _ in range(rounds if ordered else 0):
        mass = [sum(n * good[p] for p, n in ordered) + 3, sum(n * (1 - good[p]) for p, n in ordered) + 3]
        prior = mass[0] / (mass[0] + mass[1])
        for k in range(rules):
            for outcome in (GOOD, BAD, ABSTAIN):
                seen = [(n, good[p]) for p, n in ordered if p[k] == outcome]
                tables[k][outcome] = ((sum(n * g for n, g in seen) + 1) / mass[0], (sum(n * (1 - g) for n, g in seen) + 1) / mass[1])
        for p, _ in ordered:
            odds = math.log(prior / (1 - prior)) + sum(math.log(tables[k][o][0] / tables[k][o][1]) for k, o in enumerate(p))
            good[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
    weights = tuple({o: round(math.log(g / b), 6) for o, (g, b) in t.items()} for t in tables)
    return LabelModel(round(prior, 6), weights)


def learn(judged: DataFrame) -> LabelModel:
    """The model from every row's votes; the driver gets one count a pattern."""
    return fit_label_model({r["votes"]: r["count"] for r in judged.groupBy("votes").count().collect()})


def _verdict(judged: DataFrame, model: LabelModel) -> DataFrame:
    return judged.withColumn("quality", model.posterior()).withColumn("kept", ~base_failed() & (F.col("quality") >= 0.5))


def quality_report(docs: DataFrame) -> DataFrame:
    """Counts, votes, posterior and verdict for each row of ``docs`` (doc_id, text)."""
    judged = cut(measures(docs, [F.col("doc_id")]).withColumn("votes", votes()))
    return _verdict(judged, learn(judged)).withColumn("base_failed", base_failed()).withColumn("doc_id", F.col("row.doc_id")).drop("row")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    The texts are read twice, once to learn and once to filter, instead of being written with their measures.
    """
    judged = measures(docs, every_column(docs)).withColumn("votes", votes())
    return _verdict(judged, learn(judged)).filter("kept").select("row.*")
