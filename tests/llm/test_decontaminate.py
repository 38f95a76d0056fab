"""Occurrences, partial and edited passages of benchmark items."""

from __future__ import annotations

from changeflow.llm import decontaminate

ITEM = "if a farmer called Bob sells 12 kg of ripe apples to Mary and Bob keeps 3.5 kg of them how many are left"
OTHER = ITEM.replace("Bob", "Carl").replace("12", "40").replace("3.5", "7")
THIRD = ITEM.replace("Bob", "Eve").replace("12", "9").replace("3.5", "2")
SPLIT = ITEM.replace("Bob sells", "Carl sells").replace("Bob keeps", "Dave keeps").replace("12", "40")
FILLER = " and so the long day went on by the sea where nobody had ever been seen before that year" * 3


def found(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r["doc_id"]: r["kind"] for r in decontaminate.leaks(docs, bench).collect()}


def test_each_occurrence_is_judged(spark):
    numbers = " ".join(f"{k} Ann {k + 1} Bert" for k in range(200))
    texts = [ITEM + FILLER + " " + OTHER, OTHER + " " + THIRD, OTHER + FILLER + THIRD, ITEM + " " + ITEM, numbers + FILLER + " " + ITEM + " " + numbers, SPLIT.replace("Mary", "Ann") + FILLER]
    got = found(spark, texts, [ITEM])
    assert {d: got.get(d) for d in range(5)} == {0: "verbatim", 1: "parameters", 2: "parameters", 3: "verbatim", 4: "verbatim"}


def test_partial_and_edited_passages(spark):
    long = [f"word{'abcdefghijklmnopqrstuvwxyz'[k % 26]}{'xyz'[k // 26]}" for k in range(59)]
    middle, short = long[:38], long[:15]
    edit = lambda words, *at: " ".join("other" if k in at else w for k, w in enumerate(words))
    items = [" ".join(long), "Sharp green lizards climb tall walls", " ".join(f"m{w}" for w in middle), " ".join(f"s{w}" for w in short)]
    texts = [
        "they said " + " ".join(long[10:42]) + FILLER,
        edit([f"m{w}" for w in middle], 12, 24) + FILLER,
        "we saw " + edit([f"s{w}" for w in short], 7) + FILLER,
        "we saw that Sharp green lizards climb tall walls in spring",
        "we saw " + " ".join(long[10:18]) + FILLER,
    ]
    assert found(spark, texts, items) == {k: "verbatim" for k in range(4)}
