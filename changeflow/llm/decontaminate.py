"""Benchmark decontamination by template windows.

Texts are canonicalised to templates: names, numbers and units become typed placeholders. Windows of template words of each
document are joined with those of the benchmark items by hash. The windows found of an item are aligned along the document:
hits of about the same offset between document and item that follow one another are one occurrence. An occurrence counts if it
covers half of the item's words, or 13 of them in a row but for edited words, and if its slots are consistent: each value the item has
in a slot must go with one value of the occurrence throughout. Equal values are a verbatim leak, other values a question
with new parameters. An item is reported if any of its occurrences counts.

A document may have the first word of an item inside a sentence, where a capital marks a name; items are looked up both ways.

Null texts count as empty, and have no windows. Items of few words are matched as a whole. Repeated rows of a document
count once. Empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import at_most, cut, once

#: With one word of fifteen changed, seven words stay on one side of it at least.
WIDTH = 7
#: Share of the item's words to be covered, and the least number; or so many in a row, over gaps of so many edited words.
COVERAGE, LEAST_WORDS = 0.5, 8
STRETCH, EDITED = 13, 2
CONSISTENT = 0.8
#: Words by which the offset may shift between hits of an occurrence, and that may lie between their beginnings.
SHIFT, GAP = 6, 24
#: Rows of up to five integers up to which a table is sent to every executor; larger ones are shuffled.
BROADCAST_ROWS = 400_000

# Units of measure and money that follow a number.
UNITS = (
    "mm|cm|m|km|in|ft|yd|mi|mg|g|kg|t|oz|lb|lbs|ml|l|s|sec|min|h|hr|hrs|hz|v|w|kw|j|kj|pa|"
    "meter|meters|metre|metres|kilometer|kilometers|kilometre|kilometres|miles|mile|feet|foot|inches|inch|grams|gram|"
    "kilograms|kilogram|pounds|pound|ounces|ounce|liters|liter|litres|litre|gallons|gallon|seconds|second|minutes|minute|"
    "hours|hour|days|day|weeks|week|months|month|years|year|degrees|degree|percent|cents|cent|dollars|dollar|euros|euro|usd|eur"
)
#: Placeholders, and what joins the parts of a number: characters that Unicode leaves for private use.
NAME, NUMBER, UNIT, JOIN = "\uE001", "\uE002", "\uE003", "\uE004"
MARKS = NAME + NUMBER + UNIT
SPLIT = f"[^\\p{{L}}\\p{{N}}{MARKS}{JOIN}]+"


def values_text(text: Column, digits: Column) -> Column:
    """Lower case with names marked and the parts of a number joined. A name is a capitalised word inside a sentence."""
    named = F.lower(F.regexp_replace(text, "\\x20(?<=[^.!?:\\x20\\x09-\\x0D]\\x20)(?=\\p{Lu}\\p{Ll})", f" {NAME}"))
    return F.when(digits, F.regexp_replace(named, "(?<=\\p{N})[.,](?=\\p{N})", JOIN)).otherwise(named)


def template_text(values: Column, digits: Column) -> Column:
    """The same words with each name, number and unit replaced by its placeholder."""
    named = F.when(F.contains(values, F.lit(NAME)), F.regexp_replace(values, f"{NAME}[\\p{{L}}\\p{{N}}{JOIN}]+", NAME)).otherwise(values)
    counted = F.regexp_replace(named, f"\\p{{N}}[\\p{{N}}{JOIN}]*", NUMBER)
    measured = F.regexp_replace(counted, f"({NUMBER}\\x20)(?:{UNITS})(?![\\p{{L}}\\p{{N}}])", f"$1{UNIT}")
    return F.when(digits, measured).otherwise(named)


def templated(frame: DataFrame, id_name: str, with_values: bool) -> DataFrame:
    """Rows (id, t, v): words of the template and, for texts with slots and if asked for, the same words with their values."""
    text = F.coalesce("text", F.lit(""))
    base = frame.select(F.col(id_name).alias("id"), text.alias("text"), text.rlike("\\p{N}").alias("digits"))
    base = base.select("id", "digits", values_text(F.col("text"), F.col("digits")).alias("values"))
    base = base.select("id", "digits", "values", template_text(F.col("values"), F.col("digits")).alias("template"))
    words = F.array_remove(F.split("template", SPLIT), "")
    if not with_values:
        return base.select("id", once(words).alias("t"))
    slots = F.col("digits") | F.contains("values", F.lit(NAME))
    both = F.struct(words.alias("t"), F.when(slots, F.array_remove(F.split("values", SPLIT), "")).alias("v"))
    return base.select("id", once(both).alias("w")).select("id", "w.*")


def windows(words: DataFrame, width: int) -> DataFrame:
    """Rows (id, doc_at, hash): every window of ``width`` template words and its place."""
    hashed = words.select("id", once(F.expr("transform(t, x -> xxhash64(x))")).alias("h"))
    window = ", ".join(f"h[i + {k}]" for k in range(width))
    made = F.expr(f"transform(slice(h, 1, greatest(size(h) - {width - 1}, 0)), (x, i) -> xxhash64({window}))")
    return hashed.select("id", F.posexplode(made).alias("doc_at", "hash"))


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows (item_id, form, width, at, hash, words, t, item_v): windows of the items; of items of few words, the whole item.

    Items of under twice the width and a word have shorter windows, so that one edited word leaves some. Form 1 has the first word as a name.
    """
    words = templated(benchmark, "item_id", True).filter(F.size("t") > 0)
    plain = F.col("t")[0].rlike("^\\p{L}")
    named = words.filter(plain).select(
        "id", F.expr(f"concat(array('{NAME}'), slice(t, 2, size(t)))").alias("t"), F.expr(f"concat(array('{NAME}' || t[0]), slice(coalesce(v, t), 2, size(t)))").alias("v")
    )
    words = words.select("id", "t", "v", F.lit(0).alias("form")).unionByName(named.withColumn("form", F.lit(1)))
    own = F.when(F.size("t") <= width, F.size("t")).otherwise(F.least(F.lit(width), F.greatest(F.lit(5), F.floor((F.size("t") - 1) / 2))))
    size = words.select("id", "form", "t", "v", own.cast("int").alias("width"))
    hashed = size.select("*", once(F.expr("transform(t, x -> xxhash64(x))")).alias("h"))
    # A hash of the words' hashes, one by one, as for the documents.
    cases = " ".join(f"WHEN {k} THEN xxhash64({', '.join(f'h[i + {j}]' for j in range(k))})" for k in range(1, width + 1))
    made = F.expr(f"transform(slice(h, 1, size(h) - width + 1), (x, i) -> CASE width {cases} END)")
    out = hashed.select("id", "form", "t", "v", "width", F.size("t").alias("words"), F.posexplode(made).alias("at", "hash"))
    # The forms differ in the first window only.
    out = out.filter("form = 0 OR at = 0")
    part = [F.expr(f"slice({c}, at + 1, width)").alias(n) for c, n in (("t", "t"), ("v", "item_v"))]
    return cut(out.select(F.col("id").alias("item_id"), "form", "width", "at", "hash", "words", *part).distinct())


def _sent(frame: DataFrame) -> DataFrame:
    """The frame, marked for sending to every executor if it is small."""
    return F.broadcast(frame) if at_most(frame, BROADCAST_ROWS) else frame


def occurrences(hits: DataFrame) -> DataFrame:
    """``hits`` with ``occurrence``: a number for those of a document and item that are aligned and follow one another.

    Of the item's windows with equal words, each place of the document keeps the one whose offset has the most hits.
    """
    pair = "PARTITION BY doc_id, item_id"
    hits = hits.withColumn("offset", F.col("doc_at") - F.col("at"))
    hits = hits.withColumn("n", F.expr(f"count(*) OVER ({pair}, offset)"))
    one = hits.withColumn("k", F.expr(f"row_number() OVER ({pair}, doc_at ORDER BY n DESC, offset, form)")).filter("k = 1").drop("n", "k")
    steps = one.withColumn("s", F.expr(f"IF(offset - lag(offset) OVER ({pair} ORDER BY offset, doc_at) > {SHIFT}, 1, 0)"))
    bands = steps.withColumn("band", F.expr(f"sum(s) OVER ({pair} ORDER BY offset, doc_at ROWS UNBOUNDED PRECEDING)"))
    along = f"{pair}, band ORDER BY doc_at"
    far = f"doc_at - lag(doc_at) OVER ({along}) > {GAP} OR abs(offset - lag(offset) OVER ({along})) > {SHIFT}"
    breaks = bands.withColumn("s", F.expr(f"IF({far}, 1, 0)"))
    return breaks.withColumn("occurrence", F.expr(f"struct(band, sum(s) OVER ({along} ROWS UNBOUNDED PRECEDING) AS part)")).drop("s", "band", "offset")


def _covered(found: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id, occurrence, n_windows, coverage) of occurrences that cover enough of their item."""
    key = ["doc_id", "item_id", "occurrence"]
    # At most as many places as the item has words.
    ats = found.groupBy(*key, "words", "width").agg(F.array_sort(F.collect_set("at")).alias("ats"))
    more = "x + width - greatest(x, c.e)"
    run = f"IF(x > c.e + {EDITED}, width, c.r + {more})"
    seen = F.expr(
        f"aggregate(ats, struct(-{EDITED + 1} AS e, 0 AS n, 0 AS r, 0 AS best), (c, x) -> struct(x + width AS e, c.n + {more} AS n,"
        f" {run} AS r, greatest(c.best, {run}) AS best))"
    )
    ats = ats.select(*key, "words", F.size("ats").cast("long").alias("n_windows"), once(seen).alias("c"))
    share = f"c.n >= {COVERAGE} * words AND c.n >= least(words, {LEAST_WORDS})"
    return ats.filter(f"({share}) OR c.best >= {STRETCH}").select(*key, "n_windows", F.expr("round(c.n / words, 6)").alias("coverage"))


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows (doc_id, item_id, n_windows, coverage, kind) of items found in documents; kind is verbatim or parameters.

    Of the occurrences of an item that count, the row is of a verbatim one if there is one, and of the one that covers most.
    ``n_windows`` counts its windows, ``coverage`` is the share of the item's words in them. Values are looked up in a
    second pass over the documents that hold an item, as few windows of the first pass need them.
    """
    items = item_windows(benchmark, width)
    words = templated(docs, "doc_id", False)
    hits = None
    for (k,) in sorted(items.select("width").distinct().collect()) or [(width,)]:
        own = _sent(items.filter(F.col("width") == k).select("hash", "item_id", "form", "width", "at", "words"))
        found = windows(words, k).join(own, "hash").drop("hash")
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.withColumnRenamed("id", "doc_id").filter("doc_id IS NOT NULL").distinct()
    key = ["doc_id", "item_id", "occurrence"]
    hits = cut(occurrences(hits))
    covered = cut(_covered(hits))
    hits = hits.join(covered.select(*key), key, "left_semi")

    found = _sent(covered.select("doc_id").distinct())
    values = templated(docs.join(found, "doc_id", "left_semi").select("doc_id", "text"), "doc_id", True).filter("v IS NOT NULL")
    opened = values.join(hits, values["id"] == hits["doc_id"]).select(*key, "at", "form", F.expr("slice(v, doc_at + 1, width)").alias("v"))
    item_side = items.filter("item_v IS NOT NULL").select("item_id", "at", "form", "t", "item_v")
    zipped = F.expr(f"filter(arrays_zip(t, item_v, v), x -> x.t RLIKE '[{MARKS}]')")
    pairs = opened.join(item_side, ["item_id", "at", "form"]).select(*key, F.explode(zipped).alias("s")).select(*key, "s.*")
    seen = pairs.groupBy(*key, "t", "item_v").agg(F.min("v").alias("least"), F.max("v").alias("most"))
    slots = seen.groupBy(*key).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("least") == F.col("most")).alias("same"),
        F.count_if((F.col("least") == F.col("item_v")) & (F.col("most") == F.col("item_v"))).alias("equal"),
    )
    n, same, equal = (F.coalesce(c, F.lit(0)) for c in ("n", "same", "equal"))
    good = covered.join(slots, key, "left").filter(same >= CONSISTENT * n)
    best = good.groupBy("doc_id", "item_id").agg(F.max(F.struct((equal == n).alias("verbatim"), "coverage", "n_windows")).alias("b"))
    kind = F.when(F.col("b.verbatim"), "verbatim").otherwise("parameters")
    return best.select("doc_id", "item_id", "b.n_windows", "b.coverage", kind.alias("kind"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document holds no item; rows without an id stay."""
    bad = cut(leaks(docs, benchmark).select(F.col("doc_id").alias("_bad")).distinct())
    return docs.join(_sent(bad), docs["doc_id"] == bad["_bad"], "left_anti")
