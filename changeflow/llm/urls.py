"""URL filters by a sort-merge range join.

A rule (host, path) fits its host and all subdomains if the path starts with the rule's. With the labels of a host in reverse, a
rule is one prefix of a key, hence one interval of sorted keys, and rules nest like their prefixes. A URL has one key for
each of its host's suffixes. Rules and keys are sorted together; the last rule begun before a key carries the stack of the
rules around it, and those of the stack that the key still starts with are active. The longest one wins.

Null URLs and URLs without ``://`` have an empty host and path and get the default. Equal URLs are judged once and joined back, so
repeated rows stay. Of two rules for the same prefix the blocking one counts. Empty tables give no rows, no rules the default for
all. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"
REVERSED = "array_join(reverse(split({0}, '[.]')), '.')"


def with_parts(pages: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    return pages.select("page_id", F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER).alias("host"), F.regexp_extract(url, PARTS, 2).alias("path"))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Rows (key, stack): each rule's interval starts at its key; the stack holds it and the rules around it, outer first."""
    keyed = rules.selectExpr(
        f"concat({REVERSED.format('host')}, '.', path) AS key", "concat(host, path) AS rule", "length(host) AS host_length", "verdict"
    ).groupBy("key").agg(F.max_by("rule", "verdict").alias("rule"), F.max("host_length").alias("host_length"), F.max("verdict").alias("verdict"))
    entry = F.struct(F.length("key").alias("size"), "host_length", "key", "rule", "verdict")
    outer = keyed.select(F.col("key").alias("prefix"), entry.alias("entry"))
    prefixes = keyed.select("key", F.explode(F.expr("transform(sequence(1, length(key)), n -> substr(key, 1, n))")).alias("prefix"))
    return prefixes.join(outer, "prefix").groupBy("key").agg(F.sort_array(F.collect_list("entry")).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Rows (page_id, host, path, rule, verdict) for each row of ``pages``; ``rules`` has host, path and verdict."""
    parts = with_parts(pages)
    urls = parts.select("host", "path").distinct()
    keys = urls.withColumn("labels", F.expr("reverse(split(host, '[.]'))")).select(
        "host", "path",
        F.explode(F.expr("transform(sequence(1, size(labels)), n -> concat(array_join(slice(labels, 1, n), '.'), '.', path))")).alias("key"),
    )
    stacks = rule_stacks(rules).select("key", F.lit(0).alias("side"), F.lit(0).cast("long").alias("tie"), F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "stack")
    points = keys.select("key", F.lit(1).alias("side"), F.xxhash64("host", "path").alias("tie"), "host", "path", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"))
    slices = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once, so that the slice of a row stays what it was when its neighbours were counted.
    swept = cut(stacks.unionByName(points).repartitionByRange(slices, "key", "side", "tie").withColumn("slice", F.spark_partition_id()))
    own = swept.withColumn("open", F.expr("last(stack, true) OVER (PARTITION BY slice ORDER BY key, side, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
    # One row a slice: what the slices before it left open.
    ends = swept.groupBy("slice").agg(F.expr("max_by(stack, key) FILTER (WHERE side = 0)").alias("stack"))
    carried = ends.withColumn("carried", F.expr("last(stack, true) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"))
    met = own.filter("side = 1").join(carried.select("slice", "carried"), "slice").select(
        "host", "path", F.expr("filter(coalesce(open, carried), x -> startswith(key, x.key))").alias("active")
    )
    best = met.filter("size(active) > 0").select("host", "path", F.element_at("active", -1).alias("best")).groupBy("host", "path").agg(F.max("best").alias("best"))
    return parts.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
