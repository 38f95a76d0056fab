"""Resolution of not-modified revisits in web archives.

A revisit record stands for a response whose body was not stored again because the server answered that nothing had changed.
It is joined as of its time with the latest earlier full response for the same canonical URL. It is resolved if no validator
the two share differs and they share one; then the response's headers are kept, with those replaced that a not-modified
answer may change.

Rows of a URL are taken in pieces of time: the last response inside a piece is found by a window, and the last one of earlier
pieces comes from one row a piece, so a URL that most captures share is spread over its pieces.

Null URLs match nothing; records without a time are unresolved. Of records at the same time the one with the larger id is
later. Repeated rows are resolved row by row. Empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Header fields that a 304 answer updates in a stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical(url: Column) -> Column:
    """Host in lower case without ``www.`` and default ports, path without a closing slash, no fragment, no tracking fields."""
    bare = F.regexp_replace(F.regexp_replace(url, "(?s)#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), "^www[.]|:(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "(?s)^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_replace(F.regexp_extract(bare, "(?s)^[^?]*[?](.*)$", 1), "(?:^|&)(?:utm_[a-z]+|ref)=[^&]*", "")
    query = F.array_join(F.array_sort(F.array_remove(F.split(query, "&"), "")), "&")
    return F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def resolve(records: DataFrame, piece: str = "day") -> DataFrame:
    """Rows (record_id, url, refers_to, state, headers, body_bytes) for each revisit record.

    ``records`` has record_id, kind (response or revisit), url, ts, headers (a map with names in lower case) and body_bytes.
    ``state`` is resolved, changed (a validator differs), unchecked (no validator in common) or missing (no response).
    """
    own = records.select("record_id", "kind", canonical(F.col("url")).alias("url"), "ts", "headers", "body_bytes")
    own = own.withColumn("piece", F.date_trunc(piece, F.col("ts")))
    full = F.when((F.col("kind") == "response") & F.col("url").isNotNull() & F.col("ts").isNotNull(), F.struct("ts", "record_id", "headers", "body_bytes"))
    own = own.withColumn("full", full)
    inside = own.withColumn(
        "near", F.expr("last(full, true) OVER (PARTITION BY url, piece ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    ).filter("kind = 'revisit'")
    pieces = own.groupBy("url", "piece").agg(F.expr("max_by(full, struct(full.ts, full.record_id)) FILTER (WHERE full IS NOT NULL)").alias("end"))
    earlier = pieces.select(
        "url", "piece", F.expr("last(end, true) OVER (PARTITION BY url ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)").alias("far")
    )
    met = inside.join(earlier, ["url", "piece"], "left").withColumn("found", F.when(F.col("ts").isNotNull(), F.coalesce("near", "far")))

    def shared(name: str) -> tuple[Column, Column]:
        mine, theirs = F.col("headers")[name], F.col("found.headers")[name]
        return mine.isNotNull() & theirs.isNotNull(), F.coalesce(mine == theirs, F.lit(True))

    checks = [shared("etag"), shared("last-modified")]
    state = (
        F.when(F.col("found").isNull(), "missing")
        .when(~(checks[0][1] & checks[1][1]), "changed")
        .when(~(checks[0][0] | checks[1][0]), "unchecked")
        .otherwise("resolved")
    )
    met = met.withColumn("state", state)
    good = F.col("state") == "resolved"
    allowed = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*PERMITTED))
    stored = F.map_filter(F.col("found.headers"), lambda k, v: ~F.map_contains_key(allowed, k))
    return met.select(
        "record_id",
        "url",
        F.when(good, F.col("found.record_id")).alias("refers_to"),
        "state",
        F.when(good, F.map_concat(stored, allowed)).otherwise(F.col("headers")).alias("headers"),
        F.when(good, F.col("found.body_bytes")).alias("body_bytes"),
    )
