"""The registered queries of this package: thin calls of the operators over whole tables."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import (
    decontaminate,
    extract,
    packing,
    phrases,
    pii,
    quality,
    reshard,
    revisits,
    rotated,
    runs,
    simhash,
    toxicity,
    urls,
)
from changeflow.llm.common import table
from changeflow.plans.registry import Query

QUERIES: dict[str, Query] = {}

TOKENIZER = "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = Query(name, build, sql)
        return build

    return register


@query("op1_decontaminate")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op3_pack")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


@query("op6_pii")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op8_simhash")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    fingerprint = F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0"))
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


@query("op10_quality")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.quality_report(table(spark, folder, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept", F.round("quality", 4).alias("quality"), "votes")


# The rules of the query.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
_HOST = "translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '')"
_FITS = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in URL_RULES]
_LONGEST = sorted(range(len(URL_RULES)), key=lambda k: -len(URL_RULES[k][0] + URL_RULES[k][1]))


@query(
    "op2_url_filter",
    f"""
    SELECT page_id, host, path,
           CASE {" ".join(f"WHEN {_FITS[k]} THEN '{URL_RULES[k][0] + URL_RULES[k][1]}'" for k in _LONGEST)} END AS rule,
           CASE {" ".join(f"WHEN {_FITS[k]} THEN '{URL_RULES[k][2]}'" for k in _LONGEST)} ELSE 'allow' END AS verdict
    FROM (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages) parts
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return urls.judge(table(spark, folder, "pages"), rules)


@query("op4_toxicity")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def captures(pages: DataFrame) -> DataFrame:
    """Archive records derived from pages: the captures of a section of a site are versions of one URL.

    Every fourth capture by hash is a full response, the others are revisits; a version lasts 500 pages, and some answers leave
    the validator out.
    """
    version = F.floor(F.col("page_id") / 500).cast("string")
    turn = F.pmod(F.conv(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 4), 16, 10).cast("int"), F.lit(4))
    full = turn == 0
    # The path's first part stands for the section; scheme, fragment and fields differ between captures.
    section = F.regexp_replace(F.col("url"), "(://[^/?#]*/[^/?#]*)[^?#]*", "$1")
    etag = F.when(F.pmod("page_id", F.lit(11)) != 0, F.concat(F.lit('"v'), version, F.lit('"')))
    fields = {
        "date": F.col("page_id").cast("string"),
        "cache-control": F.concat(F.lit("max-age="), turn.cast("string")),
        "content-type": F.when(full, "text/html"),
        "content-length": F.when(full, F.octet_length("html").cast("string")).otherwise("0"),
        "etag": etag,
    }
    headers = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v)])
    return pages.select(
        F.col("page_id").alias("record_id"),
        F.when(full, "response").otherwise("revisit").alias("kind"),
        section.alias("url"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60).alias("ts"),
        F.map_filter(headers, lambda k, v: v.isNotNull()).alias("headers"),
        F.when(full, F.octet_length("html")).cast("long").alias("body_bytes"),
    )


@query(
    "op5_revisits",
    """
    WITH r AS (
        SELECT page_id AS record_id, page_id // 500 AS version, page_id % 11 <> 0 AS tagged,
               concat('max-age=', r.turn) AS cache, r.turn = 0 AS full_, strlen(html) AS bytes,
               regexp_extract(url, '://(?:www[.])?([^/?#]*/[^/?#]*)', 1) AS section,
               array_to_string(list_sort([x FOR x IN string_split(regexp_replace(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1),
                   '(?:^|&)(?:utm_[a-z]+|ref)=[^&]*', '', 'g'), '&') IF x <> '']), '&') AS fields
        FROM (SELECT *, CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 4) AS INTEGER) % 4 AS turn FROM pages) r
    ), u AS (
        SELECT *, CASE WHEN fields = '' THEN rtrim(section, '/') ELSE rtrim(section, '/') || '?' || fields END AS url FROM r
    ), f AS (SELECT * FROM u WHERE full_)
    SELECT v.record_id, v.url, CASE WHEN v.tagged AND f.tagged AND v.version = f.version THEN f.record_id END AS refers_to,
           CASE WHEN f.record_id IS NULL THEN 'missing' WHEN v.tagged AND f.tagged AND v.version <> f.version THEN 'changed'
                WHEN NOT (v.tagged AND f.tagged) THEN 'unchecked' ELSE 'resolved' END AS state,
           CASE WHEN v.tagged AND f.tagged AND v.version = f.version
                THEN concat('cache-control=', v.cache, ';content-length=', f.bytes, ';content-type=text/html;date=', v.record_id,
                            ';etag="v', v.version, '"')
                ELSE concat('cache-control=', v.cache, ';content-length=0;date=', v.record_id,
                            CASE WHEN v.tagged THEN concat(';etag="v', v.version, '"') ELSE '' END) END AS headers,
           CASE WHEN v.tagged AND f.tagged AND v.version = f.version THEN f.bytes END AS body_bytes
    FROM (SELECT * FROM u WHERE NOT full_) v ASOF LEFT JOIN f ON v.url = f.url AND v.record_id > f.record_id
    """,
)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = revisits.resolve(captures(table(spark, folder, "pages")))
    pairs = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("headers", F.array_join(pairs, ";"))


@query("op7_reshard")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """The old layout has a shard for each source, so its sizes are as uneven as the sources."""
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(24))
    found = reshard.reshard(table(spark, folder, "documents"), old, 24)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old"
    )


@query("op9_main_text")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract(table(spark, folder, "pages"))


@query(
    "op11_inner_product",
    """
    WITH v AS (
        SELECT vec_id, min(embedding::DOUBLE[]) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        GROUP BY vec_id
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda x, y: x + y) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
        WHERE q.vec_id % 20 = 0
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM s QUALIFY rank <= 20
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return rotated.nearest(table(spark, folder, "embeddings"), F.pmod("id", F.lit(20)) == 0)


def repeated_tail(doc_id: int | None, text: str | None) -> list[bytes]:
    """Words of a text; those of every tenth id by checksum repeat a stretch from some word on."""
    words = runs.words_of(doc_id, text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@query("op12_periodic_runs")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, folder, "documents"), repeated_tail)
    longest = "array_min(transform(runs, r -> named_struct('l', -r.length, 'start', r.start, 'period', r.period)))"
    lines = "array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), '')"
    return found.withColumn("longest", F.expr(longest)).selectExpr(
        "doc_id",
        "CAST(size(runs) AS BIGINT) AS n_runs",
        "longest.start AS start",
        "-longest.l AS length",
        "longest.period AS period",
        "(-1000 * longest.l) DIV longest.period AS exponent_milli",
        f"sha2({lines}, 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


COLLOCATIONS = """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), w AS (
        SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces
    ), g AS (
        SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS phrase
        FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k
    ), totals AS (
        SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang
    ), f AS (
        SELECT lang, phrase, k, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100 /*support*/
    ), wider AS (
        SELECT lang, part, max(a) AS a FROM (
            SELECT lang, a, unnest([regexp_extract(phrase, '^(.*) [^ ]+$', 1), regexp_extract(phrase, '^[^ ]+ (.*)$', 1)]) AS part
            FROM f WHERE k > 2) GROUP BY lang, part
    ), c AS (
        SELECT f.lang, f.phrase, f.a, f.k, string_split(f.phrase, ' ') AS ws
        FROM f LEFT JOIN wider ON f.lang = wider.lang AND f.phrase = wider.part
        WHERE f.k > 1 AND (wider.a IS NULL OR 100 * wider.a < 100 * f.a)
    ), cuts AS (
        SELECT c.*, j, array_to_string(ws[1:j], ' ') AS lp, array_to_string(ws[j + 1 :], ' ') AS rp
        FROM c, (SELECT unnest([1, 2, 3, 4]) AS j) WHERE j < k
    ), scored AS (
        SELECT cuts.lang, cuts.phrase, cuts.a, cuts.j, x.a AS l, y.a AS r, totals.n,
               CAST((1000::HUGEINT * cuts.a * totals.n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
        FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp JOIN f y ON y.lang = cuts.lang AND y.phrase = rp
        JOIN totals ON totals.lang = cuts.lang
    ), least AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM least QUALIFY rank <= 2000
"""


@query("op13_collocations", COLLOCATIONS)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))
