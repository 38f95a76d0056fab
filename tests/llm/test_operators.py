"""Each operator against a plain Python version, and on nulls, empty tables, repeated rows and clashing columns."""

from __future__ import annotations

import html
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from changeflow.llm import decontaminate, extract, packing, pii, quality, queries, reshard, revisits, simhash, toxicity, urls
from changeflow.llm.common import table
from changeflow.llm.components import components

TOKENIZER = public_tokenizers.path(queries.TOKENIZER)
EXTRA = "words string, row int, t string, cell string, kept boolean, hash long"


@pytest.fixture(scope="module")
def docs(spark, small):
    return table(spark, small, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns of names that operators use."""
    long_text = " ".join(f"word{k % 977} of the" for k in range(40_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4), (4, long_text, "en", "s", 9), (4, long_text, "en", "s", 9), (None, "the end of it", None, None, None), (6, "12 " * 9000, "en", "s", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, kind in (c.split() for c in EXTRA.split(", ")):
        frame = frame.withColumn(name, F.lit(None).cast(kind))
    return frame


def empty(frame):
    return frame.limit(0)


def words(text):
    return [w for w in re.split("[ \t-\r]+", text) if w]


def test_quality_counts(spark, docs, texts):
    for r in quality.quality_report(docs).collect():
        text = texts[r["doc_id"]]
        w = words(text)
        grams = Counter(zip(w, w[1:], w[2:]))
        at = {k + d for k, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(at))
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (len(w) < 50 or 100 * len(at) > 50 * len(w)) and not (r["base_failed"] and r["kept"])


def test_quality_follows_labels(spark, docs, small):
    labels = table(spark, small, "labels").withColumnRenamed("quality", "label")
    both = quality.quality_report(docs).filter("NOT base_failed").join(labels, "doc_id")
    assert both.filter("kept = (label = 1)").count() >= 0.9 * both.count()


def test_label_model_weighs_rules():
    model = quality.fit_label_model({"gg": 900, "bb": 90, "gb": 8, "bg": 2}, rules=2)
    assert model.weights[0]["b"] < 0 < model.weights[0]["g"] and 0.8 < model.prior < 0.97


def fingerprint(text):
    w = text.encode().lower().split()
    grams = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, texts):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(docs, simhash.Settings(tile=8)).collect()}
    some = sorted(texts, key=lambda d: len(texts[d]))[:120]
    for d in some:
        assert rows[d]["fp"][0] & (2**64 - 1) == fingerprint(texts[d])
    ids = sorted(texts)
    prints = np.array([rows[d]["fp"][0] for d in ids]).view(np.uint64)
    least = {d: d for d in ids}
    near = np.argwhere(np.bitwise_count(prints[:, None] ^ prints[None]) <= 3)
    for _ in ids:
        before = dict(least)
        for i, j in near:
            least[ids[i]] = least[ids[j]] = min(least[ids[i]], least[ids[j]])
        if least == before:
            break
    assert {d: r["component_id"] for d, r in rows.items()} == least


def test_simhash_chain_over_tiles(spark):
    fps = [(k, [(1 << k) - 1], 0) for k in range(60)]
    entries = spark.createDataFrame(fps, "id long, fp array<long>, band int")
    got = components(simhash.links(entries, simhash.Settings(tile=2, radius=1))).collect()
    assert {r["node"]: r["least"] for r in got} == {k: 0 for k in range(60)}


def test_components(spark):
    edges = [(k, k + 1) for k in range(20)] + [(30, 31), (31, 31), (31, 30)]
    got = {r["node"]: r["least"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(21)}, 30: 30, 31: 30}


def test_decontaminate_finds_passages(spark, docs, texts, small):
    bench = {r["item_id"]: r["text"] for r in table(spark, small, "benchmark").collect()}
    plain = {d: f" {' '.join(re.findall(r'\w+', t.lower()))} " for d, t in texts.items()}
    want = {(d, i) for d, t in plain.items() for i, b in bench.items() if f" {' '.join(re.findall(r'\w+', b.lower()))} " in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, table(spark, small, "benchmark")).collect()}
    assert want == got and want


def test_decontaminate_slots(spark):
    item = "if a farmer called Bob sells 12 kg of ripe apples to Mary and Bob keeps 3.5 kg of them how many are left"
    other = item.replace("Bob", "Carl").replace("12", "40").replace("3.5", "7").replace("kg", "lb")
    mixed = item.replace("Bob sells", "Carl sells").replace("Bob keeps", "Dave keeps").replace("12", "40")
    rows = [(1, "we read " + item + " today"), (2, other), (3, mixed.replace("Mary", "Ann")), (4, "short words"), (5, None)]
    bench = spark.createDataFrame([(7, item), (8, "Short words"), (9, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got[1, 7] == "verbatim" and got[2, 7] == "parameters" and got[4, 8] == "verbatim" and (5, 7) not in got


def luhn(digits):
    return sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) < 256 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out)


def test_pii_base_spans(spark, docs, texts):
    own = [(-1, "a@b.c.@d.e x.y@z 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4"), (-2, "é🙂 +1 (222) 333-4444 1.2.3.4 4111 1111-1111 1111 9" + "9" * 30), (-3, "+12345 @ [at] 4111111111111111,")]
    extra = spark.createDataFrame(own, "doc_id long, text string")
    want = {**texts, **dict(own)}
    for r in pii.find(docs.select("doc_id", "text").unionByName(extra)).collect():
        assert r["base"] == base_spans(want[r["doc_id"]])
        assert set(filter(None, r["base"].split(","))) <= set(r["spans"].split(","))


def test_pii_redacts(docs, texts):
    for r in pii.redact(docs).collect():
        assert base_spans(r["text"]) == "" or base_spans(texts[r["doc_id"]]) != ""
        if not base_spans(texts[r["doc_id"]]):
            assert r["text"] == texts[r["doc_id"]]
        assert "@mail" not in r["text"]


def test_boosting_learns():
    cells = [(dict.fromkeys(["kind", *pii.NAMES], 0) | {"kind": k, "plus": p}, 100, 95 if k and p else 2) for k, p in itertools.product((0, 1), (0, 1))]
    start, trees = pii.boost(cells)
    model = pii.Boosted(start, trees, {})
    assert all((model.score_row(x) > 0) == (y > 50) for x, _, y in cells)


def test_packing_round_trip(docs, texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, TOKENIZER).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for d, text in texts.items():
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    sizes = []
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        sizes.append(at)
    assert max(sizes) <= 2048 and sum(2048 - s for s in sizes) < 2048


@pytest.mark.parametrize("histogram", [{}, {1: 5}, {2047: 3, 1: 3}, {1500: 7, 700: 9, 3: 1}, {k: 2048 - k for k in range(1, 2048, 37)}])
def test_shortest_pack_first(histogram):
    packs, placed = packing.shortest_pack_first(histogram)
    assert packs == -(-sum(k * n for k, n in histogram.items()) // 2048)
    used, tokens = defaultdict(set), Counter()
    for p in placed:
        for rank in range(p.low, p.high):
            span = set(range(p.offset, p.offset + p.size))
            assert not span & used[p.first + rank - p.low] and max(span) < 2048
            used[p.first + rank - p.low] |= span
            tokens[p.length, rank] += p.size
    assert tokens == Counter({(k, r): k for k, n in histogram.items() for r in range(n)})


def test_tokenizer_equals_whole_texts():
    own = packing.WordTokenizer(TOKENIZER)
    for text in ("", "don't I'LL 'S x_y", "naïve ΑΣ Σ", "<|endoftext|>a", "a\x1cb", "½ 12ab3", "日本🙂", "İ ß ﬁ", "a̸ b"):
        assert own(text) == own.encode(text)


def test_url_rules_against_scan(spark):
    hosts = ["a.com", "b.a.com", "x.b.a.com", "ab.com", "com", "", "A.COM"]
    pages = [(k, f"http://{h}{p}") for k, (h, p) in enumerate(itertools.product(hosts, ["", "/", "/x", "/x/y", "/xy", "?q", "/x#z"]))] + [(900, None), (901, "no url"), (902, "http://a.com/x"), (902, "http://a.com/x")]
    rules = [("com", "/", "block"), ("a.com", "/x", "allow"), ("b.a.com", "/x/", "block"), ("a.com", "/x/y", "allow"), ("b.com", "/", "block")]
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(pages)
    for r in got:
        fit = [(len(h + p), h + p, v) for h, p, v in rules if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        best = max(fit) if fit else (0, None, "allow")
        assert (r["rule"], r["verdict"]) == best[1:], r


def test_revisits_as_of(spark, small):
    records = queries.captures(table(spark, small, "pages"))
    rows = records.withColumn("canonical", revisits.canonical(F.col("url"))).collect()
    full = defaultdict(list)
    for r in rows:
        if r["kind"] == "response":
            full[r["canonical"]].append(r)
    got = {r["record_id"]: r for r in revisits.resolve(records, "hour").collect()}
    for r in (r for r in rows if r["kind"] == "revisit"):
        before = [x for x in full[r["canonical"]] if (x["ts"], x["record_id"]) < (r["ts"], r["record_id"])]
        found = max(before, key=lambda x: (x["ts"], x["record_id"])) if before else None
        same = found and found["headers"].get("etag") == r["headers"].get("etag") is not None
        assert (got[r["record_id"]]["refers_to"] is not None) == bool(same)
        if same:
            assert got[r["record_id"]]["refers_to"] == found["record_id"]
            assert got[r["record_id"]]["headers"]["content-length"] == found["headers"]["content-length"]
            assert got[r["record_id"]]["headers"]["date"] == r["headers"]["date"]


@pytest.mark.parametrize("supply,capacity", [([30, 0, 0], [10, 10, 10]), ([7, 9, 2, 4], [6, 6, 10]), ([5], [2, 2, 1])])
def test_flow_moves_least(supply, capacity):
    cost = [[int(i != j) for j in range(len(capacity))] for i in range(len(supply))]
    flow = reshard.min_cost_flow(supply, capacity, cost)
    assert [sum(r) for r in flow] == supply and all(sum(c) <= k for c, k in zip(zip(*flow), capacity))
    stay = sum(min(s, capacity[i] if i < len(capacity) else 0) for i, s in enumerate(supply))
    assert sum(supply) - sum(flow[i][i] for i in range(min(len(supply), len(capacity)))) == sum(supply) - stay


def test_reshard_and_rewrite(spark, docs, texts, tmp_path):
    old = F.pmod(F.col("doc_id"), F.lit(3))
    got = reshard.reshard(docs, old, 4, blocks=4)
    rows = got.collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        text = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.1 * sum(sizes.values()) / 4
    folder = str(tmp_path / "shards")
    docs.withColumn("shard", old).write.partitionBy("shard").parquet(folder)
    reshard.rewrite(got, docs, folder)
    assert {(r["doc_id"], r["shard"]) for r in spark.read.parquet(folder).collect()} == {(r["doc_id"], r["shard"]) for r in rows}


def test_nearest_equals_full_scan():
    rng = np.random.default_rng(1)
    draw = lambda: {int(t): int(rng.integers(1, 4)) for t in set(rng.integers(0, 30, 4))}
    examples = [(k, int(rng.integers(0, 2)), draw()) for k in range(400)]
    idf = rng.random(30) + 0.5
    index = toxicity.Index.build(examples, idf)
    by_id = {i: c for i, _, c in examples}
    for _ in range(50):
        query = draw()
        q = toxicity.unit(query, idf)
        sims = sorted((round(sum(w * toxicity.unit(by_id[i], idf).get(t, 0) for t, w in q.items()), 6) for i in by_id), reverse=True)
        assert [round(s, 6) for s, _ in index.nearest(query, 8)] == [s for s in sims[:8] if s > 0]


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    scored = toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    both = scored.join(table(spark, folder, "labels"), "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in both) >= 0.93 * len(both)
    assert all(0 <= r["score"] <= 1 for r in both)


def test_extract_articles(spark, small):
    pages = table(spark, small, "pages")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in extract.extract(pages).collect():
        inner = source[r["page_id"]].split("<article>")[1].split("</article>")[0].split("<footer>")[0].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("</?b>", "", p)).split()) for p in re.split("</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


def test_extract_without_article():
    menu = " ".join(f"menu{k}" for k in range(20))
    pages = [f"<body><div>{menu} <p>own{k} text &amp; more<div class='comments'>hi</div><aside>x</aside></body>" for k in range(4)]
    assert extract.main_texts(pages, list("abcd")) == [f"own{k} text & more" for k in range(4)]
    assert extract.main_texts(pages[:2], list("ab"))[0].startswith("menu0")
    assert extract.main_texts(["", "<p", "<article><header><h1>T</h1></header>a<br>b<!-- c --><script>x</script></article>"], [None] * 3) == ["", "<p", "T\na b"]


def test_boilerplate_does_not_depend_on_the_parts_of_a_host(spark, monkeypatch):
    menu = " ".join(f"menu{k}" for k in range(20))
    rows = [(k, f"http://h.org/{k}", f"<body><div>{menu}</div><p>own{k} text</body>") for k in range(9)]
    rows += [(20 + k, None if k else "http://i.org/", f"<body>{menu}<p>one of few {k}</body>") for k in range(3)]
    rows += [(30, "http://h.org/x", f"<article>{menu}</article>{menu}")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = sorted((r["page_id"], r["text"]) for r in extract.extract(pages).collect())
    assert whole[:9] == [(k, f"own{k} text") for k in range(9)] and whole[-1] == (30, menu)
    monkeypatch.setattr(extract, "PART_BYTES", 250)
    assert sorted((r["page_id"], r["text"]) for r in extract.extract(pages).collect()) == whole


OPERATORS = {
    "quality": lambda s, d: quality.quality_report(d),
    "keep_good": lambda s, d: quality.keep_good(d),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "leaks": lambda s, d: decontaminate.leaks(d, table(s, "/root/testdata/sf0.001", "benchmark")),
    "pii": lambda s, d: pii.find(d),
    "redact": lambda s, d: pii.redact(d),
    "pack": lambda s, d: packing.pack(d, TOKENIZER),
    "reshard": lambda s, d: reshard.reshard(d, F.lit(0), 3),
    "toxicity": lambda s, d: toxicity.scores(d, table(s, "/root/testdata/sf0.001", "labels")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_documents(spark, name):
    odd = odd_docs(spark)
    got = OPERATORS[name](spark, odd).collect()
    if name in ("quality", "simhash", "pii", "redact", "reshard", "toxicity"):
        assert len(got) == odd.count()
    assert OPERATORS[name](spark, empty(odd)).collect() == []


def test_odd_pages(spark):
    rows = [(1, None, None), (None, "http://a.b/c", "<p>x"), (2, "http://a.b/c", ""), (2, "http://a.b/c", ""), (3, "x", "<" * 5000)]
    rows += [(4, "x", open_tag * 200_000) for open_tag in ("<a ", "<script ", "<!", '<a "')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("t"))
    assert extract.extract(pages).count() == len(rows) and extract.extract(empty(pages)).count() == 0
    rules = spark.createDataFrame(list(queries.URL_RULES), "host string, path string, verdict string")
    assert urls.judge(pages, rules).count() == len(rows) and urls.judge(empty(pages), rules).count() == 0
    assert {r["verdict"] for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}
