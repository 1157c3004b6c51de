import gzip
import json
import random
import time
import zlib

import numpy as np
import pytest

from tideglass.llm import decontamination, warc
from tideglass.llm.decontamination import Items, Latent, lcs


def test_records_round_trip():
    records = [warc.Record([("WARC-Type", "x"), ("A", "ü"), ("Content-Length", "99")], b"a\r\n\r\nWARC/1.0 b"), warc.Record([("WARC-Type", "y")], b"")]
    for compress in (True, False):
        back = list(warc.parsed(warc.written(records, compress)))
        assert [r.block for r in back] == [r.block for r in records]
        assert back[0].get("a") == "ü" and back[0].get("content-length") == str(len(records[0].block)) and not back[0].faults


@pytest.mark.parametrize("cut", [1, 30, 120, 200])
def test_truncated_files_give_faults(cut):
    data = warc.written([warc.response_of("http://x/", "<p>hello</p>" * 20, "1")], False)
    got = list(warc.parsed(data[:-cut]))
    assert got and (cut <= 4 or got[0].faults)
    list(warc.parsed(warc.written([warc.response_of("http://x/", "<p>a</p>", "1")])[:-cut]))


def test_derivatives_refer_to_their_source():
    source = warc.response_of("http://x/", "<title>T</title><script>no</script><p>Hello &amp; <b>you</b></p><a href='/a'>A</a>", "1")
    meta, text = warc.derivatives(source)
    assert meta.get("WARC-Refers-To") == text.get("WARC-Refers-To") == source.get("WARC-Record-ID")
    assert meta.get("WARC-Concurrent-To") == text.get("WARC-Record-ID") and text.get("WARC-Target-URI") == "http://x/"
    assert text.block.decode() == "T\nHello & you\nA" and text.get("WARC-Block-Digest") == warc.digest(text.block)
    held = json.loads(meta.block)
    assert held["source-headers"] == [list(h) for h in source.headers] and held["payload-digest"] == held["actual-digest"] == source.get("WARC-Payload-Digest")
    assert held["outline"]["title"] == "T" and held["outline"]["links"] == [{"url": "/a", "text": "A"}]
    assert warc.derivatives(warc.Record([("WARC-Type", "request")])) == []


def _conversion(body, *headers):
    meta, text = warc.derivatives(warc.response_of("http://x/", body, "1", headers=[("Content-Type", "text/html"), *headers]) if isinstance(body, str) else _raw(body, headers))
    return text.block.decode(), json.loads(meta.block)["faults"]


def _raw(body, headers):
    block = b"HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n" + body
    return warc.Record([("WARC-Type", "response"), ("WARC-Record-ID", "<a>")], block)


def test_encoded_bodies_are_decoded():
    page = b"<p>hello you</p>" * 500
    chunked = b"".join(b"%x;a=b\r\n%s\r\n" % (len(page[i : i + 700]), page[i : i + 700]) for i in range(0, len(page), 700)) + b"0\r\n\r\n"
    zipped, flat = gzip.compress(page), zlib.compress(page)[2:-4]
    want = "\n".join(["hello you"] * 500)
    te, ce = "Transfer-Encoding", "Content-Encoding"
    assert _conversion(chunked, (te, "chunked")) == (want, [])
    assert _conversion(zipped, (ce, "gzip")) == _conversion(zlib.compress(page), (ce, "deflate")) == _conversion(flat, (ce, "deflate")) == (want, [])
    assert _conversion(b"%x\r\n%s\r\n0\r\n\r\n" % (len(zipped), zipped), (te, "chunked"), (ce, "gzip")) == (want, [])
    assert _conversion(page, (te, "chunked")) == (want, ["no chunks"]) and _conversion(page, (ce, "gzip")) == (want, ["not gzip"])
    assert _conversion(page, (ce, "br"))[1] == ["unread encoding br"] and _conversion(b"", (ce, "gzip")) == ("", [])
    text, faults = _conversion(gzip.compress(random.Random(1).randbytes(20000).hex().encode())[:9000], (ce, "gzip"))
    assert len(text) > 1000 and faults == ["truncated gzip"]
    text, faults = _conversion(chunked[:1000], (te, "chunked"))
    assert text.startswith("hello you") and faults == ["truncated chunk"]


def test_repeated_headers_are_kept(spark):
    record = warc.Record([("WARC-Type", "response"), ("WARC-Record-ID", "<a>"), ("X", "1"), ("X", "2")], b"HTTP/1.1 200 OK\r\n\r\nhi")
    sources = spark.createDataFrame([(1, bytearray(warc.written([record])))], "page_id long, warc binary")
    for r in warc.derived(sources).collect():
        assert [tuple(h) for h in r.source_headers if h.name == "X"] == [("X", "1"), ("X", "2")]


@pytest.mark.parametrize("page", ["<script>", "<a href='x'>", "<a href=x", "<title>", "<", "<!--", "a" * 9, "<meta name", "</a>", "<script"])
def test_a_megabyte_of_anything_takes_linear_time(page):
    began = time.perf_counter()
    source = page * (1_000_000 // len(page))
    for text in (source, source + ">"):
        warc.plain_text(text)
        warc.outline(text)
    assert time.perf_counter() - began < 8


def test_warc_edges(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x</p>", "q"), (1, "http://a/", "<p>x</p>", "q"), (2, None, None, "q"), (None, "u\r\nX: 1", "", "q"), (4, "http://b/", "<p>" + "long " * 50000, "q")], "page_id long, url string, html string, warc string")
    out = warc.derived(warc.responses(pages)).toPandas()
    assert len(out) == 2 * pages.count() and set(out.record_type) == {"metadata", "conversion"}
    assert out[out.page_id == 1].record_id.nunique() == 2
    assert all(list(warc.parsed(bytes(w)))[0].get("WARC-Record-ID") == i for w, i in zip(out.warc, out.record_id, strict=True))
    assert warc.derived(spark.createDataFrame([(1, None), (2, bytearray(b"")), (3, bytearray(b"junk"))], "page_id long, warc binary")).count() == 0
    assert warc.op6_warc  # the query applies this to all pages


def test_warc_query(spark, sf_dir):
    out = warc.op6_warc(spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert out.count() == 2 * n and out.select("record_id").distinct().count() == 2 * n
    assert out.where("record_type = 'conversion'").select("refers_to").exceptAll(out.where("record_type = 'metadata'").select("refers_to")).count() == 0


def test_lcs_equals_the_table():
    rng = random.Random(0)
    for _ in range(200):
        a, b = ([rng.choice(b"abcd").to_bytes() for _ in range(rng.randrange(0, 30))] for _ in range(2))
        masks: dict[bytes, int] = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        assert lcs(masks, b) == t[-1, -1]


def test_basis_equals_numpy_svd(spark):
    rng = random.Random(1)
    words = [f"t{i}" for i in range(30)]
    groups = [rng.sample(words, 6) for _ in range(4)]
    texts = [" ".join(rng.choices(rng.choice(groups), k=20)) for _ in range(200)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    cfg = Latent(dims=30, most_share=1.0)
    items = Items([(0, " ".join(words).encode())], False)
    items.chosen(decontamination._shares(docs, items, cfg), cfg)
    basis = decontamination._basis(docs, items, cfg)
    rows = []
    for t in [*texts, " ".join(words)]:
        v = np.zeros(len(items.terms))
        for w in t.split():
            v[items.terms[w.encode()]] += 1
        v = np.where(v > 0, 1 + np.log(np.maximum(v, 1)), 0) * items.idf
        rows.append(v / np.linalg.norm(v))
    right = np.linalg.svd(np.array(rows))[2]
    for k in range(3):
        assert np.linalg.norm(basis[:, :6].T @ right[k]) > 0.99


def _corpus(rng, n=150):
    words = [f"w{i}" for i in range(3000)]
    text = lambda k: [rng.choice(words) for _ in range(k)]
    items = [text(rng.randrange(15, 60)) for _ in range(12)]
    rows, want = [], set()
    for i in range(n):
        w = text(rng.randrange(20, 400))
        j, kind, at = rng.randrange(12), i % 6, rng.randrange(0, 15)
        item = list(items[j])
        if kind == 1:
            w[at:at] = item
            want.add((i, j))
        elif kind == 2:
            for p in rng.sample(range(len(item) - 12 if len(item) > 24 else 3), max(1, len(item) // 12)):
                item[p] = rng.choice(words)
            w[at:at] = [x.upper() + rng.choice(["", ",", "."]) for x in item]
            want.add((i, j))
        elif kind == 3:
            w[at:at] = item[: len(item) // 4]
        rows.append((i, " ".join(w)))
    return rows, [(j, " ".join(x)) for j, x in enumerate(items)], want


def test_leaks_equal_brute_force(spark):
    rows, items, want = _corpus(random.Random(2))
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}
    assert got == want
    blocks = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench, Latent(block_bytes=800)).collect()}
    assert blocks == want
    kept = {r.doc_id for r in decontamination.clean(docs, bench).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in want}


def test_leak_edges(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta", "x"), (2, None, "x"), (3, "", "x"), (4, "!!", "x"), (1, "alpha beta gamma delta epsilon zeta eta theta", "x")], "item_id long, text string, doc_id string")
    docs = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, "x", 7), (4, "so ALPHA, beta gamma delta epsilon zeta eta theta. yes", 7), (4, "so ALPHA, beta gamma delta epsilon zeta eta theta. yes", 7), (None, "word " * 30000, 7)], "doc_id long, text string, item_id int")
    out = decontamination.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in out} == {(4, 1)}
    left = decontamination.clean(docs, bench)
    assert left.columns == docs.columns and left.count() == 4
    assert decontamination.contaminated(docs, bench.where("false")).count() == 0 and decontamination.clean(docs, bench.where("false")).count() == 6
    assert decontamination.contaminated(docs.where("false"), bench).count() == 0


def test_leak_query_finds_whole_items(spark, sf_dir):
    out = decontamination.op7_decontamination(spark, sf_dir).toPandas()
    flat = lambda t: " " + " ".join(w.decode() for w in decontamination.plain_words((t or "").encode())) + " "
    docs = {r.doc_id: flat(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    items = {r.item_id: flat(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = set(zip(out.doc_id, out.item_id, strict=True))
    assert exact <= got and len(got - exact) <= 0.1 * len(exact) + 2


def test_paraphrases_equal_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    text = lambda k: rng.choices(words, [1 / (i + 1) for i in range(2000)], k=k)
    items = [text(rng.randrange(15, 60)) for _ in range(12)] + [["only", "two"]]
    answers, rows = [], []
    for item in items:
        rare = sorted(range(len(item)), key=lambda p: -int(item[p][1:]) if item[p][0] == "w" else 0)[: int(0.38 * len(item))]
        answers.append(" ".join(w for p, w in enumerate(item) if p not in rare))
        for k in range(4):
            w, at = text(rng.randrange(0, 200)), rng.randrange(0, 90)
            w[at:at] = [f"new{rng.randrange(10**6)}" if p in rare and k else x for p, x in enumerate(item)]
            rows.append((len(rows), " ".join(w)))
    want, cfg = set(), Latent()
    block = Items([(j, " ".join(x).encode(), a.encode()) for j, (x, a) in enumerate(zip(items, answers, strict=True))], True)
    for (i, t), j in ((r, j) for r in rows for j in range(len(items))):
        w, size = t.encode().split(), len(items[j])
        for s in range(cfg.stride - cfg.passage, len(w), cfg.stride):
            region = w[max(0, s - size // 2) :][: cfg.passage + size]
            common, told = lcs(block.masks[j], region), len(block.answers[j] & set(region)) / max(1, len(block.answers[j]))
            if common >= 0.6 * size and (common >= 0.8 * size or told >= 0.6):
                want.add((i, j))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(j, " ".join(x), a) for j, (x, a) in enumerate(zip(items, answers, strict=True))], "item_id long, text string, answer string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}
    assert len(want) >= 40 and got == want


def test_latent_search_finds_reordered_items_and_the_stage_drops_them(spark, sf_dir, monkeypatch):
    rng = random.Random(4)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    leaks = {r.doc_id for r in decontamination.contaminated(whole, bench).select("doc_id").collect()}
    clean = [r for r in whole.where("length(text) > 500").orderBy("doc_id").limit(150).collect() if r.doc_id not in leaks]
    items = {r.item_id: r.text.split() for r in bench.collect()}
    rows, want = [], set()
    for k, r in enumerate(clean):
        words = r.text.split()
        if k % 3 == 0:
            j, at = rng.choice(sorted(items)), rng.randrange(len(words) + 1)
            parts = [items[j][i : i + 4] for i in range(0, len(items[j]), 4)]
            words[at:at] = [w for p in reversed(parts) for w in p]
            want.add((r.doc_id, j))
        rows.append((*r[:1], " ".join(words), *r[2:]))
    docs = spark.createDataFrame(rows, whole.schema)
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}
    assert got <= want and len(got) >= 0.95 * len(want)
    left = {r.doc_id for r in decontamination.stage(spark, docs, sf_dir).collect()}
    assert left == {r[0] for r in rows} - {i for i, _ in got}
    fit = next(decontamination._searches(docs, bench, Latent()))
    monkeypatch.setattr(decontamination.Search, "_near", lambda *_: None)
    assert len(fit([r[1].encode() for r in rows])) < 0.5 * len(got)  # shared words in order alone don't find them


def test_long_reordered_item_is_found(spark):
    rng = random.Random(6)
    item, other = [f"i{rng.randrange(400)}" for _ in range(300)], [f"w{i}" for i in range(700)]
    turned = [w for i in range(290, -1, -10) for w in item[i : i + 10]]
    docs = spark.createDataFrame([(1, " ".join(other[:350] + turned + other[350:])), (2, " ".join(other)), (3, " ".join(turned[:150] + other))], "doc_id long, text string")
    got = decontamination.contaminated(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 7)] and 240 <= got[0].common_words <= 300
