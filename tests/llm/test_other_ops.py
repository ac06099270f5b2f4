"""Nearest neighbours, WARC and HTML extraction, the pipeline and the queries with SQL."""

import base64
import gzip
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from conftest import SF, same_rows
from pyspark.sql import functions as F

from sparktel.llm import ann, html_extraction, queries, warc


def brute_nearest(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        o = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(d[j])) for j in o]
    return out


def test_ann(spark):
    r = np.random.default_rng(0)
    rows = [(i, r.normal(size=12).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # copies
    bad = [(2000, None), (2100, [0.0] * 12), (2200, [float("nan")] + [1.0] * 11), (2300, [1.0] * 3), (None, [1.0] * 12), (2400, [None] + [1.0] * 11), (2500, [float("inf")] * 12), (2600, [])]
    df = spark.createDataFrame(rows + bad + rows[:3], "vec_id bigint, embedding array<float>").withColumn("label", F.lit(1)).repartition(3)
    rows32 = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    got = {}
    for x in ann.search(df, F.col("vec_id") % 100 == 0, k=10).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    want = brute_nearest(rows32, [i for i, _ in rows if i % 100 == 0], 10)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in want[q]} & {v for _, v, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    x = dict(rows32)
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11)) and q not in {f[1] for f in found}
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        assert all(s == pytest.approx(float(np.linalg.norm(np.array(x[q]) - np.array(x[v]))), rel=1e-12) for _, v, s in found)
    full = ann.search(df, F.col("vec_id") == 5, k=10, probes=10**6, rerank=10**6, query_block=1).collect()
    assert [(y["vec_id"], pytest.approx(y["score"])) for y in sorted(full, key=lambda y: y["rank"])] == brute_nearest(rows32, [5], 10)[5]
    assert ann.search(df.limit(0), F.lit(True)).count() == 0
    few = spark.createDataFrame(rows[:3], "vec_id bigint, embedding array<double>")
    assert ann.search(few, F.lit(True)).groupBy("query_id").count().agg(F.max("count"), F.count("*")).first()[:] == (2, 3)


def test_ann_of_near_copies(spark):
    """Groups of near copies larger than `rerank`: all of a group share few codes, which can't tell them apart."""
    r = np.random.default_rng(3)
    x = r.normal(size=(6000, 64))
    x[1000:1500] = x[1000] + r.normal(size=(500, 64)) * 0.016
    x[2000:2900] = x[2000] + r.normal(size=(900, 64)) * 0.008
    x /= np.sqrt((x * x).sum(1))[:, None]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    asked = list(range(1000, 1500, 25)) + list(range(2000, 2900, 45))
    want = brute_nearest(rows, asked, 10)
    got = {}
    for y in ann.search(df, F.col("vec_id").isin(asked), k=10, groups=4, sample_rows=600).collect():
        got.setdefault(y["query_id"], set()).add(y["vec_id"])
    for group in (asked[:20], asked[20:]):
        hits = sum(len({v for v, _ in want[q]} & got[q]) for q in group)
        assert hits >= 0.99 * 10 * len(group), hits / (10 * len(group))


def test_ann_of_huge_and_tiny_components(spark):
    r = np.random.default_rng(5)
    for size in (1e30, 1e-30):
        x = r.normal(size=(300, 8)) * size
        rows = [(i, v) for i, v in enumerate(x.tolist())]
        df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        want = brute_nearest(rows, [0, 100, 200], 5)
        got = {}
        for y in ann.search(df, F.col("vec_id") % 100 == 0, k=5, probes=10**6).collect():
            got.setdefault(y["query_id"], []).append((y["rank"], y["vec_id"], y["score"]))
        for q in want:
            assert [(v, pytest.approx(s, rel=1e-12)) for _, v, s in sorted(got[q])] == want[q]


def test_probes_follow_the_vectors():
    """Vectors in groups need few cells, vectors without any need most."""
    r = np.random.default_rng(2)
    middles = r.normal(size=(40, 16)) * 20
    for x, low, high in ((middles[r.integers(0, 40, 4000)] + r.normal(size=(4000, 16)), 0, 20), (r.normal(size=(4000, 16)), 20, 63)):
        x = x.astype(np.float32)
        q = ann.Quantizer.train(x, 63, 4)
        assert low < ann.needed_probes(q, x, 10, 0.97) <= high


def test_warc_files(tmp_path):
    pages = [(1, "http://a/ b<>", b"x" * 100_000), (2, None, b""), (None, "u\r\nx", "é".encode())]
    raw = b"".join(warc.record(p, u, b, None, False, "2024-01-01T00:00:00Z") for p, u, b in pages) + warc.record(9, "http://r", b"x" * 100_000, 1, True, "2024-01-01T00:00:00Z")
    for stream in (gzip.compress(raw), gzip.compress(raw[:70_000]) + gzip.compress(raw[70_000:])):
        out, index = io.BytesIO(), []
        assert warc.normalise_file(io.BytesIO(stream), out, index.append) == 4
        data = out.getvalue()
        assert b"".join(zlib.decompress(data[e["offset"] : e["offset"] + e["length"]], 31) for e in index) == raw == gzip.decompress(data)
        assert index[-1]["offset"] + index[-1]["length"] == len(data) and [e["type"] for e in index] == ["response"] * 3 + ["revisit"]
        head, block = warc.read_member(io.BytesIO(data), index[0]["offset"], index[0]["length"])
        assert block.endswith(b"x" * 100_000) and head["warc-target-uri"] == "http://a/%20b%3C%3E"
    with pytest.raises((EOFError, ValueError)):
        warc.normalise_file(io.BytesIO(gzip.compress(raw[:-50_000])), io.BytesIO(), index.append)
    assert warc.normalise_file(io.BytesIO(gzip.compress(b"")), io.BytesIO(), index.append) == 0


def test_warc_long_head():
    url = "http://a/" + "".join(random.Random(1).choices("abcdef0123456789", k=5 << 20))
    raw = warc.record(1, url, b"x", None, False, "2024-01-01T00:00:00Z") + warc.record(2, "u", b"y", None, False, "2024-01-01T00:00:00Z")
    out, index = io.BytesIO(), []
    assert warc.normalise_file(io.BytesIO(gzip.compress(raw)), out, index.append) == 2 and gzip.decompress(out.getvalue()) == raw
    assert [e["uri"] for e in index] == [url, "u"]
    assert warc.read_member(io.BytesIO(out.getvalue()), index[0]["offset"], index[0]["length"])[0]["warc-target-uri"] == url
    with pytest.raises(ValueError):
        warc.normalise_file(io.BytesIO(gzip.compress(b"x" * 100)), io.BytesIO(), index.append)


@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_warc_round_trip(spark, limit, monkeypatch):
    rows = [(1, "http://a", "same"), (7, "http://b", "same"), (3, None, "same"), (4, "u", None), (5, "u", ""), (6, "u", "é" * 5000), (None, "n", "alone"), (7, "http://c", "same")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash"))
    decide = warc.decide
    monkeypatch.setattr(warc, "decide", lambda p, k, b: decide(p, k, b, limit))
    got = sorted(map(str, (tuple(r) for r in warc.round_trip(df).collect())))
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    best = {"same": 7, "": 5}
    want = []
    for p, u, t in rows:
        b = best.get(t or "", p)
        want.append(str((p, u, len((t or "").encode()), sha(t), "response" if p == b else "revisit", None if p == b else b)))
    assert got == sorted(want)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_html_blocks():
    scan = lambda p: [b.text for b in html_extraction.scan(p)]
    assert scan("<p>a<b>b</b><br>c&amp;&nbsp;d<p>e<!-- x --><script>if (a<b) '</p>'</script> f") == ["ab c& d", "e f"]
    assert scan("<ul><li>x<li>y</ul>z < 3 &lt;<title>t</title>") == ["x", "y", "z < 3 <"]
    assert scan("") == [] and scan("<p") == [] and scan("plain") == ["plain"] and scan("<style>p{}") == []
    assert scan('<div title="a>b">x</div><textarea>no</textarea>') == ["x"]


def test_html_head_without_end():
    scan = lambda p: [b.text for b in html_extraction.scan(p)]
    assert scan("<html><head><meta charset=utf-8><title>x</title><style>p{}</style><body><p>a<p>b") == ["a", "b"]
    assert scan("<html><head><title>x</title><p>a</p></html>") == ["a"] and scan("<head><title>x</title><b>a</b> c") == ["a c"]
    assert scan("<head><template><p>no</p></template><script>1</script></head><body>a") == ["a"]


def test_html_accuracy(spark):
    field = html_extraction.trained()
    right = total = 0
    for feats, labels in html_extraction.labelled(range(50_000, 50_300)):
        got = field.decode(field.encode(feats))
        right += sum(a == b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert total > 2000 and right >= 0.97 * total
    page = "<html><head><title>t</title></head><body><nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav><div class='ad'>Buy now this thing.</div><article><h1>Head line</h1><p>First text of it, quite long and with words.</p><p>All rights reserved.</p></article><div class='comments'><p>I like this very much.</p></div><footer>&copy; x.example &middot; All about it.</footer></body></html>"
    rows = [(1, "u", page), (2, None, None), (None, "u", ""), (3, "u", page * 1), (4, "u", "<p>" + "word " * 200_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    out = {(r["page_id"], r["url"]): r for r in html_extraction.extract(df).collect()}
    assert out[1, "u"]["text"] == "Head line First text of it, quite long and with words. All rights reserved."
    assert out[2, None]["text"] == "" and out[2, None]["n_chars"] == 0 and out[1, "u"]["n_chars"] == len(out[1, "u"]["text"])
    assert out[4, "u"]["n_chars"] in (0, 999_999) and html_extraction.extract(df.limit(0)).count() == 0


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(1)
    f = html_extraction.Field({str(i): i for i in range(6)})
    f.unary, f.pair, f.first = r.normal(size=(6, 2)), r.normal(size=(2, 2)), r.normal(size=2)
    for _ in range(30):
        rows = [r.integers(0, 6, 3).tolist() for _ in range(r.integers(1, 8))]
        u = f.potentials(rows)
        score = lambda y: f.first[y[0]] + sum(u[i, a] for i, a in enumerate(y)) + sum(f.pair[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: E731,B023
        best = max((tuple(int(b) for b in np.binary_repr(m, len(rows))) for m in range(2 ** len(rows))), key=score)
        assert tuple(f.decode(rows)) == best


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_sql(name, spark, duck):
    same_rows(queries.queries()[name](spark, SF), duck, queries.oracle_sql()[name])


def test_pipeline_decodes(spark):
    import corpus_pipeline
    from sparktel.llm.queries import tokenizer

    import sentencepiece

    texts = ["plain words", " two  spaces ", "\u2581 \u4e2d \U0001f600", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    got = {x["doc_id"]: x["decoded_sha256"] for x in corpus_pipeline.encode(spark, docs, SF).collect()}
    assert got == {i: hashlib.sha256(sp.decode([*sp.encode(t), 2]).encode()).hexdigest() for i, t in enumerate(texts)}
