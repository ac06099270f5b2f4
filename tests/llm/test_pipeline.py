"""The corpus pipeline, through its own stages and run(), against a brute-force version of all of them."""

import hashlib
import random
import re

import pytest

import corpus_pipeline
import sentencepiece
from conftest import SF
from sparktel import session
from sparktel.llm.queries import tokenizer
from test_text_ops import brute_components, brute_hits, corpus

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows():
    r = random.Random(4)
    out = [(i, t, "en" if (i or 0) % 3 else None, f"s{k % 7}", 1) for k, (i, t) in enumerate(corpus()) if not t or len(t) < 5000]
    line = lambda: " ".join(r.choice(["ab", "cd", "ef"]) + str(r.randrange(999)) for _ in range(12))
    out += [(100 + i, f"line of {i} {line()}\nmenu\nrare" if i % 15 == 0 else f"line of {i} {line()}\n menu ", "en", "site", 1) for i in range(30)]
    out += [(200 + i, f"own {line()}\nboth\n{'menu' if i else 'x'}", "fr" if i else None, "few", 1) for i in range(2)] + [(300, "12 34", "en", None, 1), (301, "menu\nmenu", None, None, 1), (302, "menu", "en", None, 1)]
    return out


def bench_of(docs):
    return [(1, next(t for i, t, *_ in docs if i == 103).split("\n")[0]), (2, "own two"), (3, None)]


def expected(docs, bench):
    """(doc_id, text) that the first four stages keep."""
    kept = [(i, t, s) for i, t, _, s, _ in docs if t and any(c.isalpha() for c in t)]
    strip = lambda x: x.strip(" \t\r\x0b\x0c")
    pages, holds = {}, {}
    for _, t, s in kept:
        pages[s] = pages.get(s, 0) + 1
        for x in {strip(x) for x in t.split("\n")} - {""}:
            holds[s, x] = holds.get((s, x), 0) + 1
    lines = [(i, "\n".join(x for x in t.split("\n") if not (holds.get((s, strip(x)), 0) > 1 and holds[s, strip(x)] > 0.1 * pages[s]))) for i, t, s in kept]
    of = brute_components(lines)
    one = list(dict.fromkeys(w for k, w in enumerate(lines) if of[k][2] == w[0]))
    clean = []
    for w in one:
        n, hit = map(int, re.search(r", (\d+), (\d+), \[", brute_hits([w], bench)[0]).groups())
        if not (hit and 20 * hit >= n):
            clean.append(w)
    assert len(kept) < len(docs) and lines != [w[:2] for w in kept] and len(one) < len(lines) and len(clean) < len(one)  # every stage decides
    return clean


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows(), DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench_of(rows()), "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = held = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, folder)
        assert held.columns == docs.columns
    out = held.collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((x["doc_id"], x["text"]) for x in out), key=key) == sorted(expected(rows(), bench_of(rows())), key=key)
    assert all(x["n_chars"] == len(x["text"]) and x["lang"] is not None for x in out)


def test_run(spark, folder):
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    ids = lambda t: [*sp.encode(t), 2]
    want = [(i, len(ids(t)), ids(t), hashlib.sha256(sp.decode(ids(t)).encode()).hexdigest()) for i, t in expected(rows(), bench_of(rows()))]
    got = [(x["doc_id"], x["n_tokens"], list(x["ids"]), x["decoded_sha256"]) for x in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_empty(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clean_documents_stay(spark, tmp_path):
    """Documents without any fault pass every stage, whole."""
    r = random.Random(2)
    texts = [(i, " ".join("".join(r.choices("abcdefghij", k=5)) for _ in range(80))) for i in range(40)]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "quite another text than any of these, long enough to be a window of words")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {x["doc_id"]: x["decoded_sha256"] for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts}


def test_small_batches(spark):
    """Every stage, and the result that is computed later, moves Arrow batches of the smaller bound; a bound that the session sets stays."""
    name, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    before = spark.conf.get(name)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(name, default)
            stage(spark, docs.limit(5), SF)
            assert int(spark.conf.get(name)) == session.CHAIN_ARROW_BYTES < session.ARROW_BYTES
        session.ship(spark)
        assert int(spark.conf.get(name)) == session.CHAIN_ARROW_BYTES
        spark.conf.set(name, "12345678")
        session.ship(spark, chain=True)
        assert spark.conf.get(name) == "12345678"
    finally:
        spark.conf.set(name, before)
