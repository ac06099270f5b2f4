"""Operators over documents against brute force, on small tables with nulls, ties, repeats, long and empty texts."""

import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparktel.llm import decontamination, language_id, line_dedup, ngram_join, sentencepiece_codec, substring_dedup, token_store
from sparktel.llm.queries import tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = "doc_id bigint, text string, lang string, source string, n_words bigint, key string, rid int"


def prose(r, n):
    return " ".join(r.choice("a bb Ccc dd é ß 中 x1 y2 zz,".split()) + str(r.randrange(60)) for _ in range(n))


def corpus():
    """(doc_id, text): near copies, shared passages, repeats, nulls."""
    r = random.Random(5)
    base, passage = prose(r, 120), prose(r, 40)
    rows = [(1, base), (2, base), (2, base), (3, base.replace("bb", "bb", 1) + " tail"), (4, " ".join(base.split()[5:])), (5, prose(r, 30) + " " + passage + "\n" + prose(r, 30)), (6, passage), (7, passage.upper() + "\t" + passage)]
    rows += [(2, base.upper() + " " + passage), (8, None), (9, ""), (10, "  \n\t "), (11, "one two"), (12, "one two"), (None, "one TWO"), (13, "x " * 100), (14, prose(r, 20_000)), (15, base + " " + passage + " " + base), (16, "a b \x1c c"), (17, prose(r, 34)), (18, prose(r, 35))]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, "s", 1, "k", 2) for i, t in corpus()]
    return spark.createDataFrame(rows, CLASH).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASH)


def rows_of(df, *cols):
    return sorted(map(str, df.select(*cols).collect()))


# -- 3 -----------------------------------------------------------------------------------------------------------


def test_substring_dedup(spark, docs, empty):
    texts = [(i, WORD.findall(t or "")) for i, t in corpus()]
    seen = {}
    for _, w in texts:
        for p in range(len(w) - 34):
            seen[tuple(w[p : p + 35])] = seen.get(tuple(w[p : p + 35]), 0) + 1
    want = []
    for i, w in texts:
        gone = {q for p in range(len(w) - 34) if seen[tuple(w[p : p + 35])] > 1 for q in range(p, p + 35)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        want.append(str((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)))
    got = [str(tuple(r)) for r in substring_dedup.remove_repeats(docs, with_text=True).collect()]
    assert sorted(got) == sorted(want)
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_run_index(spark):
    index = substring_dedup.RunIndex(spark, fan_in=2)
    batches = [[(1, 1), (2, 2), (3, 1)], [(3, 1), (4, 1)], [(5, 1), (5, 1)], [(1, 1), (6, 1)]]
    for b in batches:
        index.append(spark.createDataFrame(b, "hash bigint, n int"))
    assert len(index.runs) <= 2 and sorted(r[0] for r in index.repeated().collect()) == [1, 2, 3, 5]
    index.compact()
    assert sorted(r[0] for r in index.repeated().collect()) == [1, 2, 3, 5] and index.tables()[0].count() == 6
    index.drop()


def test_run_index_opened_again(spark):
    index = substring_dedup.RunIndex(spark, fan_in=1)
    for b in ([(1, 1), (2, 1)], [(2, 1), (3, 1)], [(4, 2)]):
        index.append(spark.createDataFrame(b, "hash bigint, n int"))
    folder = index.save()
    index.close()
    again = substring_dedup.RunIndex.open(spark, folder)
    again.append(spark.createDataFrame([(1, 1), (5, 1)], "hash bigint, n int"))
    assert len(again.runs) == 2 and sorted(r[0] for r in again.repeated().collect()) == [1, 2, 4]
    again.compact()
    assert len(again.runs) == 1 and again.tables()[0].count() == 5
    again.drop()


def test_substring_dedup_compacts(spark, docs, monkeypatch):
    seen = []
    compact = substring_dedup.RunIndex.compact
    monkeypatch.setattr(substring_dedup.RunIndex, "compact", lambda self: (seen.append(len(self.runs)), compact(self)))
    substring_dedup.remove_repeats(docs)
    assert seen == [3]


# -- 5 -----------------------------------------------------------------------------------------------------------


def brute_hits(texts, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for i, t in items:
        w = cut(t)
        for p in range(max(len(w) - 12, 1) if w else 0):
            windows.setdefault(tuple(w[p : p + 13]), set()).add(str(i))
    out = []
    for i, t in texts:
        w, hit, found = cut(t), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    found |= windows[tuple(w[p : p + n])]
        out.append(str((i, len(w), len(hit), sorted(found))))
    return sorted(out)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_decontamination(spark, docs, empty, limit):
    r = random.Random(5)
    texts = corpus()
    passage = texts[6][1]
    long = " ".join(prose(r, 9000).split()[:9000])
    items = [(1, passage), (2, "ONE two"), (3, " ".join(passage.split()[10:24])), (4, None), (5, "!!"), (6, passage), (7, " ".join(texts[15][1].split()[4090:4110])), (8, "x x x x x x x x x x x x x x"), (9, long)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = [str((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]))) for r in decontamination.hits(docs, bench, broadcast_bytes=limit).collect()]
    assert sorted(got) == brute_hits(texts, items)
    assert decontamination.hits(empty, bench).count() == 0
    again = decontamination.hits(docs.unionByName(docs).unionByName(docs), bench, broadcast_bytes=limit).collect()
    assert sorted(str((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]))) for r in again) == sorted(3 * brute_hits(texts, items))
    none = decontamination.decontaminate(docs, bench.limit(0)).agg(F.sum("n_hit"), F.count("*")).first()
    assert tuple(none) == (0, len(texts))


# -- 8 -----------------------------------------------------------------------------------------------------------


def brute_components(texts):
    sets = []
    for _, t in texts:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[p : p + 5]) for p in range(max(len(w) - 4, 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = []
    for a, (i, _) in enumerate(texts):
        ids = [texts[b][0] for b in range(len(texts)) if find(b) == find(a) and texts[b][0] is not None]
        out.append((i, len(sets[a]), min(ids) if ids and sets[a] else i))
    return out


def test_ngram_join(spark, docs, empty):
    got = [tuple(r) for r in ngram_join.link_components(docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_components(corpus())))
    assert ngram_join.link_components(empty).count() == 0


def test_ngram_join_of_many_edits(spark):
    """A group whose members link with the middle one and partly with each other, and chains."""
    r = random.Random(11)
    base = prose(r, 60).split()
    texts = []
    for i in range(80):
        w = list(base)
        for _ in range(r.randrange(5)):
            w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
        texts.append((i, " ".join(w)))
    chain = prose(r, 80).split()
    for i in range(30):
        texts.append((100 + i, " ".join(chain[i * 2 : i * 2 + 40])))
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    for rounds in (0, 2):
        got = [tuple(x) for x in ngram_join.link_components(df, rounds=rounds, broadcast_bytes=(32 << 20) * (rounds > 0)).collect()]
        assert sorted(got) == sorted(brute_components(texts))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 300), (150, 300), (7, 7)]
    got = {r["node"]: r["label"] for r in ngram_join.components(spark, spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and {got[i] for i in (100, 150, 200, 300)} == {100}
    assert ngram_join.components(spark, spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# -- 2 -----------------------------------------------------------------------------------------------------------


def test_line_dedup(spark):
    rows = [(i, f"own {i}\n  menu \nbody {i}\n\nrare" if i % 7 == 0 else f"own {i}\nmenu\t\n\nown {i}", "h" if i < 30 else None) for i in range(50)]
    rows += [(90, None, "h"), (91, "", "h"), (92, "menu", "h"), (93, "menu\nmenu", "few"), (94, "menu", "few")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("N_LINES", F.lit(1))
    for limit in (16 << 20, 0):
        out = line_dedup.drop_boilerplate(df, broadcast_bytes=limit)
        assert out.columns == ["doc_id", "text", "source", "N_LINES", "_n_lines", "n_removed"]
        pages, holds = {}, {}
        for _, t, s in rows:
            pages[s] = pages.get(s, 0) + 1
            for line in {x.strip(" \t\r\x0b\x0c") for x in (t or "").split("\n")} - {""}:
                holds[s, line] = holds.get((s, line), 0) + 1
        bad = {k for k, n in holds.items() if n > 1 and n > 0.1 * pages[k[0]]}
        want = [(i, None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\r\x0b\x0c")) not in bad)) for i, t, s in rows]
        assert sorted(map(str, (tuple(r) for r in out.select("doc_id", "text").collect()))) == sorted(map(str, want))
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


# -- 4 -----------------------------------------------------------------------------------------------------------


def test_language_id(spark, empty):
    r = random.Random(3)
    kinds = {"aa": "alo bani ceto duri", "bb": "xyk wqz vrx zzt", "cc": "éçà ôûî ñü"}
    rows = [(i, " ".join(r.choice(w.split()) for _ in range(r.randint(5, 40))), lang) for i, lang in enumerate(list(kinds) * 60) for w in [kinds[lang]]]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !?", "bb"), (1003, "alo", None), (None, "xyk wqz", "bb"), (1004, "alo " * 200_000, "aa"), (1005, "\U0001f600 é", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(df, per_label=40, landmarks=24)
    out = {r["doc_id"]: r for r in language_id.predict(df, model).collect()}
    assert model.labels == ["aa", "bb", "cc"]
    assert [out[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None, 1004)] == ["und", "und", "und", "aa", "bb", "aa"]
    test = [o for i, o in out.items() if i is not None and i < 1000 and zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(test) > 20 and sum(o["lang_pred"] == o["lang"] for o in test) >= 0.98 * len(test)
    assert all(0 <= o["score"] <= 1 for o in out.values()) and out[1000]["score"] == 0
    got = df.select("doc_id", language_id.held_out(F.col("doc_id")).alias("h")).where("doc_id is not null").collect()
    assert all(g["h"] == (zlib.crc32(str(g["doc_id"]).encode()) % 5 == 0) for g in got)
    nothing = language_id.fit(empty.select("doc_id", "text", "lang"))
    assert {r["lang_pred"] for r in language_id.predict(df, nothing).collect()} == {"und"}
    assert language_id.predict(empty, model, names=("p", "q")).count() == 0
    with pytest.raises(ValueError):
        language_id.predict(df.withColumn("SCORE", F.lit(1)), model)


def test_presence_in_blocks(monkeypatch):
    """n-grams of a text don't depend on where its blocks end, also within runs of blanks."""
    r = random.Random(6)
    for _ in range(50):
        raw = np.frombuffer("".join(r.choice("ab  \n9é") for _ in range(r.randint(0, 60))).encode(), np.uint8)
        flags = [np.zeros((len(language_id.ORDERS), language_id.WIDTH), np.uint8) for _ in range(2)]
        for f, size in zip(flags, (1 << 20, r.randint(1, 9)), strict=True):
            monkeypatch.setattr(language_id.th, "BLOCK_BYTES", size)
            language_id.presence(raw, f)
        assert (flags[0] == flags[1]).all()


def grams(text):
    """Distinct n-grams of each order of a text, by the letter of the definition."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
    raw = b" " + b" ".join(raw.split(b" ")) + b" "
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    return [{raw[i : i + n] for i in range(len(raw) - n + 1)} for n in language_id.ORDERS]


def test_language_id_against_its_definition():
    """Scores of the folded weights equal kernel sums over the landmarks: kernel and regression by brute force."""
    r = random.Random(12)
    kinds = {"aa": "alo bani ceto duri", "bb": "xyk wqz vrx zzt"}
    texts = [(k, " ".join(r.choice(w.split()) for _ in range(r.randint(2, 9)))) for k, w in kinds.items() for _ in range(12)]
    flags = np.zeros((len(language_id.ORDERS), language_id.WIDTH), np.uint8)
    sample = []
    for k, t in texts:
        language_id.presence(np.frombuffer(t.encode(), np.uint8), flags)
        sample.append((k, zlib.compress(np.packbits(flags).tobytes(), 1)))
    model = language_id.train(sample, landmarks=24)
    sets = [grams(t) for _, t in texts]
    kernel = lambda x, y: sum(len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1)) for a, b in zip(x, y, strict=True))
    k = np.array([[kernel(x, y) for y in sets] for x in sets])
    y = np.array([[1.0 if label == c else -1.0 for c in ("aa", "bb")] for label, _ in texts])
    left = k.T @ (k / 12) + 1e-2 * k / 24 * 2 + 1e-9 * np.eye(24) * np.trace(k)
    alpha = np.linalg.solve(left, k.T @ (y / 12))
    for t in ("alo duri", "xyk zzt wqz", "alo xyk", "", "bani bani"):
        language_id.presence(np.frombuffer(t.encode(), np.uint8), flags)
        want = np.array([kernel(grams(t), s) for s in sets]) @ alpha
        assert model.scores(flags[None])[0] == pytest.approx(want, abs=2e-3)


def test_language_id_of_many_labels(spark):
    rows = [(5 * i + j, f"{chr(0x4E00 + i)}{chr(0x5E00 + i)} " * 3, f"l{i:03}") for i in range(230) for j in range(5)]
    rows += [(i, "abc def", "l000") for i in range(2000, 2040)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(df, per_label=4)
    assert model.labels == sorted({k for _, _, k in rows})
    out = language_id.predict(df.where("doc_id < 1150"), model).collect()
    assert sum(o["lang_pred"] == o["lang"] for o in out) >= 0.98 * len(out)


# -- 7 -----------------------------------------------------------------------------------------------------------


def test_token_store(spark, docs, empty):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    want, start = [], 0
    for i, t in sorted(corpus(), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_store.encode_store_read(docs, path).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert token_store.encode_store_read(empty, path).count() == 0


def test_encoder_units():
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    enc, tok, r = token_store.encoder(path), Tokenizer.from_file(path), random.Random(2)
    bits = ["a", "B", " ", "  ", "\n", "\t", "'s", "'ll", "é", "中", "1", "%%", "\x1c", "\x85", "\xa0", "<|endoftext|>", "\r\n", "\x00", "½", "́", "_", "​", "\U0001f600"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 10))) for _ in range(2000)]
    assert [np.frombuffer(x, enc.kind).tolist() for x in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_of_all_short_texts():
    """White space of every kind next to a blank: only a blank between other characters is a cut."""
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    enc, tok = token_store.encoder(path), Tokenizer.from_file(path)
    for alphabet, longest in (("a \n\xa0\t", 7), ("a1.' \n\t\r\xa0\u2003\u3000\u1680\x1c\x85", 4)):
        for n in range(longest + 1):
            texts = ["".join(t) for t in itertools.product(alphabet, repeat=n)]
            want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
            ids, edges = enc.block(pa.array(texts, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)] == want
    ids, edges = enc.block(pa.array(["a b", "", "<|endoftext|> x"], pa.string()), 2)
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)] == [[*tok.encode(t).ids, 2] for t in ("a b", "", "<|endoftext|> x")]


def test_encoder_forgets(monkeypatch):
    """A memo smaller than the units of a block, and blocks that share some of them."""
    from tokenizers import Tokenizer

    path, r = tokenizer("byte_bpe_50k.json"), random.Random(8)
    monkeypatch.setattr(token_store, "MEMO", 40)
    enc, tok = token_store.Encoder(path), Tokenizer.from_file(path)
    words = [f"{a}{b}{c}" for a in ("run", "Stra\u00dfe", "x1", "\u4e2d") for b in ("", "ning", "\n") for c in ("", ".", "!?", "'", "'s", "a\u0301")]
    for _ in range(20):
        texts = [" ".join(r.choices(words, k=r.randint(0, 30))) for _ in range(5)]
        assert [np.frombuffer(x, enc.kind).tolist() for x in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(enc.keys) <= 40 + len(words)


@pytest.mark.parametrize("n,kind", [(0, np.uint16), (1, np.uint16), (70_000, np.uint16), (200_003, np.uint32)])
def test_wavelet_matrix(tmp_path, n, kind):
    r = np.random.default_rng(n)
    ids = r.choice(np.array([0, 5, 7, 50_000 if kind == np.uint16 else 90_000]), n).astype(kind)
    path = str(tmp_path / "x.wvt")
    with open(path, "wb") as f:
        token_store.write_shard(f, ids, [3, None], np.array([0, n // 2, n]))
    s = token_store.Shard(path)
    assert (s.decode() == ids).all() and s.documents()[0] == [3, None]
    for i in r.integers(0, n, 20) if n else []:
        assert s.access(int(i)) == ids[i]
    for v in (0, 5, 6, 1 << 30):
        places = np.flatnonzero(ids == v)
        assert s.count(v) == len(places) and s.count(v, n // 3, n // 2) == ((places >= n // 3) & (places < n // 2)).sum()
        for j in {0, len(places) // 2, len(places) - 1} if len(places) else ():
            assert s.select(v, j) == places[j]
        with pytest.raises(IndexError):
            s.select(v, len(places))


# -- 10 ----------------------------------------------------------------------------------------------------------


def test_sentencepiece(spark, docs, empty):
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    c, r = sentencepiece_codec.codec(path), random.Random(1)
    bits = ["a", "b", "th", "e", " ", "  ", "\n", "é", "ß", "▁", "中", "\U0001f600", "the", "ing", "\t", "�", "0", "...", "\x00", "</s>", "<0x41>", "▁▁"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 12))) for _ in range(3000)] + ["".join(r.choice("abcdef") for _ in range(r.randint(1, 14))) for _ in range(3000)]
    for t in texts:
        ids = sp.encode(t)
        assert c.encode(t) == ids and c.decode([*ids, 2]) == sp.decode([*ids, 2])
        assert c.document(t) == (" ".join(map(str, [*ids, 2])), len(ids) + 1, sp.decode([*ids, 2]))
    want = sorted(str((i, len(sp.encode(t or "")) + 1, [*sp.encode(t or ""), 2], sp.decode([*sp.encode(t or ""), 2]))) for i, t in corpus())
    out = sentencepiece_codec.encode_documents(docs, path).select("doc_id", "n_tokens", "ids", "decoded")
    assert sorted(str(tuple(x)) for x in out.collect()) == want
    digests = {(x["doc_id"], x["n_tokens"]): x for x in sentencepiece_codec.digest_documents(docs, path).collect()}
    for x in out.collect():
        d = digests[x["doc_id"], x["n_tokens"]]
        assert d["ids_sha256"] == hashlib.sha256(" ".join(map(str, x["ids"])).encode()).hexdigest() and d["decoded_sha256"] == hashlib.sha256(x["decoded"].encode()).hexdigest()
    assert sentencepiece_codec.encode_documents(empty, path).count() == 0
    with pytest.raises(Exception):
        sentencepiece_codec.Codec("/nope.model")


def test_sentencepiece_of_long_words():
    """Texts of a megabyte without blanks: time and memory grow with the text."""
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    sp, c, r = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_codec.codec(path), random.Random(9)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "\u4e2d\u6587\u5b57\u7684\u662f\u4e00", "ab"):
        text = "".join(r.choices(alphabet, k=300_000))
        assert c.encode(text) == sp.encode(text)
    start = time.process_time()
    c.encode("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)))
    assert time.process_time() - start < 30
