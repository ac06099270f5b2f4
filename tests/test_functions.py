"""Hashes, ids, names and sketches against fixed values and models."""

import math

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparktel.functions import attributes as A
from sparktel.functions import hashing as H
from sparktel.functions import sketch as S
from sparktel.functions.prints import of_batch


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def wrap(n):
    n &= (1 << 64) - 1
    return n - (1 << 64) if n >> 63 else n


def test_poly_hash(spark):
    fixed = {"": 0, "a": 97, "ab": 3105, "abc": 96354, "abcd": 2987074, "hello": 99162322, "hello world": 88006926820958916}
    rows = spark.createDataFrame(list(fixed.items()), "x string, want bigint").select("x", "want", H.poly31(F.col("x")).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in rows)
    assert one(spark, f=H.field_fingerprint("resource_service_name", H.EXISTS))["f"] == -7421396210046370992


def test_hashes_of_any_text(spark):
    texts = ["", "é", "中文 text", "😀", "a" * 300, "\x00\x7f", "ß|=,"]

    def poly(t):
        h = 0
        for b in t.encode():
            h = 31 * h + b
        return wrap(h)

    def fnv(t):
        h = 0xCBF29CE484222325
        for b in t.encode():
            h = (h ^ b) * 0x100000001B3 & (1 << 64) - 1
        return wrap(h)

    rows = spark.createDataFrame([(t,) for t in texts], "x string").select("x", H.poly31(F.col("x")).alias("p"), H.fnv1a(F.col("x")).alias("f")).collect()
    assert [(r["p"], r["f"]) for r in rows] == [(poly(r["x"]), fnv(r["x"])) for r in rows]


def tags(**kv):
    return F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in kv.items()])


def test_series_ids(spark):
    a = H.tid(tags(resource_service_name="my-service", metric_name="test_metric", chq_metric_type="gauge", other="x", attr_empty=""))
    b = H.tid(tags(attr_http_method="GET", attr_http_status="200", chq_metric_type="count", metric_name="http_server_requests", resource_k8s_pod_name="pod-123", resource_service_name="my-service", resource_service_version="1.0.0"))
    assert tuple(one(spark, a=a, b=b)) == (4261145125547256768, -7350676297560190200)


def test_trigrams(spark):
    r = one(spark, a=H.trigrams(F.lit("hello")), b=H.trigrams(F.lit("ab")), c=H.trigrams(F.lit("aaaa")), d=F.size(H.trigrams(F.lit("test-service"))))
    assert (set(r["a"]), r["b"], r["c"], r["d"]) == ({"hel", "ell", "llo"}, [], ["aaa"], 10)


def test_fingerprint_sets(spark):
    got = one(spark, p=H.fingerprints(tags(resource_service_name="abcd", resource_file="f", attr_x="y", scope_empty="")))["p"]
    want = {f"{k}:{v}" for k, v in (("resource_service_name", ".*"), ("resource_service_name", "abcd"), ("resource_service_name", "abc"), ("resource_service_name", "bcd"), ("resource_file", ".*"), ("resource_file", "f"), ("attr_x", ".*"))}
    assert len(got) == len(want) and got == sorted(got)
    assert one(spark, t=H.fingerprint_text(F.array(F.lit(-1), F.lit(2))))["t"] == "[-1,2]"


def test_fingerprint_sets_of_batches(spark):
    """Arrow batches give what the expression gives, whatever the texts; rows of very different width are sorted another way."""
    texts = ["", "a", "ab", "abc", "aaaa", "0123456789abcdef" * 2, "größe", "日本語テキスト", "\U0001f600x\U0001f600y", "a\0b", "x7" * 800]
    rows = [(t, {"service_name": t, "k8s_cluster_name": texts[3 * i % len(texts)], "file": u, "ü": "1"}, {}, {"Aö": t, "b": u}) for i, t in enumerate(texts) for u in texts]
    df = spark.createDataFrame(rows, "trace string, resource map<string,string>, scope map<string,string>, attr map<string,string>")
    pairs = lambda m: F.transform(F.map_entries(m), lambda e: F.struct(F.concat(F.lit(f"{m}_"), e["key"]).alias("k"), e["value"].alias("v")))
    both = tags(chq_telemetry_type="traces"), F.array(F.struct(F.lit("span_trace_id").alias("k"), F.col("trace").alias("v")))
    want = [r["p"] for r in df.select(H.fingerprints(F.concat(*both, *map(pairs, ("resource", "scope", "attr")))).alias("p")).collect()]
    held = df.toArrow().combine_chunks()
    column = {c: held[c].combine_chunks() for c in held.column_names}
    narrow = [i for i, r in enumerate(rows) if max(len(r[0]), len(r[1]["k8s_cluster_name"])) < 40]
    for at in (range(len(rows)), range(len(rows) - 1, len(rows)), narrow, []):
        got = of_batch({"chq_telemetry_type": pa.repeat("traces", len(at)), "span_trace_id": column["trace"].take(pa.array(at, pa.int32()))}, {f"{c}_": column[c].take(pa.array(at, pa.int32())) for c in ("resource", "scope", "attr")})
        assert got.to_pylist() == [want[i] for i in at]
    sliced = of_batch({"chq_telemetry_type": pa.repeat("traces", 9), "span_trace_id": column["trace"].slice(20, 9)}, {f"{c}_": column[c].slice(20, 9) for c in ("resource", "scope", "attr")})
    assert sliced.to_pylist() == want[20:29]


def test_names(spark):
    cases = {"service.name": "service_name", "http.status-code": "http_status_code", "Foo..Bar": "foo__bar", "...": "___", "123abc": "123abc", "é": "__", "": ""}
    rows = spark.createDataFrame(list(cases.items()), "x string, want string").select("want", A.normalize_name(F.col("x")).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in rows)


def test_labels_ids_and_times(spark):
    r = one(
        spark, k=A.span_kind(F.lit(99)), s=A.status_code(F.lit(2)), z=A.hex_id(F.unhex(F.lit("0000")), None), e=A.hex_id(F.unhex(F.lit("")), ""), h=A.hex_id(F.unhex(F.lit("0AFF")), None),
        t=A.slot_ms(F.lit(1700000000123456789)), u=A.slot_ms(F.lit(1700000015 * 10**9)), d=A.duration_ms(F.lit(1_999_999), F.lit(3_000_000)), n=A.duration_ms(F.lit(0).cast("bigint"), F.lit(5_000_000)), m=A.metric_type(F.lit("summary")), y=A.temporality(F.lit(0)),
    )
    assert tuple(r) == ("SPAN_KIND_UNSPECIFIED", "STATUS_CODE_ERROR", None, "", "0aff", 1700000000000, 1700000010000, 2, 0, "histogram", None)


def test_sketch_fixed_values():
    s = S.from_value(42.5)
    assert s.encode().hex() == "02fd4a815abf52f03f00000000000000000501f80202"
    assert s.quantile(0.5) == pytest.approx(43.3833476036132)
    h = S.from_histogram([10, 30, 40, 15, 5], [10, 50, 100, 500], 100, 5000.0)
    assert h.positive == {81: 10, 156: 30, 213: 40, 271: 15} and h.count == 95 and h.sum == 5000
    assert h.rollups()["p50"] == pytest.approx(71.528240, abs=1e-5)
    x = S.Sketch()
    for i in range(1, 101):
        x.add(i)
    assert [round(x.rollups()[q], 6) for q in S.QUANTILES] == [25.281115, 50.911102, 75.951451, 90.930942, 96.553991, 100.494568]
    assert (x.count, x.sum, x.min, x.max) == (100, 5050, 1, 100)


def test_sketch_of_odd_inputs():
    s = S.Sketch()
    for v in (math.nan, math.inf, -math.inf):
        s.add(v)
    assert s.count == 0 and s.quantile(0.5) is None and s.rollups()["p50"] == 0
    for v in (-5, -1, 0, 0, 2, 8):
        s.add(v)
    assert s.quantile(0) < -4.9 and s.quantile(0.5) == 0 and s.quantile(1) > 7.9 and s.quantile(1.5) is None
    assert S.from_histogram([], [], 0, 5.0).sum == 0
    e = S.from_exponential(3, 0, (0, [10, 20, 15, 5]), (0, []), 2500.0, 10.0, 200.0)
    assert (e.count, e.sum, e.min, e.max) == (50, 2500, 10, 200)
    m = S.from_summary(1000, 50000.0, [(0.5, 45), (0.9, 90), (0.99, 150), (0.5, 46), (2, 1)])
    assert m.count == 1000 and m.sum == 50000 and 43 < m.quantile(0.5) < 47
    assert S.from_summary(5000, 1.0, [(0.5, 4.0)]).count == 2048


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-1e12, 1e12, allow_nan=False), max_size=40), st.lists(st.floats(-1e3, 1e3), max_size=10))
def test_sketch_codec_and_merge(xs, ys):
    a, b, both = S.Sketch(), S.Sketch(), S.Sketch()
    for v in xs:
        a.add(v)
        both.add(v)
    for v in ys:
        b.add(v)
        both.add(v)
    back = S.Sketch.decode(a.encode())
    assert (back.positive, back.negative, back.zero, back.count) == (a.positive, a.negative, a.zero, a.count)
    a.merge(b)
    assert (a.positive, a.negative, a.zero, a.count) == (both.positive, both.negative, both.zero, both.count)


def test_jaccard(spark):
    r = one(spark, a=A.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))), b=A.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")))
    assert (r["a"], r["b"]) == (pytest.approx(1 / 3), 0.0)


def test_single_sketch(spark):
    values = [42.5, 1.0, -3.25, 0.0, -0.0, 1e300, 5e-324, -1e-5, float("nan"), float("inf"), None, 12345.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r, v in zip(df.select(S.single(F.col("v")).alias("s")).collect(), values, strict=True):
        s = S.Sketch()
        if v is not None:
            s.add(v)
        assert bytes(r["s"]["sketch"]) == s.encode()
        assert {k: r["s"][k] for k in S.ROLLUPS} == pytest.approx(s.rollups())
    assert S.from_value(42.5).encode().hex() == "02fd4a815abf52f03f00000000000000000501f80202"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.floats(-50, 50, allow_nan=False), st.just(0.0)), min_size=1, max_size=40))
def test_signed_quantiles(spark, xs):
    want = S.Sketch()
    for x in xs:
        want.add(x)
    df = spark.createDataFrame([(1, x) for x in xs], "g int, v double")
    got = S.sketch_groups(df, ["g"], "v").first()
    slots = df.groupBy("g", S.slot_of(F.col("v")).alias("idx")).agg(F.count("*").alias("cnt"))
    assert got["rollup_count"] == len(xs)
    for n, q in list(S.QUANTILES.items())[::2]:
        assert got[f"rollup_{n}"] == pytest.approx(want.quantile(q)) == S.running_quantile(slots, ["g"], q).first()["quantile"]


def test_unsigned_times(spark):
    signed = lambda n: n - (1 << 64) if n >= 1 << 63 else n
    times = [0, 1, 999_999, 10**18, 2**63 - 1, 2**63, 2**63 + 12345678901234567, 2**64 - 1]
    rows = spark.createDataFrame([(signed(t),) for t in times], "t bigint").select(A.millis(F.col("t")), A.slot_ms(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [(t // 10**6, t // 10**6 // 10_000 * 10_000) for t in times]
    d = spark.createDataFrame([(signed(2**63 - 10**6), signed(2**63 + 5 * 10**6))], "a bigint, b bigint").select(A.duration_ms(F.col("a"), F.col("b"))).first()[0]
    assert d == (2**63 + 5 * 10**6) // 10**6 - (2**63 - 10**6) // 10**6
