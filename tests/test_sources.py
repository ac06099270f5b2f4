"""OTLP files: input grammar, decoding, enrichment, flattening, data source, streams."""

import gzip
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparktel.functions import attributes as A
from sparktel.functions import hashing as H
from sparktel.functions.sketch import Sketch
from sparktel.operators.flatten import attribute_names, flatten_attributes
from sparktel.plans import otlp
from sparktel.sources import decode, inputs
from sparktel.sources import readers as R
from sparktel.sources.descriptors import messages
from sparktel.streaming import windows


def attribute(target, key, value):
    a = target.attributes.add(key=key)
    kind = {str: "string_value", bool: "bool_value", int: "int_value", float: "double_value", bytes: "bytes_value"}[type(value)]
    setattr(a.value, kind, value)


def metrics_payload() -> bytes:
    q = messages()["Metrics"]()
    rm = q.resource_metrics.add()
    for k, v in (("service.name", "test-service"), ("host.name", "h"), ("k8s.pod.name", "pod-zx")):
        attribute(rm.resource, k, v)
    sm = rm.scope_metrics.add()
    sm.scope.name, sm.scope.version = "test-scope", "1.0.0"
    p = sm.metrics.add(name="test.gauge").gauge.data_points.add(as_double=42.5, time_unix_nano=1700000015 * 10**9)
    attribute(p, "env", "prod")
    attribute(p, "_internal", "hidden")
    m = sm.metrics.add(name="test.counter")
    m.sum.is_monotonic, m.sum.aggregation_temporality = True, 2
    attribute(m.sum.data_points.add(as_int=12345, time_unix_nano=1700000000 * 10**9), "region", "us-west-2")
    for counts in ([10, 30, 40, 15, 5], [0, 0, 0, 0, 0]):
        m = sm.metrics.add(name="h")
        m.histogram.data_points.add(count=sum(counts), sum=5000, min=1, max=1000, bucket_counts=counts, explicit_bounds=[10, 50, 100, 500])
    for counts in ([10, 20, 15, 5], [0]):
        p = sm.metrics.add(name="eh").exponential_histogram.data_points.add(scale=3, count=sum(counts), sum=2500, min=10, max=200)
        p.positive.bucket_counts.extend(counts)
    p = sm.metrics.add(name="su").summary.data_points.add(count=1000, sum=50000)
    for a, b in ((0.5, 45), (0.9, 90), (0.99, 150)):
        p.quantile_values.add(quantile=a, value=b)
    sm.metrics.add(name="none")
    return q.SerializeToString()


def logs_payload() -> bytes:
    q = messages()["Logs"]()
    rl = q.resource_logs.add()
    attribute(rl.resource, "service.name", "svc")
    attribute(rl.resource, "_hidden.attr", "x")
    sl = rl.scope_logs.add()
    sl.scope.name = "s"
    r = sl.log_records.add(time_unix_nano=1700000000 * 10**9, severity_text="INFO", trace_id=bytes(range(16)), span_id=b"\x01" * 8)
    r.body.string_value = "User logged in from 192.168.1.100"
    r = sl.log_records.add(observed_time_unix_nano=1700000000 * 10**9, trace_id=bytes(16))
    r.body.string_value = "User logged in from 10.0.0.50"
    sl.log_records.add()
    return q.SerializeToString()


def traces_payload() -> bytes:
    q = messages()["Traces"]()
    rs = q.resource_spans.add()
    attribute(rs.resource, "service.name", "svc")
    ss = rs.scope_spans.add()
    t = 1700000000 * 10**9
    s = ss.spans.add(trace_id=bytes(range(16)), span_id=b"\x01" * 8, name="root", kind=2, start_time_unix_nano=t, end_time_unix_nano=t + 50_000_000)
    s.status.code = 1
    ss.spans.add(trace_id=bytes(range(16)), span_id=b"\x02" * 8, parent_span_id=b"\x01" * 8, name="child", kind=3, start_time_unix_nano=t, end_time_unix_nano=t + 15_000_000)
    ss.spans.add(name="odd", kind=99)
    return q.SerializeToString()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("otlp")
    (d / "m1.binpb").write_bytes(metrics_payload())
    (d / "_m2.binpb.gz").write_bytes(gzip.compress(metrics_payload()) + gzip.compress(b"other member"))
    (d / "l.binpb").write_bytes(logs_payload())
    (d / "t.binpb").write_bytes(traces_payload())
    return d


def test_input_grammar(folder):
    m1 = str(folder / "m1.binpb")
    assert inputs.parse_list(None, m1) == [m1]
    assert inputs.parse_list(None, f"['{m1}', \"x\", y]") == [m1, "x", "y"]
    assert [p.rsplit("/", 1)[1] for p in inputs.parse_list(None, f"{folder}/*m*.binpb*")] == ["_m2.binpb.gz", "m1.binpb"]
    for bad, said in ((f"{folder}/*.nope", "No files matched pattern"), ("[]", "Empty file list"), ("[ , ]", "Empty file list")):
        with pytest.raises(ValueError, match=said):
            inputs.parse_list(None, bad)
    got = inputs.parse_inputs(None, json.dumps(["a", {"path": "b", "k": "v", "n": 1}, 7]), json.dumps({"b": {"k": "later", "z": "1"}}))
    assert [(i.path, i.meta) for i in got] == [("a", []), ("b", [("k", "v"), ("k", "later"), ("z", "1")])]
    assert inputs.parse_inputs(None, "x", "{broken")[0].meta == []


def test_values():
    v = messages()["AnyValue"]
    assert [decode.any_text(v(**kw)) for kw in ({"bool_value": True}, {"int_value": -3}, {"bytes_value": b"\x0a\xff"}, {"string_value": "s"}, {})] == ["true", "-3", "0aff", "s", ""]
    assert [decode.plain_double(x) for x in (1.0, 1e21, 1e-7, -0.0, float("inf"), float("nan"), 0.1)] == ["1", "1000000000000000000000", "0.0000001", "-0", "inf", "NaN", "0.1"]
    assert decode.signed(2**63) == -(2**63)
    with pytest.raises(ValueError):
        decode.inflate("x.gz", gzip.compress(b"abc")[:10])
    with pytest.raises(Exception):
        list(decode.metric_rows(b"\xff\xff\xff"))


def test_metrics(spark, folder):
    df = R.read_metrics(spark, f"[{folder}/m1.binpb, {folder}/_m2.binpb.gz]", customer_id="c1")
    rows = df.toPandas()
    assert len(rows) == 10 and list(df.columns[25:]) == ["resource_k8s_pod_name", "resource_service_name", "attr_env", "attr_region"]
    by = {n: g.iloc[0] for n, g in rows.groupby("metric_name")}
    assert set(by) == {"test_gauge", "test_counter", "h", "eh", "su"}
    g, c, h, e, s = (by[n] for n in ("test_gauge", "test_counter", "h", "eh", "su"))
    assert (g.chq_metric_type, g.chq_rollup_sum, g.chq_timestamp, g.attr_env, g.resource_service_name, g.metric_is_monotonic, g.metric_temporality) == ("gauge", 42.5, 1700000010000, "prod", "test-service", None, None)
    assert (c.chq_metric_type, c.chq_rollup_sum, c.metric_is_monotonic, c.metric_temporality, c.attr_region) == ("count", 12345, True, "cumulative", "us-west-2")
    assert (h.chq_metric_type, h.chq_rollup_min, h.chq_rollup_max, h.chq_rollup_count, h.metric_is_monotonic) == ("histogram", 1, 1000, 95, None)
    assert (e.chq_rollup_count, e.chq_rollup_min, s.chq_rollup_sum, s.chq_metric_type) == (50, 10, 50000, "histogram")
    assert Sketch.decode(bytes(g.chq_sketch)).count == 1 and rows.chq_tid.nunique() == 5 and (rows.chq_customer_id == "c1").all()


def test_logs(spark, folder):
    df = R.read_logs(spark, json.dumps([{"path": str(folder / "l.binpb"), "resource_bucket_name": "b"}]), customer_id="c")
    rows = df.toPandas()
    assert len(rows) == 3 and "resource_bucket_name" in df.columns and not any("hidden" in c for c in df.columns)
    a, b = rows[rows.log_message.notna()].sort_values("chq_tsns", kind="stable").to_dict("records")
    assert a["chq_fingerprint"] == b["chq_fingerprint"] != 0 and {a["chq_timestamp"], b["chq_timestamp"]} == {1700000000000}
    first = rows[rows.log_level == "INFO"].iloc[0]
    assert first.trace_id == bytes(range(16)).hex() and rows[rows.log_level.isna()].trace_id.isna().all()
    assert rows[rows.log_message.isna()].chq_fingerprint.tolist() == [0] and rows.chq_id.str.len().eq(26).all() and rows.chq_id.nunique() == 3
    assert R.read_logs(spark, str(folder / "l.binpb"), "c", mode="exact").count() == 3


def test_traces(spark, folder):
    rows = R.read_traces(spark, str(folder / "t.binpb"), customer_id="c").toPandas().set_index("span_name")
    assert rows.span_duration.to_dict() == {"root": 50, "child": 15, "odd": 0}
    assert rows.span_kind.to_dict() == {"root": "SPAN_KIND_SERVER", "child": "SPAN_KIND_CLIENT", "odd": "SPAN_KIND_UNSPECIFIED"}
    assert rows.loc["root"].span_parent_span_id == "" and rows.loc["child"].span_parent_span_id == "01" * 8 and rows.loc["odd"].span_trace_id == ""
    assert rows.loc["root"].chq_fingerprint.startswith("[") and rows.loc["odd"].chq_timestamp > 0 and rows.loc["odd"].span_status_code == "STATUS_CODE_UNSET"


def test_trace_names_without_rows(spark, tmp_path, monkeypatch):
    """Columns come from the attributes alone, and are those of the rows; no fingerprint is hashed byte by byte in the plan."""
    q = messages()["Traces"]()
    attribute(q.resource_spans.add().resource, "no.span", "x")
    rs = q.resource_spans.add()
    attribute(rs.resource, "Service.Name", "svc")
    attribute(rs.scope_spans.add().scope, "no.span.here", "x")
    ss = rs.scope_spans.add()
    attribute(ss.scope, "Build", True)
    for pairs in ((("a.b", ""), ("_hidden", "x")), (("a.b", "later"), ("A.b", "again"), ("n", 0)), ()):
        s = ss.spans.add(name="s")
        for k, v in pairs:
            attribute(s, k, v)
    (tmp_path / "t.binpb").write_bytes(q.SerializeToString())
    (tmp_path / "u.binpb").write_bytes(traces_payload())
    paths = [inputs.Input(str(tmp_path / f)) for f in ("t.binpb", "u.binpb")]
    want = attribute_names(R.decode_files(spark, "traces", paths))
    assert want == {"resource": ["service_name"], "scope": ["build"], "attr": ["a_b", "n"]}
    monkeypatch.setattr("sparktel.operators.flatten.attribute_names", None)
    df = R.read_traces(spark, f"{tmp_path}/*.binpb", "c")
    assert R.span_attribute_names(spark, paths) == want and {f"{n}_{k}" for n in want for k in want[n]} <= set(df.columns)
    assert "aggregate(" not in df._jdf.queryExecution().optimizedPlan().toString() and df.count() == 6


def test_spans_on_the_wire():
    """Spans encoded by hand are those that protobuf reads, large sizes too."""
    rows = [{"service": "FO"[i % 2], "trace": i << 40, "span": ("r", "7", "0")[i % 3], "parent": ("", "r", "r")[i % 3], "name": "n" * (i % 200), "kind": i % 6, "status": i % 3, "start_ns": i, "end_ns": (1 << 63) - 1 - i} for i in range(1000)]
    q = messages()["Traces"].FromString(otlp._encode_spans(pa.RecordBatch.from_pylist(rows)))
    got = [(r.resource.attributes[0].value.string_value, r.scope_spans[0].scope.name, r.scope_spans[0].scope.version, s) for r in q.resource_spans for s in r.scope_spans[0].spans]
    assert [len(r.scope_spans) for r in q.resource_spans] == [1, 1] and len(got) == len(rows)
    ident = {"": b"", "r": (255).to_bytes(8, "big"), "7": (7).to_bytes(8, "big"), "0": bytes(8)}
    for r, (service, scope, version, s) in zip(sorted(rows, key=lambda r: r["service"]), sorted(got, key=lambda g: (g[0], g[3].start_time_unix_nano)), strict=True):
        assert (service, scope, version, s.trace_id, s.span_id, s.parent_span_id) == (r["service"], "scope", "1", r["trace"].to_bytes(16, "big"), ident[r["span"]], ident[r["parent"]])
        assert (s.name, s.kind, s.start_time_unix_nano, s.end_time_unix_nano, s.status.code, s.status.message) == (r["name"], r["kind"], r["start_ns"], r["end_ns"], r["status"], "bad" if r["status"] == 2 else "")
        assert [(a.key, a.value.string_value) for a in s.attributes] == [("Role", "root" if r["parent"] == "" else "child")]


def test_flatten_collisions(spark):
    df = spark.sql("SELECT 'n' AS scope_name, map('name', 'x') AS scope, map('a', '1') AS attr")
    out = flatten_attributes(df)
    assert out.columns == ["scope_name", "scope_name_1", "attr_a"] and tuple(out.first()) == ("n", "x", "1")
    with pytest.raises(ValueError):
        flatten_attributes(df, strict=True)
    assert flatten_attributes(df, {"attr": ["b"]}).columns == ["scope_name", "attr_b"]


def test_data_source_and_view(spark, folder):
    R.register(spark)
    df = spark.read.format("otlp").option("signal", "traces").load(str(folder / "t.binpb"))
    assert df.count() == 3 and df.select("name").where("kind = 3").first()[0] == "child"
    R.create_view(spark, "m", "metrics", str(folder / "m1.binpb"), "c")
    assert spark.sql("SELECT count(*) FROM m WHERE chq_metric_type = 'histogram'").first()[0] == 3
    spans = R.canonical(df, "traces", "c", flat=True)
    assert spans.where("span_name = 'root'").first()["span_duration"] == 50 and "resource_service_name" in spans.columns
    with pytest.raises(Exception, match="signal"):
        spark.read.format("otlp").option("signal", "x").load("y").count()


def test_streams(spark, folder, tmp_path):
    m = R.stream(spark, "metrics", str(folder), "c", glob="m1*")
    q = windows.metric_windows(m).writeStream.format("memory").queryName("w").outputMode("complete").option("checkpointLocation", str(tmp_path / "a")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("w").agg(F.sum("cnt")).first()[0] == 5
    logs = R.stream(spark, "logs", str(folder), "c", glob="l*", metadata={"l.binpb": {"bucket": "b"}}).where("file_meta['bucket'] = 'b'").select("chq_fingerprint").writeStream.format("memory").queryName("lg").option("checkpointLocation", str(tmp_path / "b")).trigger(availableNow=True).start()
    logs.awaitTermination(120)
    assert spark.table("lg").count() == 3


def test_sql_calls(spark, folder):
    from sparktel.sources.sqlcalls import sql

    got = sql(spark, f"SELECT chq_metric_type, count(*) AS n /* otel_logs_read('x') */ FROM otel_metrics_read('{folder}/m1.binpb', customer_id = 'c') WHERE 'otel_traces_read(''y'')' <> '' GROUP BY 1 ORDER BY 1").collect()
    assert [tuple(r) for r in got] == [("count", 1), ("gauge", 1), ("histogram", 3)]
    joined = sql(spark, f"SELECT count(*) FROM OTEL_LOGS_READ('{folder}/l.binpb', customer_id := 'c', file_metadata => '{{}}') l JOIN otel_traces_read('{folder}/t.binpb', customer_id='c') t ON l.trace_id = t.span_trace_id")
    assert joined.first()[0] == 2
    for bad in (f"SELECT * FROM otel_metrics_read('{folder}/m1.binpb')", f"SELECT * FROM otel_traces_read('{folder}/t.binpb', customer_id='c', x='y')"):
        with pytest.raises(ValueError):
            sql(spark, bad)


def test_sql_functions(spark):
    R.register(spark)
    one = lambda x: spark.sql(f"SELECT {x}").first()[0]
    same = lambda c: spark.range(1).select(c).first()[0]
    text = "Service.Näme 中"
    assert one(f"otel_normalize('{text}')") == same(A.normalize_name(F.lit(text))) and one("otel_keeps_resource('app')") is True
    assert one(f"otel_hash('{text}')") == same(H.poly31(F.lit(text))) and one(f"otel_fnv1a('{text}')") == same(H.fnv1a(F.lit(text)))
    assert one("otel_field_fingerprint('a', 'b')") == same(H.field_fingerprint("a", F.lit("b"))) and one(f"otel_trigrams('{text}')") == same(H.trigrams(F.lit(text)))
    tags = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in (("resource_b", "1"), ("metric_name", "m"), ("other", "x"), ("attr_a", ""))])
    assert one("otel_tid(map('resource_b', '1', 'metric_name', 'm', 'other', 'x', 'attr_a', ''))") == same(H.tid(tags))
    assert one("otel_slot_ms(-1)") == (2**64 - 1) // 10**6 // 10_000 * 10_000 and one("otel_span_kind(2)") == "SPAN_KIND_SERVER" and one("otel_status_code(9)") == "STATUS_CODE_UNSET" and one("otel_metric_type('sum')") == "count"
    assert one("otel_jaccard(array('a', 'b'), array('b', 'c'))") == pytest.approx(1 / 3)
    assert one("otel_may_hold(array(otel_field_fingerprint('metric_name', 'm')), 'metric_name', 'm')") is True
    got = spark.sql("SELECT otel_sketch_quantile(otel_sketch_merge(s), 0.5D) AS p, otel_sketch_decode(otel_sketch_merge(s)).zero AS z FROM (SELECT otel_sketch(id - 2D) AS s FROM range(5) GROUP BY id % 2)").first()
    assert tuple(got) == (0.0, 1.0)
    row = spark.sql("SELECT r.* FROM (SELECT otel_tokenize(m) AS r, m FROM VALUES ('disk full on 10.0.0.1'), (NULL) AS t(m)) ORDER BY m NULLS LAST").collect()
    assert row[0]["tokens"] == ["disk", "full", "on", "<IPv4>"] and row[0]["fingerprint"] is not None and row[1]["tokens"] is None
