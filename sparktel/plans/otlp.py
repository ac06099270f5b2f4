"""Queries over OTLP files: the star-schema tables written as requests of each signal, and read back by path."""

from __future__ import annotations

import gzip
import json
import struct
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktel.functions import attributes as A
from sparktel.operators.logclusters import with_clusters
from sparktel.operators.logtokens import with_tokens
from sparktel.plans.frames import load, points, shared_folder, spans
from sparktel.plans.queries import _DURATION, _KIND, _NS, _POINTS, _SPANS, _STATUS, _signed, _sql_fnv, query
from sparktel.sources import readers
from sparktel.sources.files import write_bytes


def write_requests(rows: DataFrame, encode: Callable[[pa.RecordBatch], bytes], name: str, packed: bool = False) -> list[str]:
    """One OTLP file for each Arrow batch of rows, in the shared folder; the paths, of finished tasks only.

    packed: gzip files whose second member isn't part of the request.
    """
    folder = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, path = encode(b), f"{folder}/{uuid.uuid4().hex}.binpb{'.gz' if packed else ''}"
            write_bytes(path, gzip.compress(raw, 1) + gzip.compress(b"not read") if packed else raw)
            yield pa.RecordBatch.from_pydict({"path": [path]})

    return sorted(r["path"] for r in rows.mapInArrow(run, "path string").collect())  # a row a file


def _put(target, key: str, value) -> None:
    a = target.add(key=key)
    if value is not None:
        setattr(a.value, {str: "string_value", bool: "bool_value", int: "int_value", float: "double_value", bytes: "bytes_value"}[type(value)], value)


# -- metrics -----------------------------------------------------------------------------------------------------


def _encode_metrics(batch: pa.RecordBatch) -> bytes:
    """A metric of each kind by turns; distributions without a count among them."""
    from sparktel.sources.descriptors import messages

    q, resources = messages()["Metrics"](), {}
    for r in batch.to_pylist():
        if (rm := resources.get(r["service"])) is None:
            rm = resources[r["service"]] = q.resource_metrics.add()
            for k, v in (("service.name", r["service"]), ("host.name", "left out"), ("k8s.pod.name", "")):
                _put(rm.resource.attributes, k, v)
            sm = rm.scope_metrics.add()
            sm.scope.name, sm.scope.version = "scope", "2"
        m, i = rm.scope_metrics[0].metrics.add(name=r["name"], unit="ms"), r["event_id"]
        at = {"time_unix_nano": r["time_ns"]}
        if i % 5 == 0:
            p = m.gauge.data_points.add(as_double=r["value"], **at)
        elif i % 5 == 1:
            m.sum.aggregation_temporality, m.sum.is_monotonic = 1 + i % 2, True
            p = m.sum.data_points.add(as_int=i, **at)
        elif i % 5 == 2:
            p = m.histogram.data_points.add(count=3, sum=r["value"], min=1, max=9, bucket_counts=[3 * (i % 10 != 2), 0, 0], explicit_bounds=[4, 8], **at)
        elif i % 5 == 3:
            p = m.exponential_histogram.data_points.add(count=2, sum=r["value"], scale=0, zero_count=i % 2, **at)
            p.negative.bucket_counts.append(0)
        else:
            p = m.summary.data_points.add(count=5, sum=r["value"], **at)
            p.quantile_values.add(quantile=0.5, value=0.0)
        _put(p.attributes, "event.id", i)
        _put(p.attributes, "_hidden", "x")
        _put(p.attributes, "Empty", "")
    return q.SerializeToString()


_TAGS = "'attr_event_id=' || event_id || '|chq_metric_type=' || mtype || '|metric_name=' || mname || '|resource_service_name=' || service || '|'"


@query(f"""WITH {_POINTS}, k AS (SELECT *, event_id % 5 AS k, replace(name, '.', '_') AS mname, CASE event_id % 5 WHEN 0 THEN 'gauge' WHEN 1 THEN 'count' ELSE 'histogram' END AS mtype FROM points)
SELECT event_id, mname AS metric_name, mtype AS chq_metric_type, time_ns // 1000000 // 10000 * 10000 AS chq_timestamp, time_ns AS chq_tsns, service AS resource_service_name, 'ms' AS chq_unit, '2' AS chq_scope_url,
  CASE WHEN k = 1 THEN true END AS metric_is_monotonic, CASE WHEN k = 1 THEN CASE WHEN event_id % 2 = 0 THEN 'delta' ELSE 'cumulative' END END AS metric_temporality,
  CASE k WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 1 ELSE 5 END::DOUBLE AS "count", round(CASE k WHEN 1 THEN event_id ELSE value END, 4)::DOUBLE AS "sum",
  CASE k WHEN 0 THEN round(value, 4) WHEN 1 THEN event_id WHEN 2 THEN 9 ELSE 0 END::DOUBLE AS "max", {_signed(_sql_fnv(_TAGS))} AS chq_tid
FROM k WHERE NOT (k = 2 AND event_id % 10 = 2) AND NOT (k = 3 AND event_id % 2 = 0)""")
def otlp_metrics_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip files of every metric kind, read by a pattern: empty distributions dropped, attributes kept by rule, series ids."""
    paths = write_requests(points(spark, sf_dir), _encode_metrics, "metrics", packed=True)
    if not paths:
        return spark.createDataFrame([], "event_id bigint, metric_name string, chq_metric_type string, chq_timestamp bigint, chq_tsns bigint, resource_service_name string, chq_unit string, chq_scope_url string, metric_is_monotonic boolean, metric_temporality string, count double, sum double, max double, chq_tid bigint")
    m = readers.read_metrics(spark, f"{paths[0].rpartition('/')[0]}/*.binpb.gz", "c")
    return m.select(F.col("attr_event_id").cast("bigint").alias("event_id"), "metric_name", "chq_metric_type", "chq_timestamp", "chq_tsns", "resource_service_name", "chq_unit", "chq_scope_url", "metric_is_monotonic", "metric_temporality", F.col("chq_rollup_count").alias("count"), F.round("chq_rollup_sum", 4).alias("sum"), F.round("chq_rollup_max", 4).alias("max"), "chq_tid")


# -- logs --------------------------------------------------------------------------------------------------------


def _encode_logs(batch: pa.RecordBatch) -> bytes:
    from sparktel.sources.descriptors import messages

    q, resources = messages()["Logs"](), {}
    for r in batch.to_pylist():
        if (rl := resources.get(r["service"])) is None:
            rl = resources[r["service"]] = q.resource_logs.add()
            _put(rl.resource.attributes, "service.name", r["service"])
            _put(rl.resource.attributes, "_hidden", "x")
            sl = rl.scope_logs.add()
            sl.scope.name = "scope"
            _put(sl.scope.attributes, "Build", True)
        i = r["event_id"]
        x = rl.scope_logs[0].log_records.add(severity_text="" if i % 4 == 0 else "INFO", trace_id=bytes(16) if i % 3 else i.to_bytes(16, "big"), span_id=i.to_bytes(8, "big"))
        if i % 2:
            x.time_unix_nano = r["time_ns"]
        x.observed_time_unix_nano = r["time_ns"] + 10**6
        if i % 5 == 0:
            x.body.int_value = -i
        elif i % 5 == 1:
            x.body.double_value = r["value"]
        elif i % 5 == 2:
            x.body.bool_value = i % 2 == 0
        elif i % 5 == 3:
            x.body.array_value.values.add().int_value = 1
        else:
            x.body.bytes_value = i.to_bytes(4, "big")
        for k, v in (("event.id", i), ("Event-ID", "later"), ("Amount", r["value"]), ("", "no name"), ("none", None), ("_x", 1)):
            _put(x.attributes, k, v)
    return q.SerializeToString()


_DOUBLE = "regexp_replace(CAST(value AS VARCHAR), '\\.0$', '')"


@query(f"""WITH {_POINTS} SELECT event_id, 'svc-' AS prefix, service AS resource_service_name, 'true' AS scope_build, {_DOUBLE} AS attr_amount,
  CASE event_id % 5 WHEN 0 THEN CAST(-event_id AS VARCHAR) WHEN 1 THEN {_DOUBLE} WHEN 2 THEN CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END WHEN 3 THEN '[array]' ELSE lower(printf('%08x', event_id)) END AS log_message,
  CASE WHEN event_id % 4 <> 0 THEN 'INFO' END AS log_level, CASE WHEN event_id % 3 = 0 AND event_id > 0 THEN lower(printf('%032x', event_id)) END AS trace_id, CASE WHEN event_id > 0 THEN lower(printf('%016x', event_id)) END AS span_id,
  time_ns // 1000000 + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS chq_timestamp, time_ns + CASE WHEN event_id % 2 = 0 THEN 1000000 ELSE 0 END AS chq_tsns, 'logs' AS chq_telemetry_type, 'log_events' AS metric_name,
  'b1' AS bucket, 'n1' AS note FROM points""")
def otlp_logs_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files read by a JSON list with metadata of their own and more by path; bodies and attributes of every value kind."""
    paths = write_requests(points(spark, sf_dir), _encode_logs, "logs")
    if not paths:
        return spark.createDataFrame([], "event_id bigint, prefix string, resource_service_name string, scope_build string, attr_amount string, log_message string, log_level string, trace_id string, span_id string, chq_timestamp bigint, chq_tsns bigint, chq_telemetry_type string, metric_name string, bucket string, note string")
    own, more = [{"path": p, "bucket": "b1"} for p in paths], {p: {"bucket": "later", "note": "n1"} for p in paths}
    logs = readers.read_logs(spark, json.dumps(own), "c", file_metadata=json.dumps(more), mode="exact")
    return logs.select(F.col("attr_event_id").cast("bigint").alias("event_id"), F.substring("resource_service_name", 1, 4).alias("prefix"), "resource_service_name", "scope_build", "attr_amount", "log_message", "log_level", "trace_id", "span_id", "chq_timestamp", "chq_tsns", "chq_telemetry_type", "metric_name", "bucket", "note")


# -- traces ------------------------------------------------------------------------------------------------------


def _framed(tag: bytes, body: bytes) -> bytes:
    """A field of bytes on the wire."""
    n, size = len(body), b""
    while n > 127:
        size, n = size + bytes([n & 127 | 128]), n >> 7
    return tag + size + bytes([n]) + body


def _encode_spans(batch: pa.RecordBatch) -> bytes:
    """Spans by service.  What many spans share is encoded once, ids and times by hand: the order of a message's fields is free."""
    from sparktel.sources.descriptors import messages

    def shared(name: str, kind: int, status: int, root: bool) -> bytes:
        x = messages()["Span"](name=name, kind=kind)
        x.status.code = status
        if status == 2:
            x.status.message = "bad"
        _put(x.attributes, "Role", "root" if root else "child")
        return x.SerializeToString()

    shared, services, packed = lru_cache(maxsize=None)(shared), {}, struct.Struct("<BQBQ").pack
    ident = lru_cache(maxsize=1 << 10)(lambda tag, s: b"" if s == "" else tag + (255 if s == "r" else int(s)).to_bytes(8, "big"))
    columns = [batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("service", "trace", "span", "parent", "name", "kind", "status", "start_ns", "end_ns")]
    for service, trace, span, parent, name, kind, status, start, end in zip(*columns, strict=True):
        x = b"\x0a\x10" + trace.to_bytes(16, "big") + ident(b"\x12\x08", span) + ident(b"\x22\x08", parent) + packed(0x39, start, 0x41, end)
        services.setdefault(service, []).append(_framed(b"\x12", x + shared(name, kind, status, parent == "")))
    out = []
    for service, spans_of in services.items():
        rs, ss = messages()["ResourceSpans"](), messages()["ScopeSpans"]()
        _put(rs.resource.attributes, "service.name", service)
        ss.scope.name, ss.scope.version = "scope", "1"
        out.append(_framed(b"\x0a", rs.SerializeToString() + _framed(b"\x12", ss.SerializeToString() + b"".join(spans_of))))
    return b"".join(out)


_IDENT = "CASE {0} WHEN '' THEN '' WHEN '0' THEN '' WHEN 'r' THEN '00000000000000ff' ELSE lower(printf('%016x', TRY_CAST({0} AS BIGINT))) END"


@query(f"""WITH {_SPANS}, t AS (SELECT *, CASE WHEN trace = 0 THEN '' ELSE lower(printf('%032x', trace)) END AS tid FROM spans)
SELECT tid AS span_trace_id, {_IDENT.format('span')} AS span_id, {_IDENT.format('parent')} AS span_parent_span_id, name AS span_name, {_KIND} AS span_kind, {_STATUS} AS span_status_code,
  CASE WHEN status = 2 THEN 'bad' END AS span_status_message, start_ns // 1000000 AS chq_timestamp, start_ns AS chq_tsns, end_ns // 1000000 AS span_end_timestamp, {_DURATION} AS span_duration, service AS resource_service_name,
  CASE WHEN parent = '' THEN 'root' ELSE 'child' END AS attr_role, 'scope' AS scope_name, '1' AS scope_version, 'traces' AS chq_telemetry_type,
  -- telemetry type: existence, value, 4 trigrams; trace: existence, value, its trigrams; service of one letter: existence, value; role: existence
  6 + CASE WHEN tid = '' THEN 0 ELSE 2 + len(list_distinct(list_transform(range(1, 31), lambda i: substr(tid, i::INTEGER, 3)))) END + 2 + 1 AS prints FROM t""")
def otlp_traces_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of orders and lines, written as files and read by a list of paths."""
    paths = write_requests(spans(spark, sf_dir), _encode_spans, "traces")
    if not paths:
        return spark.createDataFrame([], "span_trace_id string, span_id string, span_parent_span_id string, span_name string, span_kind string, span_status_code string, span_status_message string, chq_timestamp bigint, chq_tsns bigint, span_end_timestamp bigint, span_duration bigint, resource_service_name string, attr_role string, scope_name string, scope_version string, chq_telemetry_type string, prints bigint")
    t = readers.read_traces(spark, f"[{', '.join(paths)}]", "c")
    prints = (F.size(F.split("chq_fingerprint", ","))).cast("bigint").alias("prints")
    return t.select("span_trace_id", "span_id", "span_parent_span_id", "span_name", "span_kind", "span_status_code", "span_status_message", "chq_timestamp", "chq_tsns", "span_end_timestamp", "span_duration", "resource_service_name", "attr_role", "scope_name", "scope_version", "chq_telemetry_type", prints)


# -- tokens and clusters -----------------------------------------------------------------------------------------

#: A message (`{n}` the event's number, `{d}` a digit of it, `{t}` its type), the tokens it gives, and its level.
_MESSAGES = [
    ("found 'x y {n}' here", "found <QuotedString> here", ""), ("at 2024-03-0{d}T01:02:03.5Z started", "at <ISO8601> started", ""), ("from lib{n}@v1.2.3/x/main.go:{n} called", "from <ModuleName> called", ""),
    ("job 0a1b2c3d-0a1b-0a1b-0a1b-0a1b2c3d4e5f done", "job <UUID> done", ""), ("open http://host{n}.example.org:80/a/b now", "open <Url> now", ""), ("send to user{n}@mail.example.org now", "send to <Email> now", ""),
    ("read /var/log/{t}/{n} now", "read <Path> now", ""), ("from 10.1.2.{d} now", "from <IPv4> now", ""), ("at 01:02:0{d} now", "at <Time> now", ""), ("on 2024-03-0{d} now", "on <Date> now", ""),
    ("took {n}ms here", "took <Duration> here", ""), ("host node.example.org down", "host <FQDN> down", ""), ("count {n} rows", "count <Number> rows", ""), ("ERROR: disk full", "<Loglevel> disk full", "error"),
    ("GET request failed", "<HTTPMethod> request failed", ""), ("key AbCdEf0123456789AbCdEf+/0123 ok", "key <Identifier> ok", ""), ("job q7x9-{n}-zz done", "job <Identifier> done", ""), ("\x1b[31mwarn\x1b[0m user logged in", "<Loglevel> user logged in", "warn"),
    ('before {{"level": "INFO", "a": {{"b": {n}, "c": []}}, "msg": "user {n} ok"}} after', "before <Loglevel> user <Number> ok after", "info"), ("first line\nsecond line {n}", "first line", ""), ("count 300.1.2.{d} rows", "count <Identifier> rows", ""),
]


def _messages(events: DataFrame) -> DataFrame:
    """events with a message by turns from _MESSAGES."""
    out = F.lit(None).cast("string")
    for k, (text, _, _) in enumerate(_MESSAGES):
        one = F.lit(text.replace("{{", "\x01").replace("}}", "\x02"))
        for name, value in (("n", F.col("event_id").cast("string")), ("d", F.pmod("event_id", F.lit(9)).cast("string")), ("t", F.col("event_type"))):
            one = F.replace(one, F.lit(f"{{{name}}}"), value)
        out = F.when(F.pmod("event_id", F.lit(len(_MESSAGES))) == k, F.translate(one, "\x01\x02", "{}")).otherwise(out)
    return events.withColumn("body", out)


def _by_message(values: list[str | None]) -> str:
    text = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return f"CASE event_id % {len(_MESSAGES)} " + " ".join(f"WHEN {k} THEN {text(v)}" for k, v in enumerate(values)) + " END"


_JSON_AT = next(k for k, m in enumerate(_MESSAGES) if "{{" in m[0])


@query(f"""SELECT event_id, {_by_message([m[1] for m in _MESSAGES])} AS tokens, {_by_message([m[2] for m in _MESSAGES])} AS level, {_by_message(['a.b,a.c,level,msg' if k == _JSON_AT else None for k in range(len(_MESSAGES))])} AS keys FROM events""")
def log_token_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of every token shape, of levels, quotes, escapes, lines and JSON."""
    t = with_tokens(_messages(load(spark, sf_dir, "events").select("event_id", "event_type")), "body")
    return t.select("event_id", F.array_join("log_tokens", " ").alias("tokens"), F.col("log_detected_level").alias("level"), F.array_join("log_json_keys", ",").alias("keys"))


@query(f"""SELECT {_by_message([m[1] for m in _MESSAGES])} AS tokens, count(*) AS n, 1 AS prints, min(event_id) AS first FROM events GROUP BY 1""")
def log_fingerprint_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal tokens and keys have one fingerprint, others another: grouped by it."""
    t = with_tokens(_messages(load(spark, sf_dir, "events").select("event_id", "event_type")), "body")
    g = t.groupBy("log_fingerprint").agg(F.count("*").alias("n"), F.min("event_id").alias("first"), F.min(F.array_join("log_tokens", " ")).alias("tokens"), F.max(F.array_join("log_tokens", " ")).alias("other"))
    return g.where("tokens = other").groupBy("tokens").agg(F.sum("n").alias("n"), F.count("*").alias("prints"), F.min("first").alias("first"))


#: Messages whose variable parts are words, so that only similarity can unite them, with the words that vary.
_VARIED = [("user {} logged in from home", ("alpha", "beta")), ("disk {} almost full on server", ("first", "second", "third")), ("payment of order failed with {} error", ("network", "database"))]


def _varied(which: str) -> str:
    turns = " ".join(f"WHEN {k} THEN " + f"CASE event_id // 3 % {len(words)} " + " ".join(f"WHEN {i} THEN '{text.format(w)}'" for i, w in enumerate(words)) + " END" for k, (text, words) in enumerate(_VARIED))
    return f"CASE {which} {turns} END"


@query("""WITH m AS (SELECT event_id, 't' || (event_id % 4) AS tenant, event_id % 3 AS kind FROM events)
SELECT tenant, min(event_id) AS first, count(*) AS n FROM m GROUP BY tenant, kind""")
def log_cluster_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar messages of a tenant share a cluster, tenants share none: the first event and the size of each cluster."""
    e = load(spark, sf_dir, "events").select("event_id", F.concat(F.lit("t"), F.pmod("event_id", F.lit(4)).cast("string")).alias("tenant"), F.expr(_varied("event_id % 3").replace("//", "div")).alias("body"))
    c = with_clusters(with_tokens(e, "body"), "tenant", ["event_id"])
    return c.groupBy("tenant", "log_cluster").agg(F.min("event_id").alias("first"), F.count("*").alias("n")).select("tenant", "first", "n")


@query("SELECT c_custkey, 's' || (c_custkey % 7) AS resource_service_name, CASE WHEN c_custkey % 2 = 0 THEN 'a' || c_custkey END AS attr_even FROM customer")
def attribute_flattening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of attributes become columns, null where a row lacks one."""
    from sparktel.operators.flatten import flatten_attributes

    c = load(spark, sf_dir, "customer")
    resource = F.create_map(A.normalize_name(F.lit("Service.Name")), F.concat(F.lit("s"), F.pmod("c_custkey", F.lit(7)).cast("string")))
    attr = F.when(F.pmod("c_custkey", F.lit(2)) == 0, F.create_map(F.lit("even"), F.concat(F.lit("a"), F.col("c_custkey").cast("string"))))
    return flatten_attributes(c.select("c_custkey", resource.alias("resource"), attr.alias("attr")))
