"""Decoded OTLP rows to the canonical tables: every derived column is an expression of its own, so unused ones cost nothing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktel.functions import attributes as A
from sparktel.functions import hashing as H
from sparktel.functions import sketch as S
from sparktel.functions.prints import of_batch
from sparktel.operators.logclusters import with_clusters
from sparktel.operators.logtokens import with_tokens

METRIC_COLUMNS = [
    "chq_customer_id", "chq_telemetry_type", "chq_tid", "chq_timestamp", "chq_tsns", "metric_name", "chq_description", "chq_unit", "chq_metric_type",
    "chq_scope_name", "chq_scope_url", "metric_is_monotonic", "metric_temporality", "chq_sketch", *[f"chq_rollup_{r}" for r in ("avg", "count", "min", "max", "sum", "p25", "p50", "p75", "p90", "p95", "p99")],
]
LOG_COLUMNS = ["chq_id", "chq_customer_id", "chq_telemetry_type", "chq_timestamp", "chq_tsns", "chq_fingerprint", "log_level", "log_message", "metric_name", "scope_name", "scope_version", "trace_id", "span_id"]
SPAN_COLUMNS = [
    "chq_customer_id", "chq_telemetry_type", "chq_timestamp", "chq_tsns", "chq_fingerprint", "span_trace_id", "span_id", "span_parent_span_id", "span_name", "span_kind",
    "span_status_code", "span_status_message", "span_end_timestamp", "span_duration", "scope_name", "scope_version",
]
_SKETCH = T.StructType([T.StructField("sketch", T.BinaryType()), *[T.StructField(r, T.DoubleType()) for r in S.ROLLUPS]])
_BINS = T.ArrayType(T.StructType([T.StructField("idx", T.IntegerType()), T.StructField("cnt", T.DoubleType())]))
_DECODED = T.StructType([*[T.StructField(n, T.DoubleType()) for n in ("count", "sum", "min", "max", *S.QUANTILES)], T.StructField("bins", _BINS), T.StructField("negative", _BINS), T.StructField("zero", T.DoubleType())])


def sketch_of(kind, count, total, low, high, counts, bounds, scale, zero, po, pc, no, nc, quantiles) -> tuple[S.Sketch, float | None, float | None]:
    """The sketch of a distribution, and the minimum and maximum that the point itself states."""
    if kind == "histogram":
        return S.from_histogram(list(counts), list(bounds), int(count), total), low, high
    if kind == "exponential_histogram":
        return S.from_exponential(int(scale), int(zero), (int(po), list(pc)), (int(no), list(nc)), total, low, high), low, high
    return S.from_summary(int(count), total, [(q["q"], q["v"]) for q in quantiles]), None, None


@F.pandas_udf(_SKETCH)
def _distributions(kind: pd.Series, count: pd.Series, total: pd.Series, low: pd.Series, high: pd.Series, counts: pd.Series, bounds: pd.Series, scale: pd.Series, zero: pd.Series, po: pd.Series, pc: pd.Series, no: pd.Series, nc: pd.Series, quantiles: pd.Series) -> pd.DataFrame:
    """Sketches of distributions; null for other kinds."""
    out: list[tuple] = [(None,) * (1 + len(S.ROLLUPS))] * len(kind)
    none = lambda x: None if x is None or x != x else float(x)
    for i in kind.index[kind.isin(["histogram", "exponential_histogram", "summary"])]:
        s, least, most = sketch_of(kind[i], count[i], none(total[i]), none(low[i]), none(high[i]), *[c[i] for c in (counts, bounds, scale, zero, po, pc, no, nc, quantiles)])
        r = s.rollups()
        r["min"], r["max"] = r["min"] if least is None else least, r["max"] if most is None else most
        out[i] = (s.encode(), *(float(r[n]) for n in S.ROLLUPS))
    return pd.DataFrame(out, columns=["sketch", *S.ROLLUPS])


def sketches(kind: Column, value: Column, *distribution: Column) -> Column:
    """struct<sketch, rollups> of data points: numbers in closed form, distributions by their own builders."""
    return F.when(kind.isin("gauge", "sum"), S.single(value)).otherwise(_distributions(kind, *distribution))


@F.pandas_udf(_DECODED)
def sketch_decode(raw: pd.Series) -> pd.DataFrame:
    """Statistics, quantiles, positive and negative bins and the count of zeros of encoded sketches; null for null."""
    bins = lambda store: [{"idx": k, "cnt": store[k]} for k in sorted(store)]
    out: list[tuple] = []
    for b in raw:
        if b is None:
            out.append((None,) * len(_DECODED))
            continue
        s = S.Sketch.decode(bytes(b))
        out.append((s.count, s.sum, s.min, s.max, *[s.quantile(q) for q in S.QUANTILES.values()], bins(s.positive), bins(s.negative), s.zero))
    return pd.DataFrame(out, columns=_DECODED.names)


def merge_sketches(df: DataFrame, keys: list[str], sketch: str = "chq_sketch") -> DataFrame:
    """Encoded sketches merged by key: partly in each task, then once a key and salt, so no group is gathered whole."""
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", sketch binary"

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, S.Sketch] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(*k, s.encode()) for k, s in held.items()], columns=[*keys, "sketch"])
            held.clear()
            return out

        for pdf in batches:
            for *key, raw in pdf.itertuples(index=False, name=None):
                s = S.Sketch.decode(raw)
                key = tuple(key)
                held[key].merge(s) if key in held else held.__setitem__(key, s)
            if len(held) > 10_000:
                yield flush()
        yield flush()

    one = df.select(*keys, F.col(sketch).alias("sketch")).mapInPandas(partial, schema)
    return one.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(partial, schema).withColumnRenamed("sketch", sketch)


def _tags(first: list[tuple[str, Column]], *arrays: Column) -> Column:
    return F.concat(F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in first]), *arrays)


def metrics(rows: DataFrame, customer_id: str) -> DataFrame:
    """METRIC_SCHEMA rows to the canonical metric table: the fixed columns, then maps resource and attr."""
    name, kind = A.normalize_name(F.col("name")), A.metric_type(F.col("kind"))
    tid = H.tid(_tags([("metric_name", name), ("chq_metric_type", kind)], F.col("resource_tags"), F.col("attr_tags")))
    sk = sketches(F.col("kind"), F.col("value"), *map(F.col, ("count", "sum", "min", "max", "bucket_counts", "bounds", "scale", "zero_count", "pos_offset", "pos_counts", "neg_offset", "neg_counts", "quantiles")))
    rows = rows.withColumn("_s", sk)
    return rows.select(
        F.lit(customer_id).alias("chq_customer_id"), F.lit("metrics").alias("chq_telemetry_type"), tid.alias("chq_tid"), A.slot_ms(F.col("time_ns")).alias("chq_timestamp"), F.col("time_ns").alias("chq_tsns"),
        name.alias("metric_name"), F.col("description").alias("chq_description"), F.col("unit").alias("chq_unit"), kind.alias("chq_metric_type"), F.col("scope_name").alias("chq_scope_name"), F.col("scope_version").alias("chq_scope_url"),
        F.col("is_monotonic").alias("metric_is_monotonic"), F.when(F.col("kind") == "sum", A.temporality(F.col("temporality"))).alias("metric_temporality"),
        F.col("_s.sketch").alias("chq_sketch"), *[F.col(f"_s.{r}").alias(f"chq_rollup_{r}") for r in S.ROLLUPS], "resource", "attr",
    )


#: The digits of a ULID.
_ULID = "0123456789abcdefghjkmnpqrstvwxyz"


@F.pandas_udf(T.StringType())
def _ulid(n: pd.Series) -> pd.Series:
    import secrets
    import time

    def one() -> str:
        x = int(time.time() * 1000) << 80 | secrets.randbits(80)
        return "".join(_ULID[x >> 5 * i & 31] for i in range(25, -1, -1))

    return pd.Series([one() for _ in n])


ulid: Callable[[Column], Column] = _ulid.asNondeterministic()


def logs(rows: DataFrame, customer_id: str, mode: str = "cluster") -> DataFrame:
    """LOG_SCHEMA rows to the canonical log table.  mode `cluster`: fingerprints of similar messages agree, in the order of
    file and record, whose tokens pass through one task; `exact`: of the message alone, without a shuffle."""
    if mode not in ("cluster", "exact"):
        raise ValueError("mode is cluster or exact")
    if mode == "cluster":
        marks = with_clusters(with_tokens(rows.select("file", "ord", "body"), "body").withColumn("_tenant", F.lit(customer_id)), "_tenant", ["file", "ord"])
        rows = rows.join(marks.select("file", "ord", "log_cluster"), ["file", "ord"])
    else:
        rows = with_tokens(rows, "body")
    ms = lambda c: A.millis(F.col(c))
    return rows.select(
        ulid(F.col("ord")).alias("chq_id"), F.lit(customer_id).alias("chq_customer_id"), F.lit("logs").alias("chq_telemetry_type"),
        F.coalesce(F.when(F.col("time_ns") != 0, ms("time_ns")), F.when(F.col("observed_ns") != 0, ms("observed_ns")), F.unix_millis(F.current_timestamp())).alias("chq_timestamp"),
        A.first_time(F.col("time_ns"), F.col("observed_ns")).alias("chq_tsns"), F.col("log_cluster" if mode == "cluster" else "log_fingerprint").alias("chq_fingerprint"),
        F.col("severity_text").alias("log_level"), F.col("body").alias("log_message"), F.lit("log_events").alias("metric_name"), "scope_name", "scope_version",
        A.hex_id(F.col("trace_id"), None).alias("trace_id"), A.hex_id(F.col("span_id"), None).alias("span_id"), "resource", "scope", "attr", "file_meta",
    )


@F.arrow_udf(T.ArrayType(T.LongType()))
def _span_prints(trace: pa.Array, resource: pa.Array, scope: pa.Array, attr: pa.Array) -> pa.Array:
    """hashing.fingerprints of a span's tags: type, trace id and the attributes."""
    kind = pa.repeat("traces", len(trace))
    return of_batch({"chq_telemetry_type": kind, "span_trace_id": trace}, {"resource_": resource, "scope_": scope, "attr_": attr})


def spans(rows: DataFrame, customer_id: str, as_text: bool = True) -> DataFrame:
    """SPAN_SCHEMA rows to the canonical span table; the fingerprint set as text, or as array<bigint>."""
    trace = A.hex_id(F.col("trace_id"), "")
    prints = _span_prints(trace, *map(F.col, ("resource", "scope", "attr")))
    ms = lambda c: F.when(F.col(c) != 0, A.millis(F.col(c))).otherwise(F.unix_millis(F.current_timestamp()))
    return rows.select(
        F.lit(customer_id).alias("chq_customer_id"), F.lit("traces").alias("chq_telemetry_type"), ms("start_ns").alias("chq_timestamp"),
        F.when(F.col("start_ns") != 0, F.col("start_ns")).otherwise(F.unix_micros(F.current_timestamp()) * 1000).alias("chq_tsns"),
        (H.fingerprint_text(prints) if as_text else prints).alias("chq_fingerprint"), trace.alias("span_trace_id"), A.hex_id(F.col("span_id"), "").alias("span_id"), A.hex_id(F.col("parent_span_id"), "").alias("span_parent_span_id"),
        F.col("name").alias("span_name"), A.span_kind(F.col("kind")).alias("span_kind"), A.status_code(F.col("status_code")).alias("span_status_code"), F.nullif(F.col("status_message"), F.lit("")).alias("span_status_message"),
        ms("end_ns").alias("span_end_timestamp"), A.duration_ms(F.col("start_ns"), F.col("end_ns")).alias("span_duration"), "scope_name", "scope_version", "resource", "scope", "attr",
    )
