"""The engine's functions for SQL: most as expressions that Catalyst inlines, those over sketches and messages by Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktel.functions.attributes import RESOURCE_KEYS, SLOT_MS, SPAN_KINDS, STATUS_CODES
from sparktel.functions.hashing import EXACT_FIELDS, EXISTS, FNV_LOW, FNV_SEED, TRIGRAM_FIELDS
from sparktel.functions.sketch import Sketch
from sparktel.operators import enrich
from sparktel.operators.logtokens import tokenize

_M = 0xFFFFFFFF
_LATIN = "decode(encode({0}, 'UTF-8'), 'ISO-8859-1')"
_BYTES = f"transform(filter(split({_LATIN.format('x')}, ''), c -> c <> ''), c -> CAST(ascii(c) AS BIGINT))"
_SUM = "(shiftleft(({high} + shiftrightunsigned({low}, 32)) & " + str(_M) + ", 32) | ({low} & " + str(_M) + "))"
_POLY = f"aggregate({_BYTES}, 0L, (h, b) -> {_SUM.format(high='shiftrightunsigned(h, 32) * 31', low=f'((h & {_M}) * 31 + b)')})"
_TIMES = _SUM.format(high=f"shiftrightunsigned(g, 32) * {FNV_LOW} + shiftleft(g & 16777215, 8)", low=f"((g & {_M}) * {FNV_LOW})")
_FNV = f"aggregate({_BYTES}, {FNV_SEED}L, (h, b) -> transform(array(h ^ b), g -> {_TIMES})[0])"
_list = lambda names: ", ".join(f"'{n}'" for n in names)
_labels = lambda labels: "CASE x " + " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(labels)) + f" ELSE '{labels[0]}' END"

#: name: (parameters, type of the result, expression)
FUNCTIONS = {
    "otel_normalize": ("x STRING", "STRING", f"lower(regexp_replace({_LATIN.format('x')}, '[^A-Za-z0-9]', '_'))"),
    "otel_keeps_resource": ("x STRING", "BOOLEAN", f"x IN ({_list(RESOURCE_KEYS)})"),
    "otel_metric_type": ("x STRING", "STRING", "CASE WHEN x = 'sum' THEN 'count' WHEN x IN ('histogram', 'exponential_histogram', 'summary') THEN 'histogram' ELSE 'gauge' END"),
    "otel_span_kind": ("x INT", "STRING", _labels(SPAN_KINDS)),
    "otel_status_code": ("x INT", "STRING", _labels(STATUS_CODES)),
    "otel_millis": ("x BIGINT", "BIGINT", "CASE WHEN x >= 0 THEN x div 1000000 ELSE (CAST(x AS DECIMAL(20, 0)) + 18446744073709551616BD) div 1000000BD END"),
    "otel_slot_ms": ("x BIGINT", "BIGINT", f"otel_millis(x) div {SLOT_MS} * {SLOT_MS}"),
    "otel_hash": ("x STRING", "BIGINT", _POLY),
    "otel_fnv1a": ("x STRING", "BIGINT", _FNV),
    "otel_field_fingerprint": ("field STRING, value STRING", "BIGINT", "otel_hash(field || ':' || value)"),
    "otel_trigrams": ("x STRING", "ARRAY<STRING>", "CASE WHEN length(x) >= 3 THEN array_distinct(transform(sequence(1, length(x) - 2), i -> substr(x, i, 3))) ELSE CAST(array() AS ARRAY<STRING>) END"),
    "otel_jaccard": ("a ARRAY<STRING>, b ARRAY<STRING>", "DOUBLE", "CASE WHEN size(array_union(a, b)) = 0 THEN 0D ELSE size(array_intersect(a, b)) / size(array_union(a, b)) END"),
    "otel_tid": (
        "tags MAP<STRING, STRING>", "BIGINT",
        "otel_fnv1a(array_join(transform(array_sort(filter(map_entries(tags), t -> t.value <> '' AND (t.key IN ('metric_name', 'chq_metric_type') OR startswith(t.key, 'resource_') OR startswith(t.key, 'attr_')))), t -> t.key || '=' || t.value || '|'), ''))",
    ),
    "otel_may_hold": ("prints ARRAY<BIGINT>, field STRING, value STRING", "BOOLEAN", f"array_contains(prints, otel_hash(field || ':' || CASE WHEN field IN ({_list((*TRIGRAM_FIELDS, *EXACT_FIELDS))}) THEN value ELSE '{EXISTS}' END))"),
}


@F.pandas_udf(T.BinaryType())
def sketch_of(values: pd.Series) -> bytes:
    """Aggregate: the encoded sketch of a column of numbers."""
    s = Sketch()
    x = values.to_numpy(dtype=float, na_value=float("nan"))
    s.add_all(x[abs(x) < float("inf")])
    return s.encode()


@F.pandas_udf(T.BinaryType())
def sketch_merge(sketches: pd.Series) -> bytes:
    """Aggregate: encoded sketches merged to one.  A group's sketches meet in one task: enrich.merge_sketches has no such bound."""
    out = Sketch()
    for raw in sketches.dropna():
        out.merge(Sketch.decode(bytes(raw)))
    return out.encode()


@F.pandas_udf(T.DoubleType())
def sketch_quantile(sketches: pd.Series, q: pd.Series) -> pd.Series:
    return pd.Series([None if raw is None else Sketch.decode(bytes(raw)).quantile(p) for raw, p in zip(sketches, q, strict=True)], dtype="float64")


@F.pandas_udf("tokens array<string>, keys array<string>, level string, fingerprint bigint")
def message_tokens(messages: pd.Series) -> pd.DataFrame:
    """Tokens, JSON keys (null without JSON), level and fingerprint of log messages; null for null."""
    found = {m: tokenize(m) for m in messages.dropna().unique()}
    rows = [(None, None, None, None) if m is None else ((x := found[m]).items, x.keys, x.level, x.fingerprint()) for m in messages]
    return pd.DataFrame(rows, columns=["tokens", "keys", "level", "fingerprint"]).astype({"fingerprint": "Int64"})


def register_functions(spark: SparkSession) -> None:
    """The functions, under their names, for this session."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    for name, f in (("otel_sketch", sketch_of), ("otel_sketch_merge", sketch_merge), ("otel_sketch_quantile", sketch_quantile), ("otel_sketch_decode", enrich.sketch_decode), ("otel_tokenize", message_tokens), ("otel_ulid", enrich.ulid)):
        spark.udf.register(name, f)
