"""OTLP bytes to flat rows.  What rows cost to enrich (ids, sketches, fingerprints) is left to expressions on them."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from decimal import Decimal
from functools import lru_cache

from sparktel.functions.attributes import RESOURCE_KEYS
from sparktel.sources.descriptors import messages

_OTHER = re.compile(rb"[^A-Za-z0-9]")
ATTRS = "array<struct<k:string,v:string>>"
MAPS = "map<string,string>"
METRIC_SCHEMA = (
    "file int, ord bigint, name string, description string, unit string, kind string, scope_name string, scope_version string, time_ns bigint, "
    f"is_monotonic boolean, temporality int, value double, count bigint, sum double, min double, max double, bucket_counts array<bigint>, bounds array<double>, "
    f"scale int, zero_count bigint, pos_offset int, pos_counts array<bigint>, neg_offset int, neg_counts array<bigint>, quantiles array<struct<q:double,v:double>>, "
    f"resource {MAPS}, attr {MAPS}, resource_tags {ATTRS}, attr_tags {ATTRS}"
)
LOG_SCHEMA = f"file int, ord bigint, time_ns bigint, observed_ns bigint, severity_text string, body string, trace_id binary, span_id binary, scope_name string, scope_version string, resource {MAPS}, scope {MAPS}, attr {MAPS}, file_meta {MAPS}"
SPAN_SCHEMA = f"file int, ord bigint, trace_id binary, span_id binary, parent_span_id binary, name string, kind int, start_ns bigint, end_ns bigint, status_code int, status_message string, scope_name string, scope_version string, resource {MAPS}, scope {MAPS}, attr {MAPS}"


def inflate(path: str, raw: bytes) -> bytes:
    """The first gzip member of a file named *.gz; other files as they are."""
    if not path.endswith(".gz"):
        return raw
    gz = zlib.decompressobj(31)
    out = gz.decompress(raw)
    if not gz.eof:
        raise ValueError(f"{path}: the gzip stream is cut off")
    return out


@lru_cache(maxsize=1 << 14)
def normalize(name: str) -> str:
    return _OTHER.sub(b"_", name.encode()).decode().lower()


def plain_double(x: float) -> str:
    """Shortest decimal digits that read back as x, never with an exponent."""
    if x != x:
        return "NaN"
    if math.isinf(x):
        return "inf" if x > 0 else "-inf"
    text = format(Decimal(repr(x)), "f")
    return text[:-2] if text.endswith(".0") else text


def any_text(value) -> str:
    kind = value.WhichOneof("choice")
    if kind == "string_value":
        return value.string_value
    if kind == "bool_value":
        return "true" if value.bool_value else "false"
    if kind == "int_value":
        return str(value.int_value)
    if kind == "double_value":
        return plain_double(value.double_value)
    if kind == "bytes_value":
        return value.bytes_value.hex()
    return {"array_value": "[array]", "kvlist_value": "[kvlist]"}.get(kind, "")


def signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def public(attributes) -> dict[str, str]:
    """Normalized names of attributes whose raw name doesn't begin with `_` and whose text isn't empty; the first wins."""
    out: dict[str, str] = {}
    for a in attributes:
        if not a.key.startswith("_") and (text := any_text(a.value)):
            out.setdefault(normalize(a.key), text)
    return out


def tags(prefix: str, attributes, keep=None, hidden: bool = True) -> list[tuple[str, str]]:
    """(prefixed normalized name, text) of every non-empty attribute, repeats included."""
    pairs = ((normalize(a.key), any_text(a.value)) for a in attributes if hidden or not a.key.startswith("_"))
    return [(prefix + k, v) for k, v in pairs if v and (keep is None or k in keep)]


def metric_rows(raw: bytes, file: int = 0) -> Iterator[tuple]:
    """Rows of METRIC_SCHEMA.  A distribution without any count is left out; summaries never are."""
    request = messages()["Metrics"]()
    request.ParseFromString(raw)
    n = 0
    for rm in request.resource_metrics:
        attributes = rm.resource.attributes
        resource = {k: v for k, v in ((normalize(a.key), any_text(a.value)) for a in reversed(attributes)) if v and k in RESOURCE_KEYS}
        resource_tags = tags("resource_", attributes, RESOURCE_KEYS)
        for sm in rm.scope_metrics:
            for m in sm.metrics:
                kind = m.WhichOneof("choice")
                if kind is None:
                    continue
                data = getattr(m, kind)
                for p in data.data_points:
                    value = count = total = low = high = scale = zero = None
                    counts = bounds = pos = neg = quantiles = None
                    pos_offset = neg_offset = None
                    if kind in ("gauge", "sum"):
                        which = p.WhichOneof("choice")
                        value = float(getattr(p, which)) if which else 0.0
                    elif kind == "summary":
                        count, total, quantiles = signed(p.count), p.sum, [(q.quantile, q.value) for q in p.quantile_values]
                    else:
                        count, total = signed(p.count), p.sum if p.HasField("sum") else None
                        low, high = p.min if p.HasField("min") else None, p.max if p.HasField("max") else None
                        if kind == "histogram":
                            counts, bounds = [signed(c) for c in p.bucket_counts], list(p.explicit_bounds)
                            if not any(counts):
                                continue
                        else:
                            scale, zero = p.scale, signed(p.zero_count)
                            pos, neg = [signed(c) for c in p.positive.bucket_counts], [signed(c) for c in p.negative.bucket_counts]
                            pos_offset, neg_offset = p.positive.offset, p.negative.offset
                            if not (any(pos) or any(neg) or zero):
                                continue
                    yield (
                        file, n, m.name, m.description, m.unit, kind, sm.scope.name, sm.scope.version, signed(p.time_unix_nano),
                        data.is_monotonic if kind == "sum" else None, data.aggregation_temporality if kind in ("sum", "histogram", "exponential_histogram") else None,
                        value, count, total, low, high, counts, bounds, scale, zero, pos_offset, pos, neg_offset, neg, quantiles,
                        resource, public(p.attributes), resource_tags, tags("attr_", p.attributes, hidden=False),
                    )
                    n += 1


def log_rows(raw: bytes, file: int = 0, meta: tuple[tuple[str, str], ...] = ()) -> Iterator[tuple]:
    """Rows of LOG_SCHEMA.  File metadata goes along in its own map, the first of a name."""
    request = messages()["Logs"]()
    request.ParseFromString(raw)
    own, n = dict(reversed(meta)), 0
    for rl in request.resource_logs:
        resource = public(rl.resource.attributes)
        for sl in rl.scope_logs:
            scope = public(sl.scope.attributes)
            for r in sl.log_records:
                body = any_text(r.body) or None
                yield file, n, signed(r.time_unix_nano), signed(r.observed_time_unix_nano), r.severity_text or None, body, r.trace_id, r.span_id, sl.scope.name, sl.scope.version, resource, scope, public(r.attributes), own
                n += 1


def span_rows(raw: bytes, file: int = 0) -> Iterator[tuple]:
    """Rows of SPAN_SCHEMA."""
    request = messages()["Traces"]()
    request.ParseFromString(raw)
    n = 0
    for rs in request.resource_spans:
        resource = public(rs.resource.attributes)
        for ss in rs.scope_spans:
            scope = public(ss.scope.attributes)
            for s in ss.spans:
                yield file, n, s.trace_id, s.span_id, s.parent_span_id, s.name, s.kind, signed(s.start_time_unix_nano), signed(s.end_time_unix_nano), s.status.code, s.status.message, ss.scope.name, ss.scope.version, resource, scope, public(s.attributes)
                n += 1


def span_names(raw: bytes) -> set[tuple[str, str]]:
    """(column, name) of every attribute that span_rows gives to a row, without the rows."""
    request = messages()["Traces"]()
    request.ParseFromString(raw)
    found, seen = set(), set()
    for rs in request.resource_spans:
        for ss in rs.scope_spans:
            if ss.spans:
                found.update(("resource", k) for k in public(rs.resource.attributes))
                found.update(("scope", k) for k in public(ss.scope.attributes))
            for s in ss.spans:
                for a in s.attributes:
                    if a.key not in seen and public((a,)):
                        seen.add(a.key)
                        found.add(("attr", normalize(a.key)))
    return found
