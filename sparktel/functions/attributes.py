"""Attribute names, labels, ids and times as Catalyst expressions (ANSI-safe)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Resource attributes that metric rows keep.
RESOURCE_KEYS = (
    "app", "container_image_name", "container_image_tag", "k8s_cluster_name", "k8s_daemonset_name", "k8s_deployment_name",
    "k8s_namespace_name", "k8s_pod_ip", "k8s_pod_name", "k8s_statefulset_name", "service_name", "service_version",
)
#: Labels of the wire's numbers.
SPAN_KINDS = ("SPAN_KIND_UNSPECIFIED", "SPAN_KIND_INTERNAL", "SPAN_KIND_SERVER", "SPAN_KIND_CLIENT", "SPAN_KIND_PRODUCER", "SPAN_KIND_CONSUMER")
STATUS_CODES = ("STATUS_CODE_UNSET", "STATUS_CODE_OK", "STATUS_CODE_ERROR")
#: Milliseconds of a metric's time slot.
SLOT_MS = 10_000


def normalize_name(name: Column) -> Column:
    """Every byte outside A-Z, a-z, 0-9 becomes `_`; letters become small."""
    latin = F.decode(F.encode(name, "UTF-8"), "ISO-8859-1")
    return F.lower(F.regexp_replace(latin, "[^A-Za-z0-9]", "_"))


def keeps_resource(name: Column) -> Column:
    return name.isin(*RESOURCE_KEYS)


def _label(code: Column, labels: tuple[str, ...]) -> Column:
    out = F.lit(labels[0])
    for i, label in enumerate(labels[1:], 1):
        out = F.when(code == i, label).otherwise(out)
    return out


def span_kind(code: Column) -> Column:
    return _label(code, SPAN_KINDS)


def status_code(code: Column) -> Column:
    return _label(code, STATUS_CODES)


def metric_type(kind: Column) -> Column:
    """Wire kind to stored type: sum is count, every distribution is histogram, the rest gauge."""
    return F.when(kind == "sum", "count").when(kind.isin("histogram", "exponential_histogram", "summary"), "histogram").otherwise("gauge")


def temporality(code: Column) -> Column:
    return F.when(code == 1, "delta").when(code == 2, "cumulative")


def slot_ms(ns: Column) -> Column:
    """Start of the 10 s slot, in ms, of a time in ns."""
    return F.call_function("div", millis(ns), F.lit(SLOT_MS)) * SLOT_MS


def millis(ns: Column) -> Column:
    """Whole ms of an unsigned time in ns, of which a bigint holds the bits: times from 2**63 on are negative there."""
    large = ns.cast("decimal(20,0)") + F.lit(Decimal(1 << 64))
    return F.when(ns >= 0, F.call_function("div", ns, F.lit(1_000_000))).otherwise(F.call_function("div", large, F.lit(Decimal(1_000_000))))


def hex_id(raw: Column, missing: str | None) -> Column:
    """Lower-case hex; `missing` for a null, empty or all-zero id."""
    text = F.lower(F.hex(raw))
    return F.when(text.isNull() | text.rlike("^0*$"), F.lit(missing)).otherwise(text)


def duration_ms(start_ns: Column, end_ns: Column) -> Column:
    """Difference of the times cut to ms; 0 if either is unset.  May be negative."""
    return F.when((start_ns == 0) | (end_ns == 0), F.lit(0).cast("bigint")).otherwise(millis(end_ns) - millis(start_ns))


def first_time(*times: Column) -> Column:
    """The first that is set (not 0), else the time of the query."""
    now = F.unix_micros(F.current_timestamp()) * 1000
    return F.coalesce(*[F.nullif(t, F.lit(0).cast("bigint")) for t in times], now)


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two arrays; 0 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)
