"""Index hashes as Catalyst expressions: 31-polynomial hash, FNV-1a series ids, trigrams and span fingerprints.

All arithmetic wraps modulo 2**64 without a long overflow (which ANSI mode would raise): products are formed from
32-bit halves.  Bytes come from the text's UTF-8 form as Latin-1 code points, so one `ascii` a byte suffices.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_M = 0xFFFFFFFF
#: FNV-1a 64-bit seed (signed), and its prime as 2**40 + 435.
FNV_SEED, FNV_LOW, FNV_SHIFT = -3750763034362895579, 435, 40

#: Fields that a span index holds, by how.  Other fields only have an existence fingerprint.
TRIGRAM_FIELDS = ("chq_telemetry_type", "resource_customer_domain", "resource_k8s_cluster_name", "resource_k8s_namespace_name", "resource_service_name", "span_trace_id")
EXACT_FIELDS = ("log_level", "metric_name", "resource_file")
EXISTS = ".*"


def utf8_bytes(text: Column) -> Column:
    """UTF-8 bytes as array<bigint>; empty for ''."""
    latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return F.transform(F.filter(F.split(latin, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("bigint"))


def _halves(high: Column, low: Column) -> Column:
    """(high + carry of low) << 32 | low, modulo 2**64."""
    return F.shiftleft((high + F.shiftrightunsigned(low, 32)).bitwiseAND(F.lit(_M)), 32).bitwiseOR(low.bitwiseAND(F.lit(_M)))


def poly31(text: Column) -> Column:
    """h = 31 h + byte over the UTF-8 bytes, from 0, as a signed 64-bit number."""
    return F.aggregate(utf8_bytes(text), F.lit(0).cast("bigint"), lambda h, b: _halves(F.shiftrightunsigned(h, 32) * 31, h.bitwiseAND(F.lit(_M)) * 31 + b))


def fnv1a(text: Column) -> Column:
    """64-bit FNV-1a of the UTF-8 bytes, signed."""

    def step(h: Column, b: Column) -> Column:
        def times(g: Column) -> Column:
            high = F.shiftrightunsigned(g, 32) * FNV_LOW + F.shiftleft(g.bitwiseAND(F.lit((1 << (64 - FNV_SHIFT)) - 1)), FNV_SHIFT - 32)
            return _halves(high, g.bitwiseAND(F.lit(_M)) * FNV_LOW)

        return F.transform(F.array(h.bitwiseXOR(b)), times).getItem(0)

    return F.aggregate(utf8_bytes(text), F.lit(FNV_SEED).cast("bigint"), step)


def field_fingerprint(field: Column | str, value: Column | str) -> Column:
    """poly31 of `field:value`; strings are literals."""
    field, value = (F.lit(x) if isinstance(x, str) else x for x in (field, value))
    return poly31(F.concat(field, F.lit(":"), value))


def trigrams(text: Column) -> Column:
    """Distinct substrings of three code points; none below three."""
    grams = F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substr(text, i, F.lit(3)))
    return F.when(F.length(text) >= 3, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def tid(tags: Column) -> Column:
    """Series id of array<struct<k,v>>: non-empty metric_name, chq_metric_type, resource_* and attr_* tags, by key (ties stay in order)."""
    kept = F.filter(tags, lambda t: (t["v"] != "") & (t["k"].isin("metric_name", "chq_metric_type") | t["k"].startswith("resource_") | t["k"].startswith("attr_")))
    ordered = F.array_sort(F.transform(kept, lambda t, i: F.struct(t["k"].alias("k"), i.alias("i"), t["v"].alias("v"))))
    return fnv1a(F.array_join(F.transform(ordered, lambda t: F.concat(t["k"], F.lit("="), t["v"], F.lit("|"))), ""))


def fingerprints(tags: Column) -> Column:
    """Index fingerprints of array<struct<k,v>> with non-empty values: sorted distinct array<bigint>.

    Each field has one of its existence; indexed fields have their exact value's, and trigram fields one a trigram.
    """

    def of(t: Column) -> Column:
        exists = F.array(field_fingerprint(t["k"], EXISTS))
        exact = F.when(t["k"].isin(*TRIGRAM_FIELDS, *EXACT_FIELDS), F.array(field_fingerprint(t["k"], t["v"]))).otherwise(F.array().cast("array<bigint>"))
        grams = F.when(t["k"].isin(*TRIGRAM_FIELDS), F.transform(trigrams(t["v"]), lambda g: field_fingerprint(t["k"], g))).otherwise(F.array().cast("array<bigint>"))
        return F.concat(exists, exact, grams)

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(tags, lambda t: t["v"] != ""), of))))


def fingerprint_text(prints: Column) -> Column:
    """`[a,b,...]`, the text form of a fingerprint set."""
    return F.concat(F.lit("["), F.array_join(prints.cast("array<string>"), ","), F.lit("]"))


def may_hold(prints: Column, field: str, value: str) -> Column:
    """Whether a span with this fingerprint set can have the value: a filter to put before an exact one."""
    return F.array_contains(prints, field_fingerprint(field, value) if field in (*TRIGRAM_FIELDS, *EXACT_FIELDS) else field_fingerprint(field, EXISTS))
