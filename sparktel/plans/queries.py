"""The engine's registered queries, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparktel.functions import attributes as A
from sparktel.functions import hashing as H
from sparktel.functions import sketch as S
from sparktel.operators import enrich
from sparktel.operators.flatten import flatten_attributes, union_all
from sparktel.operators.logclusters import with_clusters
from sparktel.operators.logtokens import with_tokens
from sparktel.plans.frames import load, points, records, shared_folder, spans
from sparktel.streaming.windows import metric_windows

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# -- SQL of the other engine, for comparison ---------------------------------------------------------------------


def _signed(x: str) -> str:
    return f"(CASE WHEN {x} >= 9223372036854775808::HUGEINT THEN {x} - 18446744073709551616::HUGEINT ELSE {x} END)::BIGINT"


def _codes(x: str) -> str:
    return f"list_transform(range(1, length({x}) + 1), lambda i: ascii(substr({x}, i::INTEGER, 1))::HUGEINT)"


def _sql_poly(x: str) -> str:
    return f"list_reduce({_codes(x)}, lambda h, b: (h * 31 + b) % 18446744073709551616::HUGEINT, 0::HUGEINT)"


def _sql_fnv(x: str) -> str:
    """h = (h ^ b) * (2**40 + 435), the product in parts that stay within 128 bits."""
    return f"list_reduce({_codes(x)}, lambda h, b: ((xor(h, b) % 16777216::HUGEINT) * 1099511627776::HUGEINT + xor(h, b) * 435::HUGEINT) % 18446744073709551616::HUGEINT, 14695981039346656037::HUGEINT)"


_NS = "epoch_us({}) * 1000"
_GAMMA = "(1 + 2 * 0.01::DOUBLE / (1 - 0.01::DOUBLE))"
_BIN = f"CAST(ceil(ln({{}}) / ln({_GAMMA})) AS INTEGER)"
_VAL = f"pow({_GAMMA}, {{}}) * 1.01::DOUBLE"
_POINTS = f"""points AS (SELECT event_id, {_NS.format('ts')} AS time_ns, 'app.' || event_type AS name, CASE WHEN event_type = 'purchase' THEN 'sum' ELSE 'gauge' END AS kind,
  'svc-' || (user_id % 5) AS service, CAST(user_id % 20 AS VARCHAR) AS bucket, value FROM events)"""
_RECORDS = f"""records AS (SELECT event_id, {_NS.format('ts')} AS time_ns, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS severity,
  'user ' || user_id || ' did ' || event_type || ' in 12ms' AS body, CASE WHEN event_id % 3 = 0 THEN event_id % 1000 END AS trace FROM events)"""
_SPANS = f"""spans AS (SELECT trace, span, parent, name, kind, status, start_ns, service, start_ns + d * 1000000 AS end_ns FROM (
  SELECT o_orderkey AS trace, 'r' AS span, '' AS parent, 'order ' || o_orderstatus AS name, 2 AS kind, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 0 END AS status,
    {_NS.format('o_orderdate')} AS start_ns, CAST(round(o_totalprice) AS BIGINT) AS d, substr(o_orderpriority, 1, 1) AS service FROM orders
  UNION ALL SELECT l_orderkey, CAST(l_linenumber AS VARCHAR), 'r', 'line ' || l_returnflag, l_linenumber % 7, CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END,
    {_NS.format('l_shipdate')}, CAST(trunc(l_quantity) AS BIGINT), l_linestatus FROM lineitem))"""
_KIND = "CASE kind WHEN 1 THEN 'SPAN_KIND_INTERNAL' WHEN 2 THEN 'SPAN_KIND_SERVER' WHEN 3 THEN 'SPAN_KIND_CLIENT' WHEN 4 THEN 'SPAN_KIND_PRODUCER' WHEN 5 THEN 'SPAN_KIND_CONSUMER' ELSE 'SPAN_KIND_UNSPECIFIED' END"
_STATUS = "CASE status WHEN 1 THEN 'STATUS_CODE_OK' WHEN 2 THEN 'STATUS_CODE_ERROR' ELSE 'STATUS_CODE_UNSET' END"
_DURATION = "(end_ns // 1000000 - start_ns // 1000000)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict[str, Query]:
    from sparktel.plans import otlp  # noqa: F401  it adds its own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from sparktel.plans import otlp  # noqa: F401

    return dict(_SQL)


def _tag(k: str, v) -> F.Column:
    return F.struct(F.lit(k).alias("k"), v.alias("v"))


# -- metrics -----------------------------------------------------------------------------------------------------

_TID_TEXT = "'attr_bucket=' || bucket || '|chq_metric_type=' || mtype || '|metric_name=' || mname || '|resource_service_name=' || service || '|'"


@query(f"""WITH {_POINTS}, g AS (SELECT replace(name, '.', '_') AS mname, CASE kind WHEN 'sum' THEN 'count' ELSE 'gauge' END AS mtype, service, bucket, count(*) AS points, round(sum(value), 4) AS total, min(value) AS low, max(value) AS high FROM points GROUP BY 1, 2, 3, 4)
SELECT mname AS metric_name, {_signed(_sql_fnv(_TID_TEXT))} AS chq_tid, points, total, low, high FROM g""")
def series_rollup_by_tid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points, sum and range of each time series; the series id is computed once a series, after the aggregate."""
    g = points(spark, sf_dir).groupBy(A.normalize_name(F.col("name")).alias("metric_name"), A.metric_type(F.col("kind")).alias("mtype"), "service", "bucket")
    g = g.agg(F.count("*").alias("points"), F.round(F.sum("value"), 4).alias("total"), F.min("value").alias("low"), F.max("value").alias("high"))
    tid = H.tid(F.array(_tag("metric_name", F.col("metric_name")), _tag("chq_metric_type", F.col("mtype")), _tag("resource_service_name", F.col("service")), _tag("attr_bucket", F.col("bucket"))))
    return g.select("metric_name", tid.alias("chq_tid"), "points", "total", "low", "high")


@query("SELECT p_partkey, lower(regexp_replace(p_name || '.' || p_brand, '[^A-Za-z0-9]', '_', 'g')) AS name FROM part")
def normalize_attr_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select("p_partkey", A.normalize_name(F.concat("p_name", F.lit("."), "p_brand")).alias("name"))


@query("SELECT epoch_us(ts) // 1000 // 10000 * 10000 AS chq_timestamp, count(*) AS points, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def metric_ts_truncate_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).groupBy(A.slot_ms(F.col("time_ns")).alias("chq_timestamp")).agg(F.count("*").alias("points"), F.round(F.avg("value"), 6).alias("mean"))


@query("""WITH k AS (SELECT CASE event_id % 6 WHEN 0 THEN 'gauge' WHEN 1 THEN 'sum' WHEN 2 THEN 'histogram' WHEN 3 THEN 'exponential_histogram' WHEN 4 THEN 'summary' ELSE 'other' END AS kind, event_id % 4 AS t FROM events)
SELECT CASE WHEN kind = 'sum' THEN 'count' WHEN kind IN ('histogram', 'exponential_histogram', 'summary') THEN 'histogram' ELSE 'gauge' END AS chq_metric_type,
  CASE t WHEN 1 THEN 'delta' WHEN 2 THEN 'cumulative' END AS metric_temporality, count(*) AS n FROM k GROUP BY 1, 2""")
def metric_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ("gauge", "sum", "histogram", "exponential_histogram", "summary", "other")])
    e = load(spark, sf_dir, "events").select(F.get(kinds, F.pmod("event_id", F.lit(6)).cast("int")).alias("kind"), F.pmod("event_id", F.lit(4)).alias("t"))
    return e.groupBy(A.metric_type(F.col("kind")).alias("chq_metric_type"), A.temporality(F.col("t")).alias("metric_temporality")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, 'resource_service_name' AS name, c_name AS value FROM customer WHERE c_name <> ''
UNION ALL SELECT c_custkey, 'resource_k8s_cluster_name', n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name <> ''""")
def resource_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resource attributes that metric rows keep, of raw names with dots."""
    c = load(spark, sf_dir, "customer").join(F.broadcast(load(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    raw = F.array(_tag("service.name", F.col("c_name")), _tag("k8s.cluster.name", F.col("n_name")), _tag("host.name", F.col("c_mktsegment")), _tag("segment", F.col("c_mktsegment")))
    named = F.transform(raw, lambda t: F.struct(A.normalize_name(t["k"]).alias("k"), t["v"].alias("v")))
    kept = F.filter(named, lambda t: A.keeps_resource(t["k"]) & (t["v"] != ""))
    return c.select("c_custkey", F.explode(kept).alias("t")).select("c_custkey", F.concat(F.lit("resource_"), "t.k").alias("name"), F.col("t.v").alias("value"))


_SIGNED = "(value - 50)"
_AT = f"CASE WHEN {_SIGNED} = 0 THEN 0 ELSE sign({_SIGNED}) * {_VAL.format(_BIN.format(f'CASE WHEN {_SIGNED} = 0 THEN 1 ELSE abs({_SIGNED}) END'))} END"


@query(f"""SELECT event_id, {_SIGNED} AS rollup_sum, 1::DOUBLE AS rollup_count, round({_AT}, 6) AS p50 FROM events""")
def gauge_rollup_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch of a single value of either sign, in closed form."""
    e = load(spark, sf_dir, "events").select("event_id", S.single(F.col("value") - 50).alias("s"))
    return e.select("event_id", F.col("s.sum").alias("rollup_sum"), F.col("s.count").alias("rollup_count"), F.round("s.p50", 6).alias("p50"))


@query(f"SELECT l_returnflag, {_BIN.format('l_extendedprice')} AS idx, count(*)::DOUBLE AS cnt FROM lineitem WHERE l_extendedprice > 0 GROUP BY 1, 2")
def ddsketch_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").where("l_extendedprice > 0")
    return li.groupBy("l_returnflag", S.bin_of(F.col("l_extendedprice")).alias("idx")).agg(F.count("*").cast("double").alias("cnt"))


def _sql_quantiles(group: str, value: str, source: str, names: dict[str, float]) -> str:
    def at(q: float) -> str:
        rank = f"({q} * (n - 1))"
        low = f"-min(CASE WHEN sg < 0 AND run > neg - 1 - {rank} THEN {_VAL.format('idx')} END)"
        high = f"min(CASE WHEN sg > 0 AND run > {rank} - neg - zer THEN {_VAL.format('idx')} END)"
        rank = f"({q} * (any_value(n) - 1))"
        return f"round(CASE WHEN {rank} < any_value(neg) THEN {low} WHEN {rank} < any_value(neg) + any_value(zer) THEN 0 ELSE {high} END, 4)"

    qs = ", ".join(f"{at(q)} AS {name}" for name, q in names.items())
    size = f"CASE WHEN {value} = 0 THEN 1 ELSE abs({value}) END"
    return f"""WITH b AS (SELECT {group} AS g, CAST(sign({value}) AS INTEGER) AS sg, {_BIN.format(size)} AS idx, count(*) AS c, sum({value}) AS s, min({value}) AS lo, max({value}) AS hi FROM {source} WHERE {value} IS NOT NULL GROUP BY 1, 2, 3),
r AS (SELECT *, sum(c) OVER (PARTITION BY g, sg ORDER BY idx) AS run, sum(c) OVER (PARTITION BY g) AS n, sum(CASE WHEN sg < 0 THEN c ELSE 0 END) OVER (PARTITION BY g) AS neg, sum(CASE WHEN sg = 0 THEN c ELSE 0 END) OVER (PARTITION BY g) AS zer FROM b)
SELECT g AS {group}, sum(c)::DOUBLE AS rollup_count, round(sum(s), 3) AS rollup_sum, min(lo) AS rollup_min, max(hi) AS rollup_max, {qs} FROM r GROUP BY g"""


@query(_sql_quantiles("event_type", "(round(value) - 50)", "events", S.QUANTILES))
def signed_quantiles_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of negative, zero and positive values."""
    g = S.sketch_groups(load(spark, sf_dir, "events").withColumn("v", F.round("value") - 50), ["event_type"], "v")
    return g.select("event_type", "rollup_count", F.round("rollup_sum", 3).alias("rollup_sum"), "rollup_min", "rollup_max", *[F.round(f"rollup_{q}", 4).alias(q) for q in S.QUANTILES])


@query(_sql_quantiles("event_type", "(round(value) - 50)", "events", {"p25": 0.25, "p99": 0.99}).replace("round(sum(s), 3) AS rollup_sum, min(lo) AS rollup_min, max(hi) AS rollup_max, ", "").replace("sum(c)::DOUBLE AS rollup_count, ", ""))
def signed_quantile_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same quantiles by window functions over rows of slots."""
    b = load(spark, sf_dir, "events").groupBy("event_type", S.slot_of(F.round("value") - 50).alias("idx")).agg(F.count("*").alias("cnt"))
    one = {n: S.running_quantile(b, ["event_type"], q).withColumnRenamed("quantile", n) for n, q in (("p25", 0.25), ("p99", 0.99))}
    return one["p25"].join(one["p99"], "event_type").select("event_type", F.round("p25", 4).alias("p25"), F.round("p99", 4).alias("p99"))


@query(_sql_quantiles("event_type", "value", "events", S.QUANTILES))
def ddsketch_quantiles_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = S.sketch_groups(load(spark, sf_dir, "events"), ["event_type"], "value")
    return g.select("event_type", "rollup_count", F.round("rollup_sum", 3).alias("rollup_sum"), "rollup_min", "rollup_max", *[F.round(f"rollup_{q}", 4).alias(q) for q in S.QUANTILES])


@query(_sql_quantiles("event_type", "value", "events", {"p50": 0.5, "p99": 0.99}))
def sketch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches a (type, service), merged to sketches a type."""
    parts = S.sketch_groups(points(spark, sf_dir).withColumn("event_type", F.substring("name", 5, 99)), ["event_type", "service"], "value")
    stats = parts.groupBy("event_type").agg(F.sum("rollup_count").alias("rollup_count"), F.round(F.sum("rollup_sum"), 3).alias("rollup_sum"), F.min("rollup_min").alias("rollup_min"), F.max("rollup_max").alias("rollup_max"))
    bins = S.merge_bins(parts, ["event_type"])
    return bins.join(stats, "event_type").select("event_type", "rollup_count", "rollup_sum", "rollup_min", "rollup_max", *[F.round(S.quantile_of(F.col("bins"), F.col("rollup_count"), q), 4).alias(n) for n, q in (("p50", 0.5), ("p99", 0.99))])


@query(_sql_quantiles("l_linestatus", "l_extendedprice", "lineitem", {"p50": 0.5}).replace("round(sum(s), 3) AS rollup_sum, min(lo) AS rollup_min, max(hi) AS rollup_max, ", "").replace("sum(c)::DOUBLE AS rollup_count, ", ""))
def quantile_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").groupBy("l_linestatus", S.slot_of(F.col("l_extendedprice")).alias("idx")).agg(F.count("*").alias("cnt"))
    return S.running_quantile(li, ["l_linestatus"], 0.5).select("l_linestatus", F.round("quantile", 4).alias("p50"))


_ROLLUPS = ["count", "sum", "min", "max", "p50", "p99"]


def _rolled(df: DataFrame, key: str, **cols) -> DataFrame:
    """One sketch a row of data-point columns; rounded statistics."""
    blank = {"kind": F.lit("summary"), "value": F.lit(None).cast("double"), "count": F.lit(None).cast("bigint"), "sum": F.lit(None).cast("double"), "min": F.lit(None).cast("double"), "max": F.lit(None).cast("double"), "bucket_counts": F.lit(None).cast("array<bigint>"), "bounds": F.lit(None).cast("array<double>"), "scale": F.lit(0), "zero": F.lit(0).cast("bigint"), "po": F.lit(0), "pc": F.lit(None).cast("array<bigint>"), "no": F.lit(0), "nc": F.lit(None).cast("array<bigint>"), "quantiles": F.lit(None).cast("array<struct<q:double,v:double>>")}
    args = [cols.get(k, v) for k, v in blank.items()]
    return df.select(key, enrich.sketches(*args).alias("s")).select(key, *[F.round(F.col(f"s.{r}"), 4).alias(r) for r in _ROLLUPS])


_BOUNDS = [10.0, 20.0, 30.0, 40.0]


@query(f"""WITH h AS (SELECT l_suppkey, CASE WHEN l_quantity <= 10 THEN 1 WHEN l_quantity <= 20 THEN 2 WHEN l_quantity <= 30 THEN 3 WHEN l_quantity <= 40 THEN 4 END AS k, l_quantity FROM lineitem),
b AS (SELECT l_suppkey, k, count(*) AS c, CASE k WHEN 1 THEN 5.0 WHEN 2 THEN sqrt(200.0) WHEN 3 THEN sqrt(600.0) ELSE sqrt(1200.0) END::DOUBLE AS rep FROM h WHERE k IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, sum(c) OVER (PARTITION BY l_suppkey ORDER BY k) AS run, sum(c) OVER (PARTITION BY l_suppkey) AS n FROM b),
t AS (SELECT l_suppkey, sum(l_quantity) AS s, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY 1)
SELECT l_suppkey, n::DOUBLE AS "count", round(any_value(s), 4) AS "sum", round(any_value(lo), 4) AS "min", round(any_value(hi), 4) AS "max",
  round(min(CASE WHEN run > 0.5 * (n - 1) THEN {_VAL.format(_BIN.format('rep'))} END), 4) AS p50, round(min(CASE WHEN run > 0.99 * (n - 1) THEN {_VAL.format(_BIN.format('rep'))} END), 4) AS p99
FROM r JOIN t USING (l_suppkey) GROUP BY l_suppkey, n""")
def histogram_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit-bucket histograms of quantities a supplier; the bucket without an upper bound is left out."""
    q = F.col("l_quantity")
    edges = [None, *_BOUNDS, None]
    counts = [F.sum(F.when((q > lo if lo is not None else F.lit(True)) & (q <= hi if hi is not None else F.lit(True)), 1).otherwise(0)) for lo, hi in zip(edges, edges[1:], strict=False)]
    g = load(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.array(*counts).cast("array<bigint>").alias("counts"), F.count("*").alias("n"), F.sum(q).alias("s"), F.min(q).alias("lo"), F.max(q).alias("hi"))
    return _rolled(g, "l_suppkey", kind=F.lit("histogram"), count=F.col("n"), sum=F.col("s"), min=F.col("lo"), max=F.col("hi"), bucket_counts=F.col("counts"), bounds=F.array(*[F.lit(b) for b in _BOUNDS]))


@query(f"""WITH b AS (SELECT o_orderpriority, CAST(floor(log2(o_totalprice)) AS INTEGER) AS k, count(*) AS c FROM orders GROUP BY 1, 2),
r AS (SELECT *, pow(2::DOUBLE, k + 0.5::DOUBLE) AS rep, sum(c) OVER (PARTITION BY o_orderpriority ORDER BY k) AS run, sum(c) OVER (PARTITION BY o_orderpriority) AS n FROM b),
t AS (SELECT o_orderpriority, sum(o_totalprice) AS s, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1)
SELECT o_orderpriority, n::DOUBLE AS "count", round(any_value(s), 2) AS "sum", round(any_value(lo), 4) AS "min", round(any_value(hi), 4) AS "max",
  round(min(CASE WHEN run > 0.5 * (n - 1) THEN {_VAL.format(_BIN.format('rep'))} END), 4) AS p50, round(min(CASE WHEN run > 0.99 * (n - 1) THEN {_VAL.format(_BIN.format('rep'))} END), 4) AS p99
FROM r JOIN t USING (o_orderpriority) GROUP BY o_orderpriority, n""")
def exp_histogram_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exponential histograms (scale 0: powers of two) of order prices."""
    o = load(spark, sf_dir, "orders")
    b = o.groupBy("o_orderpriority", F.floor(F.log2("o_totalprice")).cast("int").alias("k")).agg(F.count("*").alias("c"), F.sum("o_totalprice").alias("s"), F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    g = b.groupBy("o_orderpriority").agg(F.map_from_entries(F.collect_list(F.struct("k", "c"))).alias("m"), F.min("k").alias("first"), F.max("k").alias("last"), F.sum("c").alias("n"), F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    counts = F.transform(F.sequence("first", "last"), lambda k: F.coalesce(F.element_at("m", k), F.lit(0)).cast("bigint"))
    out = _rolled(g, "o_orderpriority", kind=F.lit("exponential_histogram"), count=F.col("n"), sum=F.col("s"), min=F.col("lo"), max=F.col("hi"), po=F.col("first"), pc=counts, nc=F.array().cast("array<bigint>"), quantiles=F.lit(None).cast("array<struct<q:double,v:double>>"))
    return out.withColumn("sum", F.round("sum", 2))


@query(f"""WITH q AS (SELECT event_type, count(*) AS n, sum(value) AS s, round(min(value), 2) AS a, round(max(value), 2) AS b FROM events GROUP BY 1),
d AS (SELECT event_type, n, s, a, b, least(2048, n) AS m, (unnest(range(0, least(2048, n))) + 0.5::DOUBLE) / least(2048, n) AS u FROM q),
v AS (SELECT *, exp(ln(a) + u * (ln(b) - ln(a))) AS x FROM d),
c AS (SELECT event_type, any_value(s) AS s, {_BIN.format('x')} AS idx, count(*) AS c, any_value(m) AS m FROM v GROUP BY event_type, idx),
r AS (SELECT *, sum(c) OVER (PARTITION BY event_type ORDER BY idx) AS run FROM c)
SELECT event_type, any_value(m)::DOUBLE AS "count", round(any_value(s), 3) AS "sum", round(min(CASE WHEN run > 0.5 * (m - 1) THEN {_VAL.format('idx')} END), 4) AS p50 FROM r GROUP BY event_type""")
def summary_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of the least and greatest value, drawn on a logarithmic scale."""
    g = load(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("s"), F.round(F.min("value"), 2).alias("a"), F.round(F.max("value"), 2).alias("b"))
    pairs = F.array(F.struct(F.lit(0.0).alias("q"), F.col("a").alias("v")), F.struct(F.lit(1.0).alias("q"), F.col("b").alias("v")))
    return _rolled(g, "event_type", kind=F.lit("summary"), count=F.col("n"), sum=F.col("s"), quantiles=pairs).select("event_type", "count", F.round("sum", 3).alias("sum"), "p50")


@query("""WITH g AS (SELECT l_partkey, sum(CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END) AS a, sum(CASE WHEN l_quantity > 48 THEN 1 ELSE 0 END) AS b FROM lineitem GROUP BY 1)
SELECT l_partkey, a::BIGINT AS above_45, b::BIGINT AS above_48 FROM g WHERE a > 0 OR b > 0""")
def empty_histogram_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distributions without any count are left out."""
    q = F.col("l_quantity")
    g = load(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum((q > 45).cast("int")).alias("a"), F.sum((q > 48).cast("int")).alias("b"))
    return g.where(F.exists(F.array("a", "b"), lambda c: c > 0)).select("l_partkey", F.col("a").alias("above_45"), F.col("b").alias("above_48"))


@query("SELECT event_id, value AS \"sum\", 1::DOUBLE AS \"count\", 'app_' || event_type AS metric_name, epoch_us(ts) // 1000 // 10000 * 10000 AS chq_timestamp, CASE WHEN event_type = 'purchase' THEN 'count' ELSE 'gauge' END AS chq_metric_type FROM events")
def otlp_metrics_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as OTLP requests (one for each Arrow batch), decoded and enriched again."""
    from sparktel.sources.readers import decode_content

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sparktel.sources.descriptors import messages

        for b in batches:
            request = messages()["Metrics"]()
            scope = request.resource_metrics.add().scope_metrics.add()
            for r in b.to_pylist():
                m = scope.metrics.add(name=r["name"])
                p = (m.sum if r["kind"] == "sum" else m.gauge).data_points.add(time_unix_nano=r["time_ns"], as_double=r["value"])
                a = p.attributes.add(key="event.id")
                a.value.int_value = r["event_id"]
            yield pa.RecordBatch.from_pydict({"path": ["x.binpb"], "content": pa.array([request.SerializeToString()], pa.binary())})

    raw = points(spark, sf_dir).select("event_id", "time_ns", "name", "kind", "value").mapInArrow(encode, "path string, content binary")
    m = enrich.metrics(decode_content(raw, "metrics"), "c")
    return m.select(F.element_at("attr", F.lit("event_id")).cast("bigint").alias("event_id"), F.col("chq_rollup_sum").alias("sum"), F.col("chq_rollup_count").alias("count"), "metric_name", "chq_timestamp", "chq_metric_type")


@query(f"""SELECT event_type, count(*)::DOUBLE AS "count", round(sum({_AT}), 2) AS "sum", sum(CASE WHEN {_SIGNED} < 0 THEN 1 ELSE 0 END)::DOUBLE AS below FROM events GROUP BY 1""")
def sketch_codec_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sketch a value of either sign, encoded, merged by type from the bytes, and decoded; sums come from bins."""
    one = load(spark, sf_dir, "events").select("event_type", S.single(F.col("value") - 50)["sketch"].alias("chq_sketch"))
    merged = enrich.merge_sketches(one, ["event_type"]).select("event_type", enrich.sketch_decode("chq_sketch").alias("d"))
    return merged.select("event_type", F.col("d.count").alias("count"), F.round("d.sum", 2).alias("sum"), F.aggregate("d.negative", F.lit(0.0), lambda a, b: a + b["cnt"]).alias("below"))


@query(f"""WITH e AS (SELECT event_type, round(value) - 50 AS v FROM events),
b AS (SELECT event_type, sign(v)::INTEGER AS sg, CASE WHEN v = 0 THEN 0 ELSE CAST(floor(log2(CASE WHEN v = 0 THEN 1 ELSE abs(v) END) * 2) AS INTEGER) END AS k, count(*) AS c FROM e GROUP BY 1, 2, 3),
r AS (SELECT *, pow(2::DOUBLE, (k + 0.5::DOUBLE) / 2) AS rep, sum(c) OVER (PARTITION BY event_type ORDER BY CASE WHEN sg = 0 THEN 0 ELSE sg * (k + 1000) END) AS run, sum(c) OVER (PARTITION BY event_type) AS n FROM b),
t AS (SELECT event_type, round(sum(v), 2) AS s, min(v) AS lo, max(v) AS hi FROM e GROUP BY 1)
SELECT event_type, any_value(n)::DOUBLE AS "count", any_value(s) AS "sum", any_value(lo) AS "min", any_value(hi) AS "max", sum(CASE WHEN sg < 0 THEN c ELSE 0 END)::DOUBLE AS below, sum(CASE WHEN sg = 0 THEN c ELSE 0 END)::DOUBLE AS zero,
  round(max(CASE WHEN sg > 0 THEN {_VAL.format(_BIN.format('rep'))} END), 4) AS top, round(max(CASE WHEN sg < 0 THEN {_VAL.format(_BIN.format('rep'))} END), 4) AS bottom FROM r JOIN t USING (event_type) GROUP BY 1""")
def exp_histogram_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exponential histograms of scale 1 with positive, negative and zero buckets, encoded and decoded again."""
    v = F.col("v")
    e = load(spark, sf_dir, "events").select("event_type", (F.round("value") - 50).alias("v"))
    b = e.groupBy("event_type", F.signum("v").cast("int").alias("sg"), F.when(v != 0, F.floor(F.log2(F.abs(v)) * 2)).otherwise(0).cast("int").alias("k")).agg(F.count("*").alias("c"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    buckets = lambda sg: F.map_from_entries(F.collect_list(F.when(F.col("sg") == sg, F.struct("k", "c"))))
    g = b.groupBy("event_type").agg(buckets(1).alias("up"), buckets(-1).alias("down"), F.sum(F.when(F.col("sg") == 0, F.col("c")).otherwise(0)).alias("zero"), F.min("k").alias("first"), F.max("k").alias("last"), F.sum("c").alias("n"), F.round(F.sum("s"), 2).alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    row = lambda m: F.transform(F.sequence("first", "last"), lambda k: F.coalesce(F.element_at(m, k), F.lit(0)).cast("bigint"))
    none = F.lit(None)
    sk = enrich.sketches(F.lit("exponential_histogram"), none.cast("double"), F.col("n"), F.col("s"), F.col("lo"), F.col("hi"), none.cast("array<bigint>"), none.cast("array<double>"), F.lit(1), F.col("zero"), F.col("first"), row("up"), F.col("first"), row("down"), none.cast("array<struct<q:double,v:double>>"))
    out = g.select("event_type", sk.alias("s")).select("event_type", "s", enrich.sketch_decode("s.sketch").alias("d"))
    part = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x["cnt"])
    most = lambda c: F.round(S.value_of(F.array_max(F.transform(c, lambda x: x["idx"]))), 4)
    return out.select("event_type", "s.count", "s.sum", "s.min", "s.max", part("d.negative").alias("below"), F.col("d.zero").alias("zero"), most("d.bins").alias("top"), most("d.negative").alias("bottom"))


@query("""SELECT epoch_ms(time_bucket(INTERVAL 10 SECOND, ts)) AS start_ms, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def window_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream operator's windows, over a bounded input."""
    m = points(spark, sf_dir).select(A.normalize_name(F.col("name")).alias("metric_name"), F.lit(0).cast("bigint").alias("chq_tid"), F.col("value").alias("chq_rollup_sum"), A.slot_ms(F.col("time_ns")).alias("chq_timestamp"))
    w = metric_windows(m)
    return w.groupBy(F.unix_millis("window.start").alias("start_ms")).agg(F.sum("cnt").cast("bigint").alias("n"), F.round(F.sum("total"), 4).alias("total"))


# -- hashes ------------------------------------------------------------------------------------------------------


@query(f"SELECT c_custkey, {_signed(_sql_poly('c_name'))} AS hash FROM customer")
def poly_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select("c_custkey", H.poly31(F.col("c_name")).alias("hash"))


@query(f"SELECT c_custkey, {_signed(_sql_poly(chr(39) + 'resource_service_name:' + chr(39) + ' || c_name'))} AS fp, {_signed(_sql_poly(chr(39) + 'resource_service_name:.*' + chr(39)))} AS there FROM customer")
def field_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select("c_custkey", H.field_fingerprint("resource_service_name", F.col("c_name")).alias("fp"), H.field_fingerprint("resource_service_name", H.EXISTS).alias("there"))


@query("SELECT s_suppkey, unnest(list_distinct(list_transform(range(1, length(s_name) - 1), lambda i: substr(s_name, i::INTEGER, 3)))) AS gram FROM supplier WHERE length(s_name) >= 3")
def trigram_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").select("s_suppkey", F.explode(H.trigrams(F.col("s_name"))).alias("gram"))


def _service_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    tags = F.array(_tag("chq_telemetry_type", F.lit("traces")), _tag("resource_service_name", F.col("c_mktsegment")), _tag("resource_file", F.concat(F.lit("f"), F.pmod("c_custkey", F.lit(9)).cast("string"))), _tag("attr_x", F.lit("1")))
    return c.select("c_custkey", "c_mktsegment", H.fingerprints(tags).alias("prints"))


def _sql_prints() -> str:
    fields = {"chq_telemetry_type": "'traces'", "resource_service_name": "c_mktsegment", "resource_file": "'f' || (c_custkey % 9)", "attr_x": "'1'"}
    rows = [f"SELECT c_custkey, '{f}:.*' AS t FROM customer" for f in fields]
    rows += [f"SELECT c_custkey, '{f}:' || ({v}) FROM customer" for f, v in fields.items() if f != "attr_x"]
    rows += [f"SELECT c_custkey, '{f}:' || unnest(list_transform(range(1, length({v}) - 1), lambda i: substr({v}, i::INTEGER, 3))) FROM customer" for f, v in fields.items() if f in H.TRIGRAM_FIELDS]
    return "WITH t AS (" + " UNION ".join(rows) + f"), h AS (SELECT DISTINCT c_custkey, {_signed(_sql_poly('t'))} AS p FROM t)"


@query(_sql_prints() + " SELECT c_custkey, count(*) AS n, '[' || string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) || ']' AS chq_fingerprint FROM h GROUP BY 1")
def span_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _service_prints(spark, sf_dir)
    return p.select("c_custkey", F.size("prints").cast("bigint").alias("n"), H.fingerprint_text(F.col("prints")).alias("chq_fingerprint"))


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def fingerprint_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _service_prints(spark, sf_dir)
    return p.where(H.may_hold(F.col("prints"), "resource_service_name", "BUILDING") & (F.col("c_mktsegment") == "BUILDING")).select("c_custkey")


# -- spans -------------------------------------------------------------------------------------------------------


@query(f"WITH {_SPANS} SELECT {_KIND} AS span_kind, {_STATUS} AS span_status_code, count(*) AS n FROM spans GROUP BY 1, 2")
def span_kind_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(spark, sf_dir).groupBy(A.span_kind(F.col("kind")).alias("span_kind"), A.status_code(F.col("status")).alias("span_status_code")).agg(F.count("*").alias("n"))


@query(f"WITH {_SPANS} SELECT {_KIND} AS span_kind, round(avg({_DURATION}), 4) AS mean, CAST(round_even(avg({_DURATION}), 0) AS INTEGER) AS mean_ms, min({_DURATION}) AS low, max({_DURATION}) AS high FROM spans GROUP BY 1")
def span_duration_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = A.duration_ms(F.col("start_ns"), F.col("end_ns"))
    return spans(spark, sf_dir).groupBy(A.span_kind(F.col("kind")).alias("span_kind")).agg(F.round(F.avg(d), 4).alias("mean"), F.bround(F.avg(d), 0).cast("int").alias("mean_ms"), F.min(d).alias("low"), F.max(d).alias("high"))


@query(f"WITH {_SPANS} SELECT CASE WHEN parent = '' THEN 'root' ELSE 'child' END AS role, count(*) AS n, sum({_DURATION})::BIGINT AS total FROM spans GROUP BY 1")
def root_vs_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(spark, sf_dir).groupBy(F.when(F.col("parent") == "", "root").otherwise("child").alias("role")).agg(F.count("*").alias("n"), F.sum(A.duration_ms(F.col("start_ns"), F.col("end_ns"))).alias("total"))


@query(f"WITH {_SPANS} SELECT trace, span, name, {_DURATION} AS duration FROM spans WHERE {_DURATION} > 1000 ORDER BY duration DESC, trace, span LIMIT 100")
def slow_spans_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spans(spark, sf_dir).withColumn("duration", A.duration_ms(F.col("start_ns"), F.col("end_ns")))
    return s.where("duration > 1000").select("trace", "span", "name", "duration").orderBy(F.desc("duration"), "trace", "span").limit(100)


@query(f"WITH {_SPANS} SELECT trace, span, lower(printf('%016x', trace)) AS trace_hex, {_DURATION} AS span_duration, start_ns // 1000000 AS chq_timestamp FROM spans")
def span_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.unhex(F.lpad(F.hex("trace"), 16, "0"))
    return spans(spark, sf_dir).select("trace", "span", A.hex_id(raw, "0000000000000000").alias("trace_hex"), A.duration_ms(F.col("start_ns"), F.col("end_ns")).alias("span_duration"), F.expr("start_ns div 1000000").alias("chq_timestamp"))


# -- logs --------------------------------------------------------------------------------------------------------


@query(f"WITH {_RECORDS} SELECT severity AS log_level, count(*) AS n, min(body) AS sample FROM records GROUP BY 1")
def logs_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).groupBy(F.col("severity").alias("log_level")).agg(F.count("*").alias("n"), F.min("body").alias("sample"))


@query(f"WITH {_RECORDS} SELECT count(*) AS logs, count(trace) AS with_trace, count(DISTINCT trace) AS traces FROM records")
def logs_trace_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).agg(F.count("*").alias("logs"), F.count("trace").alias("with_trace"), F.countDistinct("trace").alias("traces"))


@query(f"WITH {_RECORDS}, {_SPANS} SELECT severity, name, count(*) AS n, sum({_DURATION})::BIGINT AS total FROM records r JOIN spans s ON r.trace = s.trace AND s.parent = '' GROUP BY 1, 2")
def log_span_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs beside the root spans of their traces; the size of either side decides how they are joined."""
    r = records(spark, sf_dir).where("trace is not null")
    s = spans(spark, sf_dir).where("parent = ''")
    return r.join(s, "trace").groupBy("severity", "name").agg(F.count("*").alias("n"), F.sum(A.duration_ms(F.col("start_ns"), F.col("end_ns"))).alias("total"))


@query("SELECT event_id, unnest(json_keys(props)) AS key FROM events")
def json_deep_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", F.explode(F.json_object_keys("props")).alias("key"))


@query("SELECT c_custkey, strlen(c_name) AS bytes, strlen(c_mktsegment || ' é中') AS wide FROM customer")
def octet_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select("c_custkey", F.octet_length("c_name").cast("bigint").alias("bytes"), F.octet_length(F.concat("c_mktsegment", F.lit(" é中"))).cast("bigint").alias("wide"))


@query()
def log_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = with_tokens(load(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "text")
    return c.select("conv_id", "turn", F.array_join("log_tokens", " ").alias("tokens"), "log_detected_level")


@query()
def log_fingerprint_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = with_tokens(records(spark, sf_dir), "body")
    return r.groupBy("log_fingerprint").agg(F.count("*").alias("n"), F.min("body").alias("sample"))


@query()
def log_fingerprint_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = with_tokens(records(spark, sf_dir).select("event_id", "body", F.concat(F.lit("t"), F.pmod("event_id", F.lit(16)).cast("string")).alias("tenant")), "body")
    return with_clusters(r, "tenant", ["event_id"]).groupBy("tenant", "log_cluster").agg(F.count("*").alias("n"))


_JACCARD = "len(list_intersect(a.w, b.w))::DOUBLE / len(list_distinct(list_concat(a.w, b.w)))"


@query(f"""WITH t AS (SELECT conv_id, turn, list_distinct(string_split(text, ' ')) AS w FROM conversations WHERE text IS NOT NULL)
SELECT a.conv_id AS conv_id, a.turn AS turn, round({_JACCARD}, 9) AS similarity FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def token_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of each turn and the next of its conversation."""
    t = load(spark, sf_dir, "conversations").where("text is not null").select("conv_id", "turn", F.array_distinct(F.split("text", " ")).alias("w"))
    b = t.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("v"))
    return t.join(b, ["conv_id", "turn"]).select("conv_id", "turn", F.round(A.jaccard(F.col("w"), F.col("v")), 9).alias("similarity"))


# -- schemas and files -------------------------------------------------------------------------------------------


@query("""SELECT c_custkey AS id, NULL::VARCHAR AS attr_s_name, c_name AS attr_c_name, c_mktsegment AS attr_segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, NULL FROM supplier""")
def attr_superset_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files with different attributes: one table with every attribute's column."""
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.create_map(F.lit("c_name"), "c_name", F.lit("segment"), "c_mktsegment").alias("attr"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.create_map(F.lit("s_name"), "s_name").alias("attr"))
    return union_all([flatten_attributes(c), flatten_attributes(s)])


@query("SELECT r_regionkey, r_name, CASE WHEN r_regionkey < 2 THEN 'bucket-a' END AS bucket, CASE WHEN r_regionkey = 3 THEN 'x' END AS note FROM region")
def file_metadata_injection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata by file, as columns under its own names."""
    r = load(spark, sf_dir, "region")
    meta = spark.createDataFrame([(0, {"bucket": "bucket-a"}), (1, {"bucket": "bucket-a"}), (3, {"note": "x"})], "file int, file_meta map<string,string>")
    return flatten_attributes(r.join(F.broadcast(meta), F.col("r_regionkey") == F.col("file"), "left").drop("file"))


@query("SELECT event_id, event_type, value FROM events")
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted ZSTD Parquet in the shared folder, read again."""
    import uuid

    from sparktel.sources.readers import write_parquet

    path = f"{shared_folder(spark)}/events-{uuid.uuid4().hex}"
    write_parquet(load(spark, sf_dir, "events").select("event_id", "event_type", "value"), path, ["event_type", "event_id"])
    return spark.read.parquet(path)


@query("SELECT event_type, event_id, value, rank() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS place FROM events QUALIFY place <= 3")
def top_points_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("event_type").orderBy(F.desc("value"), "event_id")
    return load(spark, sf_dir, "events").select("event_type", "event_id", "value", F.rank().over(w).cast("bigint").alias("place")).where("place <= 3")
