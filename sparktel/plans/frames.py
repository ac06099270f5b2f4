"""Telemetry frames over the star-schema tables: events as data points and log records, orders and lines as spans."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktel.session import ship


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all executors see; a folder of this machine only where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="sparktel-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nanos(ts: Column) -> Column:
    """Nanoseconds since 1970 of a timestamp without zone, read as UTC whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts) * 1000


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as number data points: time_ns, name, kind, service, bucket, value."""
    e = load(spark, sf_dir, "events")
    return e.select(
        "event_id", nanos(F.col("ts")).alias("time_ns"), F.concat(F.lit("app."), "event_type").alias("name"), F.when(F.col("event_type") == "purchase", "sum").otherwise("gauge").alias("kind"),
        F.concat(F.lit("svc-"), F.pmod("user_id", F.lit(5)).cast("string")).alias("service"), F.pmod("user_id", F.lit(20)).cast("string").alias("bucket"), "value",
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as log records: time_ns, severity, body, trace (every third has one)."""
    e = load(spark, sf_dir, "events")
    body = F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" did "), "event_type", F.lit(" in 12ms"))
    return e.select(
        "event_id", nanos(F.col("ts")).alias("time_ns"), F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "signup", "WARN").otherwise("INFO").alias("severity"),
        body.alias("body"), F.when(F.pmod("event_id", F.lit(3)) == 0, F.pmod("event_id", F.lit(1000))).alias("trace"),
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A root span an order, a child a line: trace, span, parent (''), name, kind, status, start_ns, end_ns, service."""
    o, li = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    roots = o.select(
        F.col("o_orderkey").alias("trace"), F.lit("r").alias("span"), F.lit("").alias("parent"), F.concat(F.lit("order "), "o_orderstatus").alias("name"), F.lit(2).alias("kind"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "P", 2).otherwise(0).alias("status"), nanos(F.col("o_orderdate")).alias("start_ns"), F.round("o_totalprice").cast("bigint").alias("d"), F.substring("o_orderpriority", 1, 1).alias("service"),
    )
    lines = li.select(
        F.col("l_orderkey").alias("trace"), F.col("l_linenumber").cast("string").alias("span"), F.lit("r").alias("parent"), F.concat(F.lit("line "), "l_returnflag").alias("name"), (F.pmod("l_linenumber", F.lit(7))).alias("kind"),
        F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("status"), nanos(F.col("l_shipdate")).alias("start_ns"), F.col("l_quantity").cast("bigint").alias("d"), F.col("l_linestatus").alias("service"),
    )
    return roots.unionByName(lines).withColumn("end_ns", F.col("start_ns") + F.col("d") * 1_000_000).drop("d")
