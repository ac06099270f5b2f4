"""Streams of metric, span and log rows: windowed sketches and stateful log clusters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktel.functions import sketch as S
from sparktel.operators.logclusters import Clusterer


def metric_windows(df: DataFrame, value: str = "chq_rollup_sum", time_ms: str = "chq_timestamp", width: str = "10 seconds", late: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Slots of each series and window: the sketch of a window is the sum of its slots, of values of either sign and zero.

    Rows later than `late` are dropped, as are values that aren't finite.  One row a (series, window, slot), so state is
    bounded by slots; `S.merge_bins` or `S.running_quantile` finish it.
    """
    v = F.col(value)
    rows = df.where(S.usable(v)).withColumn("_t", F.timestamp_millis(F.col(time_ms))).withWatermark("_t", late)
    return rows.groupBy("metric_name", "chq_tid", F.window("_t", width, slide or width).alias("window"), S.slot_of(v).alias("idx")).agg(F.count("*").cast("double").alias("cnt"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"))


def span_sessions(df: DataFrame, gap: str = "5 seconds", late: str = "1 minute") -> DataFrame:
    """Sessions of a trace: spans less than `gap` apart."""
    rows = df.withColumn("_t", F.timestamp_millis("chq_timestamp")).withWatermark("_t", late)
    return rows.groupBy("span_trace_id", F.session_window("_t", gap).alias("session")).agg(F.count("*").alias("spans"), F.max("span_duration").alias("longest"))


def cluster_stream(df: DataFrame, tenant: str, idle: str = "1 hour") -> DataFrame:
    """(tenant, log_message, log_tokens, log_json_keys) to (tenant, log_message, log_cluster) with the tenant's clusters as
    state, which is dropped when the tenant is idle for longer than `idle`.  A micro-batch's rows come in its own order."""
    import pickle

    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    kind = df.schema[tenant].dataType.simpleString()

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        clusters = pickle.loads(state.get[0]) if state.exists else Clusterer()
        for pdf in parts:
            got = [0 if t is None else clusters.cluster(list(t), [] if k is None else list(k)) for t, k in zip(pdf["log_tokens"], pdf["log_json_keys"], strict=True)]
            yield pd.DataFrame({tenant: [key[0]] * len(pdf), "log_message": pdf["log_message"].to_numpy(), "log_cluster": got})
        state.update((pickle.dumps(clusters),))
        state.setTimeoutDuration(int(pd.Timedelta(idle).total_seconds() * 1000))

    rows = df.select(tenant, "log_message", "log_tokens", "log_json_keys")
    return rows.groupBy(tenant).applyInPandasWithState(step, f"{tenant} {kind}, log_message string, log_cluster bigint", "state binary", "append", GroupStateTimeout.ProcessingTimeTimeout)
