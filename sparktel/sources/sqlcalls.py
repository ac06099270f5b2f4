"""SQL with file reads in it: `SELECT ... FROM otel_metrics_read('path', customer_id = 'c')` as a distributed query.

Each call becomes a temporary view over the reader's DataFrame, so filters, aggregates and joins around it are planned
by Spark as for any table.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from sparktel.sources.readers import create_view

#: The table functions and their named parameters.
FUNCTIONS = {"otel_metrics_read": "metrics", "otel_logs_read": "logs", "otel_traces_read": "traces"}
PARAMETERS = {"metrics": {"customer_id"}, "logs": {"customer_id", "file_metadata"}, "traces": {"customer_id"}}

_LITERAL = r"'(?:[^']|'')*'"
_SKIP = re.compile(rf"{_LITERAL}|\"(?:[^\"]|\"\")*\"|--[^\n]*|/\*.*?\*/", re.S)
_CALL = re.compile(rf"\b({'|'.join(FUNCTIONS)})\s*\(\s*({_LITERAL})\s*((?:,\s*\w+\s*(?::=|=>|=)\s*{_LITERAL}\s*)*)\)", re.I)
_NAMED = re.compile(rf"(\w+)\s*(?::=|=>|=)\s*({_LITERAL})")


def _text(literal: str) -> str:
    return literal[1:-1].replace("''", "'")


def sql(spark: SparkSession, query: str, **options) -> DataFrame:
    """Run a query in which the table functions may be called with string literals; options go to the readers."""
    out, at = [], 0
    while at < len(query):
        call, skip = _CALL.search(query, at), _SKIP.search(query, at)
        if call is None or (skip is not None and skip.start() < call.start()):
            end = skip.end() if skip is not None else len(query)
            out.append(query[at:end])
            at = end
            continue
        signal = FUNCTIONS[call[1].lower()]
        named = {k.lower(): _text(v) for k, v in _NAMED.findall(call[3])}
        if unknown := set(named) - PARAMETERS[signal]:
            raise ValueError(f"{call[1]} has no parameter {', '.join(sorted(unknown))}")
        if "customer_id" not in named:
            raise ValueError(f"{call[1]} needs customer_id")
        view = f"sparktel_{signal}_{uuid.uuid4().hex}"
        create_view(spark, view, signal, _text(call[2]), **named, **options)
        out += [query[at : call.start()], view]
        at = call.end()
    return spark.sql("".join(out))
