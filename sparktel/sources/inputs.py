"""Which files a read takes: paths, globs, lists, and JSON with metadata for each file."""

from __future__ import annotations

import glob
import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass
class Input:
    path: str
    meta: list[tuple[str, str]] = field(default_factory=list)


def _is_remote(path: str) -> bool:
    return "://" in path and not path.startswith("file://")


def expand(spark: SparkSession | None, path: str) -> list[str]:
    """A pattern's files in order; a plain path as it is, whether or not it exists."""
    if not any(c in path for c in "*?"):
        return [path]
    if _is_remote(path) and spark is not None:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        got = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
        found = sorted(str(s.getPath()) for s in got)
    else:
        found = sorted(glob.glob(path.removeprefix("file://"), recursive=True, include_hidden=True))
    if not found:
        raise ValueError(f"No files matched pattern: {path}")
    return found


def parse_list(spark: SparkSession | None, text: str) -> list[str]:
    """A path or pattern, or several as `[a, 'b', "c"]`."""
    text = text.strip()
    if not (text.startswith("[") and text.endswith("]")):
        return expand(spark, text)
    names = [n for n in (x.strip().strip("'\"") for x in text[1:-1].split(",")) if n]
    if not names:
        raise ValueError("Empty file list")
    return [p for n in names for p in expand(spark, n)]


def parse_inputs(spark: SparkSession | None, text: str, file_metadata: str | None = None) -> list[Input]:
    """Files of a log read.  JSON lists hold strings and objects with a path and string metadata; anything else is a
    list as above.  file_metadata, a JSON object by the path as given, adds to a file's own; malformed JSON adds nothing."""
    try:
        extra = json.loads(file_metadata) if file_metadata else {}
    except ValueError:
        extra = {}
    if not isinstance(extra, dict):
        extra = {}
    more = lambda name: [(k, v) for k, v in (extra.get(name) or {}).items() if isinstance(v, str)] if isinstance(extra.get(name), dict) else []
    try:
        items = json.loads(text)
    except ValueError:
        items = None
    if not isinstance(items, list):
        given = text.strip()
        if given.startswith("[") and given.endswith("]"):
            names = [n for n in (x.strip().strip("'\"") for x in given[1:-1].split(",")) if n]
            if not names:
                raise ValueError("Empty file list")
            return [Input(p, more(n)) for n in names for p in expand(spark, n)]
        return [Input(p, more(text)) for p in expand(spark, text)]
    out = []
    for item in items:
        if isinstance(item, str):
            out += [Input(p, more(item)) for p in expand(spark, item)]
        elif isinstance(item, dict) and isinstance(item.get("path"), str):
            own = [(k, v) for k, v in item.items() if k != "path" and isinstance(v, str)]
            out += [Input(p, own + more(item["path"])) for p in expand(spark, item["path"])]
    if not out:
        raise ValueError("Empty file list")
    return out
