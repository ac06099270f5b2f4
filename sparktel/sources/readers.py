"""Reading OTLP files: read_metrics, read_logs, read_traces, their stream forms, the data source "otlp" and the SQL table functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sparktel.operators import enrich
from sparktel.operators.flatten import flatten_attributes
from sparktel.session import ship
from sparktel.sources import decode
from sparktel.sources.files import read_bytes
from sparktel.sources.inputs import Input, parse_inputs, parse_list

SIGNALS: dict[str, tuple[str, Callable]] = {"metrics": (decode.METRIC_SCHEMA, decode.metric_rows), "logs": (decode.LOG_SCHEMA, decode.log_rows), "traces": (decode.SPAN_SCHEMA, decode.span_rows)}
_BATCH = 2048
_FILES = "path string, modificationTime timestamp, length long, content binary"


def batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == _BATCH:
            yield _batch(part, schema)
            part = []
    if part:
        yield _batch(part, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_column(values, f.type) for f, values in zip(schema, zip(*rows, strict=True), strict=True)], schema=schema)


def _column(values: tuple, kind: pa.DataType) -> pa.Array:
    """An Arrow column; maps and lists of structs by their flat parts, without an object a value."""
    if pa.types.is_map(kind):
        parts, own = [() if v is None else v.items() for v in values], (kind.key_type, kind.item_type)
    elif pa.types.is_list(kind) and pa.types.is_struct(kind.value_type):
        parts, own = [v or () for v in values], [f.type for f in kind.value_type]
    else:
        return pa.array(values, kind)
    edges = [0, *accumulate(map(len, parts))]
    flat = zip(*chain.from_iterable(parts), strict=True) if edges[-1] else [()] * len(own)
    arrays = [pa.array(x, t) for x, t in zip(flat, own, strict=True)]
    null = pa.array([v is None for v in values]) if None in values else None
    if pa.types.is_map(kind):
        return pa.MapArray.from_arrays(pa.array(edges, pa.int32()), *arrays).cast(kind) if null is None else pa.array([None if v is None else list(v.items()) for v in values], kind)
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays(arrays, fields=list(kind.value_type)), type=kind, mask=null)


def decode_files(spark: SparkSession, signal: str, inputs: list[Input]) -> DataFrame:
    """Decoded rows of the files, `file` their place in the list; a task a file or several small ones.

    The list travels as a table of paths; bytes are read on the executors.
    """
    ship(spark)
    schema_text, rows_of = SIGNALS[signal]
    schema = to_arrow_schema(StructType.fromDDL(schema_text))
    table = spark.createDataFrame([(i, x.path, x.meta) for i, x in enumerate(inputs)], "file int, path string, meta array<struct<k:string,v:string>>")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in part.to_pylist():
                raw = decode.inflate(r["path"], read_bytes(r["path"]))
                more = (tuple((m["k"], m["v"]) for m in r["meta"] or []),) if signal == "logs" else ()
                yield from batches(rows_of(raw, r["file"], *more), schema)

    return table.repartition(max(1, min(len(inputs), 10_000)), "file").mapInArrow(run, schema_text)


def span_attribute_names(spark: SparkSession, inputs: list[Input]) -> dict[str, list[str]]:
    """What flatten.attribute_names gives for the rows of trace files, from their attributes alone."""
    ship(spark)
    table = spark.createDataFrame([(i, x.path) for i, x in enumerate(inputs)], "file int, path string")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[str, str]] = set()
        for part in parts:
            for path in part.column("path").to_pylist():
                found |= decode.span_names(decode.inflate(path, read_bytes(path)))
        yield pa.RecordBatch.from_pydict({"n": pa.array([n for n, _ in found], pa.string()), "k": pa.array([k for _, k in found], pa.string())})

    rows = table.repartition(max(1, min(len(inputs), 10_000)), "file").mapInArrow(run, "n string, k string").distinct().collect()
    return {n: sorted(r["k"] for r in rows if r["n"] == n) for n in ("resource", "scope", "attr")}


def read_metrics(spark: SparkSession, path: str, customer_id: str, flat: bool = True) -> DataFrame:
    """Metric rows of a path, pattern or list; flat: attributes as columns, else as maps."""
    df = enrich.metrics(decode_files(spark, "metrics", [Input(p) for p in parse_list(spark, path)]), customer_id)
    return flatten_attributes(df) if flat else df


def read_logs(spark: SparkSession, path: str, customer_id: str, file_metadata: str | None = None, flat: bool = True, mode: str = "cluster") -> DataFrame:
    df = enrich.logs(decode_files(spark, "logs", parse_inputs(spark, path, file_metadata)), customer_id, mode)
    return flatten_attributes(df) if flat else df


def read_traces(spark: SparkSession, path: str, customer_id: str, flat: bool = True) -> DataFrame:
    inputs = [Input(p) for p in parse_list(spark, path)]
    df = enrich.spans(decode_files(spark, "traces", inputs), customer_id)
    return flatten_attributes(df, span_attribute_names(spark, inputs)) if flat else df


def decode_content(df: DataFrame, signal: str, metadata: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Rows of (path, content), as the binaryFile source gives them, decoded; also for streams.  `file` is a hash of the path.

    metadata: of log files, by path, with or without its scheme, or by name.
    """
    ship(df.sparkSession)
    schema_text, rows_of = SIGNALS[signal]
    schema = to_arrow_schema(StructType.fromDDL(schema_text))

    def own(path: str) -> tuple[tuple[str, str], ...]:
        names = (path, path.removeprefix("file:").replace("///", "/"), path.rpartition("/")[2])
        return tuple(next((metadata[n] for n in names if n in metadata), {}).items())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in part.to_pylist():
                more = (own(r["path"]),) if signal == "logs" and metadata else ()
                yield from batches(rows_of(decode.inflate(r["path"], r["content"]), r["file"], *more), schema)

    return df.select(F.hash("path").alias("file"), "path", "content").mapInArrow(run, schema_text)


def stream(spark: SparkSession, signal: str, folder: str, customer_id: str, glob: str = "*", files_per_trigger: int | None = None, metadata: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Canonical rows (attributes as maps) of files as they arrive in a folder; log fingerprints are of the message alone,
    clusters of them are `windows.cluster_stream`'s.  metadata: of log files, by path or name."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = decode_content(reader.load(folder), signal, metadata)
    if signal == "metrics":
        return enrich.metrics(rows, customer_id)
    return enrich.spans(rows, customer_id) if signal == "traces" else enrich.logs(rows, customer_id, mode="exact")


class _File(InputPartition):
    def __init__(self, file: int, path: str, meta: list[tuple[str, str]]):
        self.file, self.path, self.meta = file, path, meta


class OtlpReader(DataSourceReader):
    def __init__(self, signal: str, inputs: list[Input], schema: pa.Schema):
        self.signal, self.inputs, self.schema = signal, inputs, schema

    def partitions(self) -> list[_File]:
        return [_File(i, x.path, x.meta) for i, x in enumerate(self.inputs)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        rows_of = SIGNALS[self.signal][1]
        raw = decode.inflate(partition.path, read_bytes(partition.path))
        more = (tuple(partition.meta),) if self.signal == "logs" else ()
        yield from batches(rows_of(raw, partition.file, *more), self.schema)


class OtlpSource(DataSource):
    """spark.read.format("otlp").option("signal", "metrics" | "logs" | "traces").load(path): decoded rows."""

    @classmethod
    def name(cls) -> str:
        return "otlp"

    def _signal(self) -> str:
        signal = self.options.get("signal", "metrics")
        if signal not in SIGNALS:
            raise ValueError(f"signal is one of {', '.join(SIGNALS)}")
        return signal

    def schema(self) -> str:
        return SIGNALS[self._signal()][0]

    def reader(self, schema: StructType) -> OtlpReader:
        path = self.options.get("path")
        if not path:
            raise ValueError("a path is needed")
        if self._signal() == "logs":
            return OtlpReader("logs", parse_inputs(None, path, self.options.get("file_metadata")), to_arrow_schema(schema))
        return OtlpReader(self._signal(), [Input(p) for p in parse_list(None, path)], to_arrow_schema(schema))


def register(spark: SparkSession) -> None:
    """The data source "otlp" and the SQL functions of sqlfunctions; views over files are made by `create_view`."""
    from sparktel.sources.sqlfunctions import register_functions

    ship(spark)
    spark.dataSource.register(OtlpSource)
    register_functions(spark)


def canonical(rows: DataFrame, signal: str, customer_id: str, flat: bool = False, **options) -> DataFrame:
    """Decoded rows, as the data source or decode_content gives them, to the canonical table of their signal."""
    df = {"metrics": enrich.metrics, "logs": enrich.logs, "traces": enrich.spans}[signal](rows, customer_id, **options)
    return flatten_attributes(df) if flat else df


def create_view(spark: SparkSession, name: str, signal: str, path: str, customer_id: str, **options) -> DataFrame:
    """A temporary view over files, for SQL: the columns of read_metrics, read_logs or read_traces."""
    df = {"metrics": read_metrics, "logs": read_logs, "traces": read_traces}[signal](spark, path, customer_id, **options)
    df.createOrReplaceTempView(name)
    return df


def write_parquet(df: DataFrame, path: str, keys: list[str], partitions: int | None = None) -> None:
    """Sorted ZSTD Parquet: ranges of the keys apart, rows within a file in their order."""
    parted = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    parted.sortWithinPartitions(*keys).write.mode("overwrite").option("compression", "zstd").parquet(path)
