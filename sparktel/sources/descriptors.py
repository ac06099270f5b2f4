"""OTLP messages for the protobuf runtime, built from field tables; no generated code and no protoc."""

from __future__ import annotations

from functools import lru_cache

from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

#: The public wire schema.  message: fields as `number name type`; `*` repeated, `?` with presence, `|` in the one-of.
MESSAGES = {
    "AnyValue": "1 string_value string|, 2 bool_value bool|, 3 int_value int64|, 4 double_value double|, 5 array_value ArrayValue|, 6 kvlist_value KeyValueList|, 7 bytes_value bytes|",
    "ArrayValue": "1 values AnyValue*",
    "KeyValueList": "1 values KeyValue*",
    "KeyValue": "1 key string, 2 value AnyValue",
    "Scope": "1 name string, 2 version string, 3 attributes KeyValue*, 4 dropped_attributes_count uint32",
    "Resource": "1 attributes KeyValue*, 2 dropped_attributes_count uint32",
    "Metrics": "1 resource_metrics ResourceMetrics*",
    "ResourceMetrics": "1 resource Resource, 2 scope_metrics ScopeMetrics*, 3 schema_url string",
    "ScopeMetrics": "1 scope Scope, 2 metrics Metric*, 3 schema_url string",
    "Metric": "1 name string, 2 description string, 3 unit string, 5 gauge Gauge|, 7 sum Sum|, 9 histogram Histogram|, 10 exponential_histogram ExponentialHistogram|, 11 summary Summary|, 12 metadata KeyValue*",
    "Gauge": "1 data_points NumberPoint*",
    "Sum": "1 data_points NumberPoint*, 2 aggregation_temporality int32, 3 is_monotonic bool",
    "Histogram": "1 data_points HistogramPoint*, 2 aggregation_temporality int32",
    "ExponentialHistogram": "1 data_points ExponentialPoint*, 2 aggregation_temporality int32",
    "Summary": "1 data_points SummaryPoint*",
    "NumberPoint": "7 attributes KeyValue*, 2 start_time_unix_nano fixed64, 3 time_unix_nano fixed64, 4 as_double double|, 6 as_int sfixed64|, 8 flags uint32",
    "HistogramPoint": "9 attributes KeyValue*, 2 start_time_unix_nano fixed64, 3 time_unix_nano fixed64, 4 count fixed64, 5 sum double?, 6 bucket_counts fixed64*, 7 explicit_bounds double*, 10 flags uint32, 11 min double?, 12 max double?",
    "ExponentialPoint": "1 attributes KeyValue*, 2 start_time_unix_nano fixed64, 3 time_unix_nano fixed64, 4 count fixed64, 5 sum double?, 6 scale sint32, 7 zero_count fixed64, 8 positive Buckets, 9 negative Buckets, 10 flags uint32, 12 min double?, 13 max double?, 14 zero_threshold double",
    "Buckets": "1 offset sint32, 2 bucket_counts uint64*",
    "SummaryPoint": "7 attributes KeyValue*, 2 start_time_unix_nano fixed64, 3 time_unix_nano fixed64, 4 count fixed64, 5 sum double, 6 quantile_values Quantile*, 8 flags uint32",
    "Quantile": "1 quantile double, 2 value double",
    "Logs": "1 resource_logs ResourceLogs*",
    "ResourceLogs": "1 resource Resource, 2 scope_logs ScopeLogs*, 3 schema_url string",
    "ScopeLogs": "1 scope Scope, 2 log_records LogRecord*, 3 schema_url string",
    "LogRecord": "1 time_unix_nano fixed64, 11 observed_time_unix_nano fixed64, 2 severity_number int32, 3 severity_text string, 5 body AnyValue, 6 attributes KeyValue*, 7 dropped_attributes_count uint32, 8 flags fixed32, 9 trace_id bytes, 10 span_id bytes, 12 event_name string",
    "Traces": "1 resource_spans ResourceSpans*",
    "ResourceSpans": "1 resource Resource, 2 scope_spans ScopeSpans*, 3 schema_url string",
    "ScopeSpans": "1 scope Scope, 2 spans Span*, 3 schema_url string",
    "Span": "1 trace_id bytes, 2 span_id bytes, 3 trace_state string, 4 parent_span_id bytes, 16 flags fixed32, 5 name string, 6 kind int32, 7 start_time_unix_nano fixed64, 8 end_time_unix_nano fixed64, 9 attributes KeyValue*, 10 dropped_attributes_count uint32, 15 status Status",
    "Status": "2 message string, 3 code int32",
}


@lru_cache(maxsize=1)
def messages() -> dict[str, type]:
    """Message classes by the names above."""
    kinds = descriptor_pb2.FieldDescriptorProto
    proto = descriptor_pb2.FileDescriptorProto(name="sparktel/otlp.proto", package="sparktel.otlp", syntax="proto3")
    for name, table in MESSAGES.items():
        m = proto.message_type.add(name=name)
        fields = [f.split() for f in table.split(", ")]
        chosen = [f for f in fields if f[2].endswith("|")]
        if chosen:
            m.oneof_decl.add(name="choice")
        optional = []
        for number, field, kind in fields:
            plain = kind.rstrip("*?|")
            f = m.field.add(name=field, number=int(number), label=kinds.LABEL_REPEATED if kind.endswith("*") else kinds.LABEL_OPTIONAL)
            if plain in MESSAGES:
                f.type, f.type_name = kinds.TYPE_MESSAGE, f".sparktel.otlp.{plain}"
            else:
                f.type = getattr(kinds, f"TYPE_{plain.upper()}")
            if kind.endswith("|"):
                f.oneof_index = 0
            elif kind.endswith("?"):
                f.proto3_optional = True
                optional.append(f)
        for f in optional:  # one-ofs of single optional fields come last
            f.oneof_index = len(m.oneof_decl)
            m.oneof_decl.add(name=f"_{f.name}")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(proto)
    return {name: message_factory.GetMessageClass(pool.FindMessageTypeByName(f"sparktel.otlp.{name}")) for name in MESSAGES}
