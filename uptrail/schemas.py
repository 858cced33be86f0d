"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


TAGS = T.MapType(_S, _S)

METRIC_DATA = _struct(
    ("timestamp", _S), ("service", _S), ("hostname", _S), ("metric", _S), ("status", _S),
    ("monitoring_host", _S), ("summary", _S), ("message", _S), ("tags", TAGS))
ENDPOINT_GROUPS = _struct(
    ("type", _S), ("group", _S), ("service", _S), ("hostname", _S), ("tags", TAGS))
GROUP_GROUPS = _struct(("type", _S), ("group", _S), ("subgroup", _S), ("tags", TAGS))
METRIC_PROFILES = _struct(("profile", _S), ("service", _S), ("metric", _S), ("tags", TAGS))
DOWNTIMES = _struct(("hostname", _S), ("service", _S), ("start_time", _S), ("end_time", _S))
WEIGHTS = _struct(("type", _S), ("site", _S), ("weight", _S))

RECOMPUTATIONS = _struct(
    ("id", _S), ("report", _S), ("reason", _S), ("start_time", _S), ("end_time", _S),
    ("exclude", T.ArrayType(_S)), ("status", _S), ("timestamp", _S),
    ("exclude_monitoring_source", T.ArrayType(_struct(
        ("host", _S), ("start_time", _S), ("end_time", _S)))))

ENVELOPE = _struct(("attributes", TAGS), ("data", _S))

LEGACY_LOG = _struct(
    ("time_stamp", _S), ("metric", _S), ("service_flavour", _S), ("hostname", _S),
    ("status", _S), ("vo", _S), ("vofqan", _S), ("profile", _S))
LEGACY_DETAIL = _struct(
    ("timestamp", _S), ("roc", _S), ("monitoring_box", _S), ("metric", _S), ("service_type", _S),
    ("hostname", _S), ("status", _S), ("vo", _S), ("vo_fqan", _S), ("summary", _S), ("message", _S))
LEGACY_SITES = _struct(
    ("hostname", _S), ("service", _S), ("production", _S), ("monitored", _S), ("scope", _S),
    ("site", _S), ("roc", _S), ("infrastructure", _S), ("certification", _S), ("site_scope", _S))

# Payload schema by ingested type.
PAYLOADS = {
    "metric_data": METRIC_DATA,
    "endpoint_groups": ENDPOINT_GROUPS,
    "group_groups": GROUP_GROUPS,
    "metric_profiles": METRIC_PROFILES,
    "downtimes": DOWNTIMES,
    "weights": WEIGHTS,
}
