"""Configuration documents and job options.

These are the small JSON documents a tenant writes by hand: state algebra, availability profile,
report configuration. They are read through Spark, so any file system works, and parsed on the
driver. Everything that grows with the monitored estate stays a DataFrame.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from uptrail.functions.truth import Operations


@dataclass(frozen=True)
class AvailabilityProfile:
    """Which services count, in which availability groups, folded with which operations."""

    name: str
    metric_profile: str
    metric_op: str
    total_op: str
    groups: dict[str, tuple[str, dict[str, str]]]  # group -> (group op, {service: service op})
    namespace: str | None = None
    group_type: str | None = None

    @classmethod
    def from_document(cls, doc: dict) -> "AvailabilityProfile":
        groups = {name: (group["operation"], dict(group["services"]))
                  for name, group in doc["groups"].items()}
        owner: dict[str, str] = {}
        for name, (_, services) in groups.items():
            for service in services:
                if owner.setdefault(service, name) != name:
                    raise ValueError(f"service {service} is in groups {owner[service]} and {name}")
        return cls(doc["name"], doc["metric_profile"], doc["metric_ops"], doc["operation"], groups,
                   doc.get("namespace"), doc.get("group_type"))

    def rows(self) -> list[tuple[str, str, str, str, str, str]]:
        """(service, svc_op, ag_group, group_op, total_op, metric_op), one per service."""
        return [(service, svc_op, group, group_op, self.total_op, self.metric_op)
                for group, (group_op, services) in sorted(self.groups.items())
                for service, svc_op in sorted(services.items())]

    def ops(self) -> set[str]:
        used = {self.metric_op, self.total_op}
        for group_op, services in self.groups.values():
            used |= {group_op, *services.values()}
        return used


@dataclass(frozen=True)
class ReportConfig:
    """One report of a tenant: group types, weight type and the tag filters."""

    id: str
    tenant: str
    job: str
    egroup: str
    ggroup: str
    weight: str
    altg: str | None = None
    egroup_tags: dict[str, str] = field(default_factory=dict)
    ggroup_tags: dict[str, str] = field(default_factory=dict)
    mdata_tags: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_document(cls, doc: dict) -> "ReportConfig":
        return cls(doc["id"], doc["tenant"], doc["job"], doc["egroup"], doc["ggroup"],
                   doc["weight"], doc.get("altg"), dict(doc.get("egroup_tags", {})),
                   dict(doc.get("ggroup_tags", {})), dict(doc.get("mdata_tags", {})))


@dataclass(frozen=True)
class Options:
    """Choices where more than one reading of the rules makes sense.

    strict      apply the profile filters and the monitoring-host exclusion
    scope       endpoints expected to report: the whole ``topology``, or only ``selected`` ones
    downtimes   ``first`` (earliest start) or ``all`` periods of an endpoint
    align       ``settle``: a sample acts one slot early and slot 0 is dropped; ``exact``: neither
    anchor      ``previous``: the first event of a metric gives only its previous state, at
                midnight; ``exact``: it also gives its own state
    """

    period: int = 1440
    interval: int = 5
    strict: bool = True
    scope: str = "topology"
    downtimes: str = "first"
    align: str = "settle"
    anchor: str = "previous"

    def __post_init__(self) -> None:
        allowed = {"scope": ("topology", "selected"), "downtimes": ("first", "all"),
                   "align": ("settle", "exact"), "anchor": ("previous", "exact")}
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}, not {getattr(self, name)!r}")

    @property
    def slots(self) -> int:
        return self.period // self.interval


@dataclass(frozen=True)
class ReportInputs:
    """A report with its dimension tables.

    Tables are those of ``uptrail.schemas``. A topology with a ``date`` column is taken per day,
    without one it holds for every day of the run. Downtimes have start_ts and end_ts, as
    ``sources.tables.read_downtimes`` gives them; exclusions are what
    ``operators.requests.group_exclusions`` and ``monitor_exclusions`` give; None means none.
    """

    config: ReportConfig
    profile: AvailabilityProfile
    metric_profiles: DataFrame
    endpoint_groups: DataFrame
    group_groups: DataFrame
    weights: DataFrame | None = None
    downtimes: DataFrame | None = None
    group_exclusions: DataFrame | None = None
    monitor_exclusions: DataFrame | None = None


def read_document(spark: SparkSession, path: str) -> dict | list:
    """Parse one JSON document from any file system Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_ops(spark: SparkSession, path: str, mirror: bool = True) -> Operations:
    return Operations.from_document(read_document(spark, path), mirror)


def read_availability_profile(spark: SparkSession, path: str) -> AvailabilityProfile:
    return AvailabilityProfile.from_document(read_document(spark, path))


def read_report_config(spark: SparkSession, path: str) -> ReportConfig:
    return ReportConfig.from_document(read_document(spark, path))


def literal_frame(spark: SparkSession, rows: list[tuple], *columns: str) -> DataFrame:
    """Rows of a configuration document as an inline table of texts.

    Spark knows the exact size of an inline table, so it can decide to broadcast it. A frame made
    from a Python list has no known size, and a join with it would shuffle the other side.
    """
    values = zip(*rows) if rows else [[]] * len(columns)
    return spark.createDataFrame(pa.table(
        [pa.array(column, pa.string()) for column in values], names=list(columns)))


def truth_frame(spark: SparkSession, operations: Operations) -> DataFrame:
    """The truth tables as rows (op, a, b, x) of names, undefined cells left out."""
    return literal_frame(spark, operations.cells(), "op", "a", "b", "x")


PROFILE_COLUMNS = ("service", "svc_op", "ag_group", "group_op", "total_op", "metric_op")


def profile_frame(spark: SparkSession, profile: AvailabilityProfile) -> DataFrame:
    """The profile as rows, one per service."""
    return literal_frame(spark, profile.rows(), *PROFILE_COLUMNS)
