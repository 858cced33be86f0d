"""The dimension tables of a run, keyed by report and day.

The settings of all reports are one small table. A dimension is read once and joined with it, so a
plan has the same scans, joins and shuffles for one report and for a hundred; only reports that bring
tables of their own add to it. Dimensions with a ``report`` column hold for that report only.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from uptrail.config import PROFILE_COLUMNS, Options, ReportInputs, literal_frame
from uptrail.functions.tags import tags_agree, wanted_tags
from uptrail.operators import slots
from uptrail.operators.fold import spread
from uptrail.operators.selection import ENDPOINT
from uptrail.sources.snapshots import daily_snapshots

SCOPE = ["report", "date"]
WANTED = "map<string, string>"


@dataclass(frozen=True)
class Dimensions:
    """One run: reports x days first..last."""

    reports: list[ReportInputs]
    first: str
    last: str
    checks: DataFrame         # report, date, service, metric: the metric profile
    mapping: DataFrame        # report, service, ag_group, svc_op, group_op
    places: DataFrame         # report, date, service, hostname, group: the whole topology
    endpoints: DataFrame      # report, date, service, hostname: its endpoints, each once
    selected: DataFrame       # report, date, service, hostname: inside the tag filters
    chosen: DataFrame | None  # the same without date, where all days have the same ones
    downtimes: DataFrame | None
    group_exclusions: DataFrame | None
    monitor_exclusions: DataFrame | None
    calendar: "Calendar"

    @property
    def ops(self) -> set[str]:
        return set().union(*(r.profile.ops() for r in self.reports))

    def per_report(self, value: Callable[[ReportInputs], str | int]) -> Column:
        """A value of the report's configuration as a column."""
        owners: dict[str | int, list[str]] = {}
        for r in self.reports:
            owners.setdefault(value(r), []).append(r.config.id)
        if len(owners) == 1:
            return F.lit(next(iter(owners)))
        choice = F
        for v, ids in owners.items():
            choice = choice.when(F.col("report").isin(ids), v)
        return choice

    def supergroups(self) -> DataFrame:
        """(report, date, group, supergroup): one supergroup of the report's type, the first by name."""
        def of(gg: DataFrame, reports: list[ReportInputs]) -> DataFrame:
            rows = with_settings(self.calendar.of(gg), reports, type=lambda r: r.config.ggroup)
            return (rows.groupBy("report", "date", F.col("subgroup").alias("group"))
                    .agg(F.min("group").alias("supergroup")))
        return over_tables(self.reports, lambda r: (r.group_groups,), of)

    def weights(self) -> DataFrame:
        """(report, date, group, weight): one weight of the report's type, the smallest."""
        def of(weights: DataFrame, reports: list[ReportInputs]) -> DataFrame:
            rows = with_settings(self.calendar.of(weights), reports, type=lambda r: r.config.weight)
            return (rows.groupBy("report", "date", F.col("site").alias("group"))
                    .agg(F.min(F.col("weight").cast("int")).alias("weight")))
        found = over_tables(self.reports, lambda r: (r.weights,), of)
        if found is None:
            none = literal_frame(self.checks.sparkSession, [], "report", "date", "group", "weight")
            found = none.select("report", F.col("date").cast("date"), "group", F.col("weight").cast("int"))
        return found


class Calendar:
    """Tables on every day of a run. A table with a snapshot date gives each day its newest snapshot;
    these are chosen once for each table, and one job looks at all of them."""

    def __init__(self, tables: list[DataFrame | None], first: str, last: str):
        self.first, self.last = first, last
        dated = {str(id(t)): t for t in tables if t is not None and "date" in t.columns}
        self.tables = list(dated.values())  # ids stay theirs as long as the tables live
        self.daily = daily_snapshots(dated, first, last)

    def of(self, df: DataFrame) -> DataFrame:
        return self.daily[str(id(df))] if str(id(df)) in self.daily else self.every_day(df)

    def every_day(self, df: DataFrame) -> DataFrame:
        low, high = F.lit(self.first).cast("date"), F.lit(self.last).cast("date")
        if self.first == self.last:
            return df.withColumn("date", low)
        return df.withColumn("date", F.explode(F.sequence(low, high)))


def over_tables(reports: list[ReportInputs], tables: Callable[[ReportInputs], tuple],
                of: Callable[..., DataFrame]) -> DataFrame | None:
    """of(*tables, reports) for each different set of tables, united; None without any."""
    owners: dict[tuple, tuple[tuple, list[ReportInputs]]] = {}
    for r in reports:
        mine = tables(r)
        if mine[0] is not None:
            owners.setdefault(tuple(map(id, mine)), (mine, []))[1].append(r)
    frames = [of(*mine, who) for mine, who in owners.values()]
    return reduce(DataFrame.unionByName, frames) if frames else None


def with_settings(df: DataFrame, reports: list[ReportInputs], **settings: Callable[[ReportInputs], str]) -> DataFrame:
    """The rows of each report: those with its value in the first setting's column. Further
    settings are added as columns. One join with an inline table."""
    on, *more = settings
    rows = [(r.config.id, *(value(r) for value in settings.values())) for r in reports]
    table = literal_frame(df.sparkSession, rows, "report", on, *more)
    return df.join(table, [on, *(c for c in ("report",) if c in df.columns)])


def build(spark: SparkSession, reports: list[ReportInputs], first: str, last: str,
          options: Options) -> Dimensions:
    ids = [r.config.id for r in reports]
    if len(set(ids)) != len(ids):
        raise ValueError(f"report ids repeat: {ids}")
    calendar = Calendar([t for r in reports for t in (r.metric_profiles, r.endpoint_groups, r.group_groups,
                                                      r.weights, r.downtimes)], first, last)
    mapping = [(r.config.id, *row) for r in reports for row in r.profile.rows()]
    places = over_tables(reports, lambda r: (r.endpoint_groups,), lambda *a: places_of(*a, calendar, "group"))
    endpoints = over_tables(reports, lambda r: (r.endpoint_groups,), lambda *a: places_of(*a, calendar))
    any_dated = any("date" in t.columns for r in reports for t in (r.endpoint_groups, r.group_groups))
    selected = over_tables(reports, lambda r: (r.endpoint_groups, r.group_groups), lambda *a: selected_of(*a, calendar, any_dated))
    chosen = None
    if not any_dated:
        chosen, selected = selected, calendar.every_day(selected).select(*SCOPE, *ENDPOINT)

    def downtimes_of(downtimes: DataFrame, mine: list[ReportInputs]) -> DataFrame:
        """Downtime slots of the reports' endpoints, per day."""
        if "date" in downtimes.columns:
            downtimes = calendar.of(downtimes)  # a day's snapshot lists the downtimes of that day only
        spans = slots.with_downtimes(downtimes, first, last, options)
        known = endpoints.where(F.col("report").isin([r.config.id for r in mine]))
        return spans.join(known, [*(c for c in ("report",) if c in spans.columns), "date", *ENDPOINT])

    return Dimensions(
        reports, first, last,
        over_tables(reports, lambda r: (r.metric_profiles,), lambda *a: checks_of(*a, calendar)),
        literal_frame(spark, mapping, "report", *PROFILE_COLUMNS), places, endpoints, selected, chosen,
        over_tables(reports, lambda r: (r.downtimes,), downtimes_of),
        over_tables(reports, lambda r: (r.group_exclusions,), own_requests),
        over_tables(reports, lambda r: (r.monitor_exclusions,), own_requests), calendar)


def kept(df: DataFrame, *columns: str) -> list[str]:
    """The columns, and date and report where the table has them."""
    return [*columns, *(c for c in SCOPE if c in df.columns)]


def checks_of(profiles: DataFrame, reports: list[ReportInputs], calendar: Calendar) -> DataFrame:
    """(report, date, service, metric) of the reports' metric profiles."""
    rows = calendar.of(profiles)
    rows = rows.select(*kept(rows, "profile", "service", "metric")).distinct()
    return with_settings(rows, reports, profile=lambda r: r.profile.metric_profile).select(*SCOPE, "service", "metric")


def places_of(eg: DataFrame, reports: list[ReportInputs], calendar: Calendar, *columns: str) -> DataFrame:
    """(report, date, service, hostname, columns) of the reports' grouping types, each once, tags not looked at."""
    rows = eg if "date" not in eg.columns else calendar.of(eg)
    rows = spread(rows.select(*kept(rows, "type", *ENDPOINT, *columns)).distinct(), ENDPOINT)  # before days and reports multiply them
    rows = with_settings(rows, reports, type=lambda r: r.config.egroup)
    return (rows if "date" in eg.columns else calendar.every_day(rows)).select(*SCOPE, *ENDPOINT, *columns)


def selected_of(eg: DataFrame, gg: DataFrame, reports: list[ReportInputs], calendar: Calendar, any_dated: bool) -> DataFrame:
    """(report, service, hostname) of endpoints that pass the tag filters of a report and whose
    group is a subgroup of any group that passes them; with date, if a table of any report has one.

    Snapshots are chosen before tags are looked at: a snapshot may have no row that passes.
    """
    dated = "date" in eg.columns or "date" in gg.columns
    if dated:
        eg, gg = calendar.of(eg), calendar.of(gg)
    rows = with_settings(eg, reports, type=lambda r: r.config.egroup,
                         _eg_wanted=lambda r: json.dumps(wanted_tags(r.config.egroup_tags)),
                         _gg_wanted=lambda r: json.dumps(wanted_tags(r.config.ggroup_tags, False)))
    rows = rows.where(tags_agree(F.col("tags"), F.from_json("_eg_wanted", WANTED)))
    groups = gg.select(F.col("subgroup").alias("_subgroup"), F.col("tags").alias("_gg_tags"),
                       *[F.col(c).alias(f"_{c}") for c in kept(gg)])
    hit = (F.col("group") == F.col("_subgroup")) & tags_agree(F.col("_gg_tags"), F.from_json("_gg_wanted", WANTED))
    for c in kept(gg):
        hit = hit & (F.col(c) == F.col(f"_{c}"))
    found = rows.join(groups, hit, "left_semi").select(*kept(rows, *ENDPOINT)).distinct()
    if not dated and any_dated:
        found = calendar.every_day(found)
    return found.select(*kept(found, *ENDPOINT))


def own_requests(exclusions: DataFrame, reports: list[ReportInputs]) -> DataFrame:
    """Exclusions of the reports; each report only sees its own requests."""
    return exclusions.where(F.col("report").isin([r.config.id for r in reports]))
