"""Projections, filters, semi- and anti-joins over metric data.

No join here carries a broadcast hint: Spark broadcasts a side when its size is within
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with adaptive skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from uptrail.functions import clock
from uptrail.functions.tags import tags_pass

ENDPOINT = ["service", "hostname"]
METRIC = ["service", "hostname", "metric"]

MISSING_HOST = "none"
MISSING_TEXT = "missing"

# Exclusions are joined by cells of the day of this length.
X_CELL, X_SECONDS = "_x_cell", 600


def trim_metric_data(md: DataFrame, text: bool = False) -> DataFrame:
    """The columns a job needs; ``text`` keeps summary and message."""
    columns = ["timestamp", *METRIC, "status", "monitoring_host"]
    if text:
        columns += ["summary", "message"]
    return md.select(*columns)


def with_time(md: DataFrame) -> DataFrame:
    """Add the date and the second of the day of each row, where not there yet."""
    parts = {"date": clock.text_date(F.col("timestamp")),
             "second": clock.seconds_of_day(F.col("timestamp"))}
    return md.withColumns({name: part for name, part in parts.items() if name not in md.columns})


def for_date(md: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """Rows of the days first..last (by the date column, so partitions are pruned)."""
    last = last or first
    return md.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def filter_endpoint_tags(eg: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Topology rows whose tags do not contradict the wanted ones; Y and N stand for 1 and 0."""
    return eg.where(tags_pass(F.col("tags"), wanted, answers=True))


def filter_group_tags(gg: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Group rows whose tags do not contradict the wanted ones."""
    return gg.where(tags_pass(F.col("tags"), wanted, answers=False))


def exclude_monitoring(md: DataFrame, exclusions: DataFrame, report: str | None = None) -> DataFrame:
    """Drop rows a monitoring host produced inside an excluded period, both ends included.

    ``exclusions`` has monitoring_host, start_ts, end_ts (TIMESTAMP_NTZ).
    """
    if report is not None:
        exclusions = exclusions.where(F.col("report") == report)
    # the day is part of the key, so that a host's whole history is not one key
    days = clock.day_range(F.to_date("start_ts"), F.to_date("end_ts"))
    spans = exclusions.where("start_ts <= end_ts").select(
        F.col("monitoring_host").alias("_x_host"), "start_ts", "end_ts", F.explode(days).alias("_x_day"))
    spans = merged(spans.select("_x_host", "_x_day", "end_ts", F.greatest(
        "start_ts", F.col("_x_day").cast("timestamp_ntz")).alias("start_ts")), ["_x_host", "_x_day"], "start_ts", "end_ts")
    until = F.when(F.to_date("end_ts") > F.col("_x_day"), clock.DAY_SECONDS).otherwise(clock.second_of(F.col("end_ts")))
    exclusions = in_cells(spans, clock.second_of(F.col("start_ts")), until)
    ts = clock.parse_ts(md.timestamp)
    hit = ((md.monitoring_host == exclusions["_x_host"]) & (F.to_date(ts) == exclusions["_x_day"])
           & (cell_at(clock.second_of(ts)) == exclusions[X_CELL])
           & (ts >= exclusions.start_ts) & (ts <= exclusions.end_ts))
    return md.join(exclusions, hit, "left_anti")


def merged(spans: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Spans (both ends included) of each key as the fewest that hold the same points: keys, start, end.

    Spans that begin at one point are one before the shuffle; those left are read in order. However
    many requests exclude the same hours, a row then meets one span.
    """
    one = spans.where(F.col(start) <= F.col(end)).groupBy(*keys, start).agg(F.max(end).alias(end))
    ordered = Window.partitionBy(*keys).orderBy(start)
    reached = F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    fresh = one.withColumn("_fresh", F.coalesce(F.col(start) > reached, F.lit(True)).cast("int"))
    islands = fresh.withColumn("_island", F.sum("_fresh").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return (islands.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end))
            .drop("_island"))


def cell_at(second: Column) -> Column:
    """The cell of the day a second lies in, a key for joins with spans of seconds."""
    return F.floor(second / X_SECONDS).cast("int")


def in_cells(spans: DataFrame, start: Column, end: Column) -> DataFrame:
    """A span for each cell of the day it touches; a cell has at most half as many merged spans as seconds."""
    last = F.least(cell_at(end), F.lit(clock.DAY_SECONDS // X_SECONDS - 1))
    return spans.withColumn(X_CELL, F.explode(F.sequence(cell_at(start), last)))


def semi_availability(md: DataFrame, profile: DataFrame) -> DataFrame:
    """Rows whose service is in the availability profile."""
    return md.join(profile.select("service"), "service", "left_semi")


def semi_metric_profile(md: DataFrame, mp: DataFrame) -> DataFrame:
    """Rows whose (service, metric) is in the metric profile."""
    return md.join(mp.select("service", "metric"), ["service", "metric"], "left_semi")


def semi_topology(md: DataFrame, eg: DataFrame) -> DataFrame:
    """Rows whose endpoint is in the topology."""
    return md.join(eg.select(*ENDPOINT), ENDPOINT, "left_semi")


def endpoints_in_groups(eg: DataFrame, gg: DataFrame, group_type: str) -> DataFrame:
    """Topology rows of the wanted type whose group is a subgroup of any group; of tables that both
    have a snapshot date, on the same date."""
    by = [c for c in ("date",) if c in eg.columns and c in gg.columns]
    return (eg.where(F.col("type") == group_type)
            .join(gg.select(F.col("subgroup").alias("group"), *by), ["group", *by], "left_semi"))


def pick_endpoints(md: DataFrame, eg: DataFrame, gg: DataFrame, mp: DataFrame, profile: DataFrame,
                   group_type: str, exclusions: DataFrame | None = None,
                   egroup_tags: dict[str, str] | None = None,
                   ggroup_tags: dict[str, str] | None = None, strict: bool = True) -> DataFrame:
    """Rows that count for a report.

    Small profile tests come first; the topology test is one semi-join. ``strict`` off skips the
    profile tests and the monitoring-host exclusion.
    """
    if strict:
        md = semi_availability(md, profile)
        md = semi_metric_profile(md, mp)
        if exclusions is not None:
            md = exclude_monitoring(md, exclusions)
    scoped = filter_endpoint_tags(eg, egroup_tags or {})
    places = endpoints_in_groups(scoped, filter_group_tags(gg, ggroup_tags or {}), group_type)
    return semi_topology(md, places)


def latest_state(md: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The latest row of each metric and day.

    A maximum over one struct, so rows are combined before the shuffle and a hot metric costs no
    more than a quiet one. Equal times are decided by the struct's later fields.
    """
    keys = keys or METRIC
    rest = [c for c in md.columns if c not in (*keys, "date", "timestamp")]
    latest = F.max(F.struct("timestamp", *rest)).alias("latest")
    return md.groupBy("date", *keys).agg(latest).select("date", *keys, "latest.*")


def with_carry_in(today: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows of the day with the latest row of the day before."""
    return today.unionByName(latest)


def expected_metrics(eg: DataFrame, mp: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(service, hostname, metric) the topology and the profile call for."""
    keys = keys or []
    endpoints = eg.select(*keys, *ENDPOINT).distinct()
    checks = mp.select("service", "metric").distinct()
    return endpoints.join(checks, "service").select(*keys, *METRIC)


def missing_items(expected: DataFrame, observed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Expected metrics nobody reported."""
    keys = [*(keys or []), *METRIC]
    return expected.join(observed.select(*keys), keys, "left_anti").select(*keys)


def missing_rows(items: DataFrame, report: str) -> DataFrame:
    """A midnight MISSING row for each item; items carry the date."""
    return items.select(
        F.lit(report).alias("report"), F.lit(MISSING_HOST).alias("monitoring_host"), *METRIC,
        clock.midnight(F.col("date")).alias("timestamp"), F.lit("MISSING").alias("status"),
        F.lit(MISSING_TEXT).alias("summary"), F.lit(MISSING_TEXT).alias("message"))


def with_missing(md: DataFrame, missing: DataFrame) -> DataFrame:
    """Union of observed and generated rows, on the columns of the observed ones."""
    return md.unionByName(missing.select(*md.columns))


def dedupe_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def alias_services(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """Every row, and a copy under the alias for services that have one.

    ``aliases`` has service and alias.
    """
    copies = (df.join(aliases, "service")
              .withColumn("service", F.col("alias")).select(*df.columns))
    return df.unionByName(copies)


def flatten(df: DataFrame, bag: str) -> DataFrame:
    """One row per element of an array column; rows with an empty one are dropped."""
    return df.withColumn(bag, F.explode(bag))


def flatten2(df: DataFrame, first: str, second: str) -> DataFrame:
    """One row per pair of elements of two array columns of the same row."""
    return flatten(flatten(df, first), second)
