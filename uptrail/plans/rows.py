"""From metric data to states per report, day and position.

Raw rows reach one aggregate, before anything multiplies them: the latest state of each metric, day and
position (a slot, or a second of the day), as an integer. Where monitoring hosts can be excluded, the
host is part of its key, and so is the cell of the day between two borders of exclusions, inside
which a host is excluded or not as a whole. What is left is then placed on its own day and, as
carry-in, on the next, for each report; exclusions are taken out, and hosts are put together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from uptrail.config import Options
from uptrail.functions import clock
from uptrail.functions.truth import Operations
from uptrail.operators import selection, slots
from uptrail.operators.changes import DETAIL
from uptrail.operators.selection import ENDPOINT, METRIC
from uptrail.plans.dimensions import SCOPE, Dimensions

PLACE = [*SCOPE, *ENDPOINT]
KEY = [*SCOPE, *METRIC]
ROW = ["date", *METRIC, "pos"]
HOST = "monitoring_host"


def counted(dims: Dimensions) -> DataFrame:
    """(report, service, metric) in a report's metric profile, of services in its availability profile."""
    return dims.checks.join(dims.mapping.select("report", "service"), ["report", "service"],
                            "left_semi").select("report", "service", "metric").distinct()


def usable(md: DataFrame, dims: Dimensions, operations: Operations) -> DataFrame:
    """Rows of the run's days and the day before with a readable time; with ``code``."""
    md = selection.for_date(selection.with_time(md), clock.shift(dims.first, -1), dims.last)
    return md.where("second IS NOT NULL").withColumn("code", operations.state_code(F.col("status")))


def excludes(dims: Dimensions, options: Options) -> bool:
    return options.strict and dims.monitor_exclusions is not None


def reduced(rows: DataFrame, dims: Dimensions, operations: Operations, options: Options,
            discrete: bool) -> DataFrame:
    """The latest state per metric, day and position [, host and cell]: ROW..., packed.

    All columns of the aggregate have a fixed width or are keys, so it is a hash aggregate that
    combines rows before the shuffle.
    """
    pos = clock.ts_slot(F.col("second"), options.interval, options.slots) if discrete else F.col("second")
    keys = [*ROW]
    if excludes(dims, options):
        keys.append(HOST)
        if discrete:
            rows = rows.withColumn("cell", cell_of(F.col("second"), dims))
            keys.append("cell")
    packed = slots.pack(F.col("second"), F.col("code"), operations)
    return rows.withColumn("pos", pos).groupBy(*keys).agg(F.max(packed).alias("packed"))


def cell_of(second: Column, dims: Dimensions) -> Column:
    """Number of the cell of the day that a second lies in.

    The borders are the seconds of the day at which some exclusion starts or has just ended: 86 401
    values at most, whatever the number of exclusions.
    """
    spans = excluded_spans(dims)
    borders = spans.select(F.explode(F.array("x_from", F.col("x_to") + 1)).alias("at")).distinct()
    known = sorted(row["at"] for row in borders.where(F.col("at").between(1, clock.DAY_SECONDS - 1)).collect())
    cells = np.searchsorted(known, np.arange(clock.DAY_SECONDS), side="right")
    return F.get(F.from_json(F.lit(str(cells.tolist())), "array<int>"), second)


def excluded_spans(dims: Dimensions) -> DataFrame:
    """Exclusions per report, host and day: seconds from and to (both excluded with what lies between)."""
    low, high = F.lit(clock.shift(dims.first, -1)).cast("date"), F.lit(dims.last).cast("date")
    days = clock.day_range(F.greatest(F.to_date("start_ts"), low), F.least(F.to_date("end_ts"), high))
    return dims.monitor_exclusions.withColumn("x_date", F.explode(days)).select(
        F.col("report").alias("x_report"), F.col("monitoring_host").alias("x_host"), "x_date",
        F.when(F.to_date("start_ts") < F.col("x_date"), 0)
         .otherwise(clock.second_of(F.col("start_ts"))).alias("x_from"),
        F.when(F.to_date("end_ts") > F.col("x_date"), clock.DAY_SECONDS)
         .otherwise(clock.second_of(F.col("end_ts"))).alias("x_to"), "from_date", "to_date")


def excluded_cells(dims: Dimensions) -> DataFrame:
    """Exclusions per report, host, day of a row and day ``x_on`` it is placed on (its own or the next),
    merged, for each cell of the day."""
    keys = ["x_report", "x_host", "x_date", "x_on"]
    on = F.explode(F.array(F.col("x_date"), F.date_add("x_date", 1)))
    spans = excluded_spans(dims).withColumn("x_on", on).where(F.col("x_on").between(F.col("from_date"), F.col("to_date")))
    one = selection.merged(spans, keys, "x_from", "x_to")
    return selection.in_cells(one, F.col("x_from"), F.col("x_to"))


def for_reports(rows: DataFrame, dims: Dimensions, operations: Operations, options: Options,
                discrete: bool, second: Column | None = None) -> DataFrame:
    """Reduced rows on the days and for the reports they matter for, exclusions taken out.

    Where all days have the same selected endpoints, rows of others are gone.
    ``second`` is the second of a row's day, by default that of its packed state.
    """
    second = slots.second_of(F.col("packed"), operations) if second is None else second
    rows = rows.withColumn("second", second)
    if options.strict:
        rows = rows.join(counted(dims), ["service", "metric"])
    else:
        rows = rows.withColumn("report", F.explode(F.array(*[F.lit(r.config.id) for r in dims.reports])))
    if dims.chosen is not None:  # before days multiply the rows
        rows = rows.join(dims.chosen, ["report", *ENDPOINT], "left_semi")
    placed = slots.on_days(rows, options, dims.first, dims.last, discrete, seeds=discrete and not options.strict)
    if excludes(dims, options):
        x = excluded_cells(dims)
        hit = ((F.col("report") == F.col("x_report")) & (F.col(HOST) == F.col("x_host"))
               & (F.col("row_date") == F.col("x_date")) & (F.col("date") == F.col("x_on"))
               & (selection.cell_at(F.col("second")) == F.col(selection.X_CELL))
               & F.col("second").between(F.col("x_from"), F.col("x_to")))
        placed = placed.join(x, hit, "left_anti")
    return placed


@dataclass(frozen=True)
class Reduced:
    """Rows that are reduced already, as a stored state is: ROW..., packed. They say nothing of
    monitoring hosts."""

    rows: DataFrame


def states(md: DataFrame | Reduced, dims: Dimensions, operations: Operations, options: Options,
           discrete: bool) -> DataFrame:
    """Packed states per report, day, metric and position, of selected endpoints: KEY..., pos, packed.

    Not yet one per key: hosts, and the positions of a day before, are still apart.
    """
    if isinstance(md, Reduced):
        if excludes(dims, options):
            raise ValueError("excluded monitoring hosts need the rows themselves")
        rows = selection.for_date(md.rows, clock.shift(dims.first, -1), dims.last)
    else:
        rows = reduced(usable(md, dims, operations), dims, operations, options, discrete)
    placed = for_reports(rows, dims, operations, options, discrete)
    if discrete:
        placed = placed.withColumn("packed", slots.without_effect(operations))
    return in_selected(placed.select(*KEY, "pos", "packed"), dims, options)


def detailed(md: DataFrame, dims: Dimensions, operations: Operations, options: Options) -> DataFrame:
    """``states`` per second with all columns of a row: KEY..., pos, second, code, DETAIL.

    Of the rows of one second the highest state counts, then host and texts; hosts are still apart.
    """
    keys = [*ROW, *([HOST] if excludes(dims, options) else [])]
    texts = [c for c in DETAIL if c not in keys]
    rows = usable(md, dims, operations).withColumn("pos", F.col("second"))
    rows = rows.groupBy(*keys).agg(F.max(F.struct("code", *texts)).alias("_row")).select(*keys, "_row.*")
    placed = for_reports(rows, dims, operations, options, False, F.col("pos"))
    return in_selected(placed.select(*KEY, "pos", "second", "code", *DETAIL), dims, options)


def unreadable_rows(md: DataFrame) -> DataFrame:
    """Rows whose timestamp cannot be read, for diagnosis; ``usable`` leaves them out."""
    return selection.with_time(md).where("second IS NULL").select(*md.columns)


def in_selected(df: DataFrame, dims: Dimensions, options: Options) -> DataFrame:
    """Rows of ``for_reports`` of selected endpoints, and of metrics in that day's profile."""
    if dims.chosen is None:
        df = df.join(dims.selected, PLACE, "left_semi")
    if options.strict and any("date" in r.metric_profiles.columns for r in dims.reports):
        df = df.join(dims.checks, ["report", "date", "service", "metric"], "left_semi")
    return df


def expected(dims: Dimensions, options: Options) -> DataFrame:
    """Metrics that should report, per report and day."""
    endpoints = dims.selected if options.scope == "selected" else dims.endpoints
    return endpoints.join(dims.checks, ["report", "date", "service"]).select(*KEY)
