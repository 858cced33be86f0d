"""Availability and reliability: metric data to service and group rates.

Shuffles of the whole plan, with what bounds one key in each:

1. metric x slot     raw rows, combined map-side to one integer per metric, day and slot (and monitoring
                     host and cell, where hosts can be excluded)
2. endpoint          reduced rows per report and day, with expected metrics and downtimes
3. service x slot    endpoint changes, combined map-side to counts per state
4. group             at most 288 rows per service of the group

Days and reports are key columns, so a range of days or several reports is one plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptrail.config import Options, ReportInputs
from uptrail.functions.truth import Operations
from uptrail.operators import integrate, results, slots
from uptrail.operators.fold import fold, moves, period_moves, spread
from uptrail.plans import dimensions, rows
from uptrail.plans.dimensions import SCOPE, Dimensions
from uptrail.plans.rows import KEY, PLACE

GROUP = [*SCOPE, "group"]
SERVICE = [*GROUP, "service"]


@dataclass(frozen=True)
class AvailabilityPlan:
    """Timelines (keys, pos, code, prev) on the three levels, and what is derived from them."""

    dims: Dimensions
    operations: Operations
    options: Options
    endpoints: DataFrame
    services: DataFrame
    groups: DataFrame

    def service_rates(self) -> DataFrame:
        return integrate.integrate(self.services, SERVICE, self.operations, self.options.slots)

    def group_rates(self) -> DataFrame:
        return integrate.integrate(self.groups, GROUP, self.operations, self.options.slots)

    def service_ar(self) -> DataFrame:
        return results.map_service(self.service_rates())

    def group_ar(self) -> DataFrame:
        return results.map_group(self.group_rates(), self.dims.supergroups(), self.dims.weights())

    def hourly_endpoint_ar(self) -> DataFrame:
        return integrate.hourly(self.endpoints, PLACE, self.operations, self.options.slots,
                                self.options.interval)


def availability(spark: SparkSession, md: DataFrame, reports: list[ReportInputs],
                 operations: Operations, first: str, last: str | None = None,
                 options: Options = Options()) -> AvailabilityPlan:
    """The plan for all reports and the days first..last. ``md`` has a date column."""
    return plan_of(md, dimensions.build(spark, reports, first, last or first, options), operations, options)


def plan_of(md: DataFrame | rows.Reduced, dims: Dimensions, operations: Operations, options: Options) -> AvailabilityPlan:
    """The plan over given dimensions, from raw rows or from a stored state."""
    endpoints = endpoint_timelines(md, dims, operations, options)
    services = service_timelines(endpoints, dims, operations)
    groups = group_timelines(services, dims, operations, options)
    return AvailabilityPlan(dims, operations, options, endpoints, services, groups)


def metric_changes(md: DataFrame, dims: Dimensions, operations: Operations,
                   options: Options) -> DataFrame:
    """Settled changes of every observed or expected metric, and downtime covers.

    Expected metrics come in as seed rows, so absent ones need no join to be found: a metric whose
    only row is the seed is MISSING all day.
    """
    states = rows.states(md, dims, operations, options, discrete=True)
    missing = slots.pack(F.lit(0), F.lit(operations.missing_code), operations)
    seeds = rows.expected(dims, options).select(*KEY, F.lit(slots.SEED).alias("pos"), missing.alias("packed"))
    everything = states.unionByName(seeds).withColumn("cover", F.lit(0))
    covers = downtime_covers(dims, options)
    if covers is not None:
        everything = everything.unionByName(covers)
    one = spread(everything, PLACE).groupBy(*KEY, "pos").agg(
        F.max("packed").alias("packed"), F.sum("cover").cast("int").alias("cover"))
    return slots.settle(one, KEY, operations, options)


def downtime_covers(dims: Dimensions, options: Options) -> DataFrame | None:
    if dims.downtimes is None:
        return None
    steps = period_moves(dims.downtimes, PLACE, options.slots)
    return steps.select(*PLACE, F.lit(None).cast("string").alias("metric"), "pos",
                        F.lit(None).cast("int").alias("packed"), "cover")


def endpoint_timelines(md: DataFrame, dims: Dimensions, operations: Operations,
                       options: Options) -> DataFrame:
    """Metrics folded per endpoint, DOWNTIME laid over."""
    op = dims.per_report(lambda r: operations.op_number(r.profile.metric_op))
    changes = metric_changes(md, dims, operations, options).select(
        *PLACE, F.col("metric").alias("member"), op.alias("op"), "pos", "new", "old", "cover")
    ops = {r.profile.metric_op for r in dims.reports}
    cover_code = operations.down_code if dims.downtimes is not None else None
    return fold(changes, PLACE, operations, ops, cover_code=cover_code, few=True)


def service_timelines(endpoints: DataFrame, dims: Dimensions, operations: Operations) -> DataFrame:
    """Hosts folded per group and service; a host counts in each group it belongs to."""
    in_group = endpoints.join(dims.places, PLACE)
    with_op = in_group.join(dims.mapping.select("report", "service", "svc_op"),
                            ["report", "service"])
    ops = {op for r in dims.reports for _, svcs in r.profile.groups.values() for op in svcs.values()}
    return fold(moves(with_op, SERVICE, "hostname", operations.op_code(F.col("svc_op"))), SERVICE, operations, ops,
                place=GROUP)


def group_timelines(services: DataFrame, dims: Dimensions, operations: Operations,
                    options: Options | None = None) -> DataFrame:
    """Services folded per availability group, then these per group, exclusions laid over.

    ``options`` None means no exclusions (the status path).
    """
    ag = [*GROUP, "ag_group"]
    with_op = services.join(dims.mapping.select("report", "service", "ag_group", "group_op"),
                            ["report", "service"])
    ops = {op for r in dims.reports for op, _ in r.profile.groups.values()}
    parts = fold(moves(with_op, ag, "service", operations.op_code(F.col("group_op"))), ag,
                 operations, ops, place=GROUP, few=True)
    total = dims.per_report(lambda r: operations.op_number(r.profile.total_op))
    parts = moves(parts, GROUP, "ag_group", total)
    total_ops = {r.profile.total_op for r in dims.reports}
    if options is None or dims.group_exclusions is None:
        return fold(parts, GROUP, operations, total_ops, few=True)
    covers = period_moves(exclusion_slots(dims, options), GROUP, options.slots)
    parts = parts.withColumn("cover", F.lit(0)).unionByName(covers)
    return fold(parts, GROUP, operations, total_ops, cover_code=operations.unknown_code, few=True)


def exclusion_slots(dims: Dimensions, options: Options) -> DataFrame:
    """Excluded slots per report, day and group."""
    spans = slots.day_spans(dims.group_exclusions, dims.first, dims.last, options)
    return spans.select(*GROUP, "pos_from", "pos_to")
