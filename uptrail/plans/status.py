"""Status changes: metric data to change lists of metrics, endpoints, services and groups.

Downtimes and group exclusions play no part here; only the monitoring-host exclusion does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from uptrail.config import Options, ReportInputs
from uptrail.functions.truth import Operations
from uptrail.operators import changes, results, selection, slots
from uptrail.operators.fold import fold, moves, spread
from uptrail.operators.slots import CARRY, SEED
from uptrail.plans import availability as ar, dimensions, rows
from uptrail.plans.availability import GROUP, SERVICE
from uptrail.plans.dimensions import Dimensions
from uptrail.plans.rows import KEY, PLACE


@dataclass(frozen=True)
class StatusPlan:
    """Annotated metric rows with texts, the same without, and the timelines folded from the latter."""

    dims: Dimensions
    operations: Operations
    metrics: DataFrame
    events: DataFrame
    endpoints: DataFrame
    services: DataFrame
    groups: DataFrame

    def status_metrics(self) -> DataFrame:
        day = self.metrics.where("emitted").join(self.dims.places, PLACE)
        fields = changes.status_fields(day)
        return day.select("report", F.col("group").alias("endpoint_group"), "service",
                          F.col("hostname").alias("host"), "metric", *fields)

    def status_endpoints(self) -> DataFrame:
        return results.map_changes(
            self.endpoints.join(self.dims.places, PLACE),
            {"group": "endpoint_group", "service": "service", "hostname": "host"}, self.operations)

    def status_services(self) -> DataFrame:
        return results.map_changes(
            self.services, {"group": "endpoint_group", "service": "service"}, self.operations)

    def status_groups(self) -> DataFrame:
        return results.map_changes(self.groups, {"group": "endpoint_group"}, self.operations)


def status(spark: SparkSession, md: DataFrame, reports: list[ReportInputs],
           operations: Operations, first: str, last: str | None = None,
           options: Options = Options()) -> StatusPlan:
    """The plan for all reports and the days first..last. ``md`` has a date column."""
    dims = dimensions.build(spark, reports, first, last or first, options)
    metrics = metric_events(md, dims, operations, options, texts=True)
    events = metric_events(md, dims, operations, options)
    endpoints = endpoint_timelines(events, dims, operations, options)
    services = ar.service_timelines(endpoints, dims, operations)
    groups = ar.group_timelines(services, dims, operations)
    return StatusPlan(dims, operations, metrics, events, endpoints, services, groups)


def metric_events(md: DataFrame, dims: Dimensions, operations: Operations,
                  options: Options, texts: bool = False) -> DataFrame:
    """Rows per metric with the state before, and with ``texts`` its name and all columns of the row.

    ``emitted`` marks rows of the day, and the row made for a metric nobody reported. Carry-in rows
    stay, unmarked, because their metric is then known to be expected. Timelines are folded from
    rows without texts: integers that are combined before every shuffle.
    """
    seeds = rows.expected(dims, options).select(*KEY, F.lit(SEED).alias("pos"))
    if texts:
        text = F.lit(selection.MISSING_TEXT)
        seeds = seeds.withColumns({
            "second": F.lit(0), "code": F.lit(operations.missing_code), "status": F.lit(operations.missing),
            "monitoring_host": F.lit(selection.MISSING_HOST), "summary": text, "message": text})
        placed = spread(rows.detailed(md, dims, operations, options).unionByName(seeds), PLACE)
        latest = F.max(F.struct("second", "code", *changes.DETAIL)).alias("_row")
        events = placed.groupBy(*KEY, "pos").agg(latest).select(*KEY, "pos", "_row.*")
    else:
        missing = slots.pack(F.lit(0), F.lit(operations.missing_code), operations)
        states = rows.states(md, dims, operations, options, discrete=False)
        placed = spread(states.unionByName(seeds.withColumn("packed", missing)), PLACE)
        events = changes.with_state(placed.groupBy(*KEY, "pos").agg(F.max("packed").alias("packed")), operations)
    known = changes.with_previous(events, KEY, operations.missing)
    return known.withColumn("emitted", (F.col("pos") > CARRY) | F.col("alone"))


def endpoint_timelines(metrics: DataFrame, dims: Dimensions, operations: Operations,
                       options: Options) -> DataFrame:
    """Metrics folded per endpoint, for endpoints with at least one row on the day.

    A profile metric with a carry-in but no row on the day counts as MISSING from midnight.
    """
    endpoint = Window.partitionBy(*PLACE)
    w = Window.partitionBy(*KEY)
    usable = metrics.withColumns({
        "reports": F.max("emitted").over(endpoint),
        "silent": ~F.max("emitted").over(w) & (F.col("pos") == SEED)})
    usable = usable.where(F.col("reports") & (F.col("emitted") | F.col("silent")))
    timeline = changes.anchored(
        usable.withColumn("first", F.col("first") | F.col("silent")), KEY, operations,
        options.anchor)
    op = dims.per_report(lambda r: operations.op_number(r.profile.metric_op))
    ops = {r.profile.metric_op for r in dims.reports}
    return fold(moves(timeline, PLACE, "metric", op), PLACE, operations, ops, few=True)


__all__ = ["GROUP", "SERVICE", "StatusPlan", "status"]
