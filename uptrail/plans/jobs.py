"""Jobs: a day for all reports, a range of days, recomputation requests."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptrail.config import Options, ReportInputs
from uptrail.functions.truth import Operations
from uptrail.operators import requests as rq
from uptrail.plans import availability as ar, status as st
from uptrail.sinks import store


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder; a fresh one of its own only for a local session."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared one."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def run_availability(spark: SparkSession, md: DataFrame, reports: list[ReportInputs],
                     operations: Operations, root: str, first: str, last: str | None = None,
                     options: Options = Options()) -> None:
    """Compute and store service and group results.

    The service timelines feed both tables. They are small, so they are checkpointed: computed
    once, and safe when executors are lost.
    """
    plan = ar.availability(spark, md, reports, operations, first, last, options)
    shared_dir(spark)
    services = plan.services.checkpoint()
    groups = ar.group_timelines(services, plan.dims, operations, options)
    plan = ar.AvailabilityPlan(plan.dims, operations, options, plan.endpoints, services, groups)
    store.upsert(plan.service_ar(), root, "service_ar")
    store.upsert(plan.group_ar(), root, "endpoint_group_ar")


def run_status(spark: SparkSession, md: DataFrame, reports: list[ReportInputs],
               operations: Operations, root: str, first: str, last: str | None = None,
               options: Options = Options()) -> None:
    """Compute and store the four status tables. The rows with texts are written as they come; the
    timelines are folded from rows without texts, each level once."""
    plan = st.status(spark, md, reports, operations, first, last, options)
    store.upsert(plan.status_metrics(), root, "status_metrics")
    shared_dir(spark)
    endpoints = plan.endpoints.checkpoint()
    services = ar.service_timelines(endpoints, plan.dims, operations).checkpoint()
    groups = ar.group_timelines(services, plan.dims, operations)
    plan = st.StatusPlan(plan.dims, operations, plan.metrics, plan.events, endpoints, services, groups)
    store.upsert(plan.status_endpoints(), root, "status_endpoints")
    store.upsert(plan.status_services(), root, "status_services")
    store.upsert(plan.status_groups(), root, "status_endpoint_groups")


def run_day(spark: SparkSession, md: DataFrame, reports: list[ReportInputs],
            operations: Operations, root: str, date: str, options: Options = Options()) -> None:
    """Availability and status of all reports for one day."""
    run_availability(spark, md, reports, operations, root, date, None, options)
    run_status(spark, md, reports, operations, root, date, None, options)


def run_range(spark: SparkSession, md: DataFrame, reports: list[ReportInputs],
              operations: Operations, root: str, first: str, last: str,
              options: Options = Options()) -> None:
    """Availability for every day of a range, as one plan with the day as a key."""
    run_availability(spark, md, reports, operations, root, first, last, options)


def recompute(spark: SparkSession, request: dict[str, str], requests: DataFrame, md: DataFrame,
              report: ReportInputs, operations: Operations, root: str,
              options: Options = Options(), status: bool = False) -> tuple[str, str]:
    """Run the days of one request again, with all requests of its report applied.

    Returns the days. Status is left as it is unless asked for.
    """
    first, last = request["start_time"][:10], request["end_time"][:10]
    if last < first:
        raise ValueError(f"request {request['id']} ends before it starts")
    mine = requests.where(F.col("report") == report.config.id)
    report = ReportInputs(
        report.config, report.profile, report.metric_profiles, report.endpoint_groups,
        report.group_groups, report.weights, report.downtimes, rq.group_exclusions(mine),
        rq.monitor_exclusions(mine))
    run_availability(spark, md, [report], operations, root, first, last, options)
    if status:
        run_status(spark, md, [report], operations, root, first, last, options)
    return first, last
