"""Results that follow the day as its rows come in.

A state is kept: the latest code of each metric, day and slot. A micro-batch is reduced to the same
form and laid over it. Where that moves a state, the groups of the endpoint are touched; only they are
folded again, from the state and not from raw rows, and only their stored results are replaced.

Results and state are replaced by partition, from rows that are written first, and the state goes last: a
batch that fails on the way finds the old state when it is run again, and moves the same groups.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptrail.config import Options, ReportInputs
from uptrail.functions import clock
from uptrail.functions.truth import Operations
from uptrail.operators import selection, slots
from uptrail.operators.selection import ENDPOINT
from uptrail.plans import availability as ar, dimensions, jobs, rows
from uptrail.plans.dimensions import SCOPE, Dimensions
from uptrail.sinks import store

STATE_SCHEMA = "service string, hostname string, metric string, pos int, packed int, date date"
RESULTS = {"service_ar": "supergroup", "endpoint_group_ar": "name"}  # and the column with the group


def stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A table below the shared folder, None where nothing has been written yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table of their own: what is replaced next can then no longer change them."""
    path = jobs.scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apply_batch(spark: SparkSession, batch: DataFrame, reports: list[ReportInputs], operations: Operations,
                root: str, first: str, last: str | None = None, options: Options = Options()) -> int:
    """Lay a batch of probe results over the state of the days first..last and bring their results up
    to date; returns how many (report, day, group) were folded again.

    The day before ``first`` only serves as carry-in. Rows of other days are left out. A day without
    results gets those of all its groups. Reports with excluded monitoring hosts are an error: their
    days are run from raw rows.
    """
    last = last or first
    dims = dimensions.build(spark, reports, first, last, options)
    if rows.excludes(dims, options):
        raise ValueError("excluded monitoring hosts need the rows themselves")
    fresh = written(slots.latest(rows.usable(batch, dims, operations), ["date", *selection.METRIC], operations, options), "refresh-fresh")
    known = stored(spark, f"{root}/state", STATE_SCHEMA)
    moved = state = fresh
    if known is not None:
        before = known.join(fresh.select("date").distinct(), "date", "left_semi")
        same = before.select("date", *selection.METRIC, "pos", F.col("packed").alias("_was"))
        moved = fresh.join(same, ["date", *selection.METRIC, "pos"], "left").where("_was IS NULL OR packed > _was").drop("_was")
        fresh = written(before.select(*fresh.columns).unionByName(fresh).repartition("date", *ENDPOINT)
                        .groupBy("date", *selection.METRIC, "pos").agg(F.max("packed").alias("packed")), "refresh-state")
        others = known.join(fresh.select("date").distinct(), "date", "left_anti").select(*fresh.columns)
        state = fresh.unionByName(others)
    touched = written(touched_groups(moved, dims, root), "refresh-touched")
    count = touched.count()
    if count:
        replace_results(spark, state, restricted(dims, touched), touched, operations, root, options)
    store.overwrite_partitions(fresh, f"{root}/state", ["date"])
    return count


def touched_groups(moved: DataFrame, dims: Dimensions, root: str) -> DataFrame:
    """(report, date, group) whose endpoints have moved on the day or the day before, and all of days
    without results."""
    days = F.explode(F.array(F.col("date"), F.date_add("date", 1)))
    endpoints = moved.select(*ENDPOINT, days.alias("date")).distinct()
    groups = dims.places.join(endpoints, ["date", *ENDPOINT], "left_semi").select(*SCOPE, "group")
    results = stored(dims.places.sparkSession, f"{root}/endpoint_group_ar")
    missing = dims.places.select(*SCOPE, "group")
    if results is not None:
        there = store.read_results(dims.places.sparkSession, root, "endpoint_group_ar").select("report", F.col("date").alias("_day")).distinct()
        missing = missing.join(there, (missing["report"] == there["report"]) & (clock.date_int(missing["date"]) == there["_day"]), "left_anti")
    return groups.unionByName(missing).distinct()


def restricted(dims: Dimensions, touched: DataFrame) -> Dimensions:
    """The dimensions with the endpoints of these groups only."""
    places = dims.places.join(touched, [*SCOPE, "group"], "left_semi")
    by = [*SCOPE, *ENDPOINT]
    return replace(dims, places=places, endpoints=dims.endpoints.join(places, by, "left_semi"),
                   selected=dims.selected.join(places, by, "left_semi"), chosen=None)


def replace_results(spark: SparkSession, state: DataFrame, dims: Dimensions, touched: DataFrame, operations: Operations, root: str,
                    options: Options) -> None:
    plan = ar.plan_of(rows.Reduced(state), dims, operations, options)
    services = written(plan.services, "refresh-services")
    groups = ar.group_timelines(services, dims, operations, options)
    plan = ar.AvailabilityPlan(dims, operations, options, plan.endpoints, services, groups)
    gone = touched.select("report", clock.date_int(F.col("date")).alias("date"), "group")
    for table, result in (("service_ar", plan.service_ar()), ("endpoint_group_ar", plan.group_ar())):
        mine = gone.withColumnRenamed("group", RESULTS[table])
        result = result.join(mine, ["report", "date", RESULTS[table]], "left_semi")
        if stored(spark, f"{root}/{table}") is not None:
            others = store.read_results(spark, root, table).join(mine.select("report", "date").distinct(), ["report", "date"], "left_semi")
            others = others.join(mine, ["report", "date", RESULTS[table]], "left_anti")
            result = result.unionByName(others.select(*result.columns))
        store.upsert(written(result, f"refresh-{table}"), root, table)


def on_batch(reports: list[ReportInputs], operations: Operations, root: str, first: str, last: str | None = None,
             options: Options = Options()) -> Callable[[DataFrame, int], None]:
    """``apply_batch`` as the function of a stream's ``foreachBatch``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch.sparkSession, batch, reports, operations, root, first, last, options)
    return run
