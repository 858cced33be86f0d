"""A job from the documents and tables of a folder.

    operations.json              states and truth tables
    profiles/<report>.json       availability profile
    reports/<report>.json        report configuration
    recomputations/              requests, JSON arrays
    tables/<name>/report=/date=  dimension tables, as they are ingested

A document that contradicts itself is an error, with the cells that are wrong.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptrail import config
from uptrail.config import ReportInputs
from uptrail.functions.truth import Operations
from uptrail.operators import requests as rq
from uptrail.sources import tables

OPERATIONS_SCHEMA = ("states array<string>, default_down string, default_missing string, default_unknown string, "
                     "operations map<string, array<struct<A string, B string, X string>>>")


class BadDocument(ValueError):
    """A document that contradicts itself or leaves something open."""


def truth_cells(document: DataFrame, mirror: bool = True) -> DataFrame:
    """(op, a, b, x): the cells of a truth table document; with ``mirror`` A,B holds for B,A as well."""
    cells = document.select(F.explode("operations").alias("op", "cells")).select("op", F.inline("cells"))
    cells = cells.toDF("op", "a", "b", "x")
    if mirror:
        cells = cells.unionByName(cells.select("op", F.col("b").alias("a"), F.col("a").alias("b"), "x"))
    return cells.distinct()


def truth_problems(document: DataFrame, mirror: bool = True, complete: bool = True) -> DataFrame:
    """(problem, op, a, b): unknown states, cells with two results and, with ``complete``, cells without any.

    The product of the states with themselves is made in the document's one row.
    """
    cells = truth_cells(document, mirror)
    states = document.select(F.explode("states").alias("state"))
    used = reduce(DataFrame.unionByName, [cells.select("op", "a", "b", F.col(c).alias("state")) for c in ("a", "b", "x")])
    found = [used.join(states, "state", "left_anti").select(F.lit("unknown state").alias("problem"), "op", "a", "b").distinct(),
             cells.groupBy("op", "a", "b").agg(F.count("*").alias("n")).where("n > 1").select(
                 F.lit("two results").alias("problem"), "op", "a", "b")]
    if complete:
        every = (document.select(F.explode(F.map_keys("operations")).alias("op"), "states")
                 .select("op", "states", F.explode("states").alias("a")).select("op", "a", F.explode("states").alias("b")))
        found.append(every.join(cells, ["op", "a", "b"], "left_anti").select(F.lit("no result").alias("problem"), "op", "a", "b"))
    return reduce(DataFrame.unionByName, found)


def read_operations(spark: SparkSession, path: str, mirror: bool = True, complete: bool = True) -> Operations:
    """The state algebra of a document, after the checks of ``truth_problems``."""
    document = spark.read.schema(OPERATIONS_SCHEMA).json(path, multiLine=True)
    problems = [tuple(row) for row in truth_problems(document, mirror, complete).limit(10).collect()]
    if problems:
        raise BadDocument(f"{path}: {problems}")
    return config.read_ops(spark, path, mirror)


def report_inputs(spark: SparkSession, root: str, report: str, operations: Operations,
                  format: str = "parquet") -> ReportInputs:
    """A report with its tables; the profile's operations and services must exist."""
    settings = config.read_report_config(spark, f"{root}/reports/{report}.json")
    profile = config.read_availability_profile(spark, f"{root}/profiles/{report}.json")
    if settings.id != report:
        raise BadDocument(f"reports/{report}.json is about {settings.id}")
    if unknown := sorted(profile.ops() - set(operations.tables)):
        raise BadDocument(f"profiles/{report}.json uses operations that are not defined: {unknown}")

    def table(read, name: str) -> DataFrame:
        return read(spark, f"{root}/tables/{name}", format, ("report", "date"))

    requests = tables.read_recomputations(spark, f"{root}/recomputations")
    return ReportInputs(
        settings, profile, table(tables.read_metric_profiles, "metric_profiles"),
        table(tables.read_endpoint_groups, "endpoint_groups"), table(tables.read_group_groups, "group_groups"),
        table(tables.read_weights, "weights"), table(tables.read_downtimes, "downtimes"),
        rq.group_exclusions(requests), rq.monitor_exclusions(requests))
