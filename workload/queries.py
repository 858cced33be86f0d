"""Registered queries: name -> (DataFrame query, SQL counterpart or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptrail.plans import availability as ar, status as st
from workload import oracle as o
from workload.tables import OPERATIONS, OPTIONS, Tables

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


# Queries whose days go out as text, so that both sides hand over the same plain value.
DAY_COLUMNS = {name: ("date",) for name in """
    endpoint_timeline service_timeline group_timeline metric_timeline metric_timeline_exact settle
    to_slots metric_ar host_fold overlay state_shares hourly_ar fold_states fold_changes
    fold_changes_ordered align_changes compact_changes previous_state anchor_midnight
    legacy_host_timetable legacy_flavour_ar legacy_site_ar legacy_vo_ar legacy_timeline_percent
    legacy_host_vos seed_members_selected seed_members date_range snapshots_per_day latest_state
    with_carry_in missing_items with_downtimes with_downtimes_all with_recomputations
    period_moves_of_downtimes apply_op apply_op_by_table asof_state metric_data_scan
    ingest_landing""".split()}
DAY_COLUMNS |= {"timestamp_functions": ("ts_date", "previous_day")}


def register(sql: str | None = None):
    def add(fn: Callable[[Tables], DataFrame]):
        days = DAY_COLUMNS.get(fn.__name__, ())

        def run(spark: SparkSession, path: str) -> DataFrame:
            df = fn(Tables.of(spark, path))
            return df.withColumns({c: F.col(c).cast("string") for c in days}) if days else df

        text = sql
        if sql and days:
            casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in days)
            text = f"SELECT * REPLACE ({casts}) FROM ({sql})"
        QUERIES[fn.__name__] = (run, o.query(text) if text else None)
        return fn
    return add


def state(code: str = "code"):
    return OPERATIONS.state_name(F.col(code)).alias("status")


def plan(t: Tables, options=OPTIONS) -> ar.AvailabilityPlan:
    return ar.availability(t.spark, t.metric_data(), t.reports(), OPERATIONS, *t.days, options)


def status_plan(t: Tables, options=OPTIONS) -> st.StatusPlan:
    return st.status(t.spark, t.metric_data(), t.reports(), OPERATIONS, *t.days, options)
