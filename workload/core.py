"""Availability and status jobs over all reports and days."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from uptrail.config import ReportInputs
from uptrail.operators.fold import intervals
from uptrail.plans import availability as ar, status as st
from workload import oracle as o
from workload.queries import OPERATIONS, OPTIONS, plan, register, state, status_plan
from workload.tables import Tables


def spans(timeline: DataFrame, keys: list[str]) -> DataFrame:
    return intervals(timeline, keys, OPTIONS.slots).select(
        *keys, F.col("pos_from").alias("slot_from"), F.col("pos_to").alias("slot_to"), state())


RATES = "availability, reliability, up, down, unknown"


@register(f"""SELECT report, {o.date_int('date')} AS date, service AS name, grp AS supergroup, {RATES}
              FROM service_rates""")
def service_ar(t: Tables) -> DataFrame:
    return plan(t).service_ar()


@register(f"""SELECT r.report, {o.date_int('r.date')} AS date, r.grp AS name, gg.grp AS supergroup,
                     coalesce(weight, 0) AS weight, {RATES}
              FROM group_rates r LEFT JOIN gg ON gg.subgroup = r.grp LEFT JOIN wt ON wt.site = r.grp""")
def group_ar(t: Tables) -> DataFrame:
    return plan(t).group_ar()


@register(o.runs("endpoint_slots", "report, date, service, hostname"))
def endpoint_timeline(t: Tables) -> DataFrame:
    return spans(plan(t).endpoints, ["report", "date", "service", "hostname"])


@register(f"""SELECT report, date, grp AS "group", service, slot_from, slot_to, status
              FROM ({o.runs("service_slots", "report, date, grp, service")})""")
def service_timeline(t: Tables) -> DataFrame:
    return spans(plan(t).services, ["report", "date", "group", "service"])


@register(f"""SELECT report, date, grp AS "group", slot_from, slot_to, status
              FROM ({o.runs("group_slots", "report, date, grp")})""")
def group_timeline(t: Tables) -> DataFrame:
    return spans(plan(t).groups, ["report", "date", "group"])


@register("SELECT * FROM status_rows")
def status_metrics(t: Tables) -> DataFrame:
    return status_plan(t).status_metrics()


@register(f"""SELECT e.report, {o.date_int('date')} AS date_integer, grp AS endpoint_group, e.service,
                     e.hostname AS host, {o.stamp('date', 'pos')} AS "timestamp",
                     {o.name_of('code')} AS status
              FROM endpoint_points e JOIN place p ON p.report = e.report AND p.service = e.service
                   AND p.hostname = e.hostname""")
def status_endpoints(t: Tables) -> DataFrame:
    return status_plan(t).status_endpoints()


@register(f"""SELECT report, {o.date_int('date')} AS date_integer, grp AS endpoint_group, service,
                     {o.stamp('date', 'pos')} AS "timestamp", {o.name_of('code')} AS status
              FROM service_points""")
def status_services(t: Tables) -> DataFrame:
    return status_plan(t).status_services()


@register(f"""SELECT report, {o.date_int('date')} AS date_integer, grp AS endpoint_group,
                     {o.stamp('date', 'pos')} AS "timestamp", {o.name_of('code')} AS status
              FROM group_points""")
def status_groups(t: Tables) -> DataFrame:
    return status_plan(t).status_groups()


# -- dimensions that change from day to day --------------------------------------------------------


def dated_reports(t: Tables) -> list[ReportInputs]:
    """Every dimension as a snapshot of each third day; supergroups and weights differ in each."""
    low, high = (F.lit(d).cast("date") for d in t.days)
    many = F.explode(F.sequence(F.lit(0), F.floor(F.date_diff(high, low) / 3).cast("int")))

    def stamped(df: DataFrame) -> DataFrame:
        return df.withColumn("k", many).withColumn("date", F.date_add(low, F.col("k") * 3))

    return [ReportInputs(
        r.config, r.profile, stamped(r.metric_profiles).drop("k"), stamped(r.endpoint_groups).drop("k"),
        stamped(r.group_groups).withColumn("group", F.concat_ws("-", "group", "k")).drop("k"),
        stamped(r.weights).withColumn("weight", (F.col("weight").cast("int") + F.col("k")).cast("string")).drop("k"),
        r.downtimes, r.group_exclusions, r.monitor_exclusions) for r in t.reports()]


def dated_plan(t: Tables) -> ar.AvailabilityPlan:
    return ar.availability(t.spark, t.metric_data(), dated_reports(t), OPERATIONS, *t.days, OPTIONS)


@register(f"""SELECT report, {o.date_int('date')} AS date, service AS name, grp AS supergroup, {RATES}
              FROM service_rates""")
def service_ar_dated(t: Tables) -> DataFrame:
    return dated_plan(t).service_ar()


@register(f"""SELECT r.report, {o.date_int('r.date')} AS date, r.grp AS name,
                     gg.grp || '-' || (r.date - span.low) // 3 AS supergroup,
                     coalesce(weight + (r.date - span.low) // 3, 0)::INT AS weight, {RATES}
              FROM span, group_rates r LEFT JOIN gg ON gg.subgroup = r.grp LEFT JOIN wt ON wt.site = r.grp""")
def group_ar_dated(t: Tables) -> DataFrame:
    return dated_plan(t).group_ar()


@register(f"""SELECT report, {o.date_int('date')} AS date_integer, grp AS endpoint_group,
                     {o.stamp('date', 'pos')} AS "timestamp", {o.name_of('code')} AS status
              FROM group_points""")
def status_groups_dated(t: Tables) -> DataFrame:
    return st.status(t.spark, t.metric_data(), dated_reports(t), OPERATIONS, *t.days, OPTIONS).status_groups()
