"""Monitoring tables derived from the provided ones.

Probe results come from ``events``, the topology from ``events``, ``supplier``, ``nation`` and
``region``, downtimes from ``orders``, weights and recomputation requests from ``supplier``. Each
derived table grows with the table it is made from.
"""

from __future__ import annotations

from functools import cached_property
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptrail.config import (AvailabilityProfile, Options, ReportConfig, ReportInputs,
                            literal_frame)
from uptrail.functions import clock
from uptrail.operators import requests as rq
from uptrail.sources.defaults import tenant_operations

OPERATIONS = tenant_operations()
OPTIONS = Options()

PROFILE_1 = AvailabilityProfile.from_document({
    "name": "ap1", "namespace": "demo", "metric_profile": "P1", "metric_ops": "AND",
    "group_type": "SITES", "operation": "AND",
    "groups": {
        "compute": {"services": {"svc-0": "OR", "svc-1": "OR"}, "operation": "OR"},
        "storage": {"services": {"svc-2": "OR"}, "operation": "OR"}}})
PROFILE_2 = AvailabilityProfile.from_document({
    "name": "ap2", "namespace": "demo", "metric_profile": "P2", "metric_ops": "OR",
    "group_type": "SITES", "operation": "OR",
    "groups": {
        "front": {"services": {"svc-0": "AND", "svc-2": "OR"}, "operation": "AND"},
        "back": {"services": {"svc-1": "AND"}, "operation": "OR"}}})
REPORT_1 = ReportConfig("R1", "demo", "Critical", "SITES", "NGI", "hepspec",
                        egroup_tags={"production": "Y"},
                        ggroup_tags={"certification": "certified"})
REPORT_2 = ReportConfig("R2", "demo", "Web", "SITES", "NGI", "hepspec")
METRIC_PROFILES = [(profile, f"svc-{s}", metric)
                   for profile, metrics in (("P1", ("m-tx", "m-web")), ("P2", ("m-web",)))
                   for s in range(4) for metric in metrics]


def h(user: str = "user_id"):
    """Three users share a host."""
    return F.floor(F.col(user) / F.lit(3.0)).cast("bigint")


def named(prefix: str, number) -> F.Column:
    return F.concat(F.lit(prefix), number.cast("string"))


_OPENED: WeakKeyDictionary = WeakKeyDictionary()


class Tables:
    """The derived tables of one data directory."""

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> "Tables":
        """The tables of a session and path; schemas and the first and last day are read once."""
        return _OPENED.setdefault(spark, {}).setdefault(path, cls(spark, path))

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.frames = spark, path, {}

    def read(self, name: str) -> DataFrame:
        if name not in self.frames:
            self.frames[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self.frames[name]

    @cached_property
    def days(self) -> tuple[str, str]:
        """First and last day of the events: two values, read once."""
        low, high = self.read("events").agg(F.min("ts"), F.max("ts")).first()
        return low.date().isoformat(), high.date().isoformat()

    def metric_data(self, *more: str) -> DataFrame:
        """Probe results, with the date a stored table is partitioned by, and the second of the day."""
        even = F.col("event_id") % 2 == 0
        error = F.col("event_type") == "error"
        second = clock.second_of(F.col("ts"))
        host = h()
        return self.read("events").select(
            clock.format_ts(F.to_date("ts"), second).alias("timestamp"),
            named("svc-", host % 3).alias("service"),
            named("host-", host).alias("hostname"),
            F.when(F.col("event_type").isin("click", "view"), "m-web")
             .when(F.col("event_type").isin("purchase", "signup"), "m-tx")
             .when(even, "m-web").otherwise("m-tx").alias("metric"),
            F.when(error & (F.col("value") > 50), "CRITICAL").when(error, "WARNING")
             .when(F.col("value") < 3, "UNKNOWN").otherwise("OK").alias("status"),
            named("mon-", F.col("event_id") % 3).alias("monitoring_host"),
            F.col("event_type").alias("summary"), F.col("props").alias("message"),
            F.to_date("ts").alias("date"), second.alias("second"), *more)

    def endpoint_groups(self) -> DataFrame:
        """Hosts that report (in one or two sites, and a project), and supplier hosts that never do."""
        hosts = self.read("events").select(h().alias("h")).distinct()
        tags = F.create_map(F.lit("production"), F.when(F.col("h") % 11 == 0, "0").otherwise("1"))
        host, service = named("host-", F.col("h")), named("svc-", F.col("h") % 3)

        def rows(kind: str, group) -> F.Column:
            return F.struct(F.lit(kind).alias("type"), group.alias("group"))

        memberships = F.array_compact(F.array(
            rows("SITES", named("NATION_", F.col("h") % 5)),
            F.when(F.col("h") % 4 == 0, rows("SITES", named("NATION_", 5 + F.col("h") % 7))),
            rows("PROJECT", named("PROJ_", F.col("h") % 2))))
        reporting = hosts.select(F.explode(memberships).alias("m"), service.alias("service"),
                                 host.alias("hostname"), tags.alias("tags"))
        silent = self.read("supplier").join(
            self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.lit("SITES").alias("type"), F.col("n_name").alias("group"),
            named("svc-", F.col("s_suppkey") % 4).alias("service"),
            named("idle-", F.col("s_suppkey")).alias("hostname"),
            F.create_map(F.lit("monitored"), F.lit("1")).alias("tags"))
        return reporting.select("m.type", "m.group", "service", "hostname",
                                "tags").unionByName(silent)

    def group_groups(self) -> DataFrame:
        """Nations in regions; every sixth nation is not certified."""
        return self.read("nation").join(
            self.read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.lit("NGI").alias("type"), F.col("r_name").alias("group"),
            F.col("n_name").alias("subgroup"),
            F.create_map(F.lit("certification"),
                         F.when(F.col("n_nationkey") % 6 == 5, "Suspended").otherwise("Certified"))
            .alias("tags"))

    def group_tree(self) -> DataFrame:
        """A deeper tree: customers in nations in regions in one world."""
        tree = self.group_groups().select("type", "group", "subgroup")
        customers = self.read("customer").join(
            self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.lit("CLIENT").alias("type"), F.col("n_name").alias("group"),
            F.col("c_name").alias("subgroup"))
        world = self.read("region").select(
            F.lit("TOP").alias("type"), F.lit("WORLD").alias("group"),
            F.col("r_name").alias("subgroup"))
        return tree.unionByName(customers).unionByName(world)

    def metric_profiles(self) -> DataFrame:
        return literal_frame(self.spark, METRIC_PROFILES, "profile", "service", "metric")

    def downtimes(self) -> DataFrame:
        """One downtime per order, 1 to 30 hours long, on the days of the events."""
        key = F.col("o_orderkey")
        first = F.lit(self.days[0]).cast("date").cast("timestamp_ntz")
        offset = (key % 30 * 86400 + key % 23 * 3600 + key % 50 * 60).cast("int")
        length = F.when(key % 10 == 0, 30 * 3600).otherwise(3600 * (1 + key % 7)).cast("int")
        return self.read("orders").select(
            named("host-", F.col("o_custkey")).alias("hostname"),
            named("svc-", F.col("o_custkey") % 3).alias("service"),
            F.timestamp_add("SECOND", offset, first).alias("start_ts"),
            F.timestamp_add("SECOND", offset + length, first).alias("end_ts"))

    def weights(self) -> DataFrame:
        return (self.read("supplier").join(
            self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_name").alias("site"))
            .agg(F.floor(F.sum("s_acctbal").cast("decimal(20,2)")).cast("int").cast("string")
                 .alias("weight"))
            .select(F.lit("hepspec").alias("type"), "site", "weight"))

    def requests(self) -> DataFrame:
        """One recomputation request per supplier."""
        k = F.col("s_suppkey")
        day = F.date_add(F.lit(self.days[0]).cast("date"), (k % 30).cast("int"))
        end_day = F.date_add(day, (k % 3).cast("int"))
        source = F.struct(
            named("mon-", k % 5).alias("host"),
            F.concat(day.cast("string"), F.lit("T00:00:00Z")).alias("start_time"),
            F.concat(day.cast("string"), F.lit("T03:00:00Z")).alias("end_time"))
        return self.read("supplier").select(
            named("req-", k).alias("id"),
            F.when(k % 3 == 2, "R2").otherwise("R1").alias("report"),
            F.lit("probe outage").alias("reason"),
            F.concat(day.cast("string"), F.lit("T06:00:00Z")).alias("start_time"),
            F.concat(end_day.cast("string"), F.lit("T08:00:00Z")).alias("end_time"),
            F.array(named("NATION_", k % 7)).alias("exclude"),
            F.when(k % 4 == 0, "pending").when(k % 4 == 1, "running").otherwise("done")
            .alias("status"),
            F.concat(F.lit("2024-02-01 00:"), F.lpad((k % 60).cast("string"), 2, "0"),
                     F.lit(":00")).alias("timestamp"),
            F.array(source).alias("exclude_monitoring_source"))

    @cached_property
    def dimensions(self) -> tuple[DataFrame, ...]:
        requests = self.requests()
        return (self.metric_profiles(), self.endpoint_groups(), self.group_groups(),
                self.weights(), self.downtimes(), rq.group_exclusions(requests),
                rq.monitor_exclusions(requests))

    def report(self, config: ReportConfig = REPORT_1,
               profile: AvailabilityProfile = PROFILE_1) -> ReportInputs:
        return ReportInputs(config, profile, *self.dimensions)

    def reports(self) -> list[ReportInputs]:
        return [self.report(), self.report(REPORT_2, PROFILE_2)]

    # -- older logs ------------------------------------------------------------------------------

    def legacy_logs(self) -> DataFrame:
        """Probe results in the older layout; four virtual organisations."""
        vo = named("vo-", F.col("user_id") % 4)
        return self._probes(
            F.col("timestamp").alias("time_stamp"), "metric",
            F.col("service").alias("service_flavour"), "hostname", "status", vo.alias("vo"),
            F.concat(F.lit("/"), vo, F.lit("/Role=NULL")).alias("vofqan"),
            F.lit("P1").alias("profile"), "date", "second")

    def legacy_detail(self) -> DataFrame:
        vo = named("vo-", F.col("user_id") % 4)
        return self._probes(
            "timestamp", named("ROC_", h() % 5).alias("roc"),
            F.col("monitoring_host").alias("monitoring_box"), "metric",
            F.col("service").alias("service_type"), "hostname", "status", vo.alias("vo"),
            F.concat(F.lit("/"), vo, F.lit("/Role=NULL")).alias("vo_fqan"), "summary", "message",
            "date", "second")

    def _probes(self, *columns) -> DataFrame:
        return self.metric_data("user_id").select(*columns)

    def sites(self) -> DataFrame:
        """Hosts of the events in the older topology layout."""
        hosts = self.read("events").select(h().alias("h")).distinct()
        return hosts.select(
            named("host-", F.col("h")).alias("hostname"), named("svc-", F.col("h") % 3).alias("service"),
            F.when(F.col("h") % 11 == 0, "N").otherwise("Y").alias("production"),
            F.lit("Y").alias("monitored"), F.lit("grid").alias("scope"),
            named("NATION_", F.col("h") % 5).alias("site"), named("ROC_", F.col("h") % 5).alias("roc"),
            F.lit("Production").alias("infrastructure"), F.lit("Certified").alias("certification"),
            F.lit("grid").alias("site_scope"))

    def legacy_checks(self) -> DataFrame:
        return self.metric_profiles().withColumnRenamed("service", "service_flavour")

    def legacy_mapping(self) -> DataFrame:
        rows = [("P1", PROFILE_1.name, service, group, group_op, PROFILE_1.total_op)
                for service, _, group, group_op, _, _ in PROFILE_1.rows()]
        return literal_frame(self.spark, rows, "profile", "availability_profile",
                             "service_flavour", "ag_group", "group_op", "total_op")
