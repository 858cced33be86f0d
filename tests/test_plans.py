import random

import pytest
from pyspark.sql import functions as F

from tests import model
from uptrail.config import (AvailabilityProfile, Options, ReportConfig, ReportInputs)
from uptrail.functions import clock
from uptrail.operators import fold as fo
from uptrail.plans.availability import GROUP, SERVICE, availability
from uptrail.plans.rows import PLACE
from uptrail.plans.status import status
from uptrail.sources.snapshots import SnapshotMissing
from uptrail.sources.defaults import grid_operations, tenant_operations

D, P = "2024-03-31", "2024-03-30"  # the day of a clock change in Europe
PROFILE = AvailabilityProfile.from_document({
    "name": "ap", "metric_profile": "mp", "metric_ops": "AND", "operation": "AND",
    "groups": {"a": {"services": {"s1": "OR", "s2": "AND"}, "operation": "OR"},
               "b": {"services": {"s3": "OR"}, "operation": "OR"}}})
CONFIG = ReportConfig("R", "t", "j", "SITES", "NGI", "w", egroup_tags={"production": "Y"})
METRICS = {"s1": ["m1", "m2"], "s2": ["m1"], "s3": ["m1", "m2", "m3"], "s4": ["m1"]}


class Fixture:
    def __init__(self, spark, ops, seed):
        rng = random.Random(seed)
        self.ops = ops
        self.topology = []
        for host in range(14):
            service = f"s{rng.randint(1, 4)}"
            for group in rng.sample(["g1", "g2", "g3"], rng.randint(1, 2)):
                self.topology.append((service, f"h{host:02d}", group))
        self.rows, self.before = {}, {}
        flat = []
        for service, host in sorted({(s, h) for s, h, _ in self.topology}):
            for metric in METRICS[service]:
                for day, into in ((P, self.before), (D, self.rows)):
                    for second in sorted({rng.randrange(86400) for _ in range(rng.choice((0, 1, 5)))}):
                        code = rng.choice((0, 0, 1, 2, 3, 4, 5))
                        ts = f"{day}T{second // 3600:02d}:{second % 3600 // 60:02d}:{second % 60:02d}Z"
                        into.setdefault((service, host, metric), []).append((ts, code))
                        flat.append((ts, service, host, metric, ops.states[code], "mon", "s", "m"))
        flat.append((f"{D}T10:00:00Z", "s1", "stranger", "m1", "OK", "mon", "s", "m"))
        flat.append((f"{D}T10:00:00Z", *self.topology[0][:2], "other", "CRITICAL", "mon", "s", "m"))
        self.downtimes = {(s, h): [(f"{P}T22:00:00Z", f"{D}T03:00:00Z"), (f"{D}T12:00:00Z", f"{D}T13:00:00Z")]
                          for s, h, _ in self.topology[::4]}
        self.exclusions = {"g2": [(f"{D}T06:00:00Z", f"{D}T08:00:00Z"), (f"{D}T07:00:00Z", "2024-04-02T00:00:00Z")]}
        md = spark.createDataFrame(flat, "timestamp string, service string, hostname string, metric string, "
                                         "status string, monitoring_host string, summary string, message string")
        self.md = md.withColumn("date", clock.text_date(F.col("timestamp")))
        tagged = [("SITES", g, s, h, {"production": "1"}) for s, h, g in self.topology]
        eg = spark.createDataFrame(tagged, "type string, group string, service string, hostname string, "
                                           "tags map<string,string>")
        gg = spark.createDataFrame([("NGI", "top", g, {}) for g in ("g1", "g2", "g3")],
                                   "type string, group string, subgroup string, tags map<string,string>")
        mp = spark.createDataFrame([("mp", s, m) for s, ms in METRICS.items() for m in ms],
                                   "profile string, service string, metric string")
        stamp = lambda df: df.withColumns({c: clock.parse_ts(F.col(c)) for c in ("start_ts", "end_ts")})
        down = stamp(spark.createDataFrame(
            [(s, h, a, b) for (s, h), ps in self.downtimes.items() for a, b in ps],
            "service string, hostname string, start_ts string, end_ts string"))
        excl = stamp(spark.createDataFrame(
            [("R", g, a, b) for g, ps in self.exclusions.items() for a, b in ps],
            "report string, group string, start_ts string, end_ts string"))
        weights = spark.createDataFrame([("w", "g1", "7")], "type string, site string, weight string")
        self.report = ReportInputs(CONFIG, PROFILE, mp, eg, gg, weights, down, excl, None)
        self.model = model.Day(ops, PROFILE, METRICS, self.topology, self.rows, self.before,
                               self.downtimes, self.exclusions, D)


def dense(timeline, keys):
    return {tuple(r[k] for k in keys[2:]): list(r.slots)
            for r in fo.to_slots(timeline, keys, 288).collect()}


def lists(timeline, keys):
    out = {}
    for r in timeline.orderBy("pos").collect():
        out.setdefault(tuple(r[k] for k in keys[2:]), []).append((r.pos, r.code))
    return out


@pytest.mark.parametrize("ops,seed", [(tenant_operations(), 1), (tenant_operations(), 2),
                                      (grid_operations(), 3)])
def test_availability_equals_model(spark, ops, seed):
    fx = Fixture(spark, ops, seed)
    plan = availability(spark, fx.md, [fx.report], ops, D)
    endpoints = fx.model.endpoints()
    assert dense(plan.endpoints, PLACE) == endpoints
    services = fx.model.services(endpoints)
    assert dense(plan.services, SERVICE) == services
    groups = fx.model.excluded(fx.model.groups(services))
    assert {k[0]: v for k, v in dense(plan.groups, GROUP).items()} == groups
    got = {r.name: (r.availability, r.reliability, r.up, r.unknown, r.down) for r in plan.group_ar().collect()}
    assert got == {g: model.rates(s, ops) for g, s in groups.items()}
    weights = {r.name: (r.weight, r.supergroup) for r in plan.group_ar().collect()}
    assert all(w == ((7 if g == "g1" else 0), "top") for g, w in weights.items())


@pytest.mark.parametrize("ops,seed", [(tenant_operations(), 4), (grid_operations(), 5)])
def test_status_equals_model(spark, ops, seed):
    fx = Fixture(spark, ops, seed)
    plan = status(spark, fx.md, [fx.report], ops, D)
    endpoints = fx.model.status_endpoints()
    assert lists(plan.endpoints, PLACE) == endpoints
    services = fx.model.status_services(endpoints)
    assert lists(plan.services, SERVICE) == services
    groups = fx.model.groups(services, model.fold_lists)
    assert {k[0]: v for k, v in lists(plan.groups, GROUP).items()} == groups


def test_one_day_equals_range(spark):
    fx = Fixture(spark, tenant_operations(), 6)
    one = availability(spark, fx.md, [fx.report], fx.ops, D).service_ar()
    both = availability(spark, fx.md, [fx.report], fx.ops, P, D).service_ar().where(
        F.col("date") == int(D.replace("-", "")))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, both.collect()))


def test_dimensions_of_the_newest_snapshot(spark):
    """Tables from the days before serve the day; of two snapshots only the newer one does."""
    fx = Fixture(spark, tenant_operations(), 10)
    old, new = F.lit(clock.shift(D, -3)).cast("date"), F.lit(clock.shift(D, -1)).cast("date")
    r = fx.report
    stale = lambda df, change: df.withColumn("date", new).unionByName(change(df).withColumn("date", old))
    renamed = lambda c: (lambda df: df.withColumn(c, F.concat(F.lit("old-"), c)))
    report = ReportInputs(
        r.config, r.profile, stale(r.metric_profiles, renamed("metric")), stale(r.endpoint_groups, renamed("group")),
        stale(r.group_groups, renamed("group")), stale(r.weights, lambda df: df.withColumn("weight", F.lit("1"))),
        None if r.downtimes is None else stale(r.downtimes, lambda df: df.withColumn("hostname", F.lit("none"))),
        r.group_exclusions, r.monitor_exclusions)
    rows = lambda x: sorted(map(tuple, x.collect()))
    plain, dated = (availability(spark, fx.md, [x], fx.ops, D) for x in (r, report))
    assert rows(plain.group_ar()) == rows(dated.group_ar()) and rows(plain.service_ar()) == rows(dated.service_ar())
    plain, dated = (status(spark, fx.md, [x], fx.ops, D) for x in (r, report))
    assert rows(plain.status_groups()) == rows(dated.status_groups())
    with pytest.raises(SnapshotMissing):
        availability(spark, fx.md, [report], fx.ops, clock.shift(D, 3))


def test_session_time_zone_does_not_matter(spark):
    fx = Fixture(spark, tenant_operations(), 7)
    results = []
    for zone in ("UTC", "Europe/Athens"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            a = availability(spark, fx.md, [fx.report], fx.ops, D).service_ar().collect()
            s = status(spark, fx.md, [fx.report], fx.ops, D).status_metrics().collect()
            results.append((sorted(map(tuple, a)), sorted(map(tuple, s))))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1]


def test_choices(spark):
    fx = Fixture(spark, tenant_operations(), 8)
    keep = fx.topology[0][:2]
    eg = fx.report.endpoint_groups.withColumn(
        "tags", F.when(F.col("hostname") == keep[1], F.col("tags"))
        .otherwise(F.create_map(F.lit("production"), F.lit("0"))))
    report = ReportInputs(CONFIG, PROFILE, fx.report.metric_profiles, eg, fx.report.group_groups)
    whole = availability(spark, fx.md, [report], fx.ops, D)
    chosen = availability(spark, fx.md, [report], fx.ops, D, options=Options(scope="selected"))
    hosts = lambda plan: {r.hostname for r in plan.endpoints.select("hostname").collect()}
    assert hosts(chosen) == {keep[1]}
    assert hosts(whole) == {h for _, h, _ in fx.topology}
    exact = status(spark, fx.md, [fx.report], fx.ops, D, options=Options(anchor="exact"))
    assert exact.endpoints.count() > 0
    with pytest.raises(ValueError):
        Options(scope="nothing")


def test_loose_mode_counts_other_metrics(spark):
    fx = Fixture(spark, tenant_operations(), 9)
    service, host, _ = fx.topology[0]
    strict = dense(availability(spark, fx.md, [fx.report], fx.ops, D).endpoints, PLACE)
    loose = dense(availability(spark, fx.md, [fx.report], fx.ops, D, options=Options(strict=False)).endpoints, PLACE)
    slot = 119  # the stray CRITICAL of ten o'clock acts from here
    downtime = fx.ops.down_code
    want = [c if i < slot or c == downtime else fx.ops.code("CRITICAL")
            for i, c in enumerate(strict[service, host])]
    missing = fx.ops.missing_code  # before, the extra metric is MISSING
    want = [c if i >= slot or c == downtime else fx.ops.combine("AND", c, missing) for i, c in enumerate(want)]
    assert loose[service, host] == want
