import json

import pytest
from pyspark.sql import functions as F

from uptrail import config, schemas
from uptrail.functions import clock
from uptrail.operators import requests as rq, selection as sel, topology
from uptrail.plans import jobs
from uptrail.sinks import store
from uptrail.sources import snapshots, tables as src
from uptrail.streaming import ingest

REQUESTS = [
    {"id": "p1", "report": "R", "reason": "power", "start_time": "2031-03-04T06:00:00Z",
     "end_time": "2031-03-07T05:59:59Z", "exclude": ["NORTH", "SOUTH"], "status": "running",
     "timestamp": "2031-04-02 08:00:00"},
    {"id": "p2", "report": "R", "reason": "probe", "start_time": "2031-03-04T00:00:00Z",
     "end_time": "2031-03-04T23:59:59Z", "exclude": ["EAST", "WEST"], "status": "pending",
     "timestamp": "2031-04-02 09:30:00",
     "exclude_monitoring_source": [
         {"host": "probe-1", "start_time": "2031-03-04T02:30:00Z", "end_time": "2031-03-04T04:45:10Z"},
         {"host": "probe-1", "start_time": "2031-03-04T21:00:05Z", "end_time": "2031-03-04T21:00:05Z"}]},
    {"id": "p3", "report": "R", "reason": "again", "start_time": "2031-03-04T20:15:00Z",
     "end_time": "2031-03-05T01:00:00Z", "exclude": ["EAST"], "status": "pending",
     "timestamp": "2031-04-02 09:29:59"}]


@pytest.fixture
def requests(spark, tmp_path):
    path = tmp_path / "requests.json"
    path.write_text(json.dumps(REQUESTS))
    return src.read_recomputations(spark, str(path))


def test_documents(spark, tmp_path):
    profile = {"name": "ap", "namespace": "n", "metric_profile": "mp", "metric_ops": "AND",
               "group_type": "sites", "operation": "AND",
               "groups": {"compute": {"services": {"CE": "OR", "ARC": "OR"}, "operation": "OR"},
                          "storage": {"services": {"SRM": "OR"}, "operation": "AND"}}}
    report = {"id": "1", "tenant": "T", "job": "J", "egroup": "SITES", "ggroup": "NGI",
              "weight": "hepspec", "egroup_tags": {"production": "Y"}}
    for name, doc in (("ap", profile), ("cfg", report)):
        (tmp_path / name).write_text(json.dumps(doc))
    ap = config.read_availability_profile(spark, str(tmp_path / "ap"))
    rows = {r.service: (r.ag_group, r.svc_op, r.group_op) for r in config.profile_frame(spark, ap).collect()}
    assert rows == {"CE": ("compute", "OR", "OR"), "ARC": ("compute", "OR", "OR"),
                    "SRM": ("storage", "OR", "AND")}
    assert ap.ops() == {"AND", "OR"}
    cfg = config.read_report_config(spark, str(tmp_path / "cfg"))
    assert cfg.egroup_tags == {"production": "Y"} and cfg.altg is None
    profile["groups"]["storage"]["services"]["CE"] = "OR"
    with pytest.raises(ValueError):
        config.AvailabilityProfile.from_document(profile)


def test_inline_table_keeps_values(spark):
    rows = [("a'b", "c\\d"), ("e", "f"), ("", "ü")]
    df = config.literal_frame(spark, rows, "x", "y")
    assert sorted(map(tuple, df.collect())) == sorted(rows)
    assert config.literal_frame(spark, [], "x").count() == 0


def test_exclusions(requests):
    groups = rq.group_exclusions(requests)
    assert groups.where("group = 'EAST'").count() == 2 and groups.count() == 5
    assert rq.covering(requests, "2031-03-06").count() == 1
    assert rq.select_recomputations(requests, "R", "2031-03-04").count() == 3
    assert {r.status: r.requests for r in rq.recomputation_counts(requests).collect()} == {
        "running": 1, "pending": 2}
    assert rq.next_pending(requests).first().id == "p3"
    done = rq.mark_request(requests, "p3", "done", "2031-05-01 00:00:00")
    assert rq.next_pending(done).first().id == "p2"


@pytest.mark.parametrize("host,time,kept", [
    ("probe-1", "02:29:59", True), ("probe-1", "02:30:00", False), ("probe-1", "04:45:10", False),
    ("probe-1", "04:45:11", True), ("probe-1", "21:00:05", False), ("probe-2", "03:00:00", True)])
def test_monitoring_exclusion(spark, requests, host, time, kept):
    md = spark.createDataFrame([(f"2031-03-04T{time}Z", host)], "timestamp string, monitoring_host string")
    assert sel.exclude_monitoring(md, rq.monitor_exclusions(requests)).count() == int(kept)


def test_dimensions(spark):
    eg = spark.createDataFrame(
        [("SITES", "A", "s", "h1", {"production": "1", "scope": "Grid"}),
         ("SITES", "B", "s", "h2", {"production": "0"}), ("SITES", "C", "s", "h3", {})],
        schemas.ENDPOINT_GROUPS)
    kept = sel.filter_endpoint_tags(eg, {"production": "y", "scope": "grid"})
    assert {r.hostname for r in kept.collect()} == {"h1", "h3"}
    gg = spark.createDataFrame([("NGI", "N2", "A", {"c": "Certified"}), ("NGI", "N1", "A", {}),
                                ("OTHER", "X", "B", {"c": "no"})], schemas.GROUP_GROUPS)
    assert sel.filter_group_tags(gg, {"c": "certified"}).count() == 2
    names = spark.createDataFrame([("A",), ("B",)], "group string")
    assert {r.group: r.supergroup for r in topology.with_supergroup(names, gg, "NGI").collect()} == {
        "A": "N1", "B": None}
    weights = spark.createDataFrame([("hepspec", "A", "12")], schemas.WEIGHTS)
    assert {r.group: r.weight for r in topology.with_weight(names, weights, "hepspec").collect()} == {
        "A": 12, "B": 0}


def test_missing_row(spark):
    items = spark.createDataFrame([("s", "h", "m", "2015-01-24")],
                                  "service string, hostname string, metric string, date string")
    row = sel.missing_rows(items.withColumn("date", F.col("date").cast("date")), "Critical").first()
    assert tuple(row) == ("Critical", "none", "s", "h", "m", "2015-01-24T00:00:00Z", "MISSING",
                          "missing", "missing")


def test_time_functions(spark):
    assert clock.date_range("2014-02-27", "2014-03-01") == ["2014-02-27", "2014-02-28", "2014-03-01"]
    with pytest.raises(ValueError):
        clock.date_range("2014-03-01", "2014-02-27")
    ts = F.lit("2014-01-15T24:59:59Z")
    row = spark.range(1).select(clock.seconds_of_day(ts).alias("s"), clock.text_date(ts).alias("d"),
                                clock.parse_ts(ts).cast("string").alias("t")).first()
    assert (row.s, str(row.d), row.t) == (3599, "2014-01-15", "2014-01-16 00:59:59")


def test_snapshots(spark):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-04", 2)], "date string, v int")
    df = df.withColumn("date", F.col("date").cast("date"))
    assert snapshots.latest_snapshot(df, "2024-01-07").first().v == 2
    assert snapshots.newest_snapshot(df).first().v == 2
    with pytest.raises(snapshots.SnapshotMissing):
        snapshots.latest_snapshot(df, "2024-01-08")
    got = {str(r.date): r.v for r in snapshots.snapshots_for(df, "2024-01-02", "2024-01-07").collect()}
    assert got == {"2024-01-02": 1, "2024-01-03": 1, "2024-01-04": 2, "2024-01-05": 2,
                   "2024-01-06": 2, "2024-01-07": 2}
    with pytest.raises(snapshots.SnapshotMissing):
        snapshots.snapshots_for(df, "2024-01-02", "2024-01-08")


def test_ancestors_stop_on_a_cycle(spark):
    jobs.shared_dir(spark)
    gg = spark.createDataFrame([("t", "b", "a"), ("t", "c", "b"), ("t", "a", "c")],
                               "type string, group string, subgroup string")
    got = {(r.group, r.ancestor): r.depth for r in topology.ancestor_groups(gg).collect()}
    assert got[("a", "b")] == 1 and got[("a", "c")] == 2 and got[("a", "a")] == 3 and len(got) == 9


def test_ancestors_of_a_deep_chain(spark):
    jobs.shared_dir(spark)
    gg = spark.createDataFrame([("t", str(i + 1), str(i)) for i in range(7)], "type string, group string, subgroup string")
    got = {(r.group, r.ancestor): r.depth for r in topology.ancestor_groups(gg).collect()}
    assert got == {(str(i), str(j)): j - i for i in range(7) for j in range(i + 1, 8)}


def test_a_chain_takes_as_many_rounds_as_its_length_has_digits(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    jobs.shared_dir(spark)
    rounds, real = [], DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a: rounds.append(1) or real(self, *a))
    gg = spark.range(200).selectExpr("'t' AS type", "string(id + 1) AS group", "string(id) AS subgroup")
    found = topology.ancestor_groups(gg)
    assert len(rounds) - 1 <= 9 and found.count() == 200 * 201 // 2
    assert found.where("depth <> int(ancestor) - int(`group`)").isEmpty()


def results(spark, rows):
    return spark.createDataFrame(
        rows, "report string, date int, name string, supergroup string, availability double")


def test_upsert_and_delete(spark, tmp_path):
    root = str(tmp_path)
    store.upsert(results(spark, [("R", 1, "a", "g", 1.0), ("R", 2, "a", "g", 2.0),
                                 ("Q", 1, "a", "g", 3.0)]), root, "service_ar")
    store.upsert(results(spark, [("R", 1, "b", "g", 9.0)]), root, "service_ar")
    read = lambda: sorted((r.report, r.date, r.name, r.availability)
                          for r in store.read_results(spark, root, "service_ar").collect())
    assert read() == [("Q", 1, "a", 3.0), ("R", 1, "b", 9.0), ("R", 2, "a", 2.0)]
    assert store.delete_results(spark, root, "service_ar", 1, "R") == 1
    assert store.delete_results(spark, root, "service_ar", 7) == 0
    assert read() == [("Q", 1, "a", 3.0), ("R", 2, "a", 2.0)]


def test_report_ids_stay_as_they_are(spark, tmp_path):
    root, ids = str(tmp_path), ["001", "eu:prod", "a b/c", "x=y%"]
    store.upsert(results(spark, [(i, d, "n", "g", 1.0) for i in ids for d in (1, 2)]), root, "service_ar")
    read = lambda: sorted((r.report, r.date) for r in store.read_results(spark, root, "service_ar").collect())
    assert read() == sorted((i, d) for i in ids for d in (1, 2))
    for i in ids[:3]:
        assert store.delete_results(spark, root, "service_ar", 1, i) == 1
    assert store.delete_results(spark, root, "service_ar", 2) == 4
    assert read() == [("x=y%", 1)]


def test_decode_envelope(spark):
    good = json.dumps({"attributes": {"type": "metric_data", "partition_date": "2015-03-01"},
                       "data": "dGhpcyBoYXMgdG8gYmUgZGVjb2RlZA=="})
    bad = ["not json", json.dumps({"attributes": {"type": "x"}, "data": "%%%"}), json.dumps({"data": "eA=="})]
    df = spark.createDataFrame([(good,), *[(b,) for b in bad]], "value string")
    rows = ingest.decode_envelope(df, "hdfs:/schemas/").collect()
    assert rows[0].body == "this has to be decoded"
    assert rows[0].headers == {"attr_type": "metric_data", "attr_partition_date": "2015-03-01"}
    assert rows[0].schema_url == "hdfs:/schemas/metric_data.avsc" and rows[0].date == "2015-03-01"
    assert [r.body for r in rows[1:]] == [None] * 3 and [r.raw for r in rows[1:]] == bad


def test_refresh_runs_touched_days(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    line = lambda day: json.dumps({"attributes": {"type": "metric_data", "partition_date": day},
                                   "data": "e30="})
    (source / "1.json").write_text("\n".join([line("2024-01-02"), line("2024-01-01"), line("2024-01-02")]))
    seen = []
    stream = ingest.decode_envelope(ingest.read_envelopes(spark, str(source)))
    ingest.refresh_stream(stream, seen.append, str(tmp_path / "state"), once=True).awaitTermination()
    assert seen == [["2024-01-01", "2024-01-02"]]


def test_stored_day(spark, tmp_path):
    from tests.test_plans import D, Fixture
    from uptrail.sources.defaults import tenant_operations
    fx = Fixture(spark, tenant_operations(), 11)
    root = str(tmp_path)
    for _ in range(2):  # a second run replaces the first
        jobs.run_day(spark, fx.md, [fx.report], fx.ops, root, D)
    for table, (partitions, key) in store.TABLES.items():
        rows = store.read_results(spark, root, table)
        assert rows.count() > 0, table
        assert rows.count() == rows.select(*partitions, *key).distinct().count(), table
