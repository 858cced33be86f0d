"""What the plans must not do at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tests.test_plans import D, P, Fixture
from uptrail.plans.availability import availability
from uptrail.plans.status import status
from uptrail.sources.defaults import tenant_operations


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fx(spark):
    return Fixture(spark, tenant_operations(), 1)


def test_no_nested_loops_and_no_python(spark, fx):
    a = availability(spark, fx.md, [fx.report], fx.ops, P, D)
    s = status(spark, fx.md, [fx.report], fx.ops, P, D)
    for df in (a.service_ar(), a.group_ar(), s.status_metrics(), s.status_groups()):
        plan = text(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "Python" not in plan and "Pandas" not in plan


def test_rows_are_combined_before_the_first_shuffle(spark, fx, tmp_path):
    path = str(tmp_path / "md")
    fx.md.write.partitionBy("date").parquet(path)
    md = spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")  # nothing but inline tables is small
    try:
        plan = text(availability(spark, md, [fx.report], fx.ops, D).service_ar())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert re.search(r"PartitionFilters: \[[^\]]*date", plan)
    scan = re.search(r"ReadSchema: struct<([^>]*timestamp[^>]*)>", plan).group(1)
    assert "summary" not in scan and "message" not in scan
    assert "partial_max" in plan


def test_one_hot_metric(spark):
    """A third of a million rows of one metric fold to at most 288 rows before they are sorted."""
    fx = Fixture(spark, tenant_operations(), 2)
    service, host, _ = fx.topology[0]
    hot = spark.range(300_000).select(
        F.concat(F.lit(f"{D}T"), F.lpad((F.col("id") % 24).cast("string"), 2, "0"), F.lit(":"),
                 F.lpad((F.col("id") % 60).cast("string"), 2, "0"), F.lit(":00Z")).alias("timestamp"),
        F.lit(service).alias("service"), F.lit(host).alias("hostname"), F.lit("m1").alias("metric"),
        F.lit("OK").alias("status"), F.lit("mon").alias("monitoring_host"), F.lit("s").alias("summary"),
        F.lit("m").alias("message"), F.lit(D).cast("date").alias("date"))
    from uptrail.config import Options
    from uptrail.operators import slots
    from uptrail.operators.selection import with_time
    rows = with_time(hot).withColumn("code", F.lit(0))
    keys = ["date", "service", "hostname", "metric"]
    assert slots.slot_states(rows, keys, fx.ops, Options(), D, D).count() <= 288
    a = availability(spark, fx.md.unionByName(hot), [fx.report], fx.ops, D)
    assert a.service_ar().count() == availability(spark, fx.md, [fx.report], fx.ops, D).service_ar().count()


def counted(df):
    plan = text(df)
    return len(re.findall(r"FileScan|LocalTableScan|Scan ExistingRDD", plan)), len(re.findall(r"Exchange ", plan))


def test_as_many_scans_and_shuffles_for_eight_reports_as_for_one(spark, fx):
    from dataclasses import replace
    many = [replace(fx.report, config=replace(fx.report.config, id=f"R{i}", egroup_tags={"production": "YN"[i % 2]},
                                              ggroup_tags={"certification": f"c{i % 3}"} if i % 4 else {})) for i in range(8)]
    for build in (lambda r: availability(spark, fx.md, r, fx.ops, P, D).service_ar(),
                  lambda r: availability(spark, fx.md, r, fx.ops, P, D).group_ar(),
                  lambda r: status(spark, fx.md, r, fx.ops, P, D).status_groups()):
        assert counted(build(many)) == counted(build(many[:1]))


def test_status_timelines_are_folded_without_texts_and_sorts(spark, fx, tmp_path):
    path = str(tmp_path / "md")
    fx.md.write.partitionBy("date").parquet(path)
    s = status(spark, spark.read.parquet(path), [fx.report], fx.ops, P, D)
    for df in (s.status_endpoints(), s.status_services(), s.status_groups()):
        plan = text(df)
        assert "SortAggregate" not in plan and "message" not in plan and "summary" not in plan


def test_rows_of_other_endpoints_go_before_days_multiply_them(spark, fx):
    for df in (status(spark, fx.md, [fx.report], fx.ops, P, D).metrics, availability(spark, fx.md, [fx.report], fx.ops, P, D).endpoints):
        assert re.search(r"Join \[(?=[^\]]*report#)(?=[^\]]*hostname#)(?![^\]]*date#)[^\n]*LeftSemi", text(df))


def test_rows_with_texts_are_dealt_once_after_their_reduction(spark, fx):
    """The state of a second is found where the rows of the endpoint's day are anyway."""
    plan = text(status(spark, fx.md, [fx.report], fx.ops, P, D).metrics)
    assert not re.search(r"hashpartitioning\(report#\d+[^)]*, pos#", plan)


def test_endpoints_are_distinct_before_days_multiply_them(spark, fx):
    from uptrail.config import Options
    from uptrail.plans import dimensions, rows
    dims = dimensions.build(spark, [fx.report], P, D, Options())
    plan = text(rows.expected(dims, Options()))
    assert "Aggregate" not in plan[:plan.index("Generate explode")]


def test_excluded_hosts_meet_reduced_rows_only(spark, fx, tmp_path):
    """Without broadcasts, raw rows reach the first aggregate before they are dealt by anything."""
    path = str(tmp_path / "md")
    fx.md.write.partitionBy("date").parquet(path)
    from dataclasses import replace
    x = spark.sql(f"""SELECT '{fx.report.config.id}' AS report, 'mon' AS monitoring_host, TIMESTAMP_NTZ '{D} 01:00:00' AS start_ts,
                      TIMESTAMP_NTZ '{D} 02:00:30' AS end_ts, DATE '{D}' AS from_date, DATE '{D}' AS to_date""")
    x.write.parquet(str(tmp_path / "x"))
    report = replace(fx.report, monitor_exclusions=spark.read.parquet(str(tmp_path / "x")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = text(availability(spark, spark.read.parquet(path), [report], fx.ops, D).service_ar())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    at = plan.index(str(tmp_path / "md").replace("/", "/"))
    above = plan[:plan.rindex("FileScan", 0, at)].splitlines()
    first = next(line for line in reversed(above) if "Exchange " in line or "HashAggregate" in line)
    assert "partial_max" in first
    assert "monitoring_host" in first
