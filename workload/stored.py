"""Jobs from documents and ingested tables on disk, and whole days stored and read back."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from uptrail import schemas
from uptrail.functions import clock
from uptrail.operators import results
from uptrail.plans import jobs, legacy, refresh
from uptrail.sinks import store
from uptrail.sources import documents, legacy as old, tables as src
from uptrail.sources.defaults import TENANT_ORDERS
from workload import oracle as o
from workload.core import RATES
from workload.queries import OPERATIONS, OPTIONS, register
from workload.tables import PROFILE_1, REPORT_1, Tables


def write_document(t: Tables, path: str, document: dict) -> None:
    t.spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(path)


def operations_document() -> dict:
    """The state algebra of the other queries, each unordered pair once."""
    states = list(OPERATIONS.states)
    cells = {op: [{"A": a, "B": b, "X": max(a, b, key=order.index)} for i, a in enumerate(states) for b in states[i:]]
             for op, order in TENANT_ORDERS.items()}
    return {"states": states, "default_down": OPERATIONS.down, "default_missing": OPERATIONS.missing,
            "default_unknown": OPERATIONS.unknown, "operations": cells}


def job_folder(t: Tables, name: str) -> str:
    """Documents and tables of report R1, the tables as snapshots of the first day; rows of another report stand
    beside them."""
    root = jobs.scratch(t.spark, name)
    write_document(t, f"{root}/operations.json", operations_document())
    r, p = REPORT_1, PROFILE_1
    write_document(t, f"{root}/reports/R1.json", {
        "id": r.id, "tenant": r.tenant, "job": r.job, "egroup": r.egroup, "ggroup": r.ggroup, "weight": r.weight,
        "egroup_tags": r.egroup_tags, "ggroup_tags": r.ggroup_tags})
    write_document(t, f"{root}/profiles/R1.json", {
        "name": p.name, "namespace": p.namespace, "metric_profile": p.metric_profile, "metric_ops": p.metric_op,
        "group_type": p.group_type, "operation": p.total_op,
        "groups": {g: {"services": services, "operation": op} for g, (op, services) in p.groups.items()}})
    part = F.pmod(F.xxhash64("id"), F.lit(8)).alias("part")
    requests = t.requests().groupBy(part).agg(F.to_json(F.collect_list(F.struct(*t.requests().columns))).alias("value"))
    requests.write.partitionBy("part").text(f"{root}/recomputations")
    day = F.lit(t.days[0]).cast("date")
    none = F.lit(None).cast(schemas.TAGS)
    for table, df in {"endpoint_groups": t.endpoint_groups(), "group_groups": t.group_groups(),
                      "metric_profiles": t.metric_profiles().withColumn("tags", none),
                      "downtimes": t.downtimes(), "weights": t.weights()}.items():
        if table == "downtimes":  # every day lists all of them
            stamp = lambda c: clock.format_ts(F.to_date(c), clock.second_of(F.col(c)))
            df = df.select("hostname", "service", stamp("start_ts").alias("start_time"), stamp("end_ts").alias("end_time"))
        df = df.withColumn("date", day)
        other = df.limit(0) if table == "downtimes" else df.where(F.col(df.columns[1]) < "O")
        store.write_landing(df.withColumn("report", F.lit("R1")).unionByName(other.withColumn("report", F.lit("X"))),
                            f"{root}/tables/{table}", per_report=True)
    landed = t.metric_data().drop("second").withColumn("tags", none)
    store.write_landing(landed, f"{root}/tables/metric_data")
    return root


@register(f"""SELECT report, {o.date_int('date')} AS date, service AS name, grp AS supergroup, {RATES}
              FROM service_rates, span WHERE report = 'R1' AND date <= low + 2""")
def service_ar_from_documents(t: Tables) -> DataFrame:
    """The first three days of a report whose settings, algebra, requests and tables are all read from files."""
    root = job_folder(t, "documents")
    operations = documents.read_operations(t.spark, f"{root}/operations.json")
    report = documents.report_inputs(t.spark, root, "R1", operations)
    last = clock.shift(t.days[0], 2)
    md = src.read_metric_data(t.spark, f"{root}/tables/metric_data", t.days[0], last)
    jobs.run_range(t.spark, md, [report], operations, f"{root}/results", t.days[0], last, OPTIONS)
    return store.read_results(t.spark, f"{root}/results", "service_ar").select(
        "report", "date", "name", "supergroup", *results.RATES)


def second_day(t: Tables, name: str) -> str:
    root = jobs.scratch(t.spark, name)
    jobs.run_day(t.spark, t.metric_data(), t.reports(), OPERATIONS, root, clock.shift(t.days[0], 1), OPTIONS)
    return root


@register(f"""SELECT r.report, {o.date_int('r.date')} AS date, r.grp AS name, gg.grp AS supergroup,
                     coalesce(weight, 0) AS weight, {RATES}
              FROM span, group_rates r LEFT JOIN gg ON gg.subgroup = r.grp LEFT JOIN wt ON wt.site = r.grp WHERE r.date = low + 1""")
def run_day_group_ar(t: Tables) -> DataFrame:
    """One day of all reports, availability and status, stored; the rates read back."""
    return store.read_results(t.spark, second_day(t, "day"), "endpoint_group_ar").select(
        "report", "date", "name", "supergroup", "weight", *results.RATES)


@register(f"""SELECT report, {o.date_int('date')} AS date_integer, grp AS endpoint_group,
                     {o.stamp('date', 'pos')} AS "timestamp", {o.name_of('code')} AS status
              FROM group_points, span WHERE date = low + 1""")
def run_day_status_groups(t: Tables) -> DataFrame:
    """The same day; the status of groups read back."""
    return store.read_results(t.spark, second_day(t, "day"), "status_endpoint_groups").select(
        "report", "date_integer", "endpoint_group", "timestamp", "status")


@register("""SELECT 'endpoint_groups' AS name, count(*) AS rows FROM eg UNION ALL SELECT 'group_groups', count(*) FROM gg
             UNION ALL SELECT 'metric_profiles', count(*) FROM mp UNION ALL SELECT 'downtimes', count(*) FROM down
             UNION ALL SELECT 'weights', count(*) FROM wt UNION ALL SELECT 'recomputations', count(*) FROM req""")
def dimension_readers(t: Tables) -> DataFrame:
    """How many rows each reader finds of report R1."""
    root = job_folder(t, "readers")
    report = documents.report_inputs(t.spark, root, "R1", OPERATIONS)
    tables = {"endpoint_groups": report.endpoint_groups, "group_groups": report.group_groups, "metric_profiles": report.metric_profiles,
              "downtimes": report.downtimes, "weights": report.weights}
    counts = [df.where("report = 'R1'").agg(F.lit(name).alias("name"), F.count("*").alias("rows")) for name, df in tables.items()]
    counts.append(src.read_recomputations(t.spark, f"{root}/recomputations").agg(F.lit("recomputations").alias("name"), F.count("*").alias("rows")))
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out


# -- results that follow the day ------------------------------------------------------------------

o.variant("plain_", mexcl="SELECT report, host, d0::TIMESTAMP AS s, d0::TIMESTAMP AS e, d0, d1 FROM req WHERE false")


def refreshed(t: Tables) -> str:
    """Probe results land as files of two shares of the events and come back as a stream, a file at a time;
    each batch is laid over the state of the first four days."""
    root = jobs.scratch(t.spark, "refresh")
    md = t.metric_data("event_id").where(F.col("date") <= F.date_add(F.lit(t.days[0]).cast("date"), 3)).drop("second")
    for i, share in enumerate((F.col("event_id") % 10 < 9, F.col("event_id") % 10 == 9)):
        md.where(share).drop("event_id").coalesce(1).write.mode("append").parquet(f"{root}/in")
    reports = [replace(r, monitor_exclusions=None) for r in t.reports()]
    stream = t.spark.readStream.schema(t.spark.read.parquet(f"{root}/in").schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    run = refresh.on_batch(reports, OPERATIONS, f"{root}/out", t.days[0], clock.shift(t.days[0], 3), OPTIONS)
    stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/offsets").trigger(availableNow=True).start().awaitTermination()
    return f"{root}/out"


@register(f"""SELECT r.report, {o.date_int('r.date')} AS date, r.grp AS name, gg.grp AS supergroup,
                     coalesce(weight, 0) AS weight, {RATES}
              FROM span, plain_group_rates r LEFT JOIN gg ON gg.subgroup = r.grp LEFT JOIN wt ON wt.site = r.grp WHERE r.date <= low + 3""")
def refresh_group_ar(t: Tables) -> DataFrame:
    return store.read_results(t.spark, refreshed(t), "endpoint_group_ar").select(
        "report", "date", "name", "supergroup", "weight", *results.RATES)


@register(f"""SELECT report, {o.date_int('date')} AS date, service AS name, grp AS supergroup, {RATES}
              FROM plain_service_rates, span WHERE date <= low + 3""")
def refresh_service_ar(t: Tables) -> DataFrame:
    return store.read_results(t.spark, refreshed(t), "service_ar").select(
        "report", "date", "name", "supergroup", *results.RATES)


# -- older logs: readers, parts of a log, rows without a ROC ----------------------------------------


@register(f"""SELECT "timestamp" AS ts, roc, monitoring_host AS mb, metric AS mn, service AS sf, hostname AS sh, status AS s, vo,
                     concat('/', vo, '/Role=NULL') AS vof, summary AS sum, message AS msg, {o.date_int('date')} AS di,
                     CAST(hour(t) * 10000 + minute(t) * 100 + second(t) AS INTEGER) AS ti FROM l_rows""")
def legacy_detail_reader(t: Tables) -> DataFrame:
    """The detail log written with its separators and read back, all columns."""
    path = jobs.scratch(t.spark, "detail")
    columns = [F.coalesce(F.col(c), F.lit("")) for c in schemas.LEGACY_DETAIL.names]
    t.legacy_detail().select(F.concat_ws(old.SEPARATOR, *columns)).write.text(path)
    return old.read_detail_log(t.spark, path)


@register("SELECT * FROM l_endpoint_points WHERE CAST(substr(hostname, 6) AS BIGINT) % 7 <> 3")
def legacy_status_without_roc(t: Tables) -> DataFrame:
    """Hosts whose rows have an empty ROC are left out."""
    log = t.legacy_detail()
    blank = F.expr("CAST(substr(hostname, 6) AS BIGINT) % 7 = 3")
    rows = legacy.previous_state(log.withColumn("roc", F.when(blank, "").otherwise(F.col("roc"))), t.sites(), *t.days)
    return legacy.status_levels(rows, OPERATIONS)[0].drop("prev")


@register("SELECT date::VARCHAR AS date, vo, hostname, service AS service_flavour, 'P1' AS profile FROM l_vo")
def legacy_united_logs(t: Tables) -> DataFrame:
    """The log of the last day united with the days before."""
    logs = t.legacy_logs()
    today = F.col("date") == F.lit(t.days[1]).cast("date")
    both = legacy.union_logs(logs.where(today), logs.where(~today))
    return legacy.host_vos(both, *t.days).withColumn("date", F.col("date").cast("string"))
