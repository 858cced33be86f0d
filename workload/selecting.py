"""Scans, filters, joins with dimensions, row generators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from uptrail.config import profile_frame, truth_frame
from uptrail.functions import clock
from uptrail.functions.tags import tag
from uptrail.operators import changes, requests as rq, selection as sel, slots, topology
from uptrail.operators.fold import period_moves
from uptrail.plans import jobs
from uptrail.sources import snapshots, tables as src
from workload import oracle as o
from workload.queries import OPERATIONS, OPTIONS, register
from workload.tables import PROFILE_1, REPORT_1, Tables

MD = 'service, hostname, metric, "timestamp", status, monitoring_host'
TEXTS = f"{MD}, summary, message"


def own(t: Tables, kind: str, report: str = "R1") -> DataFrame:
    exclusions = getattr(rq, f"{kind}_exclusions")(t.requests())
    return exclusions.where(F.col("report") == report)


def profile(t: Tables) -> DataFrame:
    return profile_frame(t.spark, PROFILE_1)


def checks(t: Tables) -> DataFrame:
    return t.metric_profiles().where("profile = 'P1'")


# -- scans -----------------------------------------------------------------------------------------


@register(f"SELECT {TEXTS} FROM md")
def trim_metric_data(t: Tables) -> DataFrame:
    return sel.trim_metric_data(t.metric_data(), text=True)


@register("""SELECT "type", grp AS "group", service, hostname, production, monitored FROM eg""")
def endpoint_groups_scan(t: Tables) -> DataFrame:
    eg = src.text_tags(t.endpoint_groups())
    return eg.select("type", "group", "service", "hostname",
                     tag(F.col("tags"), "production").alias("production"),
                     tag(F.col("tags"), "monitored").alias("monitored"))


@register("""SELECT "type", grp AS "group", subgroup, certification FROM gg""")
def group_groups_scan(t: Tables) -> DataFrame:
    return t.group_groups().select("type", "group", "subgroup",
                                   tag(F.col("tags"), "certification").alias("certification"))


@register("""SELECT "type", grp AS "group", service, hostname,
                    (production IS NOT NULL) AS has_production,
                    CASE WHEN production IS NULL THEN 0 ELSE 1 END
                    + CASE WHEN monitored IS NULL THEN 0 ELSE 1 END AS n_tags FROM eg""")
def tag_functions(t: Tables) -> DataFrame:
    return t.endpoint_groups().select(
        "type", "group", "service", "hostname",
        F.map_contains_key("tags", "production").alias("has_production"),
        F.size("tags").alias("n_tags"))


@register("""SELECT hostname, service, strftime(s, '%Y-%m-%dT%H:%M:%SZ') AS start_text,
                    s AS start_ts, e AS end_ts FROM down""")
def downtimes_scan(t: Tables) -> DataFrame:
    d = t.downtimes()
    text = lambda c: clock.format_ts(F.to_date(c), clock.second_of(F.col(c)))
    stored = d.select("hostname", "service", text("start_ts").alias("start_text"),
                      text("start_ts").alias("start_time"), text("end_ts").alias("end_time"))
    return src.parse_downtimes(stored)


@register("""SELECT site, weight FROM wt""")
def weights_scan(t: Tables) -> DataFrame:
    return t.weights().select("site", F.col("weight").cast("int").alias("weight"))


@register(f"""SELECT "timestamp", t AS ts, date AS ts_date, sec, {o.date_int('date')} AS date_integer,
                     CAST(hour(t) * 10000 + minute(t) * 100 + second(t) AS INTEGER) AS time_integer,
                     {o.stamp('date', '0')} AS midnight, CAST(date - 1 AS DATE) AS previous_day,
                     {o.stamp('date', 'sec')} AS again FROM coded""")
def timestamp_functions(t: Tables) -> DataFrame:
    ts = F.col("timestamp")
    day, second = clock.text_date(ts), clock.seconds_of_day(ts)
    return t.metric_data().select(
        "timestamp", clock.parse_ts(ts).alias("ts"), day.alias("ts_date"), second.alias("sec"),
        clock.date_text_int(F.substring(ts, 1, 10)).alias("date_integer"),
        clock.time_int(second).alias("time_integer"), clock.midnight(day).alias("midnight"),
        clock.day_before(day).alias("previous_day"), clock.format_ts(day, second).alias("again"))


@register(f"SELECT \"timestamp\", {o.slot_of('sec')} AS slot FROM coded")
def ts_slot(t: Tables) -> DataFrame:
    second = clock.seconds_of_day(F.col("timestamp"))
    return t.metric_data().select("timestamp", clock.ts_slot(second).alias("slot"))


@register("SELECT id, CAST(unnest(generate_series(d0::TIMESTAMP, d1::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date FROM req")
def date_range(t: Tables) -> DataFrame:
    low, high = (clock.text_date(F.col(c)) for c in ("start_time", "end_time"))
    return t.requests().select("id", F.explode(clock.day_range(low, high)).alias("date"))


@register("SELECT \"timestamp\", status, code, status AS again FROM coded")
def state_codes(t: Tables) -> DataFrame:
    code = OPERATIONS.state_code(F.col("status"))
    return t.metric_data().select("timestamp", "status", code.alias("code"),
                                  OPERATIONS.state_name(code).alias("again"))


SNAPSHOT_DAYS = "date_diff('day', (SELECT low FROM span), date) % 5 <> 4"
SNAPSHOTS = f"""(SELECT DISTINCT date, service, hostname FROM md WHERE {SNAPSHOT_DAYS})"""


def topology_snapshots(t: Tables) -> DataFrame:
    """Endpoints seen each day; every fifth day has no snapshot."""
    low = F.lit(t.days[0]).cast("date")
    return (t.metric_data().select("date", "service", "hostname").distinct()
            .where(F.datediff("date", low) % 5 != 4))


def snapshot_sql(back: int, day: str) -> str:
    return f"""SELECT s.service, s.hostname FROM {SNAPSHOTS} s WHERE s.date =
        (SELECT max(x.date) FROM {SNAPSHOTS} x, span WHERE x.date BETWEEN {day} - {back} AND {day})"""


@register(snapshot_sql(3, "span.high"))
def latest_snapshot(t: Tables) -> DataFrame:
    return snapshots.latest_snapshot(topology_snapshots(t), t.days[1])


@register(snapshot_sql(1, "span.high"))
def latest_snapshot_one_day_back(t: Tables) -> DataFrame:
    return snapshots.latest_snapshot(topology_snapshots(t), t.days[1], max_back=1)


@register(f"""SELECT days.date, s.service, s.hostname FROM days JOIN {SNAPSHOTS} s ON s.date =
        (SELECT max(x.date) FROM {SNAPSHOTS} x WHERE x.date BETWEEN days.date - 3 AND days.date)""")
def snapshots_per_day(t: Tables) -> DataFrame:
    return snapshots.snapshots_for(topology_snapshots(t), *t.days)


# -- selection -------------------------------------------------------------------------------------

IN_AP = "EXISTS (SELECT 1 FROM ap WHERE ap.report = 'R1' AND ap.service = m.service)"
IN_MP = """EXISTS (SELECT 1 FROM mp WHERE profile = 'P1' AND mp.service = m.service
                   AND mp.metric = m.metric)"""
NOT_MON = """NOT EXISTS (SELECT 1 FROM mexcl x WHERE x.report = 'R1' AND x.host = m.monitoring_host
                         AND m.t BETWEEN x.s AND x.e)"""
IN_SEL = """EXISTS (SELECT 1 FROM sel WHERE report = 'R1' AND sel.service = m.service
                    AND sel.hostname = m.hostname)"""


@register(f"SELECT {MD} FROM md m WHERE {IN_AP} AND {IN_MP} AND {NOT_MON} AND {IN_SEL}")
def pick_endpoints(t: Tables) -> DataFrame:
    return sel.pick_endpoints(
        sel.trim_metric_data(t.metric_data()), t.endpoint_groups(), t.group_groups(), checks(t),
        profile(t), "SITES", own(t, "monitor"), REPORT_1.egroup_tags, REPORT_1.ggroup_tags)


@register(f"SELECT {MD} FROM md m WHERE {IN_SEL}")
def pick_endpoints_loose(t: Tables) -> DataFrame:
    return sel.pick_endpoints(
        sel.trim_metric_data(t.metric_data()), t.endpoint_groups(), t.group_groups(), checks(t),
        profile(t), "SITES", own(t, "monitor"), REPORT_1.egroup_tags, REPORT_1.ggroup_tags,
        strict=False)


@register(f"SELECT {MD} FROM md m WHERE {NOT_MON}")
def exclude_monitoring(t: Tables) -> DataFrame:
    return sel.exclude_monitoring(sel.trim_metric_data(t.metric_data()), own(t, "monitor"))


@register(f"""SELECT "type", grp AS "group", service, hostname FROM eg m WHERE {IN_AP}""")
def semi_availability(t: Tables) -> DataFrame:
    return sel.semi_availability(t.endpoint_groups(), profile(t)).drop("tags")


@register(f"SELECT {MD} FROM md m WHERE EXISTS (SELECT 1 FROM mp WHERE profile = 'P2' AND mp.service = m.service AND mp.metric = m.metric)")
def semi_metric_profile(t: Tables) -> DataFrame:
    p2 = t.metric_profiles().where("profile = 'P2'")
    return sel.semi_metric_profile(sel.trim_metric_data(t.metric_data()), p2)


@register(f"""SELECT {MD} FROM md m WHERE EXISTS (SELECT 1 FROM eg WHERE eg.service = m.service
              AND eg.hostname = m.hostname AND coalesce(production, '0') = '0')""")
def semi_topology(t: Tables) -> DataFrame:
    eg = sel.filter_endpoint_tags(t.endpoint_groups(), {"production": "N"})
    return sel.semi_topology(sel.trim_metric_data(t.metric_data()), eg)


@register("""SELECT "type", grp AS "group", service, hostname FROM eg WHERE "type" = 'SITES'
             AND EXISTS (SELECT 1 FROM gg WHERE subgroup = eg.grp AND certification = 'Certified')""")
def endpoints_in_groups(t: Tables) -> DataFrame:
    gg = sel.filter_group_tags(t.group_groups(), {"certification": "CERTIFIED"})
    return sel.endpoints_in_groups(t.endpoint_groups(), gg, "SITES").drop("tags")


@register("""SELECT "type", grp AS "group", service, hostname FROM eg
             WHERE coalesce(production, '1') = '1' AND coalesce(monitored, '1') = '1'""")
def filter_endpoint_tags(t: Tables) -> DataFrame:
    wanted = {"production": "Y", "monitored": "y", "absent": "anything"}
    return sel.filter_endpoint_tags(t.endpoint_groups(), wanted).drop("tags")


@register("""SELECT "type", grp AS "group", subgroup FROM gg WHERE certification = 'Certified'""")
def filter_group_tags(t: Tables) -> DataFrame:
    return sel.filter_group_tags(t.group_groups(), {"certification": "certified"}).drop("tags")


@register(f"""SELECT date, service, hostname, metric, max("timestamp") AS "timestamp",
                     max_by(status, ("timestamp", status, monitoring_host)) AS status,
                     max_by(monitoring_host, ("timestamp", status, monitoring_host)) AS monitoring_host
              FROM md GROUP BY date, service, hostname, metric""")
def latest_state(t: Tables) -> DataFrame:
    md = t.metric_data().select("date", *sel.METRIC, "timestamp", "status", "monitoring_host")
    return sel.latest_state(md)


LATEST = """(SELECT CAST(date + 1 AS DATE) AS date, service, hostname, metric, max("timestamp") AS "timestamp",
                    max_by(status, ("timestamp", status)) AS status
             FROM md GROUP BY date, service, hostname, metric)"""


@register(f"""SELECT date, service, hostname, metric, "timestamp", status FROM md
              UNION ALL SELECT * FROM {LATEST}""")
def with_carry_in(t: Tables) -> DataFrame:
    md = t.metric_data().select("date", *sel.METRIC, "timestamp", "status")
    latest = sel.latest_state(md).withColumn("date", F.date_add("date", 1))
    return sel.with_carry_in(md, latest)


EXPECTED = """(SELECT DISTINCT eg.service, hostname, mp.metric FROM eg
               JOIN mp ON profile = 'P1' AND mp.service = eg.service)"""


@register(f"SELECT * FROM {EXPECTED}")
def expected_metrics(t: Tables) -> DataFrame:
    return sel.expected_metrics(t.endpoint_groups(), checks(t))


def missing(t: Tables) -> DataFrame:
    daily = t.endpoint_groups().withColumn("date", F.explode(F.sequence(
        *(F.lit(d).cast("date") for d in t.days))))
    expected = sel.expected_metrics(daily, checks(t), ["date"])
    observed = t.metric_data().select("date", *sel.METRIC).distinct()
    return sel.missing_items(expected, observed, ["date"])


MISSING = f"""(SELECT date, service, hostname, metric FROM {EXPECTED}, days
               EXCEPT SELECT date, service, hostname, metric FROM md)"""


@register(f"SELECT * FROM {MISSING}")
def missing_items(t: Tables) -> DataFrame:
    return missing(t)


MISSING_ROWS = f"""SELECT 'R1' AS report, 'none' AS monitoring_host, service, hostname, metric,
    {o.stamp('date', '0')} AS "timestamp", 'MISSING' AS status, 'missing' AS summary,
    'missing' AS message FROM {MISSING}"""


@register(MISSING_ROWS)
def missing_rows(t: Tables) -> DataFrame:
    return sel.missing_rows(missing(t), "R1")


@register(f"SELECT {TEXTS} FROM md UNION ALL SELECT {TEXTS} FROM ({MISSING_ROWS})")
def with_missing(t: Tables) -> DataFrame:
    md = sel.trim_metric_data(t.metric_data(), text=True)
    return sel.with_missing(md, sel.missing_rows(missing(t), "R1"))


@register("SELECT DISTINCT service, hostname, metric FROM md")
def observed_metrics(t: Tables) -> DataFrame:
    return t.metric_data().select(*sel.METRIC).distinct()


@register("""SELECT DISTINCT service, hostname, status FROM md""")
def dedupe_rows(t: Tables) -> DataFrame:
    return sel.dedupe_rows(t.metric_data().select("service", "hostname", "status"))


@register("""SELECT "type", grp AS "group", service, hostname FROM eg UNION ALL
             SELECT "type", grp, 'svc-1v2', hostname FROM eg WHERE service = 'svc-1'""")
def alias_services(t: Tables) -> DataFrame:
    aliases = F.lit("svc-1").alias("service"), F.lit("svc-1v2").alias("alias")
    eg = t.endpoint_groups().drop("tags")
    return sel.alias_services(eg, t.spark.range(1).select(*aliases))


# -- topology --------------------------------------------------------------------------------------


@register("""SELECT m.service, m.hostname, metric, status, "timestamp", grp AS "group"
             FROM md m JOIN (SELECT DISTINCT service, hostname, grp FROM eg WHERE "type" = 'SITES') g
             ON g.service = m.service AND g.hostname = m.hostname""")
def add_groups(t: Tables) -> DataFrame:
    md = t.metric_data().select(*sel.METRIC, "status", "timestamp")
    return topology.add_groups(md, t.endpoint_groups(), "SITES")


@register("""SELECT eg.service, hostname, grp AS "group", svc_op, ag AS ag_group, group_op, total_op,
                    metric_op FROM eg JOIN ap ON report = 'R1' AND ap.service = eg.service""")
def with_ops(t: Tables) -> DataFrame:
    return topology.with_ops(t.endpoint_groups().select("service", "hostname", "group"), profile(t))


@register("""SELECT service, hostname, grp AS "group" FROM eg
             WHERE service NOT IN (SELECT service FROM ap)""")
def outside_profile(t: Tables) -> DataFrame:
    return topology.outside_profile(t.endpoint_groups().select("service", "hostname", "group"),
                                    profile(t))


def group_names(t: Tables) -> DataFrame:
    return t.endpoint_groups().select("group").distinct()


@register("""SELECT e.grp AS "group", min(gg.grp) AS supergroup
             FROM (SELECT DISTINCT grp FROM eg) e LEFT JOIN gg ON subgroup = e.grp GROUP BY e.grp""")
def with_supergroup(t: Tables) -> DataFrame:
    return topology.with_supergroup(group_names(t), t.group_groups(), "NGI")


@register("""SELECT e.grp AS "group", coalesce(weight, 0) AS weight
             FROM (SELECT DISTINCT grp FROM eg) e LEFT JOIN wt ON site = e.grp""")
def with_weight(t: Tables) -> DataFrame:
    return topology.with_weight(group_names(t), t.weights(), "hepspec")


def spans_of(covers: DataFrame, keys: list[str]) -> DataFrame:
    return covers.select(*keys, F.col("pos_from").alias("slot_from"), F.col("pos_to").alias("slot_to"))


@register("SELECT date, service, hostname, i0 AS slot_from, i1 AS slot_to FROM first_down")
def with_downtimes(t: Tables) -> DataFrame:
    return spans_of(slots.with_downtimes(t.downtimes(), *t.days, OPTIONS),
                    ["date", "service", "hostname"])


@register("SELECT date, service, hostname, i0 AS slot_from, i1 AS slot_to FROM down_days")
def with_downtimes_all(t: Tables) -> DataFrame:
    from uptrail.config import Options
    return spans_of(slots.with_downtimes(t.downtimes(), *t.days, Options(downtimes="all")),
                    ["date", "service", "hostname"])


@register("""SELECT report, date, grp AS "group", i0 AS slot_from, i1 AS slot_to FROM excl_days""")
def with_recomputations(t: Tables) -> DataFrame:
    spans = slots.day_spans(rq.group_exclusions(t.requests()), *t.days, OPTIONS)
    return spans_of(spans, ["report", "date", "group"])


@register("""SELECT date, service, hostname, i AS pos, CAST(sum(c) AS INTEGER) AS cover FROM
             (SELECT date, service, hostname, i0 AS i, 1 AS c FROM down_days UNION ALL
              SELECT date, service, hostname, i1 + 1, -1 FROM down_days WHERE i1 < 287)
             GROUP BY date, service, hostname, i""")
def period_moves_of_downtimes(t: Tables) -> DataFrame:
    from uptrail.config import Options
    keys = ["date", "service", "hostname"]
    spans = slots.with_downtimes(t.downtimes(), *t.days, Options(downtimes="all"))
    return (period_moves(spans, keys, OPTIONS.slots).groupBy(*keys, "pos")
            .agg(F.sum("cover").cast("int").alias("cover")))


PAIRS = """(SELECT date, service, hostname, max(code) FILTER (metric = 'm-web') AS a,
                   max(code) FILTER (metric = 'm-tx') AS b FROM coded GROUP BY ALL)"""


@register(f"""SELECT date, service, hostname, a, b,
                     {o.AND_STATE}[greatest({o.AND_RANK}[a + 1], {o.AND_RANK}[b + 1]) + 1] AS a_and_b,
                     {o.OR_STATE}[greatest({o.OR_RANK}[a + 1], {o.OR_RANK}[b + 1]) + 1] AS a_or_b
              FROM {PAIRS} WHERE a IS NOT NULL AND b IS NOT NULL""")
def apply_op(t: Tables) -> DataFrame:
    code = OPERATIONS.state_code(F.col("status"))
    of = lambda m: F.max(F.when(F.col("metric") == m, code))
    pairs = (t.metric_data().groupBy("date", "service", "hostname")
             .agg(of("m-web").alias("a"), of("m-tx").alias("b")).dropna())
    a, b = F.col("a"), F.col("b")
    return pairs.withColumns({"a_and_b": OPERATIONS.apply_op("AND", a, b),
                              "a_or_b": OPERATIONS.apply_op("OR", a, b)})


@register(f"""SELECT date, service, hostname,
                     {o.NAMES}[{o.AND_STATE}[greatest({o.AND_RANK}[a + 1], {o.AND_RANK}[b + 1]) + 1] + 1] AS x
              FROM {PAIRS} WHERE a IS NOT NULL AND b IS NOT NULL""")
def apply_op_by_table(t: Tables) -> DataFrame:
    code = OPERATIONS.state_code(F.col("status"))
    of = lambda m: OPERATIONS.state_name(F.max(F.when(F.col("metric") == m, code)))
    pairs = (t.metric_data().groupBy("date", "service", "hostname")
             .agg(of("m-web").alias("a"), of("m-tx").alias("b")).dropna())
    table = truth_frame(t.spark, OPERATIONS).where("op = 'AND'")
    return pairs.join(table, ["a", "b"]).select("date", "service", "hostname", "x")


@register("SELECT DISTINCT profile, mp.service, hostname FROM mp JOIN eg ON eg.service = mp.service")
def profile_services(t: Tables) -> DataFrame:
    services = topology.profile_services(t.metric_profiles())
    hosts = t.endpoint_groups().select("service", "hostname").distinct()
    return services.join(hosts, "service")


@register("""SELECT hostname, e.service, array_to_string(list_sort(list(metric)), ',') AS metrics
             FROM (SELECT DISTINCT service, hostname FROM eg) e
             JOIN mp ON profile = 'P1' AND mp.service = e.service GROUP BY hostname, e.service""")
def service_metrics(t: Tables) -> DataFrame:
    hosts = t.endpoint_groups().select("service", "hostname").distinct()
    listed = topology.service_metrics(checks(t)).join(hosts, "service")
    return listed.select("hostname", "service", F.array_join("metrics", ",").alias("metrics"))


@register("""SELECT DISTINCT e.hostname, ag AS ag_group, services FROM eg e
             JOIN ap ON report = 'R1' AND ap.service = e.service JOIN
             (SELECT ag AS g, array_to_string(list_sort(list(service)), ',') AS services FROM ap
              WHERE report = 'R1' GROUP BY ag) ON g = ag""")
def group_services(t: Tables) -> DataFrame:
    services = topology.group_services(profile(t)).select(
        "ag_group", F.array_join("services", ",").alias("services"))
    hosts = topology.with_ops(t.endpoint_groups().select("service", "hostname").distinct(), profile(t))
    return hosts.join(services, "ag_group").select("hostname", "ag_group", "services").distinct()


@register("""SELECT service, hostname, min(production) AS production FROM eg
             WHERE "type" = 'SITES' AND production IS NOT NULL GROUP BY service, hostname""")
def group_tags(t: Tables) -> DataFrame:
    sites = t.endpoint_groups().where("type = 'SITES'")
    tags = topology.group_tags(sites, ["service", "hostname"])
    wanted = F.filter("tags", lambda e: e["key"] == "production")[0]["value"]
    return (tags.where(F.exists("tags", lambda e: e["key"] == "production"))
            .select("service", "hostname", wanted.alias("production")))


TREE = """(SELECT n_name AS child, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT r_name, 'WORLD' FROM region)"""


@register(f"""WITH RECURSIVE up(g, ancestor, depth) AS (
    SELECT child, parent, 1 FROM {TREE}
    UNION ALL SELECT g, parent, depth + 1 FROM up JOIN {TREE} ON child = ancestor )
    SELECT g AS "group", ancestor, min(depth) AS depth FROM up GROUP BY g, ancestor""")
def ancestor_groups(t: Tables) -> DataFrame:
    jobs.shared_dir(t.spark)
    return topology.ancestor_groups(t.group_tree())


# -- requests --------------------------------------------------------------------------------------


@register("""SELECT report, grp AS "group", s AS start_ts, e AS end_ts FROM gexcl""")
def group_exclusions(t: Tables) -> DataFrame:
    return rq.group_exclusions(t.requests())


@register("""SELECT report, host AS monitoring_host, s AS start_ts, e AS end_ts FROM mexcl""")
def monitor_exclusions(t: Tables) -> DataFrame:
    return rq.monitor_exclusions(t.requests()).drop("from_date", "to_date")


@register("SELECT id, report, status FROM req, span WHERE high BETWEEN d0 AND d1")
def recomputations_for_date(t: Tables) -> DataFrame:
    return rq.covering(t.requests(), t.days[1]).select("id", "report", "status")


@register("SELECT id, report, status FROM req, span WHERE high BETWEEN d0 AND d1 AND report = 'R2'")
def select_recomputations(t: Tables) -> DataFrame:
    return rq.select_recomputations(t.requests(), "R2", t.days[1]).select("id", "report", "status")


@register("SELECT status, count(*) AS requests FROM req GROUP BY status")
def recomputation_counts(t: Tables) -> DataFrame:
    return rq.recomputation_counts(t.requests())


@register("""SELECT id, report, "timestamp" FROM req WHERE status = 'pending'
             ORDER BY "timestamp", id LIMIT 1""")
def next_pending(t: Tables) -> DataFrame:
    return rq.next_pending(t.requests()).select("id", "report", "timestamp")


@register("""SELECT id, CASE WHEN id = 'req-0' THEN 'running' ELSE status END AS status,
                    CASE WHEN id = 'req-0' THEN '2024-02-02 00:00:00' ELSE "timestamp" END AS "timestamp"
             FROM req""")
def mark_request(t: Tables) -> DataFrame:
    marked = rq.mark_request(t.requests(), "req-0", "running", "2024-02-02 00:00:00")
    return marked.select("id", "status", "timestamp")


# -- as-of -----------------------------------------------------------------------------------------


@register("""SELECT p.service, p.date, p.pos, c.code FROM
    (SELECT DISTINCT service, date, CAST(sec // 600 * 600 AS INTEGER) AS pos FROM coded) p
    LEFT JOIN LATERAL (SELECT arg_max(code, sec * 10 + code) AS code FROM coded c
        WHERE c.service = p.service AND c.date = p.date AND c.sec <= p.pos) c ON true""")
def asof_state(t: Tables) -> DataFrame:
    code = OPERATIONS.state_code(F.col("status"))
    md = t.metric_data()
    rows = md.groupBy("service", "date", F.col("second").alias("pos")).agg(F.max(code).alias("code"))
    points = md.select("service", "date", (F.floor(F.col("second") / 600) * 600).cast("int").alias("pos"))
    return changes.asof_state(points, rows, ["service", "date"])


@register("""SELECT DISTINCT eg.service, hostname, grp AS groups, metric AS metrics FROM eg
             JOIN mp ON profile = 'P1' AND mp.service = eg.service WHERE "type" = 'SITES'""")
def flatten2(t: Tables) -> DataFrame:
    """Sites and metrics of each endpoint as two arrays, flattened one after the other."""
    sites = t.endpoint_groups().where("type = 'SITES'").groupBy("service", "hostname").agg(
        F.collect_set("group").alias("groups"))
    bags = sites.join(topology.service_metrics(checks(t)).drop("profile"), "service")
    return sel.flatten2(bags, "groups", "metrics")


@register(f"SELECT s.service, s.hostname FROM {SNAPSHOTS} s WHERE s.date = (SELECT max(x.date) FROM {SNAPSHOTS} x)")
def newest_snapshot(t: Tables) -> DataFrame:
    return snapshots.newest_snapshot(topology_snapshots(t))
