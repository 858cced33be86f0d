"""Timelines of single metrics, folds of every kind, integration, stored results, jobs, ingestion."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from uptrail import schemas
from uptrail.config import Options
from uptrail.functions import clock
from uptrail.operators import changes, integrate, results, slots, topology
from uptrail.operators import fold as fo
from uptrail.operators.selection import METRIC
from uptrail.plans import jobs, legacy
from uptrail.sinks import store
from uptrail.sources import legacy as old, tables as src
from uptrail.sources.defaults import grid_operations
from uptrail.streaming import ingest
from workload import oracle as o
from workload.core import RATES, spans
from workload.queries import OPERATIONS, OPTIONS, plan, register, state
from workload.tables import Tables

DAY_METRIC = ["date", *METRIC]
HOST = ["date", "service", "hostname"]
K = "date, service, hostname, metric"
SLOTS = OPTIONS.slots

# -- discrete timelines ----------------------------------------------------------------------------

o.cte("m_placed", f"""
    SELECT c.date, service, hostname, metric, sec, code, {o.slot_of('sec')} AS slot, false AS carried
    FROM coded c UNION ALL
    SELECT days.date, service, hostname, metric, sec, code, -1, true
    FROM coded c JOIN days ON days.date = c.date + 1""")
o.cte("m_slots", f"""
    SELECT m.date, m.service, m.hostname, m.metric, r.i,
           coalesce(last_value(f.code IGNORE NULLS) OVER w, c.code, 3) AS code
    FROM (SELECT DISTINCT {K} FROM m_placed) m CROSS JOIN range(288) r(i)
    LEFT JOIN (SELECT {K}, slot - 1 AS i, arg_max(code, sec * 10 + code) AS code FROM m_placed
               WHERE NOT carried AND slot > 0 GROUP BY {K}, slot) f
      ON f.date = m.date AND f.service = m.service AND f.hostname = m.hostname
         AND f.metric = m.metric AND f.i = r.i
    LEFT JOIN (SELECT {K}, arg_max(code, sec * 10 + code) AS code FROM m_placed WHERE carried
               GROUP BY {K}) c
      ON c.date = m.date AND c.service = m.service AND c.hostname = m.hostname
         AND c.metric = m.metric
    WINDOW w AS (PARTITION BY m.date, m.service, m.hostname, m.metric ORDER BY r.i
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
o.cte("m_exact", f"""
    SELECT m.date, m.service, m.hostname, m.metric, r.i,
           coalesce(last_value(f.code IGNORE NULLS) OVER w, c.code, 3) AS code
    FROM (SELECT DISTINCT {K} FROM m_placed) m CROSS JOIN range(288) r(i)
    LEFT JOIN (SELECT {K}, slot AS i, arg_max(code, sec * 10 + code) AS code FROM m_placed
               WHERE NOT carried GROUP BY {K}, slot) f
      ON f.date = m.date AND f.service = m.service AND f.hostname = m.hostname
         AND f.metric = m.metric AND f.i = r.i
    LEFT JOIN (SELECT {K}, arg_max(code, sec * 10 + code) AS code FROM m_placed WHERE carried
               GROUP BY {K}) c
      ON c.date = m.date AND c.service = m.service AND c.hostname = m.hostname
         AND c.metric = m.metric
    WINDOW w AS (PARTITION BY m.date, m.service, m.hostname, m.metric ORDER BY r.i
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
o.cte("h_slots", f"""
    SELECT date, service, hostname, i, {o.fold("'AND'", 'code')} AS code FROM m_slots
    GROUP BY date, service, hostname, i""")
o.cte("h_down", """
    SELECT h.date, h.service, h.hostname, h.i,
           CASE WHEN EXISTS (SELECT 1 FROM down_days d WHERE d.date = h.date AND d.service = h.service
                AND d.hostname = h.hostname AND h.i BETWEEN d.i0 AND d.i1) THEN 5 ELSE code END AS code
    FROM h_slots h""")


def metric_spans(t: Tables, options: Options = OPTIONS) -> DataFrame:
    return slots.metric_timelines(t.metric_data(), OPERATIONS, options, *t.days)


def as_timeline(s: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals back to change rows."""
    return fo.compact(s.select(*keys, F.col("pos_from").alias("pos"), "code"), keys)


def host_timeline(t: Tables) -> DataFrame:
    changes_ = as_timeline(metric_spans(t), DAY_METRIC)
    return fo.fold(fo.moves(changes_, HOST, "metric", OPERATIONS.op_code("AND")), HOST, OPERATIONS,
                   {"AND"})


@register(o.runs("m_slots", K))
def metric_timeline(t: Tables) -> DataFrame:
    return metric_spans(t).select(*DAY_METRIC, F.col("pos_from").alias("slot_from"),
                                  F.col("pos_to").alias("slot_to"), state())


@register(o.runs("m_exact", K))
def metric_timeline_exact(t: Tables) -> DataFrame:
    return metric_spans(t, Options(align="exact")).select(
        *DAY_METRIC, F.col("pos_from").alias("slot_from"), F.col("pos_to").alias("slot_to"), state())


@register(f"""SELECT {K}, CAST(i AS INTEGER) AS pos, code, before AS prev FROM
    (SELECT *, lag(code) OVER (PARTITION BY {K} ORDER BY i) AS before FROM m_slots)
    WHERE before IS DISTINCT FROM code""")
def settle(t: Tables) -> DataFrame:
    return as_timeline(metric_spans(t), DAY_METRIC)


@register(f"""SELECT {K}, string_agg(code::VARCHAR, '' ORDER BY i) AS codes FROM m_slots GROUP BY {K}""")
def to_slots(t: Tables) -> DataFrame:
    dense = fo.to_slots(as_timeline(metric_spans(t), DAY_METRIC), DAY_METRIC, SLOTS)
    texts = F.transform("slots", lambda c: c.cast("string"))
    return dense.select(*DAY_METRIC, F.array_join(texts, "").alias("codes"))


@register(f"SELECT {K}, {RATES} FROM ({o.rates('m_slots', K)})")
def metric_ar(t: Tables) -> DataFrame:
    rates = integrate.integrate(as_timeline(metric_spans(t), DAY_METRIC), DAY_METRIC, OPERATIONS, SLOTS)
    return rates.select(*DAY_METRIC, *results.RATES)


@register(o.runs("h_slots", "date, service, hostname"))
def host_fold(t: Tables) -> DataFrame:
    return spans(host_timeline(t), HOST)


@register(o.runs("h_down", "date, service, hostname"))
def overlay(t: Tables) -> DataFrame:
    periods = slots.with_downtimes(t.downtimes(), *t.days, Options(downtimes="all"))
    covers = fo.period_moves(periods, HOST, SLOTS)
    over = fo.overlay(host_timeline(t), covers, HOST, OPERATIONS, OPERATIONS.down_code)
    return spans(over, HOST)


@register(f"""SELECT date, service, hostname, {o.name_of('code')} AS status,
                     round(100.0 * count(*) / 288, 5) AS percentage
              FROM h_slots GROUP BY date, service, hostname, code""")
def state_shares(t: Tables) -> DataFrame:
    return integrate.state_shares(host_timeline(t), HOST, OPERATIONS, SLOTS)


@register(f"""SELECT report, date, service, hostname, CAST(i // 12 AS INTEGER) AS hour, {RATES} FROM
    ({o.rates('(SELECT *, i // 12 AS hr FROM endpoint_slots)', 'report, date, service, hostname, hr')}) x,
    LATERAL (SELECT hr * 12 AS i)""")
def hourly_ar(t: Tables) -> DataFrame:
    rates = plan(t).hourly_endpoint_ar()
    return rates.select("report", "date", "service", "hostname", "hour", *results.RATES)


@register(f"""SELECT r.report, {o.date_int('r.date')} AS date, gg.grp AS supergroup,
    {o.rounded('sum(CASE WHEN availability >= 0 THEN coalesce(weight, 0) * availability ELSE 0 END)',
               'sum(CASE WHEN availability >= 0 THEN coalesce(weight, 0) ELSE 0 END)')} AS availability,
    {o.rounded('sum(CASE WHEN reliability >= 0 THEN coalesce(weight, 0) * reliability ELSE 0 END)',
               'sum(CASE WHEN reliability >= 0 THEN coalesce(weight, 0) ELSE 0 END)')} AS reliability,
    CAST(sum(coalesce(weight, 0)) AS BIGINT) AS weight
    FROM group_rates r LEFT JOIN gg ON subgroup = r.grp LEFT JOIN wt ON site = r.grp
    GROUP BY r.report, r.date, gg.grp""")
def weighted_rollup(t: Tables) -> DataFrame:
    return integrate.weighted_rollup(plan(t).group_ar(), ["report", "date", "supergroup"])


@register(f"""SELECT r.report, {o.date_int('r.date')} AS date, ancestor,
    {o.rounded('sum(CASE WHEN availability >= 0 THEN coalesce(weight, 0) * availability ELSE 0 END)',
               'sum(CASE WHEN availability >= 0 THEN coalesce(weight, 0) ELSE 0 END)')} AS availability,
    {o.rounded('sum(CASE WHEN reliability >= 0 THEN coalesce(weight, 0) * reliability ELSE 0 END)',
               'sum(CASE WHEN reliability >= 0 THEN coalesce(weight, 0) ELSE 0 END)')} AS reliability,
    CAST(sum(coalesce(weight, 0)) AS BIGINT) AS weight
    FROM group_rates r JOIN (SELECT subgroup, grp AS ancestor FROM gg UNION ALL SELECT subgroup, 'WORLD' FROM gg) a ON a.subgroup = r.grp
    LEFT JOIN wt ON site = r.grp GROUP BY r.report, r.date, ancestor""")
def weighted_rollup_tree(t: Tables) -> DataFrame:
    """Rates of every level above the groups, along the closure of the tree."""
    jobs.shared_dir(t.spark)
    closure = topology.ancestor_groups(t.group_tree())
    return integrate.weighted_rollup(topology.under_ancestors(plan(t).group_ar(), closure), ["report", "date", "ancestor"])


# -- folds of states and change lists --------------------------------------------------------------

GRID = grid_operations()
GRID_OR = "[" + ",".join(str(x) for row in GRID.tables["OR"] for x in row) + "]"


def coded(t: Tables) -> DataFrame:
    return t.metric_data().withColumn("code", OPERATIONS.state_code(F.col("status")))


@register(f"""SELECT date, service, {o.fold("'AND'", 'code')} AS worst, {o.fold("'OR'", 'code')} AS best
              FROM coded GROUP BY date, service""")
def fold_states(t: Tables) -> DataFrame:
    keys = ["date", "service"]
    worst = fo.fold_states(coded(t), keys, "hostname", "code", OPERATIONS, "AND")
    best = fo.fold_states(coded(t), keys, "hostname", "code", OPERATIONS, "OR")
    return worst.withColumnRenamed("code", "worst").join(
        best.withColumnRenamed("code", "best"), keys)


o.cte("h_changes", """
    SELECT date, service, hostname, sec AS pos,
           CASE WHEN max(code) = 4 AND min(code) < 3 THEN 5 ELSE max(code) END AS code
    FROM coded GROUP BY date, service, hostname, sec
    UNION ALL SELECT DISTINCT date, service, hostname, 43200, 5 FROM coded c
    WHERE NOT EXISTS (SELECT 1 FROM coded x WHERE x.date = c.date AND x.service = c.service
                      AND x.hostname = c.hostname AND x.sec = 43200)
    AND hostname LIKE '%1'""")


def host_changes(t: Tables) -> DataFrame:
    """Status changes of hosts over all their metrics; some hosts go down at noon."""
    one = coded(t).groupBy(*HOST, F.col("second").alias("pos")).agg(
        F.max("code").alias("hi"), F.min("code").alias("lo"))
    one = one.select(*HOST, "pos", F.expr("if(hi = 4 AND lo < 3, 5, hi)").alias("code"))
    noon = one.where("hostname LIKE '%1'").select(*HOST, F.lit(43200).alias("pos")).distinct()
    noon = noon.join(one.select(*HOST, "pos"), [*HOST, "pos"], "left_anti")
    rows = one.unionByName(noon.withColumn("code", F.lit(5)))
    return fo.compact(rows, HOST)


def points(source: str, member: str, folded: str) -> str:
    return o.points_fold(source, "date, service", member, "'AND'").replace(
        o.fold("any_value(op)", "code"), folded)


@register(points("h_changes", "hostname", o.fold("'AND'", "code")))
def fold_changes(t: Tables) -> DataFrame:
    keys = ["date", "service"]
    m = fo.moves(host_changes(t), keys, "hostname", OPERATIONS.op_code("AND"))
    return fo.fold(m, keys, OPERATIONS, {"AND"}).select(*keys, "pos", "code")


@register(points("h_changes", "hostname", f"list_reduce(list(code ORDER BY hostname), "
                                          f"lambda a, b: {GRID_OR}[a * 6 + b + 1])")
          .replace("s.code, s.op FROM", "s.code, s.op, p.hostname FROM"))
def fold_changes_ordered(t: Tables) -> DataFrame:
    keys = ["date", "service"]
    m = fo.moves(host_changes(t), keys, "hostname", GRID.op_code("OR"))
    return fo.fold(m, keys, GRID, {"OR"}).select(*keys, "pos", "code")


o.cte("mt_points", f"SELECT date, service, hostname, metric, sec AS pos, max(code) AS code FROM coded GROUP BY {K}, sec")


@register(o.points_fold("mt_points", "date, service, hostname", "metric", "'OR'"))
def align_changes(t: Tables) -> DataFrame:
    rows = coded(t).groupBy(*DAY_METRIC, F.col("second").alias("pos")).agg(F.max("code").alias("code"))
    lists = fo.compact(rows, DAY_METRIC)
    web, tx = lists.where("metric = 'm-web'"), lists.where("metric = 'm-tx'")
    return changes.align_changes(web, tx, HOST, "OR", OPERATIONS).select(*HOST, "pos", "code")


@register(f"""SELECT {K}, pos, code FROM (SELECT *, lag(code) OVER (PARTITION BY {K} ORDER BY pos) AS before
              FROM mt_points) WHERE before IS DISTINCT FROM code""")
def compact_changes(t: Tables) -> DataFrame:
    rows = coded(t).groupBy(*DAY_METRIC, F.col("second").alias("pos")).agg(F.max("code").alias("code"))
    return fo.compact(rows, DAY_METRIC).drop("prev")


o.cte("m_latest", f"""
    SELECT {K}, row_date, sec, code, status FROM
      (SELECT date, service, hostname, metric, date AS row_date, sec, code, status FROM coded UNION ALL
       SELECT days.date, service, hostname, metric, c.date, sec, code, status
       FROM coded c JOIN days ON days.date = c.date + 1)
    QUALIFY row_number() OVER (PARTITION BY {K}, CASE WHEN row_date = date THEN sec ELSE -1 END
                               ORDER BY sec DESC, code DESC) = 1""")
o.cte("m_previous", f"""
    SELECT {K}, sec, code, status, previous_state, previous_timestamp FROM
      (SELECT *, coalesce(lag(status) OVER w, 'MISSING') AS previous_state,
              coalesce(lag({o.stamp('row_date', 'sec')}) OVER w, {o.stamp('date', '0')}) AS previous_timestamp
       FROM m_latest WINDOW w AS (PARTITION BY {K} ORDER BY row_date, sec)) WHERE row_date = date""")


def metric_events(t: Tables) -> DataFrame:
    one = changes.per_second(coded(t), DAY_METRIC, OPERATIONS, OPTIONS, *t.days)
    return changes.with_previous(one, DAY_METRIC).where(F.col("pos") >= 0)


@register(f"""SELECT {K}, {o.stamp('date', 'sec')} AS "timestamp", status, previous_state,
                     previous_timestamp FROM m_previous""")
def previous_state(t: Tables) -> DataFrame:
    rows = metric_events(t)
    return rows.select(*DAY_METRIC, *[c for c in changes.status_fields(rows)][:2],
                       "previous_state", "previous_timestamp")


@register(f"""SELECT {K}, pos, code FROM (SELECT *, lag(code) OVER (PARTITION BY {K} ORDER BY pos) AS before
    FROM (SELECT {K}, CASE WHEN rn = 1 THEN 0 ELSE sec END AS pos,
                 CASE WHEN rn = 1 THEN list_position({o.NAMES}, previous_state) - 1 ELSE code END AS code
          FROM (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY sec) AS rn FROM m_previous)))
    WHERE before IS DISTINCT FROM code""")
def anchor_midnight(t: Tables) -> DataFrame:
    return changes.anchored(metric_events(t), DAY_METRIC, OPERATIONS).drop("prev")


# -- stored results --------------------------------------------------------------------------------


def daily(t: Tables, scale: int = 1) -> DataFrame:
    """Small result rows in the layout of service_ar."""
    n = (F.count("*") * scale).cast("double")
    return t.metric_data().groupBy("date", "service", "hostname").agg(n.alias("availability")).select(
        F.when(F.col("service") == "svc-0", "R1").otherwise("R2").alias("report"),
        F.expr("year(date) * 10000 + month(date) * 100 + day(date)").alias("date"),
        F.col("service").alias("name"), F.col("hostname").alias("supergroup"), "availability",
        *[F.lit(0.0).alias(c) for c in results.RATES[1:]])


o.cte("daily", f"""
    SELECT CASE WHEN service = 'svc-0' THEN 'R1' ELSE 'R2' END AS report, {o.date_int('date')} AS date,
           service AS name, hostname AS supergroup, count(*)::DOUBLE AS availability
    FROM md GROUP BY md.date, service, hostname""")
STORED = ["report", "date", "name", "supergroup", "availability"]
EVEN = "CAST(date AS INTEGER) % 2 = 0"


@register(f"""SELECT report, date, name, supergroup,
                     CASE WHEN {EVEN} THEN availability * 10 ELSE availability END AS availability FROM daily""")
def upsert_results(t: Tables) -> DataFrame:
    """All days, then the even days again with other values."""
    root = jobs.scratch(t.spark, "upsert")
    store.upsert(daily(t), root, "service_ar")
    store.upsert(daily(t, 10).where(EVEN), root, "service_ar")
    return store.read_results(t.spark, root, "service_ar").select(*STORED)


@register(f"""SELECT report, date, name, supergroup, availability FROM daily, span
    WHERE NOT (date = {o.date_int('low')}) AND NOT (date = {o.date_int('high')} AND report = 'R1')""")
def delete_results(t: Tables) -> DataFrame:
    root = jobs.scratch(t.spark, "delete")
    store.upsert(daily(t), root, "service_ar")
    low, high = (int(d.replace("-", "")) for d in t.days)
    store.delete_results(t.spark, root, "service_ar", low)
    store.delete_results(t.spark, root, "service_ar", high, "R1")
    return store.read_results(t.spark, root, "service_ar").select(*STORED)


@register(f"""SELECT report, date, name, supergroup, availability FROM daily
              UNION ALL SELECT report, date, name, supergroup, availability FROM daily WHERE {EVEN}""")
def append_results(t: Tables) -> DataFrame:
    path = jobs.scratch(t.spark, "append")
    store.append(daily(t), path, ["date"])
    store.append(daily(t).where(EVEN), path, ["date"])
    return t.spark.read.parquet(path).select(*STORED)


@register(f"""SELECT report, date, name, supergroup,
                     CASE WHEN {EVEN} THEN availability * 10 ELSE availability END AS availability FROM daily""")
def merge_rows(t: Tables) -> DataFrame:
    stored, fresh = daily(t).select(*STORED), daily(t, 10).where(EVEN).select(*STORED)
    return store.merge_rows(stored, fresh, ["report", "date", "name", "supergroup"])


@register(f"SELECT report, date, name, supergroup, availability FROM daily, span WHERE NOT (date = {o.date_int('high')} AND report = 'R2')")
def results_except(t: Tables) -> DataFrame:
    day = int(t.days[1].replace("-", ""))
    return results.results_except(daily(t), day, "R2").select(*STORED)


@register(f"SELECT count(*) AS rows FROM daily, span WHERE date = {o.date_int('low')} AND report = 'R2'")
def count_results(t: Tables) -> DataFrame:
    return results.count_results(daily(t), int(t.days[0].replace("-", "")), "R2")


@register("SELECT report, date, name, supergroup, availability FROM daily ORDER BY date, name, supergroup")
def order_results(t: Tables) -> DataFrame:
    return results.order_results(daily(t).select(*STORED), ["date", "name", "supergroup"])


@register(f"SELECT date, service, hostname, metric, \"timestamp\", status FROM md")
def metric_data_scan(t: Tables) -> DataFrame:
    """Landed by date, read back through the table reader for the whole range of days."""
    root = jobs.scratch(t.spark, "landing")
    landed = t.metric_data().drop("second").withColumn("tags", F.lit(None).cast("map<string,string>"))
    store.write_landing(landed, root)
    return src.read_metric_data(t.spark, root, *t.days).select(
        "date", *METRIC, "timestamp", "status")


ROWS_OF_TABLES = """SELECT 'metric_data' AS name, count(*) AS n, count(DISTINCT date) AS days FROM md
    UNION ALL SELECT 'endpoint_groups', count(*), 1 FROM eg UNION ALL SELECT 'group_groups', count(*), 1 FROM gg
    UNION ALL SELECT 'metric_profiles', count(*), 1 FROM mp UNION ALL SELECT 'downtimes', count(*), 1 FROM down
    UNION ALL SELECT 'weights', count(*), 1 FROM wt"""


def land_tables(t: Tables, root: str) -> DataFrame:
    """The dimensions of one report as they are ingested; returns the probe results, which are not landed yet."""
    none = F.lit(None).cast(schemas.TAGS)
    day = F.lit(t.days[0]).cast("date")
    for name, table in {"endpoint_groups": t.endpoint_groups(), "group_groups": t.group_groups(),
                        "metric_profiles": t.metric_profiles().withColumn("tags", none),
                        "downtimes": t.downtimes().select(
                            "hostname", "service", F.col("start_ts").cast("string").alias("start_time"),
                            F.col("end_ts").cast("string").alias("end_time")),
                        "weights": t.weights()}.items():
        store.write_landing(table.withColumns({"date": day, "report": F.lit("R1")}), f"{root}/{name}",
                            per_report=True)
    return t.metric_data().drop("second").withColumn("tags", none)


def rows_of_tables(t: Tables, names: list[str]) -> DataFrame:
    parts = [f"SELECT '{n.rsplit('.', 1)[-1]}' AS name, count(*) AS n, count(DISTINCT date) AS days FROM {n}" for n in names]
    return t.spark.sql(" UNION ALL ".join(parts))


@register(ROWS_OF_TABLES)
def register_tables(t: Tables) -> DataFrame:
    """All six ingested tables, by name."""
    root = jobs.scratch(t.spark, "tables")
    store.write_landing(land_tables(t, root), f"{root}/metric_data")
    return rows_of_tables(t, src.register_tables(t.spark, root))


@register(ROWS_OF_TABLES)
def catalog_tables(t: Tables) -> DataFrame:
    """The six tables of the catalog; the later days of probe results land after they were made and read."""
    root = jobs.scratch(t.spark, "catalog")
    md = land_tables(t, root)
    first = F.col("date") == F.lit(t.days[0]).cast("date")
    store.write_landing(md.where(first), f"{root}/metric_data")
    names = src.create_tables(t.spark, root, f"ingested_{uuid.uuid4().hex}")
    rows_of_tables(t, names).collect()
    store.write_landing(md.where(~first), f"{root}/metric_data")
    src.repair_tables(t.spark, names)
    return rows_of_tables(t, names)


# -- jobs ------------------------------------------------------------------------------------------


@register(f"""SELECT report, {o.date_int('date')} AS date, service AS name, grp AS supergroup, {RATES}
              FROM service_rates""")
def recompute_range(t: Tables) -> DataFrame:
    """Availability of all days and reports, stored and read back."""
    root = jobs.scratch(t.spark, "range")
    jobs.run_range(t.spark, t.metric_data(), t.reports(), OPERATIONS, root, *t.days, OPTIONS)
    return store.read_results(t.spark, root, "service_ar").select(
        "report", "date", "name", "supergroup", *results.RATES)


@register(f"""SELECT report, {o.date_int('date')} AS date_integer, grp AS endpoint_group, service,
                     {o.stamp('date', 'pos')} AS "timestamp", {o.name_of('code')} AS status
              FROM service_points""")
def run_status_range(t: Tables) -> DataFrame:
    root = jobs.scratch(t.spark, "status")
    jobs.run_status(t.spark, t.metric_data(), t.reports(), OPERATIONS, root, *t.days, OPTIONS)
    return store.read_results(t.spark, root, "status_services").select(
        "report", "date_integer", "endpoint_group", "service", "timestamp", "status")


@register(f"""SELECT r.report, {o.date_int('r.date')} AS date, r.grp AS name, gg.grp AS supergroup,
                     coalesce(weight, 0) AS weight, {RATES}
              FROM group_rates r LEFT JOIN gg ON gg.subgroup = r.grp LEFT JOIN wt ON wt.site = r.grp""")
def stored_group_ar(t: Tables) -> DataFrame:
    """Group availability of all days and reports, stored and read back."""
    root = jobs.scratch(t.spark, "range")
    jobs.run_range(t.spark, t.metric_data(), t.reports(), OPERATIONS, root, *t.days, OPTIONS)
    return store.read_results(t.spark, root, "endpoint_group_ar").select(
        "report", "date", "name", "supergroup", "weight", *results.RATES)


def stored_status(t: Tables, table: str) -> DataFrame:
    root = jobs.scratch(t.spark, "status")
    jobs.run_status(t.spark, t.metric_data(), t.reports(), OPERATIONS, root, *t.days, OPTIONS)
    return store.read_results(t.spark, root, table)


@register("SELECT * FROM status_rows")
def stored_status_metrics(t: Tables) -> DataFrame:
    return stored_status(t, "status_metrics")


@register(f"""SELECT e.report, {o.date_int('date')} AS date_integer, grp AS endpoint_group, e.service,
                     e.hostname AS host, {o.stamp('date', 'pos')} AS "timestamp",
                     {o.name_of('code')} AS status
              FROM endpoint_points e JOIN place p ON p.report = e.report AND p.service = e.service
                   AND p.hostname = e.hostname""")
def stored_status_endpoints(t: Tables) -> DataFrame:
    return stored_status(t, "status_endpoints")


@register(f"""SELECT report, {o.date_int('date')} AS date_integer, grp AS endpoint_group,
                     {o.stamp('date', 'pos')} AS "timestamp", {o.name_of('code')} AS status
              FROM group_points""")
def stored_status_groups(t: Tables) -> DataFrame:
    return stored_status(t, "status_endpoint_groups")


ODD_ID = "CASE service WHEN 'svc-0' THEN '001' WHEN 'svc-1' THEN 'eu:prod' ELSE 'a b/c' END"


@register(f"""SELECT DISTINCT {ODD_ID} AS report, {o.date_int('md.date')} AS date_integer, hostname AS endpoint_group, service
              FROM md, span WHERE md.date <> low AND NOT (md.date = high AND {ODD_ID} IN ('001', 'eu:prod', 'a b/c'))""")
def delete_status_results(t: Tables) -> DataFrame:
    """Report ids that look like numbers or need escaping in a path."""
    root = jobs.scratch(t.spark, "delete")
    rows = t.metric_data().select(
        F.expr(ODD_ID).alias("report"), clock.date_int(F.col("date")).alias("date_integer"),
        F.col("hostname").alias("endpoint_group"), "service").distinct()
    store.upsert(rows, root, "status_services")
    low, high = (int(d.replace("-", "")) for d in t.days)
    store.delete_results(t.spark, root, "status_services", low)
    for report in ("001", "eu:prod", "a b/c"):
        store.delete_results(t.spark, root, "status_services", high, report)
    return store.read_results(t.spark, root, "status_services")


FIRST_R1 = "(SELECT d0, d1 FROM req WHERE report = 'R1' AND status = 'pending' ORDER BY \"timestamp\", id LIMIT 1)"


@register(f"""SELECT report, {o.date_int('date')} AS date, service AS name, grp AS supergroup, {RATES}
              FROM service_rates, {FIRST_R1} WHERE report = 'R1' AND date BETWEEN d0 AND d1""")
def recompute_request(t: Tables) -> DataFrame:
    """The days of the oldest pending request of a report, run again with all its requests applied."""
    from uptrail.operators import requests as rq
    root = jobs.scratch(t.spark, "request")
    request = rq.next_pending(t.requests().where("report = 'R1'")).first().asDict()
    jobs.recompute(t.spark, request, t.requests(), t.metric_data(), t.report(), OPERATIONS, root)
    return store.read_results(t.spark, root, "service_ar").select(
        "report", "date", "name", "supergroup", *results.RATES)


# -- ingestion -------------------------------------------------------------------------------------


def envelopes(t: Tables) -> DataFrame:
    """One message per probe result; every 50th is unreadable."""
    body = F.to_json(F.struct("timestamp", "service", "hostname", "metric", "status",
                              "monitoring_host", "summary", "message"))
    envelope = F.to_json(F.struct(
        F.struct(F.lit("metric_data").alias("type"), F.col("date").cast("string").alias("partition_date"))
        .alias("attributes"), F.base64(body.cast("binary")).alias("data")))
    return t.metric_data("event_id").select(
        F.when(F.col("event_id") % 50 == 7, F.concat(F.lit("broken "), F.col("event_id")))
        .otherwise(envelope).alias("value"))


def landed(t: Tables) -> DataFrame:
    root = jobs.scratch(t.spark, "ingest")
    envelopes(t).write.text(f"{root}/in")
    stream = ingest.decode_envelope(ingest.read_envelopes(t.spark, f"{root}/in"), "schemas/")
    ingest.land_stream(stream, f"{root}/out", f"{root}/state", once=True).awaitTermination()
    return t.spark.read.option("basePath", f"{root}/out").schema(
        "raw string, body string, schema_url string, type string, date string").parquet(f"{root}/out")


@register("SELECT m.date, m.service, m.hostname, m.metric, m.\"timestamp\", m.status, m.message "
          "FROM (SELECT md.*, event_id FROM (SELECT *, row_number() OVER () AS n FROM md) md "
          "JOIN (SELECT event_id, row_number() OVER () AS n FROM hosts) e ON e.n = md.n) m "
          "WHERE event_id % 50 <> 7")
def ingest_landing(t: Tables) -> DataFrame:
    """Envelopes streamed to dated directories, then read as typed rows."""
    return ingest.payload_rows(landed(t), "metric_data").select(
        "date", *METRIC, "timestamp", "status", "message")


@register("SELECT concat('broken ', event_id) AS raw FROM events WHERE event_id % 50 = 7")
def ingest_rejected(t: Tables) -> DataFrame:
    return ingest.rejected(landed(t))


@register("""SELECT 'schemas/metric_data.avsc' AS schema_url, 'metric_data' AS attr_type,
                    strftime(CAST(ts AS DATE), '%Y-%m-%d') AS attr_partition_date, count(*) AS messages
             FROM events WHERE event_id % 50 <> 7 GROUP BY ALL""")
def decode_envelope(t: Tables) -> DataFrame:
    decoded = ingest.decode_envelope(envelopes(t), "schemas/").where("body IS NOT NULL")
    return decoded.groupBy("schema_url", F.col("headers")["attr_type"].alias("attr_type"),
                           F.col("headers")["attr_partition_date"].alias("attr_partition_date")).agg(
        F.count("*").alias("messages"))


# -- older reports ---------------------------------------------------------------------------------

o.cte("l_rows", """
    SELECT md.*, concat('vo-', user_id % 4) AS vo, concat('ROC_', h % 5) AS roc FROM
    (SELECT *, row_number() OVER () AS n FROM coded) md
    JOIN (SELECT user_id, h, row_number() OVER () AS n FROM hosts) e ON e.n = md.n""")
o.cte("l_sites", """
    SELECT concat('host-', h) AS hostname, concat('svc-', h % 3) AS service,
           CASE WHEN h % 11 = 0 THEN 'N' ELSE 'Y' END AS production, concat('NATION_', h % 5) AS site,
           concat('ROC_', h % 5) AS ngi FROM usr""")
o.cte("l_members", f"""
    SELECT DISTINCT m.date, m.service, m.hostname, mp.metric
    FROM (SELECT DISTINCT date, service, hostname FROM m_placed) m
    JOIN mp ON profile = 'P1' AND mp.service = m.service""")
o.cte("l_hosts", f"""
    SELECT f.date, f.service, f.hostname, f.i,
           CASE WHEN d.date IS NOT NULL AND f.i BETWEEN d.i0 AND d.i1 THEN 5 ELSE f.code END AS code
    FROM (SELECT date, service, hostname, i, {o.fold("'AND'", 'code')} AS code FROM
            (SELECT m.date, m.service, m.hostname, r.i, coalesce(s.code, 3) AS code
             FROM l_members m CROSS JOIN range(288) r(i) LEFT JOIN m_slots s ON s.date = m.date
                  AND s.service = m.service AND s.hostname = m.hostname AND s.metric = m.metric
                  AND s.i = r.i)
          GROUP BY date, service, hostname, i) f
    LEFT JOIN first_down d ON d.date = f.date AND d.service = f.service AND d.hostname = f.hostname""")
o.cte("l_vo", """
    SELECT DISTINCT days.date, service, hostname, vo FROM l_rows
    JOIN days ON days.date = l_rows.date OR days.date = l_rows.date + 1""")


def rates3(source: str, keys: str) -> str:
    three = lambda part, whole: o.rounded(part, whole, "100.0").replace(", 5)", ", 3)")
    return f"""
    SELECT {keys}, count(*) FILTER (code IN (0, 1)) AS n_up, count(*) FILTER (code IN (2, 3)) AS n_unk,
           count(*) FILTER (code = 5) AS n_down, count(*) AS n, n - n_unk AS n_known,
           n - n_unk - n_down AS n_rel, {three('n_up', 'n_known')} AS availability,
           {three('n_up', 'n_rel')} AS reliability, {o.rounded('n_up', 'n')} AS up,
           {o.rounded('n_unk', 'n')} AS unknown, {o.rounded('n_down', 'n')} AS downtime
    FROM {source} GROUP BY {keys}"""


def ladder(prefix: str, source: str, keys: str) -> None:
    """Hosts to flavours, to availability groups, to a total, over dense slots."""
    o.cte(f"{prefix}_flavour", f"""
        SELECT {keys}, service, i, {o.fold("'OR'", 'code')} AS code FROM {source}
        GROUP BY {keys}, service, i""")
    o.cte(f"{prefix}_ag", f"""
        SELECT {keys}, ag, i, {o.fold('any_value(group_op)', 'code')} AS code FROM {prefix}_flavour f
        JOIN ap ON report = 'R1' AND ap.service = f.service GROUP BY {keys}, ag, i""")
    o.cte(f"{prefix}_total", f"""
        SELECT {keys}, i, {o.fold("'AND'", 'code')} AS code FROM {prefix}_ag GROUP BY {keys}, i""")


o.cte("l_topo", """SELECT h.*, site, production, ngi FROM l_hosts h
    JOIN l_sites s ON s.hostname = h.hostname AND s.service = h.service""")
o.cte("l_by_vo", """SELECT h.*, vo FROM l_hosts h JOIN l_vo v ON v.date = h.date
    AND v.service = h.service AND v.hostname = h.hostname""")
ladder("ls", "l_topo", "date, site, production, ngi")
ladder("lv", "l_by_vo", "date, vo")
FIXED = """'P1' AS profile, 'Y' AS monitored, 'grid' AS scope, 'Production' AS infrastructure,
           'Certified' AS certification_status, 'grid' AS site_scope"""
LRATES = "availability, reliability, up, unknown, downtime"


def timetables(t: Tables) -> DataFrame:
    return legacy.host_timetables(t.legacy_logs(), t.legacy_checks(), t.downtimes(), OPERATIONS, *t.days)


@register(o.runs("l_hosts", "date, service, hostname").replace("SELECT date, service, hostname,",
          "SELECT date, service AS service_flavour, hostname, 'P1' AS profile,", 1))
def legacy_host_timetable(t: Tables) -> DataFrame:
    return spans(timetables(t), legacy.HOST)


@register(f"SELECT date, site, production, ngi, {FIXED}, service AS service_flavour, {LRATES} FROM "
          f"({rates3('ls_flavour', 'date, site, production, ngi, service')})")
def legacy_flavour_ar(t: Tables) -> DataFrame:
    return legacy.flavour_ar(legacy.add_topology(timetables(t), t.sites()), OPERATIONS)


@register(f"""SELECT date, x.site, production, ngi, {FIXED}, 'ap1' AS availability_profile, {LRATES},
                     coalesce(weight, 0) AS weight
              FROM ({rates3('ls_total', 'date, site, production, ngi')}) x
              LEFT JOIN wt ON wt.site = x.site""")
def legacy_site_ar(t: Tables) -> DataFrame:
    return legacy.site_ar(legacy.add_topology(timetables(t), t.sites()), t.legacy_mapping(),
                          t.weights(), OPERATIONS)


@register(f"""SELECT date, vo, 'P1' AS profile, 'ap1' AS availability_profile, {LRATES}
              FROM ({rates3('lv_total', 'date, vo')})""")
def legacy_vo_ar(t: Tables) -> DataFrame:
    vos = legacy.host_vos(t.legacy_logs(), *t.days)
    return legacy.vo_ar(timetables(t), vos, t.legacy_mapping(), OPERATIONS)


@register(f"""SELECT date, service AS service_flavour, hostname, 'P1' AS profile,
                     {o.name_of('code')} AS status, round(100.0 * count(*) / 288, 5) AS percentage
              FROM l_hosts GROUP BY date, service, hostname, code""")
def legacy_timeline_percent(t: Tables) -> DataFrame:
    return legacy.timeline_percent(timetables(t), OPERATIONS)


@register("SELECT date, service AS service_flavour, hostname, 'P1' AS profile, vo FROM l_vo")
def legacy_host_vos(t: Tables) -> DataFrame:
    return legacy.host_vos(t.legacy_logs(), *t.days)


@register("SELECT hostname AS h, service AS srv, site AS st, ngi AS roc FROM l_sites")
def legacy_sites_scan(t: Tables) -> DataFrame:
    path = jobs.scratch(t.spark, "sites")
    t.sites().select(*schemas.LEGACY_SITES.names).write.option("sep", old.SEPARATOR).csv(path)
    return old.read_sites(t.spark, path)


@register("""SELECT "timestamp" AS time_stamp, metric, service AS service_flavour, hostname, status, vo,
                    concat('/', vo, '/Role=NULL') AS vofqan, 'P1' AS profile FROM l_rows""")
def legacy_delimited_logs(t: Tables) -> DataFrame:
    path = jobs.scratch(t.spark, "logs")
    logs = t.legacy_logs().select(*schemas.LEGACY_LOG.names)
    logs.write.option("sep", old.SEPARATOR).csv(path)
    return old.read_delimited_logs(t.spark, path)


@register(f"""SELECT "timestamp" AS time_stamp, hostname, status, strftime(date, '%Y%m%d') AS dates
              FROM l_rows, span WHERE date = high""")
def legacy_raw_data(t: Tables) -> DataFrame:
    logs = t.legacy_logs().withColumn("dates", F.date_format("date", "yyyyMMdd"))
    day = t.days[1].replace("-", "")
    return old.read_raw_data(logs, day, t.metric_profiles().select("profile").distinct()).select(
        "time_stamp", "hostname", "status", "dates")


@register(f"""SELECT "timestamp" AS ts, roc, monitoring_host AS mb, metric AS mn, service AS sf,
                     hostname AS sh, status AS s, vo, concat('/', vo, '/Role=NULL') AS vof,
                     summary AS sum, {o.date_int('date')} AS di,
                     CAST(hour(t) * 10000 + minute(t) * 100 + second(t) AS INTEGER) AS ti FROM l_rows""")
def legacy_detail_log(t: Tables) -> DataFrame:
    return old.detail_short(t.legacy_detail()).drop("msg")


@register("SELECT DISTINCT 'P1' AS profile, service AS service_flavour, metric FROM md")
def legacy_profiles(t: Tables) -> DataFrame:
    return old.trim_profiles(t.legacy_logs())


LKEY = "date, vo, monitoring_host, roc, service, hostname, metric"
o.cte("l_detail", f"""
    SELECT {LKEY}, row_date, "timestamp", sec, status, summary, message FROM
      (SELECT *, date AS row_date FROM (SELECT * FROM l_rows) UNION ALL
       SELECT l.* REPLACE (days.date AS date), l.date AS row_date FROM l_rows l
       JOIN days ON days.date = l.date + 1)
    QUALIFY row_number() OVER (PARTITION BY {LKEY}, CASE WHEN row_date = date THEN sec ELSE -1 END
                               ORDER BY "timestamp" DESC, status DESC, summary DESC, message DESC) = 1""")
o.cte("l_status", f"""
    SELECT d.*, site FROM (SELECT *, coalesce(lag(status) OVER w, 'MISSING') AS prevstate,
             coalesce(lag("timestamp") OVER w, {o.stamp('date', '0')}) AS prevts
      FROM l_detail WINDOW w AS (PARTITION BY {LKEY} ORDER BY row_date, sec)) d
    JOIN l_sites s ON s.hostname = d.hostname AND s.service = d.service WHERE row_date = date""")


@register(f"""SELECT vo, concat('/', vo, '/Role=NULL') AS vof, monitoring_host AS mb, roc, site,
                     service AS srv, hostname AS h, metric AS m, "timestamp" AS ts, status AS s,
                     summary AS sum, message AS msg, prevstate AS ps, prevts AS pts,
                     {o.date_int('date')} AS di,
                     CAST(sec // 3600 * 10000 + sec % 3600 // 60 * 100 + sec % 60 AS INTEGER) AS ti
              FROM l_status""")
def legacy_status_metrics(t: Tables) -> DataFrame:
    return legacy.status_short(legacy.previous_state(t.legacy_detail(), t.sites(), *t.days))


o.cte("l_points", f"""
    SELECT {o.date_int('date')} AS date_int, roc, site, service, hostname,
           concat(vo, '/', monitoring_host, '/', metric) AS member,
           CASE WHEN rn = 1 THEN 0 ELSE sec END AS pos,
           list_position({o.NAMES}, CASE WHEN rn = 1 THEN prevstate ELSE status END) - 1 AS code
    FROM (SELECT *, row_number() OVER (PARTITION BY {LKEY} ORDER BY sec) AS rn FROM l_status)""")
o.cte("l_endpoint_points", o.points_fold("l_points", "date_int, roc, site, service, hostname", "member", "'AND'"))
o.cte("l_service_points", o.points_fold("l_endpoint_points", "date_int, roc, site, service", "hostname", "'OR'"))
o.cte("l_site_points", o.points_fold("l_service_points", "date_int, roc, site", "service", "'AND'"))


def levels(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = legacy.previous_state(t.legacy_detail(), t.sites(), *t.days)
    return legacy.status_levels(rows, OPERATIONS)


@register("SELECT * FROM l_endpoint_points")
def legacy_status_endpoints(t: Tables) -> DataFrame:
    return levels(t)[0].drop("prev")


@register("SELECT * FROM l_service_points")
def legacy_status_services(t: Tables) -> DataFrame:
    return levels(t)[1].drop("prev")


@register("SELECT * FROM l_site_points")
def legacy_status_sites(t: Tables) -> DataFrame:
    return levels(t)[2].drop("prev")


# -- choices ---------------------------------------------------------------------------------------


@register(f"""SELECT report, date, service, hostname, metric FROM (
    SELECT DISTINCT s.report, days.date, s.service, s.hostname, checks.metric FROM sel s
    JOIN checks ON checks.report = s.report AND checks.service = s.service, days)""")
def seed_members_selected(t: Tables) -> DataFrame:
    from uptrail.plans import dimensions, rows
    options = Options(scope="selected")
    dims = dimensions.build(t.spark, t.reports(), *t.days, options)
    return rows.expected(dims, options)


@register("SELECT * FROM members")
def seed_members(t: Tables) -> DataFrame:
    from uptrail.plans import dimensions, rows
    dims = dimensions.build(t.spark, t.reports(), *t.days, OPTIONS)
    return rows.expected(dims, OPTIONS)
