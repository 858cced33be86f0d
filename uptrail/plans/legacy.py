"""The older reports: host timetables, site, VO and service-flavour rates, detailed status.

Their rules are those of the current jobs under other keys: metrics are folded with AND, hosts of a
flavour with OR, and an availability profile combines flavours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from uptrail.config import Options
from uptrail.functions import clock
from uptrail.functions.truth import Operations
from uptrail.operators import integrate, slots
from uptrail.operators.fold import fold, intervals, moves, period_moves, spread
from uptrail.operators.selection import with_time

HOST = ["date", "hostname", "service_flavour", "profile"]
SITE = ["date", "site", "profile", "production", "monitored", "scope", "ngi", "infrastructure",
        "certification_status", "site_scope"]
METRIC_OP, HOST_OP = "AND", "OR"
DETAIL_KEY = ["vo", "vo_fqan", "monitoring_box", "roc", "service_type", "hostname", "metric"]


def union_logs(current: DataFrame, beacons: DataFrame) -> DataFrame:
    """Logs of the day with those of the day before."""
    return current.unionByName(beacons)


def host_timetables(logs: DataFrame, checks: DataFrame, downtimes: DataFrame | None,
                    operations: Operations, first: str, last: str,
                    options: Options = Options()) -> DataFrame:
    """Timeline per day, host, flavour and profile (keys, pos, code, prev).

    ``checks`` has profile, service_flavour, metric: the metrics a profile calls for. Hosts are those
    with a log row on the day or the day before. Downtimes act on the flavours of these profiles. The log is
    read once: a reduced row brings the seeds of its host with it, which combine in the task of the host.
    """
    rows = with_time(logs.withColumnRenamed("time_stamp", "timestamp"))
    rows = rows.withColumn("code", operations.state_code(F.col("status")))
    key = [*HOST, "metric"]
    missing = slots.pack(F.lit(0), F.lit(operations.missing_code), operations)
    called = (checks.select("profile", "service_flavour", "metric").distinct()
              .groupBy("profile", "service_flavour").agg(F.collect_list("metric").alias("_called")))
    reduced = slots.latest(rows, key, operations, options).join(called, ["profile", "service_flavour"], "left")
    placed = slots.on_days(spread(reduced, ["hostname", "service_flavour"]), options, first, last)
    placed = placed.withColumn("packed", slots.without_effect(operations))
    # a row brings the seeds of its own metric and of all that the profile calls for
    names = F.array_union(F.coalesce("_called", F.array().cast("array<string>")), F.array("metric"))
    entry = F.struct(F.col("metric"), F.col("pos"), F.col("packed"))
    seeds = F.transform(names, lambda m: F.struct(m.alias("metric"), F.lit(slots.SEED).alias("pos"), missing.alias("packed")))
    everything = placed.select(*HOST, F.explode(F.concat(F.array(entry), seeds)).alias("_e")).select(*HOST, "_e.*")
    everything = everything.groupBy(*key, "pos").agg(F.max("packed").alias("packed")).withColumn("cover", F.lit(0))
    if downtimes is not None:
        spans = slots.with_downtimes(downtimes, first, last, options)
        spans = spans.withColumnRenamed("service", "service_flavour")
        covered = spans.join(checks.select("profile", "service_flavour").distinct(), "service_flavour")
        covers = period_moves(covered, HOST, options.slots).select(
            *HOST, F.lit(None).cast("string").alias("metric"), "pos",
            F.lit(None).cast("int").alias("packed"), "cover")
        everything = everything.unionByName(covers)
    changes = slots.settle(spread(everything, HOST), key, operations, options).select(
        *HOST, F.col("metric").alias("member"), operations.op_code(METRIC_OP).alias("op"), "pos",
        "new", "old", "cover")
    return fold(changes, HOST, operations, {METRIC_OP}, cover_code=operations.down_code)


def host_vos(logs: DataFrame, first: str, last: str) -> DataFrame:
    """(date, hostname, service_flavour, profile, vo), each once, for the day and the day before."""
    rows = with_time(logs.withColumnRenamed("time_stamp", "timestamp"))
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    days = F.explode(F.array(F.col("date"), F.date_add("date", 1)))
    return (rows.select("hostname", "service_flavour", "profile", "vo", days.alias("date"))
            .where(F.col("date").between(low, high)).select(*HOST, "vo").distinct())


def add_topology(timetables: DataFrame, sites: DataFrame) -> DataFrame:
    """Timetables with the topology columns of their host; hosts without any are dropped."""
    columns = sites.select(
        "hostname", F.col("service").alias("service_flavour"), "site", "production", "monitored",
        "scope", F.col("roc").alias("ngi"), "infrastructure",
        F.col("certification").alias("certification_status"), "site_scope").distinct()
    return timetables.join(columns, ["hostname", "service_flavour"])


def add_availability_profiles(topologed: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row per availability profile of the flavour; rows without one are dropped.

    ``mapping`` has profile, availability_profile, service_flavour, ag_group, group_op, total_op.
    """
    return topologed.join(mapping, ["profile", "service_flavour"])


def rates3(timeline: DataFrame, keys: list[str], operations: Operations, slots_: int) -> DataFrame:
    """Rates in the older rounding: percentages on three digits, fractions on five."""
    lengths = integrate.state_lengths(intervals(timeline, keys, slots_), keys, operations)
    known = F.col("n_total") - F.col("n_unknown")

    def percent(part: F.Column, whole: F.Column) -> F.Column:
        return F.coalesce(F.round(F.when(whole != 0, F.lit(100.0) * part / whole), 3), F.lit(-1.0))

    total = F.col("n_total")
    return lengths.select(
        *keys, percent(F.col("n_up"), known).alias("availability"),
        percent(F.col("n_up"), known - F.col("n_down")).alias("reliability"),
        integrate.ratio(F.col("n_up"), total).alias("up"),
        integrate.ratio(F.col("n_unknown"), total).alias("unknown"),
        integrate.ratio(F.col("n_down"), total).alias("downtime"))


def flavour_ar(topologed: DataFrame, operations: Operations, options: Options = Options()) -> DataFrame:
    """Rates per site and service flavour: hosts folded with OR."""
    keys = [*SITE, "service_flavour"]
    rows = fold(moves(topologed, keys, "hostname", operations.op_code(HOST_OP)), keys, operations,
                {HOST_OP})
    return rates3(rows, keys, operations, options.slots)


def _profile_rates(rows: DataFrame, keys: list[str], operations: Operations, ops: set[str],
                   options: Options) -> DataFrame:
    """Hosts to flavours, flavours to availability groups, these to one timeline per key."""
    flavour = [*keys, "group_op", "total_op", "ag_group", "service_flavour"]
    by_flavour = fold(moves(rows, flavour, "hostname", operations.op_code(HOST_OP)), flavour,
                      operations, {HOST_OP}, place=keys)
    group = [*keys, "total_op", "ag_group"]
    by_group = fold(moves(by_flavour, group, "service_flavour",
                          operations.op_code(F.col("group_op"))), group, operations, ops, place=keys)
    total = fold(moves(by_group, keys, "ag_group", operations.op_code(F.col("total_op"))), keys,
                 operations, ops, place=keys)
    return rates3(total, keys, operations, options.slots)


def site_ar(topologed: DataFrame, mapping: DataFrame, weights: DataFrame, operations: Operations,
            options: Options = Options()) -> DataFrame:
    """Rates per site and availability profile, with the site's weight (0 if none)."""
    keys = [*SITE, "availability_profile"]
    rows = add_availability_profiles(topologed, mapping)
    rates = _profile_rates(rows, keys, operations, set(operations.tables), options)
    first = weights.groupBy("site").agg(F.min(F.col("weight").cast("int")).alias("weight"))
    return (rates.join(first, "site", "left")
            .withColumn("weight", F.coalesce("weight", F.lit(0))))


def vo_ar(timetables: DataFrame, vos: DataFrame, mapping: DataFrame, operations: Operations,
          options: Options = Options()) -> DataFrame:
    """Rates per virtual organisation: every host counts for each of its VOs."""
    keys = ["vo", "profile", "availability_profile", "date"]
    rows = add_availability_profiles(timetables.join(vos, HOST), mapping)
    return _profile_rates(rows, keys, operations, set(operations.tables), options)


def timeline_percent(timetables: DataFrame, operations: Operations,
                     options: Options = Options()) -> DataFrame:
    """Share of each state in each host timetable."""
    return integrate.state_shares(timetables, HOST, operations, options.slots)


# -- detailed status -------------------------------------------------------------------------------


def previous_state(log: DataFrame, sites: DataFrame, first: str, last: str) -> DataFrame:
    """Detail rows with previous state and timestamp per metric, the site name, and integers.

    The latest row of the day before only serves as a previous state. Of several rows in one second
    the one highest by status, then texts, is kept.
    """
    rows = with_time(log)
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    entries = F.explode(F.array(
        F.struct(F.col("date").alias("date"), F.col("second").alias("pos")),
        F.struct(F.date_add("date", 1).alias("date"), F.lit(slots.CARRY).alias("pos"))))
    placed = (rows.withColumn("entry", entries).select(
        *DETAIL_KEY, "entry.date", "entry.pos", "timestamp", "status", "summary", "message", "second")
        .where(F.col("date").between(low, high)))
    key = ["date", *DETAIL_KEY]
    latest = F.max(F.struct("timestamp", "second", "status", "summary", "message")).alias("r")
    one = placed.groupBy(*key, "pos").agg(latest).select(*key, "pos", "r.*")
    w = Window.partitionBy(*key).orderBy("pos")
    known = one.withColumns({
        "prevstate": F.coalesce(F.lag("status").over(w), F.lit("MISSING")),
        "prevts": F.coalesce(F.lag("timestamp").over(w), clock.midnight(F.col("date")))})
    places = sites.select("hostname", F.col("service").alias("service_type"), "site").distinct()
    return (known.where(F.col("pos") >= 0).join(places, ["hostname", "service_type"])
            .select("vo", "vo_fqan", "monitoring_box", "roc", "site",
                    F.col("service_type").alias("service"), "hostname", "metric", "timestamp",
                    "status", "summary", "message", "prevstate", "prevts",
                    clock.date_int(F.col("date")).alias("date_int"),
                    clock.time_int(F.col("second")).alias("time_int")))


def status_short(rows: DataFrame) -> DataFrame:
    """Detailed status under the short stored names, ordered by place, metric and time."""
    ordered = rows.orderBy("roc", "site", "service", "hostname", "metric", "timestamp")
    names = {"vo": "vo", "vof": "vo_fqan", "mb": "monitoring_box", "roc": "roc", "site": "site",
             "srv": "service", "h": "hostname", "m": "metric", "ts": "timestamp", "s": "status",
             "sum": "summary", "msg": "message", "ps": "prevstate", "pts": "prevts",
             "di": "date_int", "ti": "time_int"}
    return ordered.select(*[F.col(long).alias(short) for short, long in names.items()])


def status_levels(rows: DataFrame, operations: Operations) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Endpoint, service and site status changes folded from detailed status rows.

    Rows without a ROC are left out. Each gives keys, date_int, pos, code, prev.
    """
    usable = rows.where(F.col("roc") != "")
    endpoint = ["date_int", "roc", "site", "service", "hostname"]
    member = F.to_json(F.array("vo", "vo_fqan", "monitoring_box", "metric"))  # no two members are alike
    w = Window.partitionBy(*endpoint, "member").orderBy("time_int")
    seconds = clock.seconds_of_day(F.col("timestamp"))
    events = usable.withColumn("member", member).withColumn(
        "is_first", F.row_number().over(w) == 1)
    points = events.select(
        *endpoint, "member", F.when(F.col("is_first"), 0).otherwise(seconds).alias("pos"),
        operations.state_code(F.when(F.col("is_first"), F.col("prevstate"))
                              .otherwise(F.col("status"))).alias("code"))
    before = F.lag("code").over(Window.partitionBy(*endpoint, "member").orderBy("pos"))
    points = points.withColumn("prev", before)
    endpoints = fold(moves(points, endpoint, "member", operations.op_code(METRIC_OP)), endpoint,
                     operations, {METRIC_OP})
    service = endpoint[:-1]
    services = fold(moves(endpoints, service, "hostname", operations.op_code(HOST_OP)), service,
                    operations, {HOST_OP})
    site = service[:-1]
    sites = fold(moves(services, site, "service", operations.op_code(METRIC_OP)), site,
                 operations, {METRIC_OP})
    return endpoints, services, sites
