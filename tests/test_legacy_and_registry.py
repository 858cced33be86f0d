from pyspark.sql import functions as F

import __spark_entry__ as entry
from workload import load
from uptrail.plans import legacy
from uptrail.sources.defaults import tenant_operations

OPS = tenant_operations()


def test_flavour_rates_rounding(spark):
    """One flavour is down for six slots of the day; percentages have three digits."""
    rows = [("h1", "CE", 0, 0, None), ("h2", "STORE", 0, 0, None), ("h2", "STORE", 100, 4, 0),
            ("h2", "STORE", 106, 0, 4), ("h3", "INFO", 0, 0, None)]
    df = spark.createDataFrame(rows, "hostname string, service_flavour string, pos int, code int, prev int")
    site = {c: F.lit("x") for c in legacy.SITE}
    got = {r.service_flavour: (r.availability, r.reliability, r.up, r.unknown, r.downtime)
           for r in legacy.flavour_ar(df.withColumns(site), OPS).collect()}
    assert got == {"CE": (100.0, 100.0, 1.0, 0.0, 0.0), "STORE": (97.917, 97.917, 0.97917, 0.0, 0.0),
                   "INFO": (100.0, 100.0, 1.0, 0.0, 0.0)}


def test_previous_state_of_the_day_before(spark):
    log = spark.createDataFrame(
        [(f"2014-02-{d}T{h}:00:00Z", "roc", "box", "m", "CE", "h1", s, "ops", "/ops", "a", "b")
         for d, h, s in (("19", "01", "OK"), ("19", "23", "WARNING"), ("20", "05", "CRITICAL"),
                         ("20", "06", "OK"))],
        "timestamp string, roc string, monitoring_box string, metric string, service_type string, "
        "hostname string, status string, vo string, vo_fqan string, summary string, message string")
    sites = spark.createDataFrame([("h1", "CE", "SITE")], "hostname string, service string, site string")
    rows = legacy.previous_state(log, sites, "2014-02-20", "2014-02-20").orderBy("timestamp").collect()
    assert [(r.status, r.prevstate, r.prevts, r.date_int, r.time_int) for r in rows] == [
        ("CRITICAL", "WARNING", "2014-02-19T23:00:00Z", 20140220, 50000),
        ("OK", "CRITICAL", "2014-02-20T05:00:00Z", 20140220, 60000)]


def test_every_query_has_sql():
    core = load()
    assert set(core) <= set(entry.queries()) and len(core) > 100
    assert set(core) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["report", "date", "name", "supergroup", "availability", "reliability",
                          "up", "down", "unknown"]
    assert df.count() > 0
