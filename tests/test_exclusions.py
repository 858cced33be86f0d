"""Exclusions of monitoring hosts, however many requests name the same hours."""

import datetime as dt
import random

from pyspark.sql import functions as F

from uptrail.operators import selection as sel
from uptrail.plans import rows

DAY = dt.datetime(2024, 1, 2)


def exclusions(spark, periods):
    return spark.createDataFrame([(h, a.isoformat(), b.isoformat()) for h, a, b in periods], "monitoring_host string, a string, b string").select(
        "monitoring_host", F.col("a").cast("timestamp_ntz").alias("start_ts"), F.col("b").cast("timestamp_ntz").alias("end_ts"))


def test_rows_in_excluded_periods_go(spark):
    rng = random.Random(1)
    at = lambda: DAY + dt.timedelta(seconds=rng.randrange(-90_000, 200_000), milliseconds=rng.choice((0, 500)))
    periods = [(f"mon-{rng.randrange(3)}", a, a + dt.timedelta(seconds=rng.choice((-5, 0, 60, 599, 4000, 90_000)))) for a in (at() for _ in range(25))]
    periods += [("mon-4", DAY, DAY + dt.timedelta(days=1))]  # both ends are included
    md = [(f"mon-{i % 5}", DAY + dt.timedelta(seconds=s)) for i, s in enumerate(rng.sample(range(-86_400, 200_000), 1500))]
    md += [(h, t.replace(microsecond=0)) for h, a, b in periods for t in (a, b)]
    text = lambda t: t.strftime("%Y-%m-%dT%H:%M:%SZ")
    table = spark.createDataFrame([*((h, text(t)) for h, t in md), (None, text(DAY)), ("mon-4", "unreadable")], "monitoring_host string, timestamp string")
    kept = sorted((r[0] or "", r[1]) for r in sel.exclude_monitoring(table, exclusions(spark, periods * 3)).collect())
    assert kept == sorted([*((h, text(t)) for h, t in md if not any(h == x and a <= t <= b for x, a, b in periods)),
                           ("", text(DAY)), ("mon-4", "unreadable")])


def test_a_row_meets_one_span_of_many_alike(spark, monkeypatch):
    """Rows are joined by host, day and part of the day with spans that do not overlap."""
    met = []
    monkeypatch.setattr(sel, "in_cells", lambda *a, real=sel.in_cells: met.append(real(*a)) or met[-1])
    hours = [("mon", DAY + dt.timedelta(minutes=i % 7), DAY + dt.timedelta(hours=3)) for i in range(500)]
    sel.exclude_monitoring(spark.createDataFrame([("mon", "2024-01-02T01:00:00Z")], "monitoring_host string, timestamp string"), exclusions(spark, hours))
    assert met[0].count() == 3 * 6 + 1 and met[0].select(sel.X_CELL).distinct().count() == 3 * 6 + 1
    dims = type("Dims", (), {"first": "2024-01-01", "last": "2024-01-05", "monitor_exclusions": exclusions(spark, hours).withColumns({
        "report": F.lit("R"), "from_date": F.lit("2024-01-02").cast("date"), "to_date": F.lit("2024-01-02").cast("date")})})
    assert rows.excluded_cells(dims).count() == 3 * 6 + 1
