"""Recomputation requests: what they exclude, which ones apply, and their state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from uptrail.functions import clock


def covering(requests: DataFrame, date: str) -> DataFrame:
    """Requests whose period covers a day; only the dates count, both ends included."""
    day = F.lit(date).cast("date")
    return requests.where((clock.text_date(F.col("start_time")) <= day)
                          & (clock.text_date(F.col("end_time")) >= day))


def select_recomputations(requests: DataFrame, report: str, date: str) -> DataFrame:
    """Requests of a report that cover a day."""
    return covering(requests.where(F.col("report") == report), date)


def group_exclusions(requests: DataFrame) -> DataFrame:
    """(report, group, start_ts, end_ts): one row per excluded group and request."""
    return requests.where("start_time IS NOT NULL AND end_time IS NOT NULL").select(
        "report", F.explode("exclude").alias("group"),
        clock.parse_ts(F.col("start_time")).alias("start_ts"),
        clock.parse_ts(F.col("end_time")).alias("end_ts"))


def monitor_exclusions(requests: DataFrame) -> DataFrame:
    """(report, monitoring_host, start_ts, end_ts, from_date, to_date), one per excluded source.

    from_date and to_date are the days the request itself covers: it has no say on other days.
    """
    return requests.select(
        "report", clock.text_date(F.col("start_time")).alias("from_date"),
        clock.text_date(F.col("end_time")).alias("to_date"),
        F.explode("exclude_monitoring_source").alias("m")).select(
        "report", F.col("m.host").alias("monitoring_host"),
        clock.parse_ts(F.col("m.start_time")).alias("start_ts"),
        clock.parse_ts(F.col("m.end_time")).alias("end_ts"), "from_date", "to_date")


def recomputation_counts(requests: DataFrame) -> DataFrame:
    """Number of requests in each state."""
    return requests.groupBy("status").agg(F.count("*").alias("requests"))


def next_pending(requests: DataFrame) -> DataFrame:
    """The oldest pending request."""
    return requests.where(F.col("status") == "pending").orderBy("timestamp", "id").limit(1)


def mark_request(requests: DataFrame, request_id: str, status: str, at: str) -> DataFrame:
    """Requests with one of them moved to another state."""
    this = F.col("id") == request_id
    return requests.withColumns({
        "status": F.when(this, F.lit(status)).otherwise(F.col("status")),
        "timestamp": F.when(this, F.lit(at)).otherwise(F.col("timestamp"))})
