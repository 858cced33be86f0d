"""Result tables: timelines and rates in the stored column layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from uptrail.functions import clock
from uptrail.functions.truth import Operations

RATES = ["availability", "reliability", "up", "down", "unknown"]


def map_service(rates: DataFrame) -> DataFrame:
    """Service rates as stored; the supergroup of a service is its endpoint group."""
    return rates.select("report", clock.date_int(F.col("date")).alias("date"),
                        F.col("service").alias("name"), F.col("group").alias("supergroup"), *RATES)


def map_group(rates: DataFrame, supergroups: DataFrame, weights: DataFrame) -> DataFrame:
    """Group rates as stored, with supergroup (null if none) and weight (0 if none)."""
    keys = ["report", "date", "group"]
    return (rates.join(supergroups, keys, "left").join(weights, keys, "left")
            .select("report", clock.date_int(F.col("date")).alias("date"),
                    F.col("group").alias("name"), "supergroup",
                    F.coalesce("weight", F.lit(0)).alias("weight"), *RATES))


def map_changes(timeline: DataFrame, names: dict[str, str], operations: Operations) -> DataFrame:
    """Status changes as stored; ``names`` maps key columns to stored names."""
    return timeline.select(
        "report", clock.date_int(F.col("date")).alias("date_integer"),
        *[F.col(key).alias(name) for key, name in names.items()],
        clock.format_ts(F.col("date"), F.col("pos")).alias("timestamp"),
        operations.state_name(F.col("code")).alias("status"))


def count_results(table: DataFrame, date: int, report: str | None = None,
                  date_column: str = "date") -> DataFrame:
    """Stored rows of a day, optionally of one report, as one row."""
    return _of_day(table, date, report, date_column).agg(F.count("*").alias("rows"))


def results_except(table: DataFrame, date: int, report: str | None = None,
                   date_column: str = "date") -> DataFrame:
    """Stored rows without those of a day, optionally of one report."""
    hit = F.col(date_column) == date
    if report is not None:
        hit = hit & (F.col("report") == report)
    return table.where(~hit)


def _of_day(table: DataFrame, date: int, report: str | None, date_column: str) -> DataFrame:
    rows = table.where(F.col(date_column) == date)
    return rows if report is None else rows.where(F.col("report") == report)


def order_results(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.orderBy(*columns)
