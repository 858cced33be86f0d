"""Choosing dimension snapshots by date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from uptrail.functions import clock


class SnapshotMissing(LookupError):
    """No snapshot within the look-back."""


def latest_snapshot(df: DataFrame, date: str, max_back: int = 3) -> DataFrame:
    """Rows of the newest snapshot among the days date-max_back..date; an error if there is none.

    Only one date comes to the driver.
    """
    near = df.where(F.col("date").between(F.lit(clock.shift(date, -max_back)).cast("date"),
                                          F.lit(date).cast("date")))
    newest = near.agg(F.max("date")).first()[0]
    if newest is None:
        raise SnapshotMissing(f"no snapshot from {clock.shift(date, -max_back)} to {date}")
    return df.where(F.col("date") == F.lit(newest)).drop("date")


def newest_snapshot(df: DataFrame) -> DataFrame:
    """Rows of the newest snapshot of all."""
    newest = df.agg(F.max("date")).first()[0]
    if newest is None:
        raise SnapshotMissing("no snapshot at all")
    return df.where(F.col("date") == F.lit(newest)).drop("date")


def snapshots_for(df: DataFrame, first: str, last: str, max_back: int = 3) -> DataFrame:
    """For each day first..last, the rows of its newest snapshot, with that day as ``date``."""
    return daily_snapshots({"table": df}, first, last, max_back)["table"]


def daily_snapshots(tables: dict[str, DataFrame], first: str, last: str,
                    max_back: int = 3) -> dict[str, DataFrame]:
    """``snapshots_for`` of several tables, by name.

    A snapshot serves from its own day until the next one, at most ``max_back`` days on. That is
    worked out on the distinct dates only, one row per day of the run. A day without a snapshot is an
    error; one job looks at all tables, and only the number of days served of each comes to the driver.
    """
    if not tables:
        return {}
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    following = F.lead("date").over(Window.partitionBy(F.lit(0)).orderBy("date"))
    until = F.least(F.date_add("date", max_back), high,
                    F.coalesce(F.date_sub("following", 1), high))
    near = {name: df.where(F.col("date").between(F.date_sub(low, max_back), high))
            for name, df in tables.items()}
    days = {name: df.select("date").distinct().withColumn("following", following)
            .select("date", F.explode(clock.day_range(F.greatest("date", low), until)).alias("serves"))
            for name, df in near.items()}
    named = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("table"), "serves") for name, df in days.items()])
    served = {row["table"]: row["days"] for row in named.groupBy("table").agg(F.count("*").alias("days")).collect()}
    wanted = len(clock.date_range(first, last))
    gaps = {name: wanted - served.get(name, 0) for name in tables if served.get(name, 0) < wanted}
    if gaps:
        missing = "; ".join(f"{n} of the days {first} to {last}" + (f" ({name})" if len(tables) > 1 else "") for name, n in gaps.items())
        raise SnapshotMissing(f"{missing} have no snapshot within {max_back} days")
    return {name: near[name].join(days[name], "date").drop("date").withColumnRenamed("serves", "date")
            for name in tables}
