"""Integration of timelines: availability, reliability, state shares, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from uptrail.functions.truth import DOWN_STATES, UNKNOWN_STATES, UP_STATES, Operations
from uptrail.operators.fold import intervals

HOUR_SLOTS_MINUTES = 60


def round5(x: Column) -> Column:
    """Five digits, half up; null (no value) is -1."""
    return F.coalesce(F.round(x, 5), F.lit(-1.0))


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """scale * part / whole on five digits, -1 when the whole is 0."""
    return round5(F.when(whole != 0, F.lit(scale) * part / whole))


def state_lengths(spans: DataFrame, keys: list[str], operations: Operations,
                  up: tuple[str, ...] = UP_STATES, unknown: tuple[str, ...] = UNKNOWN_STATES,
                  down: tuple[str, ...] = DOWN_STATES) -> DataFrame:
    """Slots up, unknown, down and in total, per key."""
    length = F.col("pos_to") - F.col("pos_from") + 1

    def total(names: tuple[str, ...]) -> Column:
        codes = [operations.code(n) for n in names if n in operations.states]
        return F.sum(F.when(F.col("code").isin(codes), length).otherwise(0))

    return spans.groupBy(*keys).agg(
        total(up).alias("n_up"), total(unknown).alias("n_unknown"), total(down).alias("n_down"),
        F.sum(length).alias("n_total"))


def rates(lengths: DataFrame, keys: list[str]) -> DataFrame:
    """Availability and reliability in percent, and up, unknown, down as fractions."""
    known = F.col("n_total") - F.col("n_unknown")
    return lengths.select(
        *keys,
        ratio(F.col("n_up"), known, 100.0).alias("availability"),
        ratio(F.col("n_up"), known - F.col("n_down"), 100.0).alias("reliability"),
        ratio(F.col("n_up"), F.col("n_total")).alias("up"),
        ratio(F.col("n_unknown"), F.col("n_total")).alias("unknown"),
        ratio(F.col("n_down"), F.col("n_total")).alias("down"))


def integrate(timeline: DataFrame, keys: list[str], operations: Operations, slots: int,
              **sets: tuple[str, ...]) -> DataFrame:
    """Availability and reliability of each timeline."""
    return rates(state_lengths(intervals(timeline, keys, slots), keys, operations, **sets), keys)


def hourly(timeline: DataFrame, keys: list[str], operations: Operations, slots: int,
           interval: int) -> DataFrame:
    """Availability and reliability of each hour: intervals are cut at hour marks."""
    per_hour = max(HOUR_SLOTS_MINUTES // interval, 1)
    hours = F.explode(F.sequence(F.floor(F.col("pos_from") / per_hour).cast("int"),
                                 F.floor(F.col("pos_to") / per_hour).cast("int")))
    spans = (intervals(timeline, keys, slots).withColumn("hour", hours)
             .withColumn("pos_from", F.greatest(F.col("pos_from"), F.col("hour") * per_hour))
             .withColumn("pos_to", F.least(F.col("pos_to"), (F.col("hour") + 1) * per_hour - 1)))
    keys = [*keys, "hour"]
    return rates(state_lengths(spans, keys, operations), keys)


def state_shares(timeline: DataFrame, keys: list[str], operations: Operations,
                 slots: int) -> DataFrame:
    """Share of each state that occurs in a timeline, in percent."""
    length = F.col("pos_to") - F.col("pos_from") + 1
    return (intervals(timeline, keys, slots)
            .groupBy(*keys, operations.state_name(F.col("code")).alias("status"))
            .agg(ratio(F.sum(length), F.lit(slots), 100.0).alias("percentage")))


def weighted_rollup(group_ar: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted mean availability and reliability of the groups of each supergroup.

    Groups without a value (-1) are left out of the mean they lack a value for.
    """
    def mean(name: str) -> Column:
        weight = F.when(F.col(name) >= 0, F.col("weight")).otherwise(0)
        return ratio(F.sum(weight * F.when(F.col(name) >= 0, F.col(name)).otherwise(0)),
                     F.sum(weight)).alias(name)

    return group_ar.groupBy(*keys).agg(
        mean("availability"), mean("reliability"), F.sum("weight").cast("long").alias("weight"))
