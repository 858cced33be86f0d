"""Discrete timelines: probe rows to sample slots, settled into member timelines.

A row's state acts from one slot before the slot of its timestamp; a row in slot 0 has no effect.
Before the first effect a metric keeps the state carried in from the day before, else MISSING.

Rows are first reduced to one per (metric, day, slot), a plain maximum of an integer that holds the
second and the state. That combines before the shuffle, and bounds what one metric can bring to a
task at 288 rows a day, however many rows a hot metric has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from uptrail.config import Options
from uptrail.functions import clock
from uptrail.functions.truth import Operations
from uptrail.operators.fold import intervals
from uptrail.operators.selection import METRIC

SEED, CARRY = -2, -1  # positions of "expected, unseen" and "carried in from the day before"


def pack(second: Column, code: Column, operations: Operations) -> Column:
    """Second and state in one integer, ordered by second, then state code."""
    return second * (operations.size + 2) + code + 1


def unpack(packed: Column, operations: Operations) -> Column:
    return packed % (operations.size + 2) - 1


def second_of(packed: Column, operations: Operations) -> Column:
    return F.floor(packed / F.lit(operations.size + 2)).cast("int")


def without_effect(operations: Operations) -> Column:
    """The packed state of a placed row; at SEED it only marks the metric as seen."""
    return F.when(F.col("pos") == SEED, pack(F.lit(0), F.lit(operations.missing_code), operations)).otherwise(F.col("packed"))


def on_days(rows: DataFrame, options: Options, first: str, last: str, discrete: bool = True,
            seeds: bool = False) -> DataFrame:
    """Rows with a date and ``pos`` (slot or second) on the days they matter for.

    Each stands on its own day and, at CARRY, on the next; ``row_date`` keeps its own. A slot-0 row
    that has no effect there stands at SEED. With ``seeds`` each also stands at SEED on both days. A
    single-day run without seeds multiplies nothing.
    """
    own = F.col("pos")
    if discrete and options.align == "settle":
        own = F.when(own == 0, SEED).otherwise(own)
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    rows = rows.where(F.col("date").between(F.date_sub(low, 1), high)).withColumn("row_date", F.col("date"))
    if first == last and not seeds:
        return rows.withColumns({"pos": F.when(F.col("date") == low, own).otherwise(CARRY), "date": low})
    places = [(F.col("date"), own), (F.date_add("date", 1), F.lit(CARRY))]
    if seeds:
        places += [(day, F.lit(SEED)) for day, _ in places]
    entries = F.explode(F.array(*[F.struct(day.alias("date"), pos.alias("pos")) for day, pos in places]))
    return (rows.withColumn("_entry", entries)
            .withColumns({"date": F.col("_entry.date"), "pos": F.col("_entry.pos")})
            .drop("_entry").where(F.col("date").between(low, high)))


def latest(rows: DataFrame, keys: list[str], operations: Operations, options: Options,
           discrete: bool = True) -> DataFrame:
    """One packed state per key, with the day among the keys, and position: keys, pos, packed.

    ``rows`` has second and code. A hash aggregate over the raw rows, before anything multiplies them.
    """
    pos = clock.ts_slot(F.col("second"), options.interval, options.slots) if discrete else F.col("second")
    packed = pack(F.col("second"), F.col("code"), operations)
    return rows.where("second IS NOT NULL").withColumn("pos", pos).groupBy(*keys, "pos").agg(F.max(packed).alias("packed"))


def slot_states(rows: DataFrame, keys: list[str], operations: Operations, options: Options, first: str,
                last: str, seeds: bool = False) -> DataFrame:
    """One packed state per key, day of the run and position, carry-in included [, and seeds]."""
    placed = on_days(latest(rows, keys, operations, options), options, first, last, seeds=seeds)
    placed = placed.withColumn("packed", without_effect(operations))
    return placed.groupBy(*keys, "pos").agg(F.max("packed").alias("packed"))


def settle(states: DataFrame, keys: list[str], operations: Operations,
           options: Options) -> DataFrame:
    """Slot states to member changes: keys, pos (the effective slot), new, old.

    Of the rows at SEED and CARRY the last one is the start state; changes follow one slot early.
    Rows without a packed state (covers) pass through.
    """
    w = Window.partitionBy(*keys).orderBy("pos")
    first_slot = 1 if options.align == "settle" else 0
    early = 1 if options.align == "settle" else 0
    following, before = F.lead("pos").over(w), F.lag("packed").over(w)
    is_change = F.col("pos") >= first_slot
    out = states.withColumns({
        "new": unpack(F.col("packed"), operations),
        "old": F.when(is_change, unpack(before, operations)),
        "superseded": ~is_change & (F.coalesce(following, F.lit(first_slot)) < first_slot)})
    moved = F.col("old").isNull() | (F.col("old") != F.col("new"))
    return (out.where(F.col("packed").isNull() | (~F.col("superseded") & moved))
            .withColumn("pos", F.when(F.col("packed").isNull(), F.col("pos"))
                        .otherwise(F.greatest(F.col("pos") - early, F.lit(0))))
            .drop("packed", "superseded"))


def net_changes(settled: DataFrame, keys: list[str]) -> DataFrame:
    """Settled changes as a timeline; a change at slot 0 replaces the start state."""
    w = Window.partitionBy(*keys).orderBy("pos")
    last_at_pos = F.max_by(F.col("new"), F.col("old").isNotNull())
    one = settled.groupBy(*keys, "pos").agg(last_at_pos.alias("code"))
    return (one.withColumn("prev", F.lag("code").over(w))
            .where(F.col("prev").isNull() | (F.col("prev") != F.col("code"))))


def metric_timelines(rows: DataFrame, operations: Operations, options: Options, first: str,
                     last: str) -> DataFrame:
    """Timeline of each single metric: date, service, hostname, metric, pos_from, pos_to, code."""
    keys = ["date", *METRIC]
    coded = rows.withColumn("code", operations.state_code(F.col("status")))
    states = slot_states(coded, keys, operations, options, first, last, seeds=True)
    return intervals(net_changes(settle(states, keys, operations, options), keys), keys,
                     options.slots)


def day_spans(periods: DataFrame, first: str, last: str, options: Options) -> DataFrame:
    """Cut periods at day borders: adds date, pos_from and pos_to (slots, both included).

    ``periods`` has start_ts and end_ts (TIMESTAMP_NTZ). Only days the period touches are given; a
    start before the day is slot 0, an end after it the last slot.
    """
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    days = clock.day_range(F.greatest(F.to_date("start_ts"), low),
                           F.least(F.to_date("end_ts"), high))

    def slot(ts: str) -> Column:
        return clock.ts_slot(clock.second_of(F.col(ts)), options.interval, options.slots)

    spans = periods.where(F.col("start_ts") <= F.col("end_ts"))
    if "date" in periods.columns:  # periods that only hold on one day
        spans = spans.withColumn("_day", F.explode(days)).where("_day = date").drop("_day")
    else:
        spans = spans.withColumn("date", F.explode(days))
    return spans.withColumns({
        "pos_from": F.when(F.to_date("start_ts") < F.col("date"), 0).otherwise(slot("start_ts")),
        "pos_to": F.when(F.to_date("end_ts") > F.col("date"), options.slots - 1)
                   .otherwise(slot("end_ts"))})


def with_downtimes(downtimes: DataFrame, first: str, last: str, options: Options) -> DataFrame:
    """Downtime slots per day and endpoint: date, service, hostname, pos_from, pos_to.

    ``downtimes`` has service, hostname, start_ts, end_ts; with a report column it is per report. With
    ``options.downtimes == "first"`` the earliest period of the endpoint's day, else all.
    """
    spans = day_spans(downtimes, first, last, options)
    keys = [*(c for c in ("report",) if c in downtimes.columns), "date", "service", "hostname"]
    if options.downtimes == "all":
        return spans.select(*keys, "pos_from", "pos_to")
    earliest = F.min(F.struct("start_ts", "end_ts", "pos_from", "pos_to")).alias("p")
    return spans.groupBy(*keys).agg(earliest).select(*keys, "p.pos_from", "p.pos_to")
