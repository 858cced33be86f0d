"""Continuous timelines: status changes at one-second resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from uptrail.config import Options
from uptrail.functions import clock
from uptrail.functions.truth import Operations
from uptrail.operators import slots
from uptrail.operators.fold import compact, dealt_anew, fold, moves
from uptrail.operators.slots import CARRY, SEED

DETAIL = ["status", "monitoring_host", "summary", "message"]


def per_second(rows: DataFrame, keys: list[str], operations: Operations, options: Options, first: str,
               last: str) -> DataFrame:
    """One row per key, day of the run and second, and one carry-in: keys, pos, second, code, status.

    Of the rows of a second the highest state counts. Texts take no part, so both aggregates are
    hash aggregates; a status that is not a state has no name here. A metric has at most 86 400 rows a day.
    """
    placed = slots.on_days(slots.latest(rows, keys, operations, options, discrete=False), options, first, last, discrete=False)
    one = placed.groupBy(*keys, "pos").agg(F.max("packed").alias("packed"))
    return with_state(one, operations).withColumn("status", operations.state_name(F.col("code")))


def with_state(packed: DataFrame, operations: Operations) -> DataFrame:
    """Packed states as second and code."""
    return packed.withColumns({"second": slots.second_of(F.col("packed"), operations),
                               "code": slots.unpack(F.col("packed"), operations)}).drop("packed")


def with_previous(events: DataFrame, keys: list[str], missing: str = "MISSING") -> DataFrame:
    """Previous state, its code and its timestamp, per key in order of time.

    Carry-in rows (pos CARRY) come first and give the day's first row its previous state; without
    one that is MISSING at midnight. Seed rows stand only where a key has nothing else. Events without
    a status column get no ``previous_state``.
    """
    w = Window.partitionBy(*keys).orderBy("pos")
    before = F.lag("pos").over(w)
    has_before = before.isNotNull() & (before > SEED)
    day = F.when(before == CARRY, clock.day_before(F.col("date"))).otherwise(F.col("date"))
    named = {"previous_state": F.when(has_before, F.lag("status").over(w)).otherwise(F.lit(missing))}
    return events.withColumns((named if "status" in events.columns else {}) | {
        "previous_code": F.when(has_before, F.lag("code").over(w)),
        "previous_timestamp": F.when(
            has_before, clock.format_ts(day, F.lag("second").over(w)))
            .otherwise(clock.midnight(F.col("date"))),
        "first": ~has_before | (before == CARRY),
        "alone": (F.col("pos") == SEED) & before.isNull() & F.lead("pos").over(w).isNull()})


def anchored(events: DataFrame, keys: list[str], operations: Operations,
             anchor: str = "previous") -> DataFrame:
    """Events with their previous state as a timeline per metric, anchored at midnight.

    The first event of the day sets midnight to its *previous* state and its own state is not
    entered; with ``anchor="exact"`` it is. Later events enter their own state.
    """
    missing = F.lit(operations.missing_code)
    at_start = F.struct(F.lit(0).alias("pos"), F.coalesce("previous_code", missing).alias("code"))
    at_event = F.struct(F.col("second").alias("pos"), F.col("code").alias("code"))
    if anchor == "exact":
        points = F.when(F.col("first") & (F.col("second") > 0), F.array(at_start, at_event))
        points = points.otherwise(F.array(at_event))
    else:
        points = F.array(F.when(F.col("first"), at_start).otherwise(at_event))
    rows = events.select(*keys, F.explode(points).alias("p")).select(*keys, "p.pos", "p.code")
    return compact(rows, keys)


def asof_state(points: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """State of each point (keys, pos): the latest change at or before it.

    Points and changes are merged and read in order, so there is no range join; a key brings at
    most one change per position.
    """
    null_int = F.lit(None).cast("int")
    merged = (changes.select(*keys, "pos", F.col("code").cast("int").alias("code"),
                             F.lit(0).alias("is_point"))
              .unionByName(points.select(*keys, "pos").distinct()
                           .select(*keys, "pos", null_int.alias("code"),
                                   F.lit(1).alias("is_point"))))
    upto = (Window.partitionBy(*keys).orderBy("pos", "is_point")
            .rowsBetween(Window.unboundedPreceding, 0))
    return (dealt_anew(merged, keys).withColumn("code", F.last("code", ignorenulls=True).over(upto))
            .where("is_point = 1").drop("is_point"))


def align_changes(a: DataFrame, b: DataFrame, keys: list[str], op: str,
                  operations: Operations) -> DataFrame:
    """Combine two timelines on the union of their change points."""
    number = operations.op_code(op)
    both = (moves(a.withColumn("member", F.lit("a")), keys, "member", number)
            .unionByName(moves(b.withColumn("member", F.lit("b")), keys, "member", number)))
    return fold(dealt_anew(both, keys), keys, operations, {op})


def status_fields(events: DataFrame) -> list[Column]:
    """Stored columns of a status row, from date, second and status."""
    ts = clock.format_ts(F.col("date"), F.col("second"))
    return [ts.alias("timestamp"), F.col("status"), F.col("summary"), F.col("message"),
            F.col("previous_state"), F.col("previous_timestamp"),
            clock.date_int(F.col("date")).alias("date_integer"),
            clock.time_int(F.col("second")).alias("time_integer")]
