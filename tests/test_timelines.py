import random

import pytest
from pyspark.sql import functions as F

from tests import model
from uptrail.config import Options
from uptrail.functions import clock
from uptrail.operators import changes, fold as fo, integrate, slots
from uptrail.sources.defaults import grid_operations, tenant_operations

OPS, GRID = tenant_operations(), grid_operations()
D = "2031-03-09"


def rows(spark, entries, day=D):
    """entries: (metric, time, state); times are HH:MM:SS, or 'prev' for the day before."""
    data = [(f"{day}T{at}Z" if at != "prev" else f"{clock.shift(day, -1)}T23:00:00Z",
             "svc", "host", metric, state) for metric, at, state in entries]
    df = spark.createDataFrame(
        data, "timestamp string, service string, hostname string, metric string, status string")
    return df.withColumns({"date": clock.text_date(F.col("timestamp")),
                           "second": clock.seconds_of_day(F.col("timestamp"))})


def folded_slots(spark, entries, op, ops=OPS, options=Options()):
    keys = ["date", "service", "hostname"]
    spans = slots.metric_timelines(rows(spark, entries), ops, options, D, D)
    tl = fo.compact(spans.withColumn("pos", F.col("pos_from")), [*keys, "metric"])
    merged = fo.fold(fo.moves(tl, keys, "metric", ops.op_code(op)), keys, ops, {op})
    return merged, list(fo.to_slots(merged, keys, options.slots).first().slots)


@pytest.mark.parametrize("time,expected", [
    ("00:00:00", 0), ("00:02:29", 0), ("00:02:30", 1), ("00:07:29", 1), ("00:07:30", 2), ("23:57:29", 287),
    ("23:59:59", 287), ("24:10:00", 2), ("07:41:17", 92), ("16:04:45", 193)])
def test_slot(spark, time, expected):
    second = clock.seconds_of_day(F.lit(f"{D}T{time}Z"))
    assert spark.range(1).select(clock.ts_slot(second)).first()[0] == expected


def test_slots_equal_model(spark):
    df = spark.range(0, 86400).select(F.col("id").cast("int").alias("s"),
                                      clock.ts_slot(F.col("id").cast("int")).alias("slot"))
    for s, got in df.collect():
        assert got == model.slot(f"{D}T{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}Z")


def test_day_rates(spark):
    """A day that starts OK from the day before: 3 hours of downtime, 1 hour of WARNING, 45 minutes CRITICAL."""
    entries = [("m", "prev", "OK"), ("m", "04:00:00", "DOWNTIME"), ("m", "07:00:00", "WARNING"),
               ("m", "08:00:00", "CRITICAL"), ("m", "08:45:00", "OK")]
    merged, _ = folded_slots(spark, entries, "AND")
    r = integrate.integrate(merged, ["date", "service", "hostname"], OPS, 288).first()
    up = 288 - 36 - 9
    assert (r.availability, r.reliability) == (round(100 * up / 288, 5), round(100 * up / (288 - 36), 5))
    assert (r.up, r.down, r.unknown) == (round(up / 288, 5), round(36 / 288, 5), 0.0)


def listed(spark, members):
    data = [(0, m, clock_second(t), OPS.code(s)) for m, cs in members.items() for t, s in cs]
    return fo.compact(spark.createDataFrame(data, "k int, member string, pos int, code int"),
                      ["k", "member"])


def clock_second(text):
    h, m, s = (text.split(":") + ["0"])[:3]
    return int(h) * 3600 + int(m) * 60 + int(s)


def fold_listed(spark, members, op, ops=OPS):
    tl = listed(spark, members)
    out = fo.fold(fo.moves(tl, ["k"], "member", ops.op_code(op)), ["k"], ops, {op})
    return [(r.pos, ops.states[r.code]) for r in out.orderBy("pos").collect()]


def against_model(spark, members, op, ops=OPS):
    got = fold_listed(spark, members, op, ops)
    codes = {m: [(clock_second(t), ops.code(state)) for t, state in cs] for m, cs in members.items()}
    assert got == [(pos, ops.states[code]) for pos, code in model.fold_lists(ops, op, codes)]
    return got


def test_overlapping_spells_of_two_members(spark):
    """CRITICAL of one inside WARNING of the other: AND shows the worse, OR the better of the two."""
    members = {"left": [("00:00", "OK"), ("03:10", "WARNING"), ("09:40", "OK")],
               "right": [("00:00", "OK"), ("05:20", "CRITICAL"), ("06:05", "OK")]}
    assert against_model(spark, members, "AND") == [
        (0, "OK"), (11400, "WARNING"), (19200, "CRITICAL"), (21900, "WARNING"), (34800, "OK")]
    assert against_model(spark, members, "OR") == [(0, "OK"), (19200, "WARNING"), (21900, "OK")]


@pytest.mark.parametrize("ops,op", [(OPS, "AND"), (OPS, "OR"), (GRID, "OR")])
def test_members_that_change_at_the_same_moment(spark, ops, op):
    members = {f"probe-{i}": [("00:00", "MISSING"), (f"0{i + 1}:30", "DOWNTIME"), ("08:15", ["OK", "CRITICAL", "UNKNOWN"][i % 3]),
                              (f"1{i}:00:0{i}", "WARNING"), ("23:59:59", "OK")] for i in range(5)}
    assert len(against_model(spark, members, op, ops)) > 1


def test_equal_states_in_a_row_are_one_change(spark):
    members = {"only": [("00:00", "OK"), ("01:00", "OK"), ("02:30", "DOWNTIME"), ("04:00", "DOWNTIME"), ("04:01", "OK")]}
    assert against_model(spark, members, "AND") == [(0, "OK"), (9000, "DOWNTIME"), (14460, "OK")]


def test_asof(spark):
    changes_ = spark.createDataFrame([(1, 100, 0), (1, 200, 4)], "k int, pos int, code int")
    points = spark.createDataFrame([(1, 50), (1, 100), (1, 199), (1, 900)], "k int, pos int")
    got = {r.pos: r.code for r in changes.asof_state(points, changes_, ["k"]).collect()}
    assert got == {50: None, 100: 0, 199: 0, 900: 4}


@pytest.mark.parametrize("ops,op", [(OPS, "AND"), (OPS, "OR"), (GRID, "OR")])
def test_random_folds(spark, monkeypatch, ops, op):
    monkeypatch.setattr(fo, "RUN_ROWS", 40)  # several runs per key
    monkeypatch.setattr(fo, "BLOCK", 50)  # and several blocks of positions
    monkeypatch.setattr(fo, "LAST_BLOCK", 86_400 // 50)
    rng = random.Random(7)
    data, want = [], {}
    for k in range(12):
        members = {}
        for m in range(rng.randint(1, 40)):
            points = sorted({0, *(rng.randrange(1, 500) for _ in range(rng.randint(0, 8)))})
            members[f"m{m:02d}"] = [(p, rng.randrange(6)) for p in points]
        want[k] = model.fold_lists(ops, op, members)
        data += [(k, m, p, c) for m, cs in members.items() for p, c in cs]
    df = fo.compact(spark.createDataFrame(data, "k int, member string, pos int, code int"),
                    ["k", "member"])
    out = fo.fold(fo.moves(df, ["k"], "member", ops.op_code(op)), ["k"], ops, {op})
    got = {}
    for r in out.orderBy("k", "pos").collect():
        got.setdefault(r.k, []).append((r.pos, r.code))
    assert got == want


def test_keys_of_few_members_in_one_pass(spark, monkeypatch):
    """Order-dependent and order-free keys and covers together, from one read of the moves."""
    monkeypatch.setattr(fo, "RUN_ROWS", 40)
    rng = random.Random(11)
    data, want = [], {}
    for k in range(14):
        op = ("AND", "OR")[k % 2]
        members = {f"m{m}": [(p, rng.randrange(-1, 6)) for p in sorted({0, *(rng.randrange(1, 288) for _ in range(rng.randint(0, 8)))})]
                   for m in range(rng.randint(1, 6))}
        want[k] = model.fold_lists(GRID, op, members)
        data += [(k, m, GRID.op_number(op), p, c) for m, cs in members.items() for p, c in cs]
    df = fo.compact(spark.createDataFrame(data, "k int, m string, o int, pos int, code int"), ["k", "m"])
    moved = fo.moves(df, ["k"], "m", F.col("o"))
    for more, code in ((moved, None), (fo.moves(df, ["k"], "m", F.col("o")).withColumn("cover", F.lit(0)).unionByName(
            fo.period_moves(spark.createDataFrame([(1, 5, 9), (2, 0, 300), (99, 1, 2)], "k int, pos_from int, pos_to int"), ["k"], 288)), 4)):
        out = fo.fold(more, ["k"], GRID, {"AND", "OR"}, cover_code=code, few=True)
        assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == (1 if code is None else 2)  # and the covers
        same = fo.fold(more, ["k"], GRID, {"AND", "OR"}, cover_code=code)
        assert sorted(out.collect()) == sorted(same.select(*out.columns).collect())
        if code is None:
            got = {}
            for r in out.orderBy("k", "pos").collect():
                got.setdefault(r.k, []).append((r.pos, r.code))
            assert got == want
    only = moved.where(F.col("op") == GRID.op_number("OR"))
    assert sorted(fo.fold(only, ["k"], GRID, {"OR"}, few=True).collect()) == sorted(fo.fold(only, ["k"], GRID, {"OR"}).collect())


def test_overlay_of_periods(spark):
    tl = spark.createDataFrame([("k", 0, 0, None), ("k", 100, 4, 0)],
                               "k string, pos int, code int, prev int")
    periods = spark.createDataFrame([("k", 20, 46), ("k", 40, 110), ("k", 280, 287)],
                                    "k string, pos_from int, pos_to int")
    out = fo.overlay(tl, fo.period_moves(periods, ["k"], 288), ["k"], OPS, 2)
    dense = fo.to_slots(out, ["k"], 288).first().slots
    want = [0] * 100 + [4] * 188
    for a, b in ((20, 46), (40, 110), (280, 287)):
        want[a:b + 1] = [2] * (b - a + 1)
    assert list(dense) == want
