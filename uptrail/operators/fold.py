"""Folding the timelines of many members into one timeline per key.

A timeline is a set of change rows: position (slot or second of the day), the state from there on
(``code``) and the state before (``prev``, null at the start). A fold takes *moves*, the changes of
all members of a key:

    keys..., member, op, pos, new, old [, cover]

and counts, per position, how many members enter and leave each state. The counts are plain sums,
so they are combined before the shuffle, and after it a key holds at most (positions x 1) rows:
288 slots or 86 400 seconds a day, however many members it has. A running sum then tells which
states are present at each position, and an order-free truth table needs no more than that.

Tables whose result depends on the order of members go through ``ordered_fold``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from uptrail.functions.truth import UNDEFINED, Operations

# An ordered fold takes about this many rows at a time, and cuts the positions of a key that it has to
# split into blocks of this length; positions are seconds of a day at most.
RUN_ROWS = 100_000
BLOCK = 3600
LAST_BLOCK = 86_400 // BLOCK


def moves(timeline: DataFrame, keys: list[str], member: str, op: Column) -> DataFrame:
    """The changes of member timelines as input of a fold; ``op`` is an operation number."""
    return timeline.select(*keys, F.col(member).alias("member"), op.alias("op"), "pos",
                           F.col("code").alias("new"), F.col("prev").alias("old"))


def compact(df: DataFrame, keys: list[str], state: str = "code") -> DataFrame:
    """Drop rows that repeat the state before them; adds ``prev``."""
    before = F.lag(state).over(Window.partitionBy(*keys).orderBy("pos"))
    return (df.withColumn("prev", before)
            .where(F.col("prev").isNull() | (F.col("prev") != F.col(state))))


def fold(member_moves: DataFrame, keys: list[str], operations: Operations, ops: set[str],
         place: list[str] | None = None, cover_code: int | None = None, few: bool = False) -> DataFrame:
    """Fold members into one timeline per key: keys, pos, code, prev.

    ``ops`` are the operations that may occur in the op column. ``place`` is the set of columns to
    partition by after pre-aggregation (default: the keys), a subset of the keys, so that later
    steps on those columns need no further shuffle. ``cover_code`` is the state of positions under
    a cover (see ``period_moves``). ``few`` says that the members of a key are bounded by a profile, so
    that a key whose order matters is one piece of work; its input is then read once.
    """
    free = {op for op in ops if operations.kinds[op] != "ordered"}
    if free == ops:
        return _sweep(member_moves, keys, operations, free, place, cover_code)
    if few:
        return _sweep(whole_keys(member_moves, keys, operations, ops - free, free), keys, operations, free, place, cover_code)
    covers = None
    if cover_code is not None:
        covers = member_moves.where("cover <> 0")
        member_moves = member_moves.where("cover = 0").drop("cover")
    is_ordered = F.col("op").isin([operations.op_number(op) for op in sorted(ops - free)])
    rows = ordered_fold(member_moves.where(is_ordered), keys, operations)
    if free:
        rows = rows.unionByName(_sweep(member_moves.where(~is_ordered), keys, operations, free))
        rows = dealt_anew(rows, keys)
    return rows if covers is None else overlay(rows, covers, keys, operations, cover_code, place)


def fold_states(df: DataFrame, keys: list[str], member: str, code: str, operations: Operations,
                op: str) -> DataFrame:
    """Fold the states of the rows of each key: keys, code.

    For order-free tables a count per state decides; others fold in ascending ``member``.
    """
    if operations.kinds[op] == "ordered":
        flat = df.select(*keys, F.col(member).alias("member"), operations.op_code(op).alias("op"),
                         F.lit(0).alias("pos"), F.col(code).alias("new"), F.lit(None).cast("int").alias("old"))
        return ordered_fold(flat, keys, operations).select(*keys, "code")
    counts = [f"n_state_{c}" for c in range(operations.size)]
    sums = [F.expr(f"sum(if(`{code}` = {c}, 1, 0)) AS {name}")
            for c, name in zip([*range(operations.size), UNDEFINED], [*counts, "n_undefined"])]
    folded = F.expr(operations.fold_counts(counts, "n_undefined", {op}))
    return df.groupBy(*keys).agg(*sums).select(*keys, folded.alias("code"))


def overlay(timeline: DataFrame, covers: DataFrame, keys: list[str], operations: Operations,
            code: int, place: list[str] | None = None) -> DataFrame:
    """Replace the state by ``code`` wherever a cover lies over a timeline."""
    alone = moves(timeline.withColumn("member", F.lit("")), keys, "member", F.lit(None).cast("int"))
    both = dealt_anew(alone.withColumn("cover", F.lit(0)).unionByName(covers), keys)
    return _sweep(both, keys, operations, set(), place, code)


def dealt_anew(united: DataFrame, keys: list[str]) -> DataFrame:
    """A union, partitioned by the keys.

    When the sides of a union have the same partitioning, Spark 4.1 takes it for that of the union and
    needs no shuffle for what follows. But adaptive execution merges small partitions of each side by
    itself, and rows of one key end up apart.
    """
    return spread(united, keys)


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by the keys, in twice as many tasks as the session has shuffle partitions.

    Without a number, adaptive execution merges partitions up to its advisory size of compressed bytes,
    and the sorts and aggregates of the steps that follow hold some thirty times that in one task. With the
    session's own number, Spark leaves the shuffle out over a union whose sides have this partitioning.
    """
    return df.repartition(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _sweep(member_moves: DataFrame, keys: list[str], operations: Operations, ops: set[str],
           place: list[str] | None = None, cover_code: int | None = None) -> DataFrame:
    """``fold`` for order-free tables; no ``ops`` at all is for keys with a single member."""
    counts = [f"n_state_{code}" for code in range(operations.size)]
    names = [*counts, "n_undefined"]
    sums = [F.expr(f"sum(if(new = {code}, 1, 0) - if(old = {code}, 1, 0)) AS {name}")
            for code, name in zip([*range(operations.size), UNDEFINED], names)]
    if cover_code is not None:
        sums.append(F.sum("cover").alias("n_cover"))
        names.append("n_cover")
    if len(ops) > 1:
        sums.append(F.max("op").alias("op"))
    summed = member_moves.groupBy(*keys, "pos").agg(*sums)
    if place is not None:
        summed = summed.repartition(*place)

    columns = ", ".join(f"`{k}`" for k in keys)
    upto = f"OVER (PARTITION BY {columns} ORDER BY pos ROWS UNBOUNDED PRECEDING)"
    counted = [f"sum({name}) {upto} AS {name}" for name in names]
    if len(ops) > 1:
        counted.append(f"max(op) {upto} AS op")
    if ops:
        code = operations.fold_counts(counts, "n_undefined", ops)
    else:
        tests = " ".join(f"WHEN {name} > 0 THEN {c}" for c, name in enumerate(counts))
        code = f"CASE WHEN n_undefined > 0 THEN {UNDEFINED} {tests} END"
    states = summed.selectExpr(*[f"`{k}`" for k in keys], "pos", *counted)
    states = states.withColumn("code", F.expr(code)).where("code IS NOT NULL")
    if cover_code is not None:
        states = states.withColumn("code", F.expr(f"if(n_cover > 0, {cover_code}, code)"))
    return compact(states.select(*keys, "pos", "code"), keys)


def period_moves(periods: DataFrame, keys: list[str], end: int) -> DataFrame:
    """Covers as moves: +1 where a period starts, -1 behind its end.

    ``periods`` has keys, pos_from and pos_to (both included); ``end`` is the number of positions.
    """
    steps = F.array(F.struct(F.col("pos_from").alias("pos"), F.lit(1).alias("cover")),
                    F.struct((F.col("pos_to") + 1).alias("pos"), F.lit(-1).alias("cover")))
    null_int = F.lit(None).cast("int")
    return (periods.where(F.col("pos_from") <= F.col("pos_to"))
            .select(*keys, F.explode(steps).alias("step")).where(F.col("step.pos") < end)
            .select(*keys, F.lit(None).cast("string").alias("member"),
                    null_int.alias("op"), F.col("step.pos").alias("pos"),
                    null_int.alias("new"), null_int.alias("old"), F.col("step.cover")))


def intervals(timeline: DataFrame, keys: list[str], end: int) -> DataFrame:
    """Change rows to intervals: keys, pos_from, pos_to (both included), code."""
    following = F.lead("pos").over(Window.partitionBy(*keys).orderBy("pos"))
    return timeline.select(*keys, F.col("pos").alias("pos_from"),
                           (F.coalesce(following, F.lit(end)) - 1).alias("pos_to"), "code")


def to_slots(timeline: DataFrame, keys: list[str], slots: int) -> DataFrame:
    """Dense timeline: one array of ``slots`` codes per key. A key has at most that many rows."""
    runs = F.sort_array(F.collect_list(F.struct("pos_from", "pos_to", "code")))
    dense = F.flatten(F.transform(
        runs, lambda r: F.array_repeat(r["code"], r["pos_to"] - r["pos_from"] + 1)))
    return intervals(timeline, keys, slots).groupBy(*keys).agg(dense.alias("slots"))


# -- order-dependent tables ------------------------------------------------------------------------


def ordered_fold(member_moves: DataFrame, keys: list[str], operations: Operations) -> DataFrame:
    """Left fold in ascending member name, for tables where the order matters.

    Combining with one more member is a map from state to state, and composing maps *is* associative.
    Range partitioning on (keys, member) keeps the order of members and splits a key with many members;
    a task takes its rows in runs of whole members. A run composes the sparse timelines of its members two
    by two, all keys at once, into one timeline of maps per key. Only a run's first and last key can go on
    in another run: their timelines are cut into blocks of positions, each with the map in force where it
    starts, and composed per key and block in the order of runs. The input is read once.
    """
    size = operations.size
    tables = {operations.op_number(op): _step_maps(operations, op)
              for op, kind in operations.kinds.items() if kind == "ordered"}
    stacked = np.zeros((max(tables) + 1, size + 1, size + 2), np.int8)
    for number, maps in tables.items():
        stacked[number] = maps
    fields = {f.name: f.dataType.simpleString() for f in member_moves.schema.fields if f.name in keys}
    out_keys = ", ".join(f"`{name}` {fields[name]}" for name in keys)

    def fold_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        for number, run in enumerate(_whole_groups(batches, [*keys, "member"], RUN_ROWS)):
            key = _numbered(run, keys)
            member = _numbered(run, [*keys, "member"])
            first = np.flatnonzero(np.diff(key, prepend=-1))
            node = member - member[first][key]
            pos = run.column("pos").to_numpy().astype(np.int64)
            maps = stacked[run.column("op").to_numpy(), run.column("new").to_numpy() + 1]
            key, pos, maps = _composed(key, node, pos, maps)
            split = (key == 0) | (key == key.max())
            source, code, block = first[key], maps[:, 0].astype(np.int32) - 2, np.where(split, pos // BLOCK, -1)
            if split.any():  # the map in force at the start of each later block
                ends = np.flatnonzero(split & np.append(np.diff(key) != 0, True))
                extra, starts = [], []
                for k, end in zip(key[ends], ends):
                    own = np.flatnonzero(key == k)
                    borders = np.arange(pos[own[0]] // BLOCK + 1, LAST_BLOCK + 1)
                    at = np.searchsorted(pos[own], borders * BLOCK, side="right") - 1
                    fresh = pos[own[at]] < borders * BLOCK
                    extra.append(own[at[fresh]])
                    starts.append(borders[fresh])
                extra, starts = np.concatenate(extra), np.concatenate(starts)
                source, code = np.append(source, source[extra]), np.append(code, code[extra])
                pos, block = np.append(pos, starts * BLOCK), np.append(block, starts)
                maps, split = np.concatenate([maps, maps[extra]]), np.append(split, np.ones(len(extra), bool))
            yield from _result(run, keys, source, {
                "block": pa.array(block, pa.int64()), "run": pa.array(np.full(len(pos), partition << 32 | number), pa.int64()),
                "pos": pa.array(pos, pa.int32()), "code": pa.array(code, pa.int32()),
                "map": pa.array([m.tobytes() if s else None for m, s in zip(maps, split)], pa.binary())})

    def join_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_groups(batches, [*keys, "block"], RUN_ROWS):
            ready = pa.compute.less(part.column("block"), 0)
            whole = part.filter(ready)
            yield from whole.select([*keys, "pos", "code"]).to_batches()
            part = part.filter(pa.compute.invert(ready))
            if part.num_rows:
                key, run = _numbered(part, [*keys, "block"]), _numbered(part, [*keys, "block", "run"])
                first = np.flatnonzero(np.diff(key, prepend=-1))
                maps = np.frombuffer(b"".join(part.column("map").to_pylist()), np.int8).reshape(-1, size + 2)
                key, pos, maps = _composed(key, run - run[first][key], part.column("pos").to_numpy().astype(np.int64), maps)
                yield from _result(part, keys, first[key], {
                    "pos": pa.array(pos, pa.int32()), "code": pa.array(maps[:, 0].astype(np.int32) - 2, pa.int32())})

    moved = member_moves.where("new IS NOT NULL").select(
        *keys, "member", "op", "pos", F.col("old").isNotNull().alias("later"), "new")
    runs = moved.repartitionByRange(*keys, "member").sortWithinPartitions(*keys, "member", "pos", "later")
    mapped = runs.mapInArrow(fold_runs, f"{out_keys}, block long, run long, pos int, code int, map binary")
    mapped = mapped.repartition(*keys, "block").sortWithinPartitions(*keys, "block", "run", "pos")
    joined = mapped.mapInArrow(join_runs, f"{out_keys}, pos int, code int")
    return compact(joined.where(F.col("code") >= UNDEFINED), keys)


def whole_keys(member_moves: DataFrame, keys: list[str], operations: Operations, ops: set[str], free: set[str]) -> DataFrame:
    """Moves with those of keys with one of the order-dependent ``ops`` replaced by the moves of their fold.

    A fold is then the only member of its key, and any of the order-free tables ``free`` keeps its state.
    Other moves and covers pass. A key is in one task, as a run of whole members of few members.
    """
    size, numbers = operations.size, [operations.op_number(op) for op in sorted(ops)]
    stacked = np.zeros((max(numbers) + 1, size + 1, size + 2), np.int8)
    for op, number in zip(sorted(ops), numbers):
        stacked[number] = _step_maps(operations, op)
    single = min(map(operations.op_number, free), default=None)
    columns = ["member", "op", "pos", "new", "old", *(["cover"] if "cover" in member_moves.columns else [])]
    moved = member_moves.select(*keys, *columns)
    later = F.col("old").isNotNull()
    if "cover" in columns:
        moved = moved.where("new IS NOT NULL OR cover <> 0").withColumn("cover", F.col("cover").cast("long"))
    else:
        moved = moved.where("new IS NOT NULL")
    moved = moved.withColumns({c: F.col(c).cast("int") for c in ("op", "pos", "new", "old")})

    def fold_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_groups(batches, keys, RUN_ROWS):
            mine = pa.compute.and_(pa.compute.is_valid(part.column("new")),
                                   pa.compute.fill_null(pa.compute.is_in(part.column("op"), pa.array(numbers, pa.int32())), False))
            nullable = pa.schema([f.with_nullable(True) for f in part.schema])
            yield from part.filter(pa.compute.invert(mine)).cast(nullable).to_batches()
            part = part.filter(mine).cast(nullable)
            if not part.num_rows:
                continue
            key, member = _numbered(part, keys), _numbered(part, [*keys, "member"])
            first = np.flatnonzero(np.diff(key, prepend=-1))
            maps = stacked[part.column("op").to_numpy(), part.column("new").to_numpy() + 1]
            key, pos, maps = _composed(key, member - member[first][key], part.column("pos").to_numpy().astype(np.int64), maps)
            new, start = maps[:, 0].astype(np.int32) - 2, np.diff(key, prepend=-1) != 0
            old = pa.array(np.append(np.int32(0), new[:-1]), pa.int32(), mask=start)
            n = len(pos)
            made = {"member": pa.nulls(n, pa.string()), "op": pa.array([single] * n, pa.int32()), "pos": pa.array(pos, pa.int32()),
                    "new": pa.array(new, pa.int32()), "old": old, "cover": pa.array(np.zeros(n), pa.int64())}
            yield from _result(part, keys, first[key], {c: made[c] for c in columns})

    runs = spread(moved, keys).sortWithinPartitions(*keys, "member", "pos", later)
    return spread(runs.mapInArrow(fold_keys, moved.schema), keys)


def _result(rows: pa.Table, keys: list[str], source: np.ndarray, more: dict[str, pa.Array]) -> list[pa.RecordBatch]:
    taken = rows.select(keys).take(pa.array(source))
    for name, column in more.items():
        taken = taken.append_column(name, column)
    return taken.combine_chunks().to_batches()


def _changes(rows: pa.Table, columns: list[str]) -> np.ndarray:
    """True where a row differs in some column from the row before; nulls are alike."""
    new = np.ones(rows.num_rows, bool)
    if rows.num_rows:
        new[1:] = False
        for name in columns:
            kinds = rows.column(name).combine_chunks().dictionary_encode().indices
            codes = np.asarray(kinds.fill_null(-1))
            new[1:] |= codes[1:] != codes[:-1]
    return new


def _numbered(rows: pa.Table, columns: list[str]) -> np.ndarray:
    """The number of each row's group; equal rows stand together."""
    return np.cumsum(_changes(rows, columns)) - 1


def _whole_groups(batches: Iterable[pa.RecordBatch], columns: list[str], rows: int) -> Iterator[pa.Table]:
    """Ordered batches as tables of at least so many rows, but the last, that cut no group of these columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            table = pa.Table.from_batches(held)
            last = int(np.flatnonzero(_changes(table, columns))[-1])
            if last:
                yield table.slice(0, last)
            held = table.slice(last).to_batches()
    if held and (table := pa.Table.from_batches(held)).num_rows:
        yield table


def _composed(key: np.ndarray, node: np.ndarray, pos: np.ndarray, maps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Timelines of maps of the nodes 0, 1, 2, ... of each key as one per key: key, pos, map.

    A round joins neighbouring nodes: at each position of either, the later map after the earlier
    one. There are as many rounds as the number of nodes has binary digits.
    """
    size = maps.shape[1]
    while True:
        side, parent = node & 1, node >> 1
        order = np.lexsort((np.arange(len(key)), pos, parent, key))
        key, parent, pos, side, maps = key[order], parent[order], pos[order], side[order], maps[order]
        group = np.ones(len(key), bool)
        group[1:] = (key[1:] != key[:-1]) | (parent[1:] != parent[:-1])
        start = np.maximum.accumulate(np.where(group, np.arange(len(key)), 0))
        value = np.broadcast_to(np.arange(size, dtype=np.int8), maps.shape)
        for which in (0, 1):
            at = np.maximum.accumulate(np.where(side == which, np.arange(len(key)), -1))
            held = np.where((at >= start)[:, None], maps[np.maximum(at, 0)], np.arange(size, dtype=np.int8)[None, :])
            value = np.take_along_axis(held, value.astype(np.intp), axis=1)
        last = np.ones(len(key), bool)
        last[:-1] = group[1:] | (pos[1:] != pos[:-1])
        key, node, pos, maps, group = key[last], parent[last], pos[last], value[last], None
        same = np.zeros(len(key), bool)
        same[1:] = (key[1:] == key[:-1]) & (node[1:] == node[:-1]) & (maps[1:] == maps[:-1]).all(axis=1)
        key, node, pos, maps = key[~same], node[~same], pos[~same], maps[~same]
        if not node.any():
            return key, pos, maps


def _step_maps(operations: Operations, op: str) -> np.ndarray:
    """Map of each member state (row 0 is -1) over "nothing before", -1, 0, 1, ... ."""
    size = operations.size
    maps = np.empty((size + 1, size + 2), dtype=int)
    for state in range(-1, size):
        after = [state] + [operations.combine(op, before, state) for before in range(-1, size)]
        maps[state + 1] = [code + 2 for code in after]
    return maps
