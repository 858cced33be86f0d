"""Nearest neighbours by a block matrix join on int8 tiles."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from uptrail.llm.common import written

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 2048
#: Largest sum of products that float32 holds exactly.
EXACT_FLOAT = 1 << 24


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has only finite numbers, not all zero."""
    x = F.col(vector)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where(x.isNotNull() & (F.size(x) > 0) & fine & F.exists(x, lambda v: v != 0))


BLOCK = "dim int, ids binary, vectors binary, codes binary, scales binary, errors binary, norms binary"


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, the scale of each row, the length of what the codes leave out, and of the row.

    Rows are scaled by a power of two first, so that no square of a large or tiny number is lost.
    """
    top = np.abs(x).max(axis=1)
    scale = top / 127
    scale[scale == 0] = top[scale == 0]  # denormal numbers
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127)
    unit = np.exp2(np.floor(np.log2(top)))
    left = np.sqrt((((x - codes * scale[:, None]) / unit[:, None]) ** 2).sum(axis=1)) * unit
    norm = np.sqrt(((x / unit[:, None]) ** 2).sum(axis=1)) * unit
    return codes.astype(np.int8), scale, left, norm


def blocks(df: DataFrame, key: str, vector: str, rows: int, group: str | None = None) -> DataFrame:
    """The rows packed in blocks of one dimension each, and of one value of group."""
    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(2).to_numpy(zero_copy_only=False) if group else np.zeros(batch.num_rows, np.int32)
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            lists = batch.column(1)
            ends = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset:lists.offset + len(lists) + 1]
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            dims = np.diff(ends)
            for dim, number in sorted(set(zip(dims.tolist(), slot.tolist(), strict=True))):
                own = np.flatnonzero((dims == dim) & (slot == number))
                for at in range(0, len(own), rows):
                    part = own[at:at + rows]
                    x = flat[ends[part][:, None] + np.arange(dim)]
                    made = [ids[part], x, *quantised(x)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int32()), pa.array([dim], pa.int32()),
                         *(pa.array([y.tobytes()], pa.binary()) for y in made)],
                        names=["qb", *(c.split()[0] for c in BLOCK.split(", "))])

    return df.select(F.col(key).cast("long"), vector, *([group] if group else [])).mapInArrow(packed, "qb int, " + BLOCK)


def tile(q: dict, c: dict, k: int, least: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query row the (scores, ids) of the candidates that may be among its k best.

    least: what each query already has at rank k. The product of the codes is exact; a candidate
    goes only if even its upper bound is below k lower bounds.
    """
    kind = np.float32 if q["dim"] * 127 * 127 < EXACT_FLOAT else np.float64
    product = (q["codes"].astype(kind) @ c["codes"].astype(kind).T).astype(np.float64)
    product *= q["scales"][:, None]
    product *= c["scales"][None, :]
    # <x,y> - s<a,b> = <x - sa, y> + <sa, y - tb>, and |sa| <= |x| + |x - sa|
    slack = 1e-12
    bound = (q["errors"] + slack * q["norms"])[:, None] * c["norms"][None, :]
    bound += (q["norms"] + q["errors"])[:, None] * c["errors"][None, :]
    own = q["ids"][:, None] == c["ids"][None, :]
    lower = np.where(own, -np.inf, product - bound)
    n = lower.shape[1]
    kth = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(lower), -np.inf)
    passed = (product + bound >= np.maximum(kth, least)[:, None]) & ~own
    i, j = np.nonzero(passed)
    score = np.zeros(len(i))
    for d in range(q["dim"]):  # in order of the components, as a plain sum does
        score += q["vectors"][i, d] * c["vectors"][j, d]
    ids = c["ids"][j]
    order = np.lexsort((ids, -score, i))
    cut = np.searchsorted(i[order], np.arange(len(lower) + 1))
    return [(score[order[a:b][:k]], ids[order[a:b][:k]]) for a, b in zip(cut, cut[1:], strict=False)]


def nearest(queries: DataFrame, candidates: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates with the largest inner product, ties to the smaller id.

    Every query block meets every candidate block of its dimension once; that is what the search
    asks for. A task keeps the k best of each of its queries in sorted runs and merges the runs of
    further tiles into them with a heap. Between tasks go k rows for a query and task.

    Rows without an id, or whose vector is null, zero or not finite, take no part. A candidate with
    the query's id is its own row. A query id that repeats is searched once, with its smallest
    vector; candidates that repeat are candidates each. Vectors of different length do not meet.
    With fewer than k candidates all are returned. Empty tables give no rows.
    """
    spark = queries.sparkSession
    left = usable(queries.where(F.col(key).isNotNull()), vector).groupBy(key).agg(F.min(vector).alias(vector))
    right = usable(candidates.where(F.col(key).isNotNull()), vector)
    names = [c.split()[0] for c in BLOCK.split(", ")]
    left = written(left, "ann-queries")
    many = -(-left.count() // QUERY_BLOCK)
    if not many:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # query blocks have dense numbers, so that a candidate block can be dealt to each of them
    slots = left.withColumn("qb", F.pmod(F.xxhash64(key), F.lit(many)).cast("int"))
    q = written(blocks(slots.repartition(many, "qb").sortWithinPartitions("qb"), key, vector, 2 * QUERY_BLOCK, "qb"),
                "ann-query-blocks").select("qb", *[F.col(c).alias(f"q_{c}") for c in names])
    c = written(blocks(right, key, vector, CANDIDATE_BLOCK).drop("qb"), "ann-candidates")
    c = c.withColumn("share", F.pmod(F.xxhash64("ids"), F.lit(spark.sparkContext.defaultParallelism)))
    c = c.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(many - 1))))
    tiles = c.join(q, (c["cb"] == q["qb"]) & (c["dim"] == q["q_dim"])).drop("cb")
    tiles = tiles.repartition("qb", "share").sortWithinPartitions("qb", "q_dim")

    def unpacked(row: dict, mark: str) -> dict:
        kinds = {"ids": np.int64, "codes": np.int8}
        out = {n: np.frombuffer(row[mark + n], kinds.get(n, np.float64)) for n in names[1:]}
        dim = row[mark + "dim"]
        return out | {"dim": dim, "vectors": out["vectors"].reshape(-1, dim), "codes": out["codes"].reshape(-1, dim)}

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, kept = None, None, []

        def out() -> pa.RecordBatch:
            rows = [(int(x), -s, v) for x, run in zip(block["ids"], kept, strict=True) for s, v in run]
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.float64()),
                                               pa.array(cols[2], pa.int64())], names=["query_id", "score", "vec_id"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if (row["qb"], row["dim"]) != at:
                    if at is not None:
                        yield out()
                    at, block = (row["qb"], row["dim"]), unpacked(row, "q_")
                    kept = [[] for _ in block["ids"]]
                least = np.array([-run[k - 1][0] if len(run) >= k else -np.inf for run in kept])
                for x, (scores, ids) in enumerate(tile(block, unpacked(row, ""), k, least)):
                    if len(ids):
                        fresh = zip((-scores).tolist(), ids.tolist(), strict=True)
                        kept[x] = list(islice(heapq.merge(kept[x], fresh), k))
        if at is not None:
            yield out()

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (tiles.mapInArrow(best, "query_id long, score double, vec_id long")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
