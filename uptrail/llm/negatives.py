"""Hard negatives: rows of another label whose score lies in a window below each positive's.

Rows of one label are dealt to groups of bounded size, and each group becomes a cover tree. The
candidates are lifted by one component to a common length, so a large inner product is a small
distance: a node's covering radius is an angle, and the angle between the anchor and the node's
centre bounds the products of all rows below it from both sides. A search goes down level by level,
takes leaves from the best bound on, leaves out those whose bounds lie outside the window or below
what is already found, and verifies the rows of the others in whole numbers.

Vectors without structure have no nodes with small radii; then most leaves are verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from uptrail.llm.common import written

#: Rows of a tree at most, on average.
TREE_ROWS = 4096
#: Trees that one task searches for one block of anchors, on average.
TREES = 4
#: Anchors of a block, on average.
ANCHORS = 1024
#: A node of so many rows is a leaf.
LEAF = 32
#: A level's radius is the one above divided by this.
BASE = 2.0
#: What rounding may add to an angle, as a share of the largest product.
SLACK = 1e-6
LOWEST = -(1 << 62)

TREE = ("dim int, label string, shard int, ids binary, vectors binary, centre binary, radius binary, parent binary, "
        "leaves binary, first binary, last binary")


def scaled(rows: DataFrame, factor: float, key: str, vector: str, label: str) -> DataFrame:
    """key, label and x = floor(factor * component) of the rows that take part."""
    x = F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * factor))
    fine = F.col(vector)
    all_finite = F.forall(fine, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # products of larger numbers do not fit a long
    fits = F.forall(fine, lambda v: F.abs(v.cast("double") * factor) * F.sqrt(F.size(fine)) < float(1 << 31) - 1)
    kept = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull() & fine.isNotNull() & (F.size(fine) > 0))
    return kept.where(all_finite).where(fits).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), x.alias("x"))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows."""
    lists = column.combine_chunks()
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def net(points: np.ndarray, centre: int, far: np.ndarray, reach: float, most: int) -> tuple[list[int], np.ndarray, np.ndarray] | None:
    """Centres more than reach apart such that every point is within reach of one: the farthest
    point becomes the next centre. None when that takes more than `most` centres."""
    square = points[0] @ points[0]
    centres, near, which = [centre], far.copy(), np.zeros(len(points), np.int64)
    while near[spot := int(near.argmax())] > reach:
        if len(centres) >= most:
            return None
        other = np.sqrt(np.maximum(2 * (square - points @ points[spot]), 0))
        closer = other < near
        near[closer], which[closer] = other[closer], len(centres)
        centres.append(spot)
    return centres, which, near


def grown(ids: np.ndarray, x: np.ndarray) -> dict[str, np.ndarray]:
    """The tree over these rows: rows in the order of leaves, and for each node its centre, its
    covering radius, its parent (nodes come after their parents) and, for leaves, its rows.

    Centres of a level are more than its radius apart, and each lies over the points nearest to it.
    Levels that would cover everything with one centre are left out. A node whose next level would
    have more than a sixteenth of its points as centres is a leaf.
    """
    flat = x.astype(np.float64)
    squares = (flat * flat).sum(axis=1)
    lifted = np.column_stack([flat, np.sqrt(np.maximum(squares.max() - squares, 0))])
    square = squares.max()

    def distances(own: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(np.maximum(2 * (square - lifted[own] @ lifted[centre]), 0))

    every = np.arange(len(ids))
    start = int(squares.argmax())
    todo = [(every, start, distances(every, start), -1)]
    nodes: list[tuple[int, float, int]] = []
    leaves: list[tuple[int, np.ndarray]] = []
    while todo:
        own, centre, far, parent = todo.pop()
        number, radius = len(nodes), float(far.max())
        nodes.append((centre, radius, parent))
        found = None
        if len(own) > LEAF and radius > SLACK * np.sqrt(square):
            found = net(lifted[own], int(np.flatnonzero(own == centre)[0]), far, radius / BASE, len(own) // 16)
        if found is None:
            leaves.append((number, own))
            continue
        centres, which, near = found
        todo += [(own[which == i], int(own[c]), near[which == i], number) for i, c in enumerate(centres)]
    order = np.concatenate([own for _, own in leaves])
    last = np.cumsum([len(own) for _, own in leaves])
    return {"ids": ids[order], "vectors": x[order].astype(np.int32), "centre": np.array([flat[c] for c, _, _ in nodes]),
            "radius": np.array([r for _, r, _ in nodes]), "parent": np.array([p for _, _, p in nodes], np.int32),
            "leaves": np.array([n for n, _ in leaves], np.int32),
            "first": np.concatenate([[0], last[:-1]]).astype(np.int32), "last": last.astype(np.int32)}


TREE_KINDS = {"ids": np.int64, "vectors": np.int32, "centre": np.float64, "radius": np.float64, "parent": np.int32,
              "leaves": np.int32, "first": np.int32, "last": np.int32}


def trees(rows: DataFrame) -> DataFrame:
    """The trees of all rows (id, label, x, dim, shard): one for each dimension, label and shard."""
    def grow(group: pa.Table) -> pa.Table:
        tree = grown(group.column("id").to_numpy(), matrix(group.column("x")))
        head = [pa.array([group.column("dim")[0].as_py()], pa.int32()), pa.array([group.column("label")[0].as_py()]),
                pa.array([group.column("shard")[0].as_py()], pa.int32())]
        return pa.Table.from_arrays([*head, *(pa.array([tree[n].astype(k).tobytes()], pa.binary()) for n, k in TREE_KINDS.items())],
                                    names=[c.split()[0] for c in TREE.split(", ")])

    return rows.groupBy("dim", "label", "shard").applyInArrow(grow, TREE)


def tree_of(row: dict) -> dict:
    out = {n: np.frombuffer(row[n], k) for n, k in TREE_KINDS.items()}
    dim = row["dim"]
    return out | {"vectors": out["vectors"].reshape(-1, dim), "centre": out["centre"].reshape(-1, dim)}


class Search:
    """The k best rows of each of some windows (anchor, least and largest score), over many trees."""

    def __init__(self, anchors: np.ndarray, x: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        """anchors: ids; x: their vectors; at: the anchor of each window."""
        self.anchors, self.x, self.at, self.low, self.high, self.k = anchors, x, at, low, high, k
        self.flat = x.astype(np.float64)
        self.norm = np.sqrt((self.flat * self.flat).sum(axis=1))
        self.window, self.score, self.found = (np.zeros(0, np.int64) for _ in range(3))
        self.kth = np.full(len(at), LOWEST, np.int64)

    def bounds(self, tree: dict) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor and leaf, between what its products lie: the node's own bounds and those
        of all nodes above it."""
        top = np.sqrt((tree["vectors"].astype(np.float64) ** 2).sum(axis=1).max())
        whole = self.norm * top
        with np.errstate(invalid="ignore", divide="ignore"):
            cosine = np.nan_to_num((self.flat @ tree["centre"].T) / whole[:, None])
            spread = 2 * np.arcsin(np.clip(np.nan_to_num(tree["radius"] / (2 * top)) + SLACK, 0, 1))
        angle = np.arccos(np.clip(cosine, -1, 1))
        most = np.cos(np.maximum(angle - spread, 0))
        least = np.cos(np.minimum(angle + spread, np.pi))
        for node, parent in enumerate(tree["parent"].tolist()):
            if parent >= 0:
                np.minimum(most[:, node], most[:, parent], out=most[:, node])
                np.maximum(least[:, node], least[:, parent], out=least[:, node])
        slack = SLACK * whole[:, None]
        return most[:, tree["leaves"]] * whole[:, None] + slack, least[:, tree["leaves"]] * whole[:, None] - slack

    def products(self, anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Exact products of these anchors with these rows."""
        x, y = self.x[anchors], vectors
        largest = int(np.abs(x).max(initial=0)) * int(np.abs(y).max(initial=0)) * x.shape[1]
        if largest < 1 << 53:
            return (self.flat[anchors] @ y.astype(np.float64).T).astype(np.int64)
        return x.astype(np.int64) @ y.astype(np.int64).T

    def visit(self, tree: dict, takes: np.ndarray) -> None:
        """Best first: a round takes the next leaves of each window in the order of their upper
        bounds, 1, 2, 4, ... of them, and leaves out those that cannot matter any more."""
        most, least = self.bounds(tree)
        order = np.argsort(-most, axis=1, kind="stable")
        windows = np.flatnonzero(takes)
        done, step = 0, 1
        while done < order.shape[1] and len(windows):
            leaf = order[self.at[windows], done:done + step]
            upper = np.take_along_axis(most[self.at[windows]], leaf, axis=1)
            lower = np.take_along_axis(least[self.at[windows]], leaf, axis=1)
            floor = np.maximum(self.low[windows], self.kth[windows]).astype(np.float64)[:, None]
            going = upper >= floor
            row, col = np.nonzero(going & (lower <= self.high[windows].astype(np.float64)[:, None]))
            number = leaf[row, col]
            by_leaf = np.argsort(number, kind="stable")
            cut = np.flatnonzero(np.diff(number[by_leaf], prepend=-1))
            parts = []
            for own in np.split(by_leaf, cut[1:]) if len(by_leaf) else []:
                parts.append(self.verified(tree, windows[row[own]], int(number[own[0]])))
            self.merge(parts)
            windows = windows[going[:, -1]]  # later leaves have lower bounds
            done, step = done + step, step * 2

    def verified(self, tree: dict, windows: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, score and id of the leaf's rows inside these windows."""
        own = slice(tree["first"][leaf], tree["last"][leaf])
        ids = tree["ids"][own]
        anchors, spot = np.unique(self.at[windows], return_inverse=True)
        score = self.products(anchors, tree["vectors"][own])[spot]
        least = np.maximum(self.low[windows], self.kth[windows])[:, None]
        i, j = np.nonzero((score >= least) & (score <= self.high[windows][:, None])
                          & (ids[None, :] != self.anchors[self.at[windows]][:, None]))
        return windows[i], score[i, j], ids[j]

    def merge(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        if not parts:
            return
        window, score, found = (np.concatenate(c) for c in zip((self.window, self.score, self.found), *parts, strict=True))
        order = np.lexsort((found, -score, window))
        window, score, found = window[order], score[order], found[order]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        keep = rank < self.k
        self.window, self.score, self.found = window[keep], score[keep], found[keep]
        full = rank == self.k - 1
        self.kth[window[full]] = score[full]


def best(windows: DataFrame, forest: DataFrame, on: list[str], k: int, other_label: bool) -> DataFrame:
    """anchor, place, score and id: the k best of each window (id, place, label, x, low, high), of the trees with
    the same values of `on`; of the anchor's label, or of all others. Ties go to the smaller id."""
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = [np.zeros(0, np.int64)] * 4
        if left.num_rows and right.num_rows:
            ids, first, at = np.unique(left.column("id").to_numpy(), return_index=True, return_inverse=True)
            labels = np.array(left.column("label").to_pylist(), object)
            found = Search(ids, matrix(left.column("x"))[first], at, left.column("low").to_numpy(), left.column("high").to_numpy(), k)
            for batch in right.to_batches(max_chunksize=1):
                row = batch.to_pylist()[0]
                same = labels == row["label"]
                found.visit(tree_of(row), ~same if other_label else same)
            places = left.column("place").to_numpy()
            columns = [ids[at[found.window]], places[found.window], found.score, found.found]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "place", "score", "id"])

    out = windows.groupBy(*on).cogroup(forest.groupBy(*on)).applyInArrow(search, "anchor long, place long, score long, id long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
          factor: float = 256.0, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A row's vector is floor(factor * component), its score the whole-number inner product with the
    anchor. An anchor's positives are the best rows of its label, a positive's negatives the best rows
    of other labels with low * positive <= 100 * negative <= high * positive. Ties go to the smaller key.

    Rows without key or label, or whose vector is null, empty, has a null or non-finite component or
    components whose products would pass 64 bits, take no part. A row with the anchor's key is not its
    own partner. An anchor's key that repeats is used once, with its smallest label and vector; other rows that
    repeat count each. Vectors of different length do not meet. Missing partners give fewer rows, empty
    tables none. Further columns of ``rows`` are not looked at.
    """
    spark = rows.sparkSession
    x = scaled(rows, factor, key, vector, label)
    x = written(x.withColumn("dim", F.size("x")).withColumn("anchor", F.coalesce(is_anchor(F.col("id")), F.lit(False))), "negatives-rows")
    total = x.count()
    if not total:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    counts = x.groupBy("dim", "label").agg(F.ceil(F.count("*") / TREE_ROWS).cast("int").alias("shards"))
    placed = x.join(counts, ["dim", "label"])
    dealt = placed.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(13)), F.col("shards")))
    forest = written(trees(dealt.select("dim", "label", "shard", "id", "x")), "negatives-trees")

    first = F.min(F.struct("label", "x", "shards")).alias("a")
    anchors = placed.where("anchor").groupBy("id", "dim").agg(first).groupBy("id").agg(F.min(F.struct("a", "dim")).alias("b"))
    anchors = anchors.select("id", F.col("b.dim").alias("dim"), "b.a.*")
    anchors = written(anchors, "negatives-anchors")
    block = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(max(1, -(-anchors.count() // ANCHORS)))).cast("int")
    anchors = anchors.withColumn("block", block)

    # positives: the trees of the anchor's label
    share = F.floor(F.col("shard") / TREES).cast("int")
    everything = anchors.withColumns({"place": F.lit(0).cast("long"), "low": F.lit(LOWEST), "high": F.lit(-LOWEST)})
    everything = everything.withColumn("share", F.explode(F.sequence(F.lit(0), F.floor((F.col("shards") - 1) / TREES).cast("int"))))
    blocks = anchors.select("dim", "label", F.col("block").alias("of_block")).distinct()
    own = forest.withColumn("share", share).join(blocks, ["dim", "label"]).withColumnRenamed("of_block", "block")
    on = ["dim", "label", "block", "share"]
    near = written(best(everything.select(*on, "id", "place", "x", "low", "high"), own, on, positives, False), "negatives-positives")

    # negatives: all trees of other labels, in groups
    many = max(1, -(-forest.count() // TREES))
    hundreds = F.expr("score div 100")  # whole hundreds apart from the rest: no product passes 64 bits
    rest = F.col("score") - hundreds * 100
    windows = near.select(F.col("anchor").alias("id"), F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"), "score",
                          (hundreds * low + F.ceil(rest * low / 100)).cast("long").alias("low"),
                          (hundreds * high + F.floor(rest * high / 100)).cast("long").alias("high"))
    windows = windows.where("low <= high").join(anchors.select("id", "dim", "label", "x", "block"), "id")
    shared = windows.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(many - 1))))
    shared = shared.select("dim", "block", "share", "label", "id", "place", "x", "low", "high")
    blocks = anchors.select("dim", F.col("block").alias("of_block")).distinct()
    others = forest.withColumn("share", F.pmod(F.xxhash64("dim", "label", "shard"), F.lit(many)).cast("int"))
    others = others.join(blocks, "dim").withColumnRenamed("of_block", "block")
    hard = best(shared, others, ["dim", "block", "share"], negatives, True)
    return hard.select(F.col("anchor").alias("_anchor"), "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        windows.select("id", "place", "positive_id", F.col("score").alias("positive_score")),
        (F.col("_anchor") == F.col("id")) & (hard["place"] == windows["place"])).select(
        F.col("_anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
