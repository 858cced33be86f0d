"""Jaccard join of documents on word n-grams, as a blocked product of sparse incidence matrices.

The matrix has a row for each different set of n-grams and a column for each n-gram; its product
with its own transpose holds the sizes of all intersections. Only parts of it are computed:

- Two sets can only link if each holds at least `share` of the other. So a row in which more
  n-grams than that stand alone goes. First on a fixed part of all n-grams, chosen by their code,
  with the bound for whole sets; then on all of them, for the rows left.
- Of what is left, two rows can only link if they share one of their rarest n-grams, so many that
  the others are too few. Rows joined by such columns form the blocks of the matrix.
- In a block, rows are multiplied with all others, and links of the pairs at or above the bound
  join components. Once the rows not yet multiplied are all in one component, the rest of the
  product can change nothing and is left out. A block of many rows is cut into column blocks.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from uptrail.llm.bwt import ROWS, dealt, load, rows, save, state_of
from uptrail.llm.common import LOWER, Rolling, discard, discard_folder, mix, n_words, scratch, slices, utf8, word_bounds, written
from uptrail.llm.components import components

ROLL = Rolling(2)
STEP = np.uint64(0xD1342543DE82EF95)
BACK = pow(0xD1342543DE82EF95, -1, 1 << 64)
#: Bytes of n-gram codes in a shard.
SHARD_BYTES = 6 << 20
#: Bytes of n-gram codes that count as one row of a block.
ROW_BYTES = 8192
#: The first look takes half of each code: what it counts too often, it only lets through to the second look.
SHORT = np.uint32


@dataclass(frozen=True)
class Join:
    """Documents link if 100 * |x and y| >= percent * |x or y|. block: rows that one task multiplies."""
    n: int = 3
    percent: int = 90
    block: int = 2048

    @property
    def part(self) -> int:
        """The first look takes one in so many n-grams, by code: twice as many as may be missing."""
        return max(1, int(100 / (2 * max(1, 100 - self.percent)) + 1e-9))

    def spare(self, size):
        """So many members of a set may be missing in one that it links with."""
        return size - -(-self.percent * size // 100)


def shingles(data: np.ndarray, at: np.ndarray, n: int, low: bool = True) -> list[np.ndarray]:
    """For each text the codes of its different n-grams of words, in order. A text of fewer words
    has one, the whole sequence; one without words has none."""
    if low:
        data = LOWER[data]
    start, end, first = word_bounds(data, at)
    codes = ROLL.of(ROLL.sums(data), start, end)
    many = len(codes)
    up = np.full(many + 1, int(STEP), np.uint64)
    up[:1] = 1
    up = np.multiply.accumulate(up)
    down = np.full(many + 1, BACK, np.uint64)
    down[:1] = 1
    down = np.multiply.accumulate(down)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up[:many])])
    windows = mix((sums[n:] - sums[:-n]) * down[:max(0, many + 1 - n)]) if many >= n else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            own = np.sort(windows[a:b - n + 1])
            fresh = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            out.append(own[fresh])
        else:
            out.append(mix((sums[[b]] - sums[[a]]) * down[[a]] + np.uint64(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def digest(codes: np.ndarray) -> bytes:
    """128 bits of a set, and its size."""
    with np.errstate(over="ignore"):
        a, b = mix(codes + np.uint64(1)).sum(dtype=np.uint64), mix(codes ^ STEP).sum(dtype=np.uint64)
    return struct.pack(">IQQ", len(codes), int(a), int(b))


def sets(docs: DataFrame, carry: list[str], join: Join, part: int, kind: type = np.uint64) -> DataFrame:
    """carry, _n, _set (a digest), _codes: one in `part` of the n-grams of _text, as numbers of a kind."""
    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_text"):
                found = shingles(*utf8(piece.column("_text")), join.n)
                kept = [x[x % np.uint64(part) == 0] if part > 1 else x for x in found]
                if kind is not np.uint64:
                    kept = [(x >> np.uint64(32)).astype(kind) for x in kept]
                yield pa.RecordBatch.from_arrays([
                    *(piece.column(c) for c in carry), pa.array([len(x) for x in found], pa.int64()),
                    pa.array([digest(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in kept], pa.binary())],
                    names=[*carry, "_n", "_set", "_codes"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return docs.select(*carry, "_text").mapInArrow(
        made, ", ".join(f"`{c}` {kinds[c]}" for c in carry) + ", _n long, _set binary, _codes binary")


def counted(group: pa.Table, kind: type) -> pa.Table:
    """For each asking row, how many sets hold each of its codes, 255 at most."""
    codes = [np.frombuffer(x, kind) for x in group.column("a").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint8) for x in group.column("b").to_pylist()])
    _, which = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.minimum(np.bincount(which, weights=counts), 255).astype(np.uint8)[which]
    parts = np.split(total, np.cumsum([len(x) for x in codes])[:-1])
    return rows([("answer", s, b, None, x.tobytes(), None) for s, b, x in zip(
        group.column("shard").to_pylist(), group.column("bucket").to_pylist(), parts, strict=True)])


def frequencies(group: pa.Table, buckets: int, codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes), np.int64)
    bucket = (codes % codes.dtype.type(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for kind, b, x in zip(group.column("kind").to_pylist(), group.column("bucket").to_pylist(), group.column("a").to_pylist(), strict=True):
        if kind == "answer":
            out[order[ends[b]:ends[b + 1]]] = np.frombuffer(x, np.uint8)
    return out


def with_frequencies(found: DataFrame, name: str, judge, schema: str, total: int, kind: type = np.uint64) -> DataFrame:
    """judge(sets, sizes, codes, frequency of each code) for each shard of the sets.

    A shard keeps its codes in a file and asks once for each different one; a code that a third of
    all sets have comes from each shard once.
    """
    spark = found.sparkSession
    width = np.dtype(kind).itemsize
    shards = max(1, -(-total * width // SHARD_BYTES))
    folder = scratch(spark, name)

    def ask(group: pa.Table) -> pa.Table:
        shard = group.column("_shard")[0].as_py()
        codes = np.frombuffer(b"".join(group.column("_codes").to_pylist()), kind)
        file = save(folder, sets=np.frombuffer(b"".join(group.column("_set").to_pylist()), np.uint8), codes=codes,
                    many=np.array([len(x) // width for x in group.column("_codes").to_pylist()], np.int64), sizes=group.column("_n").to_numpy())
        kinds, counts = np.unique(codes, return_counts=True)
        out = [("state", shard, None, file, None, None)]
        return rows(out + asked(shard, shards, kinds, counts))

    def answered(group: pa.Table) -> pa.Table:
        _, file, _ = state_of(group)
        held = load(folder, file)
        kinds, which = np.unique(held["codes"], return_inverse=True)
        names = held["sets"].reshape(len(held["sizes"]), -1)
        return judge([x.tobytes() for x in names], held["sizes"], held["many"], held["codes"], frequencies(group, shards, kinds)[which])

    state = found.withColumn("_shard", F.pmod(F.xxhash64("_set"), F.lit(shards)).cast("int"))
    state = written(dealt(state, "_shard", shards).applyInArrow(ask, ROWS), f"{name}-asked")
    answers = dealt(state.where("kind = 'ask'"), "bucket", shards).applyInArrow(lambda t: counted(t, kind), ROWS)
    judged = written(dealt(state.where("kind = 'state'").union(answers), "shard", shards).applyInArrow(answered, schema), f"{name}-judged")
    discard(state)
    discard_folder(spark, folder)
    return judged


def asked(shard: int, buckets: int, codes: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """Rows that carry the codes, in order, to the buckets which count them; counts up to 255."""
    full = np.minimum(counts, 255).astype(np.uint8)
    bucket = (codes % codes.dtype.type(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [("ask", shard, b, None, codes[order[x:y]].tobytes(), full[order[x:y]].tobytes())
            for b, (x, y) in enumerate(zip(ends, ends[1:], strict=False)) if y > x]


class Product:
    """Rows of a block's product: the sizes of intersections, and components of the links."""

    def __init__(self, join: Join, codes: list[np.ndarray], sizes: np.ndarray):
        self.join, self.sizes = join, sizes
        self.rows = codes
        owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        order = np.argsort(np.concatenate([np.zeros(0, np.uint64), *codes]), kind="stable")
        every = np.concatenate([np.zeros(0, np.uint64), *codes])[order]
        self.columns, first = np.unique(every, return_index=True)
        self.ends = np.append(first, len(every))
        self.holders = owner[order]
        self.labels = np.arange(len(codes))

    def linked(self, codes: np.ndarray, size: int) -> np.ndarray:
        """The rows that link with a set."""
        spot = np.searchsorted(self.columns, codes)
        inside = spot < len(self.columns)
        inside[inside] = self.columns[spot[inside]] == codes[inside]
        spot = spot[inside]
        a, b = self.ends[spot], self.ends[spot + 1]
        at = np.repeat(a - np.cumsum(b - a) + (b - a), b - a) + np.arange((b - a).sum())
        both = np.bincount(self.holders[at], minlength=len(self.sizes))
        return np.flatnonzero((both > 0) & (100 * both >= self.join.percent * (self.sizes + size - both)))

    def merge(self, linked: np.ndarray) -> None:
        if len(linked) > 1:
            own = np.unique(self.labels[linked])
            if len(own) > 1:
                self.labels[np.isin(self.labels, own)] = own[0]

    def solve(self, best: np.ndarray) -> np.ndarray:
        """Components of all rows. best: the rows in the order in which they are to be multiplied;
        those of the largest component come last, and not at all once no others are left."""
        open_ = np.ones(len(self.sizes), bool)
        row = best[0]
        while True:
            open_[row] = False
            self.merge(self.linked(self.rows[row], int(self.sizes[row])))
            left = best[open_[best]]
            names, counts = np.unique(self.labels[left], return_counts=True)
            if len(names) < 2:
                break
            row = left[self.labels[left] != names[np.argmax(counts)]][0]
        # the last component was not multiplied with itself, but with all others
        return self.labels


def solved(join: Join):
    """Components of the blocks in a group of small blocks: (set, root) for the rows that link."""
    def solve(group: pa.Table) -> pa.Table:
        block = np.array(group.column("_block").to_pylist(), object)
        order = np.argsort(block, kind="stable")
        ends = np.flatnonzero(np.concatenate([[True], block[order][1:] != block[order][:-1], [True]]))
        names, codes = group.column("_set").to_pylist(), group.column("_codes").to_pylist()
        sizes, lone = group.column("_n").to_numpy(), group.column("_alone").to_numpy()
        out: list = []
        for a, b in zip(ends, ends[1:], strict=False):
            own = order[a:b]
            p = Product(join, [np.frombuffer(codes[i], np.uint64) for i in own], sizes[own])
            hubs = np.lexsort((np.array([names[i] for i in own], object), lone[own] / sizes[own]))
            labels = p.solve(hubs)
            least = {}
            for i, label in zip(own, labels.tolist(), strict=True):
                least[label] = min(least.get(label, names[i]), names[i])
            out += [(names[i], least[label]) for i, label in zip(own, labels.tolist(), strict=True) if names[i] != least[label]]
        cols = list(zip(*out, strict=True)) or [[], []]
        return pa.Table.from_arrays([pa.array(c, pa.binary()) for c in cols], names=["a", "b"])
    return solve


def multiplied(join: Join):
    """Links between chosen rows and a column block, so many that their components are the same."""
    def multiply(group: pa.Table) -> pa.Table:
        names, codes = group.column("_set").to_pylist(), group.column("_codes").to_pylist()
        sizes, chosen = group.column("_n").to_numpy(), np.array(group.column("_row").to_pylist(), bool)
        block, lines = np.flatnonzero(~chosen), np.flatnonzero(chosen)
        p = Product(join, [np.frombuffer(codes[i], np.uint64) for i in block], sizes[block])
        out = []
        for i in lines:
            linked = p.linked(np.frombuffer(codes[i], np.uint64), int(sizes[i]))
            if len(linked):
                p.merge(linked)
                out.append((names[i], names[block[linked[0]]]))
        for label in np.unique(p.labels).tolist():
            own = np.flatnonzero(p.labels == label)
            out += [(names[block[own[0]]], names[block[x]]) for x in own[1:]]
        cols = list(zip(*out, strict=True)) or [[], []]
        return pa.Table.from_arrays([pa.array(c, pa.binary()) for c in cols], names=["a", "b"])
    return multiply


def links(found: DataFrame, blocks: DataFrame, join: Join) -> DataFrame:
    """a, b: links between sets, so many that their components are those of all links."""
    found = found.join(blocks.withColumnRenamed("root", "_block"), found["_set"] == blocks["node"]).drop("node")
    # long rows count for several
    weighed = found.groupBy(F.col("_block").alias("_b")).agg(F.greatest(F.count("*"), F.ceil(F.sum(F.length("_codes")) / ROW_BYTES)).alias("_rows"))
    sized = written(found.join(written(weighed, "jaccard-blocks"), F.col("_block") == F.col("_b")).drop("_b"), "jaccard-rows")
    small = sized.where(F.col("_rows") <= join.block)
    many = -(-small.count() // join.block) * 4 + 1
    groups = small.withColumn("_group", F.pmod(F.xxhash64("_block"), F.lit(many)))
    out = dealt(groups, "_group", many).applyInArrow(solved(join), "a binary, b binary")
    large = sized.where(F.col("_rows") > join.block)
    if large.isEmpty():
        return written(out, "jaccard-links")
    # column blocks of a large block; the row with fewest n-grams of its own is multiplied first
    large = large.withColumn("_column", F.pmod(F.xxhash64("_set", F.lit(1)), F.ceil(F.col("_rows") / join.block).cast("long")))
    hub = large.groupBy("_block").agg(F.min(F.struct(F.col("_alone") / F.col("_n"), "_set")).alias("_h")).select(
        F.col("_block").alias("_hb"), F.col("_h._set").alias("_hs"))
    fields = ["_block", "_column", "_set", "_n", "_codes"]

    def product(lines: DataFrame) -> DataFrame:
        spread = lines.withColumn("_column", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_rows") / join.block).cast("long") - 1)))
        spread = spread.withColumn("_chunk", F.pmod(F.xxhash64("_set", F.lit(2)), F.ceil(F.col("_lines") / join.block).cast("long")))
        chunks = written(spread.groupBy("_block").agg(F.max("_chunk").alias("_last")), "jaccard-chunks").select(F.col("_block").alias("_cb"), "_last")
        block = large.join(chunks, F.col("_block") == F.col("_cb")).withColumn(
            "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
        both = block.select(*fields, "_chunk", F.lit(False).alias("_row")).union(spread.select(*fields, "_chunk", F.lit(True).alias("_row")))
        return written(both.groupBy("_block", "_column", "_chunk").applyInArrow(multiplied(join), "a binary, b binary"), "jaccard-product")

    first = product(large.join(hub, (F.col("_block") == F.col("_hb")) & (F.col("_set") == F.col("_hs"))).withColumn("_lines", F.lit(1)))
    # rows that the hub links are one component; what is not in it is multiplied with all
    held = components(first)
    hubs = hub.join(held, F.col("_hs") == F.col("node")).select(F.col("_hb"), F.col("root").alias("_main"))
    apart = large.join(held, F.col("_set") == F.col("node"), "left").join(hubs, F.col("_block") == F.col("_hb"), "left")
    apart = apart.where("NOT coalesce(root = _main, false)").select(*large.columns)
    number = written(apart.groupBy(F.col("_block").alias("_nb")).agg(F.count("*").alias("_lines")), "jaccard-apart")
    second = product(apart.join(number, F.col("_block") == F.col("_nb")).drop("_nb"))
    return written(out.union(first).union(second), "jaccard-links")


def joined(docs: DataFrame, text: str = "text", key: str = "doc_id", join: Join = Join(), group: str | None = None) -> DataFrame:
    """The rows with n_shingles and component_id, columns of these names replaced. group: a column with
    a name for each component besides, null for rows without words.

    Words are what white space (ASCII) separates, A-Z lower-cased. component_id is the smallest key
    that can be reached by links, the row's own included; rows with equal sets link. Rows without
    words link with nothing. Null keys are larger than all others: a component_id is null only if
    all keys of the component are. Rows that repeat a key are rows of their own.
    """
    keyed = docs.drop("n_shingles", "component_id")
    slim = keyed.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn(
        "_hash", F.unhex(F.md5("_text")))
    coded = written(sets(slim, ["_id", "_hash"], join, join.part, SHORT), "jaccard-sets")
    made = written(coded.drop("_codes"), "jaccard-names")
    roots = resolved(coded, made, slim, join)
    least = made.where("_n > 0").groupBy("_set").agg(F.min("_id").alias("_least"))
    whole = roots.join(least.withColumnRenamed("_set", "node"), "node").groupBy("root").agg(F.min("_least").alias("_whole"))
    whole = written(roots.join(whole, "root").select("node", "root", "_whole"), "jaccard-components")
    ids = written(least.join(whole, F.col("_set") == F.col("node"), "left").select(
        F.col("_set").alias("_s"), F.coalesce("root", "_set").alias("_root"), F.coalesce("_whole", "_least").alias("_component")), "jaccard-ids")
    # rows with equal texts have equal sets, so the text's hash leads from the rows to them
    sets_ = made.select("_hash", "_n", "_set").groupBy("_hash").agg(F.first("_n").alias("_n"), F.first("_set").alias("_set"))
    of = written(sets_.join(ids, F.col("_set") == F.col("_s"), "left").select(
        F.col("_hash").alias("_jaccard_h"), F.col("_n").alias("_jaccard_n"), F.col("_component").alias("_jaccard_c"), F.col("_root").alias("_jaccard_g")), "jaccard-texts")
    out = keyed.withColumn("_jaccard_hash", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
    out = out.join(of, F.col("_jaccard_hash") == F.col("_jaccard_h"))
    own = F.when(F.col("_jaccard_n") > 0, F.col("_jaccard_c")).otherwise(F.col(key))
    named = [F.col("_jaccard_g").alias(group)] if group else []
    return out.select(*keyed.columns, F.col("_jaccard_n").alias("n_shingles"), own.alias("component_id"), *named)


def one_each(docs: DataFrame, text: str = "text", key: str = "doc_id", join: Join = Join(n=5, percent=80)) -> DataFrame:
    """One row of each component: that with the smallest key. Rows without words all stay. Of rows
    that repeat the smallest key, or have none but null keys, one stays."""
    names = docs.columns
    slim = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    marked = joined(slim, "_text", "_id", join, "_group").where("_group IS NOT NULL")
    # of each component one key and text; rows that share both are told apart at the end
    hashed = lambda c: F.unhex(F.md5(F.coalesce(F.col(c), F.lit(""))))
    first = marked.groupBy("_group").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), hashed("_text").alias("hash"))).alias("_lead"))
    first = written(first.select(F.col("_lead.id").alias("_lead_id"), F.col("_lead.hash").alias("_lead_hash")), "jaccard-lead")
    rows_ = docs.withColumns({"_jaccard_key": F.col(key), "_jaccard_hash": hashed(text)})
    lead = rows_.join(first, (F.col("_jaccard_hash") == F.col("_lead_hash")) & F.col("_jaccard_key").eqNullSafe(F.col("_lead_id")), "left_semi")
    bare = rows_.where(n_words(text) == 0)
    pair = ["_jaccard_key", "_jaccard_hash"]
    seen = docs.select(F.col(key).alias("_again_key"), hashed(text).alias("_again_hash")).groupBy("_again_key", "_again_hash").count()
    again = written(seen.where("count > 1").drop("count"), "jaccard-again")
    same = (F.col("_jaccard_hash") == F.col("_again_hash")) & F.col("_jaccard_key").eqNullSafe(F.col("_again_key"))
    tied = lead.join(again, same, "left_semi").dropDuplicates(pair)
    alone = lead.join(again, same, "left_anti")
    return alone.union(tied).union(bare).select(*names)


def resolved(coded: DataFrame, made: DataFrame, slim: DataFrame, join: Join) -> DataFrame:
    """node, root: components of the different sets that link with another."""
    spark = made.sparkSession

    def passing(names: list, sizes: np.ndarray, many: np.ndarray, codes: np.ndarray, frequency: np.ndarray) -> pa.Table:
        alone = np.bincount(np.repeat(np.arange(len(sizes)), many), weights=frequency < 2, minlength=len(sizes))
        kept = np.flatnonzero(alone <= join.spare(sizes)).tolist()
        return pa.Table.from_arrays([pa.array([names[i] for i in kept], pa.binary())], names=["_kept"])

    classes = coded.where("_n > 0").groupBy("_set", "_n").agg(F.first("_codes").alias("_codes"))
    total = int((made.agg(F.sum("_n")).first()[0] or 0) / join.part)
    some = with_frequencies(classes, "jaccard-part", passing, "_kept binary", total, SHORT)
    discard(coded)
    texts = made.where("_n > 0").groupBy("_set").agg(F.min("_hash").alias("_h"))
    wanted = written(texts.join(some, F.col("_set") == F.col("_kept")).select("_h"), "jaccard-wanted")
    # copies are brought down to one text before the join, so that no text is frequent in it
    single = slim.groupBy("_hash").agg(F.first("_text").alias("_text")).join(wanted, F.col("_hash") == F.col("_h")).select("_hash", "_text")
    full = written(sets(single, ["_hash"], join, 1), "jaccard-full")

    def prefixes(names: list, sizes: np.ndarray, many: np.ndarray, codes: np.ndarray, frequency: np.ndarray) -> pa.Table:
        spare = join.spare(sizes)
        ends = np.cumsum(many)
        out, columns, alone_ = [], [], []
        for i, (name, end, size) in enumerate(zip(names, ends.tolist(), many.tolist(), strict=True)):
            own, often = codes[end - size:end], frequency[end - size:end]
            alone = int((often < 2).sum())
            if alone <= spare[i]:
                rare = np.lexsort((own, often))[alone:spare[i] + 1]
                out += [name] * len(rare)
                columns.append(own[rare])
                alone_ += [alone] * len(rare)
        gram = np.concatenate([np.zeros(0, np.uint64), *columns]).view(np.int64)
        return pa.Table.from_arrays([pa.array(out, pa.binary()), pa.array(gram, pa.int64()), pa.array(alone_, pa.int64())],
                                    names=["_set", "_gram", "_alone"])

    rare = with_frequencies(full, "jaccard-rare", prefixes, "_set binary, _gram long, _alone long",
                            full.agg(F.sum("_n")).first()[0] or 0)
    if rare.isEmpty():
        return spark.createDataFrame([], "node binary, root binary")
    # each column as a star around its smallest row
    stars = written(rare.groupBy("_gram").agg(F.min("_set").alias("_least"), F.count("*").alias("_many")).where("_many > 1"), "jaccard-stars")
    edges = rare.join(stars, "_gram").where("_set <> _least").select("_set", "_least").distinct()
    blocks = components(edges, "_set", "_least")
    alone = rare.groupBy(F.col("_set").alias("_as")).agg(F.first("_alone").alias("_alone"))
    rows_ = full.select("_set", "_n", "_codes").join(written(alone, "jaccard-alone"), F.col("_set") == F.col("_as")).drop("_as")
    return components(links(rows_, blocks, join))
