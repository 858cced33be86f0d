"""Repeated paragraphs: MinHash bands, exact check of what collides, one paragraph of a cluster stays.
Passages that no two alike paragraphs hold come from uptrail.llm.passages."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from uptrail.llm.bwt import ROWS, answered, asked, exchange, load, rows, save, state_of
from uptrail.llm.common import LOWER, Rolling, discard, mix, scratch, slices, utf8, word_bounds, written
from uptrail.llm.components import components
from uptrail.llm.jaccard import BACK, Join, STEP, links
from uptrail.llm.passages import passages, stripped as without_passages

ROLL = Rolling(5)
SHARD_BYTES = 8 << 20
OTHER = 0xDA942042E4DD58B5


@dataclass(frozen=True)
class Banding:
    """Paragraphs of at least min_words words; n words in a shingle; percent: the Jaccard similarity
    from which two are repeats. recall: the chance that two at that similarity meet in a band; pairs
    that are more alike meet more often. band: values in a band."""
    n: int = 5
    percent: int = 80
    min_words: int = 20
    recall: float = 0.9999
    band: int = 4
    block: int = 2048
    seed: int = 11

    @property
    def bands(self) -> int:
        """So many that all miss with probability 1 - recall at most."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - (self.percent / 100) ** self.band))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Cut:
    """The paragraphs (lines) of some texts with enough words, and their shingles."""

    def __init__(self, data: np.ndarray, at: np.ndarray, b: Banding):
        breaks = np.flatnonzero(data == 0x0A)
        self.begin = np.unique(np.concatenate([at[:-1], breaks + 1]))
        self.begin = self.begin[self.begin < len(data)]
        edges = np.unique(np.concatenate([at, self.begin, [len(data)]]))
        self.text = np.searchsorted(at, self.begin, side="right") - 1
        start, end, _ = word_bounds(LOWER[data], at)
        first, last = np.searchsorted(start, self.begin), np.searchsorted(start, edges[np.searchsorted(edges, self.begin, side="right")])
        heads = np.searchsorted(self.begin, at[:-1])
        self.number = np.arange(len(self.begin)) - heads[self.text]
        kept = np.flatnonzero(last - first >= max(b.min_words, b.n))
        self.begin, self.text, self.number = self.begin[kept], self.text[kept], self.number[kept]
        self.stop = edges[np.searchsorted(edges, self.begin, side="right")]
        self.words = (last - first)[kept]
        codes = ROLL.of(ROLL.sums(LOWER[data]), start, end)
        many = len(codes)
        up, down = powers(int(STEP), many + 1), powers(BACK, many + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up[:many])])
        other = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes.copy()) * powers(OTHER, many))])
        a, z = first[kept], last[kept]
        self.names = np.stack([mix((sums[z] - sums[a]) * down[a]), mix((other[z] - other[a]) * powers(pow(OTHER, -1, 1 << 64), many + 1)[a])], axis=1)
        size = self.words - b.n + 1
        self.ends = np.cumsum(size)
        place = np.repeat(a - self.ends + size, size) + np.arange(self.ends[-1] if len(size) else 0)
        self.shingles = mix((sums[place + b.n] - sums[place]) * down[place])
        self.size = size

    def bands(self, b: Banding) -> np.ndarray:
        """A row for each paragraph, a code for each band."""
        rng = np.random.default_rng(b.seed)
        out = np.zeros((len(self.words), b.bands), np.uint64)
        if len(self.words):
            heads = self.ends - self.size
            for k in range(b.bands):
                code = np.full(len(heads), k + 1, np.uint64)
                for _ in range(b.band):
                    salt, odd = rng.integers(1, 1 << 63, 2, dtype=np.uint64)
                    least = np.minimum.reduceat((self.shingles ^ salt) * (odd * np.uint64(2) + np.uint64(1)), heads)
                    code = mix(code * STEP + least)
                out[:, k] = code
        return out


def clusters(docs: DataFrame, text: str = "text", key: str = "doc_id", b: Banding = Banding()) -> DataFrame:
    """A row for each paragraph that has a repeat: key, paragraph (number of its line, from 0), start,
    stop (bytes), n_words, cluster_key and cluster_paragraph (the one that stays: the smallest key,
    then line), removed.

    A paragraph is a line of the text with at least min_words words; words are compared with A-Z
    lower-cased. Two are repeats if the Jaccard similarity of their shingles is high enough, exactly
    counted; repeats of repeats are one cluster. Pairs that no band brings together are not looked
    at. Null and empty texts have no paragraphs; null keys come first. Rows that repeat a key are
    repeats of each other.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = slim.schema["_id"].dataType.simpleString()
    total = slim.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    out = f"`{key}` {kind}, paragraph long, start long, stop long, n_words long"
    shards = max(1, -(-total // SHARD_BYTES))
    folder = scratch(spark, "paragraph-shards")

    def bands(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = n = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, n
            shard = TaskContext.get().partitionId() * 1024 + n
            ids, texts, found = zip(*held, strict=True)
            file = save(folder, text=np.concatenate(texts), ids=np.frombuffer(packed_ids(ids), np.uint8), bands=np.concatenate(found),
                        sizes=np.concatenate([i.column("_size").to_numpy() for i in ids]))
            codes, counts = np.unique(np.concatenate(found).ravel(), return_counts=True)
            held, size, n = [], 0, n + 1
            return rows([("state", shard, None, file, None, None), *asked(shard, shards, codes, counts)]).combine_chunks().to_batches()[0]

        for batch in batches:
            for part in slices(batch, "_text"):
                data, at = utf8(part.column("_text"))
                ids = pa.RecordBatch.from_arrays([part.column("_id"), pa.array(np.diff(at))], names=["_id", "_size"])
                held.append((ids, data, Cut(data, at, b).bands(b)))
                size += len(data)
                if size >= SHARD_BYTES:
                    yield flush()
        if held:
            yield flush()

    state = written(slim.mapInArrow(bands, ROWS), "paragraph-bands")

    def colliding(group: pa.Table) -> pa.Table:
        """Paragraphs of which a band is found elsewhere, with their shingles and bands."""
        _, file, _ = state_of(group)
        held = load(folder, file)
        codes, which = np.unique(held["bands"].ravel(), return_inverse=True)
        hit = answered(group, shards, codes)[which].reshape(held["bands"].shape)
        ids = read_ids(held["ids"].tobytes())
        data, at = held["text"], np.concatenate([[0], np.cumsum(held["sizes"])])
        parts, first, paragraph = [], 0, 0
        while first < len(at) - 1:  # in pieces, as they were cut before
            last = max(first + 1, int(np.searchsorted(at, at[first] + (2 << 20), side="right")) - 1)
            c = Cut(data[at[first]:at[last]], at[first:last + 1] - at[first], b)
            own = hit[paragraph:paragraph + len(c.words)]
            for i in np.flatnonzero(own.any(axis=1)).tolist():
                t = first + int(c.text[i])
                a = c.ends[i] - c.size[i]
                parts.append((ids[t], int(c.number[i]), int(at[first] + c.begin[i] - at[t]), int(at[first] + c.stop[i] - at[t]), int(c.words[i]),
                              c.names[i].tobytes(), np.unique(c.shingles[a:c.ends[i]]).tobytes(),
                              held["bands"][paragraph + i][own[i]].view(np.int64).tolist()))
            first, paragraph = last, paragraph + len(c.words)
        cols = list(zip(*parts, strict=True)) or [[]] * 8
        kinds = [group_kind, *[pa.int64()] * 4, pa.binary(), pa.binary(), pa.list_(pa.int64())]
        return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)],
                                    names=["_id", "_number", "_start", "_stop", "_words", "_set", "_codes", "_bands"])

    group_kind = to_arrow_type(slim.schema["_id"].dataType)
    found = written(exchange(state, shards).applyInArrow(
        colliding, f"_id {kind}, _number long, _start long, _stop long, _words long, _set binary, _codes binary, _bands array<long>"), "paragraph-found")
    discard(state)
    different = written(found.groupBy("_set").agg(F.first("_codes").alias("_codes"), F.first("_bands").alias("_bands")), "paragraph-sets")
    different = different.withColumns({"_n": (F.length("_codes") / 8).cast("long"), "_alone": F.lit(0).cast("long")})
    # paragraphs that meet in a band are a block, named by the smallest of them; mostly they meet in many
    in_band = different.select("_set", F.explode("_bands").alias("_band"))
    stars = written(in_band.groupBy("_band").agg(F.min("_set").alias("_least"), F.count("*").alias("_many")).where("_many > 1"), "paragraph-stars")
    blocks = written(in_band.join(stars, "_band").select(F.col("_set").alias("node"), F.col("_least").alias("root")).distinct(), "paragraph-blocks")
    alike = components(links(different.drop("_bands"), blocks, Join(b.n, b.percent, b.block)))
    named = found.drop("_codes", "_bands").join(alike, F.col("_set") == F.col("node"), "left").withColumn("_cluster", F.coalesce("root", "_set"))
    named = written(named, "paragraph-named")
    first = named.groupBy(F.col("_cluster").alias("_c")).agg(F.min(F.struct("_id", "_number")).alias("_first"), F.count("*").alias("_many"))
    first = written(first.where("_many > 1"), "paragraph-first")
    both = named.join(first, F.col("_cluster") == F.col("_c"))
    stays = F.struct("_id", "_number").eqNullSafe(F.col("_first"))
    names = [c.split()[0].strip("`") for c in out.split(", ")]
    own = [F.col(c).alias(n) for c, n in zip(["_id", "_number", "_start", "_stop", "_words"], names, strict=True)]
    return both.select(*own, F.col("_first._id").alias("cluster_key"), F.col("_first._number").alias("cluster_paragraph"), (~stays).alias("removed"))


def repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", b: Banding = Banding()) -> DataFrame:
    """The rows of clusters() and those of passages(), and unit: 'line' or 'passage'."""
    runs = written(passages(docs, text, key), "paragraph-passages")
    return clusters(docs, text, key, b).withColumn("unit", F.lit("line")).union(runs.withColumn("unit", F.lit("passage")))


def packed_ids(parts: tuple[pa.RecordBatch, ...]) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, parts[0].select(["_id"]).schema) as stream:
        for p in parts:
            stream.write_batch(p.select(["_id"]))
    return out.getvalue().to_pybytes()


def read_ids(data: bytes) -> list:
    return pa.ipc.open_stream(data).read_all().column("_id").to_pylist()


def stripped(docs: DataFrame, text: str = "text", key: str = "doc_id", b: Banding = Banding()) -> DataFrame:
    """The rows with their texts without the lines that go, and then without the passages that go; a
    text of which all stays is as it was. Rows that repeat a key lose their own lines only."""
    numbered = written(docs.withColumn("_paragraph_row", F.struct(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"))), "paragraph-rows")
    lines_gone = clusters(numbered, text, "_paragraph_row", b).where("removed")
    gone = lines_gone.groupBy(F.col("_paragraph_row.row").alias("_paragraph_lost")).agg(F.collect_set("paragraph").alias("_paragraph_gone"))
    out = numbered.join(written(gone, "paragraph-gone"), F.col("_paragraph_row.row") == F.col("_paragraph_lost"), "left")
    left = F.filter(F.split(F.col(text), "\n", -1), lambda _, i: ~F.array_contains("_paragraph_gone", i.cast("long")))
    lines = out.select(*[F.when(F.col("_paragraph_gone").isNull(), F.col(text)).otherwise(F.array_join(left, "\n")).alias(text) if c == text else F.col(c)
                        for c in docs.columns])
    return without_passages(lines, text, key)
