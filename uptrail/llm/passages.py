"""Repeated passages: runs of words that stand anywhere else, over line ends and inside longer lines.

Every window of `words` words picks the least code among its grams of half as many words (winnowing),
so equal windows pick equal grams wherever they stand. A first exchange counts the picked grams; the
windows whose gram is repeated are then asked for by their own code, and the answer names the place
that stays. Consecutive windows with consecutive answers are one run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from uptrail.llm.bwt import ROWS, answered, asked, dealt, exchange, load, rows, save, state_of
from uptrail.llm.common import LOWER, Rolling, discard, discard_folder, mix, scratch, slices, utf8, word_bounds, written
from uptrail.llm.jaccard import BACK, STEP

ROLL = Rolling(6)
SHARD_BYTES = 8 << 20
PIECE_WORDS = 1 << 16


def sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """op over the n values from each place on; fewer at the end."""
    out, width = x.copy(), 1
    while width < n and len(x) > width:
        step = min(width, n - width)
        out[:-step] = op(out[:-step], out[step:])
        width += step
    return out


class Windows:
    """The words of some texts, and their windows: a place for each word that begins one."""

    def __init__(self, data: np.ndarray, at: np.ndarray, words: int):
        low = LOWER[data]
        self.start, self.end, first = word_bounds(low, at)
        self.first, self.words = first, words
        self.owner = np.repeat(np.arange(len(at) - 1), np.diff(first))
        many = len(self.start)
        codes = np.zeros(many, np.uint64)
        for i in range(0, many, PIECE_WORDS):  # byte sums take sixteen times the text
            a, z = self.start[i:i + PIECE_WORDS], self.end[i:i + PIECE_WORDS]
            codes[i:i + PIECE_WORDS] = ROLL.of(ROLL.sums(low[a[0]:z[-1]]), a - a[0], z - a[0])
        up = np.full(many + 1, int(STEP), np.uint64)
        down = np.full(many + 1, BACK, np.uint64)
        up[:1] = down[:1] = 1
        self.down = np.multiply.accumulate(down)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * np.multiply.accumulate(up)[:many])])
        places = np.arange(max(0, many - words + 1))
        self.whole = self.owner[places] == self.owner[places + words - 1]
        half = max(1, words // 2)
        grams = self.codes(np.arange(max(0, many - half + 1)), half)
        width = words - half + 1
        # the least gram of each window, and the grams that are least in one
        self.least = sliding(grams, width, np.minimum)[:len(places)]
        most = np.zeros(len(grams), np.uint64)
        most[:len(places)] = np.where(self.whole, self.least, 0)
        most = sliding(most[::-1], width, np.maximum)[::-1]
        self.picked = grams[most == grams]

    def codes(self, place: np.ndarray, n: int) -> np.ndarray:
        return mix((self.sums[place + n] - self.sums[place]) * self.down[place])


def table_bytes(t: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(t)
    return out.getvalue().to_pybytes()


def read_table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


class Search:
    """The steps of a search, each a function on the rows of one shard or bucket."""

    def __init__(self, folder: str, words: int, shards: int, kind: pa.DataType):
        self.folder, self.words, self.shards, self.kind = folder, words, shards, kind

    def kept(self, shard: int, held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]) -> pa.Table:
        """Keeps texts in a file, by key and row, and asks for the grams that their windows pick."""
        ids = pa.Table.from_batches([x[0] for x in held])
        data, sizes = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
        held.clear()
        order = pc.sort_indices(ids, [("_id", "ascending"), ("_row", "ascending")], null_placement="at_start").to_numpy()
        ends = np.cumsum(sizes)
        data = np.concatenate([data[ends[i] - sizes[i]:ends[i]] for i in order.tolist()])
        sizes = sizes[order]
        file = save(self.folder, text=data, sizes=sizes, ids=np.frombuffer(table_bytes(ids.take(pa.array(order))), np.uint8))
        at = np.concatenate([[0], np.cumsum(sizes)])
        codes, counts = np.unique(Windows(data, at, self.words).picked, return_counts=True)
        return rows([("state", shard, None, file, None, None), *asked(shard, self.shards, codes, counts)])

    def held(self, file: str) -> tuple[pa.Table, np.ndarray, np.ndarray, Windows]:
        x = load(self.folder, file)
        at = np.concatenate([[0], np.cumsum(x["sizes"])])
        return read_table(x["ids"].tobytes()), x["text"], at, Windows(x["text"], at, self.words)

    def firsts(self, w: Windows, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Of the windows at some places: the different codes, in the order of their first places; those
        places; the code of each window, by number; and the numbers that each bucket is asked for."""
        codes, first, which, counts = np.unique(w.codes(place, self.words), return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(first)
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        codes = codes[order]
        bucket = (codes % np.uint64(self.shards)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[by], np.arange(self.shards + 1))
        self.counts = np.minimum(counts[order], 2).astype(np.uint8)
        return codes, place[first[order]], number[which], [by[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def windows(self, group: pa.Table) -> pa.Table:
        """Asks for the windows whose gram is repeated."""
        shard, file, _ = state_of(group)
        ids, data, at, w = self.held(file)
        picked = np.unique(w.picked)
        place = np.flatnonzero(w.whole)
        place = place[answered(group, self.shards, picked)[np.searchsorted(picked, w.least[place])]]
        codes, first, _, buckets = self.firsts(w, place)
        breaks = np.flatnonzero(data == 0x0A)
        text = w.owner[first]
        lines = np.searchsorted(breaks, w.start[first]) - np.searchsorted(breaks, at[text])
        known = pa.table({"id": ids.column("_id").take(pa.array(text)), "row": ids.column("_row").take(pa.array(text)),
                          "word": pa.array(first - w.first[text], pa.int64()), "line": pa.array(lines, pa.int64()), "many": pa.array(self.counts)})
        out = [("state", shard, None, f"{file}/{save(self.folder, place=place)}", None, None)]
        return rows(out + [("ask", shard, b, None, codes[x].tobytes(), table_bytes(known.take(pa.array(x)))) for b, x in enumerate(buckets) if len(x)])

    def first_places(self, group: pa.Table) -> pa.Table:
        """For each asking row, the windows that occur twice or more and the first place of each."""
        codes = [np.frombuffer(x, np.uint64) for x in group.column("a").to_pylist()]
        known = pa.concat_tables([read_table(x) for x in group.column("b").to_pylist()])
        _, which = np.unique(np.concatenate(codes), return_inverse=True)
        twice = np.bincount(which, weights=known.column("many").to_numpy()) >= 2
        order = pc.sort_indices(known, [("id", "ascending"), ("row", "ascending"), ("word", "ascending")], null_placement="at_start").to_numpy()
        by = order[np.argsort(which[order], kind="stable")]
        lead = by[np.searchsorted(which[by], np.arange(len(twice)))]
        known, out, at = known.drop_columns(["many"]), [], 0
        for s, b, x in zip(group.column("shard").to_pylist(), group.column("bucket").to_pylist(), codes, strict=True):
            own = which[at:at + len(x)]
            at += len(x)
            out.append(("answer", s, b, None, twice[own].astype(np.uint8).tobytes(), table_bytes(known.take(pa.array(lead[own[twice[own]]])))))
        return rows(out)

    def runs(self, group: pa.Table) -> pa.Table:
        """The runs of windows that are the same as consecutive first ones."""
        _, file, _ = state_of(group)
        file, more = file.split("/")
        ids, data, at, w = self.held(file)
        place = load(self.folder, more)["place"]
        codes, _, which, buckets = self.firsts(w, place)
        spot = np.full(len(codes), -1, np.int64)
        found, many = [], 0
        for kind, b, a, t in zip(*(group.column(c).to_pylist() for c in ("kind", "bucket", "a", "b")), strict=True):
            if kind == "answer":
                hit = buckets[b][np.frombuffer(a, np.uint8) > 0]
                spot[hit] = many + np.arange(len(hit))
                many += len(hit)
                found.append(read_table(t))
        place, spot = place[spot[which] >= 0], spot[which][spot[which] >= 0]
        known = pa.concat_tables(found) if found else pa.table({"id": pa.array([], self.kind)} | {c: pa.array([], pa.int64()) for c in ("row", "word", "line")})
        known = known.take(pa.array(spot))
        text, row, word = w.owner[place], known.column("row").to_numpy(), known.column("word").to_numpy()
        new = np.ones(len(place), bool)
        new[1:] = (np.diff(place) > 1) | (np.diff(text) != 0) | (np.diff(row) != 0) | (np.diff(word) != 1)
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(place))[:len(head)] - 1
        a, z, text = place[head], place[last] + self.words - 1, text[head]
        own = ids.column("_row").take(pa.array(text)).to_numpy()
        breaks = np.flatnonzero(data == 0x0A)
        first = known.take(pa.array(head))
        stays = (row[head] == own) & (word[head] == a - w.first[text])
        long = lambda x: pa.array(x, pa.int64())
        return pa.Table.from_arrays([
            ids.column("_id").take(pa.array(text)).combine_chunks(), long(own), long(np.searchsorted(breaks, w.start[a]) - np.searchsorted(breaks, at[text])),
            long(w.start[a] - at[text]), long(w.end[z] - at[text]), long(z - a + 1), first.column("id"), first.column("line"), pa.array(~stays)],
            names=["_id", "_row", "paragraph", "start", "stop", "n_words", "cluster_key", "cluster_paragraph", "removed"])


def found(docs: DataFrame, text: str, key: str, row: str | None, words: int) -> DataFrame:
    """_id, _row and the columns of passages(). row: a column that numbers the rows."""
    spark = docs.sparkSession
    number = F.col(row) if row else F.monotonically_increasing_id()
    slim = docs.select(F.col(key).alias("_id"), number.cast("long").alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = slim.schema["_id"].dataType
    total = slim.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    folder = scratch(spark, "passage-shards")
    search = Search(folder, words, shards, to_arrow_type(kind))

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = n = 0
        shard = lambda: TaskContext.get().partitionId() * 1024 + n
        for batch in batches:
            for part in slices(batch, "_text"):
                data, at = utf8(part.column("_text"))
                held.append((part.select(["_id", "_row"]), data, np.diff(at)))
                size += len(data)
                if size >= SHARD_BYTES:
                    yield search.kept(shard(), held).combine_chunks().to_batches()[0]
                    held, size, n = [], 0, n + 1
        if held:
            yield search.kept(shard(), held).combine_chunks().to_batches()[0]

    grams = written(slim.mapInArrow(kept, ROWS), "passage-grams")
    asking = written(exchange(grams, shards).applyInArrow(lambda t: search.windows(t), ROWS), "passage-windows")
    discard(grams)
    answers = dealt(asking.where("kind = 'ask'"), "bucket", shards).applyInArrow(lambda t: search.first_places(t), ROWS)
    name = kind.simpleString()
    out = written(dealt(asking.where("kind = 'state'").union(answers), "shard", shards).applyInArrow(
        lambda t: search.runs(t), f"_id {name}, _row long, paragraph long, start long, stop long, n_words long, cluster_key {name}, cluster_paragraph long, removed boolean"), "passage-runs")
    discard(asking)
    discard_folder(spark, folder)
    return out


def passages(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 50) -> DataFrame:
    """A row for each run of words that stands in more than one place: key, paragraph (number of the
    line in which it begins, from 0), start, stop (bytes), n_words, cluster_key and cluster_paragraph
    (where it stands first: the smallest key, then the place), removed (it is not that place).

    A window of `words` words is repeated if the same words, A-Z lower-cased, stand at any other
    place of this or another text, whatever white space and line ends are between them. A run is as
    long as its windows repeat consecutive ones of the first place, so runs can overlap. All
    repeated windows are found. Null keys come first.
    """
    return found(docs, text, key, None, words).drop("_row").withColumnRenamed("_id", key)


def stripped(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 50) -> DataFrame:
    """The rows with their texts without the passages that go; white space around them stays."""
    names = docs.columns
    marked = written(docs.withColumn("_passage_row", F.monotonically_increasing_id()), "passage-rows")
    gone = found(marked, text, key, "_passage_row", words).where("removed").groupBy(F.col("_row").alias("_passage_gone")).agg(
        F.collect_list("start").alias("_passage_start"), F.collect_list("stop").alias("_passage_stop"))
    both = marked.join(written(gone, "passage-gone"), F.col("_passage_row") == F.col("_passage_gone"), "left")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = batch.column(text).to_pylist() if batch.column("_passage_gone").null_count < batch.num_rows else None
            for i in np.flatnonzero(batch.column("_passage_gone").is_valid().to_numpy(zero_copy_only=False)).tolist():
                raw = np.frombuffer(out[i].encode(), np.uint8)
                edge = np.zeros(len(raw) + 1, np.int64)
                np.add.at(edge, batch.column("_passage_start")[i].as_py(), 1)
                np.add.at(edge, batch.column("_passage_stop")[i].as_py(), -1)
                out[i] = raw[np.cumsum(edge)[:-1] == 0].tobytes().decode()
            new = batch.column(text) if out is None else pa.array(out, batch.column(text).type)
            yield pa.RecordBatch.from_arrays([new if c == text else batch.column(c) for c in names], names=names)

    return both.mapInArrow(cut, docs.schema)
