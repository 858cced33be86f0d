"""Phrases that stand together more often than their parts would by chance.

The corpus is held in shards of some megabytes. A shard numbers its words and has an index of both
reading directions: the order of its suffixes and of its reversed prefixes, each with the transform
that gives the word before, or behind, every place. A phrase is a range in either order. Taking one
more word on the left is a backward step in the first order and splits the range in the second; on the
right the other way round. A phrase of h + 1 words is looked at where both steps meet: its first h and
its last h words are frequent phrases. Shards name it by the numbers of these two and its own count; counts
of all shards are added up by ranges of names, and what stays frequent gets a number and goes back to the
shards that hold it. So a shard sends each phrase once, whatever its count, and a frequent word or
passage is one entry for each shard.

Scores and the choice among phrases are joins on the tables of frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from uptrail.llm.bwt import load, save
from uptrail.llm.common import LOWER, bounded_batches, discard, discard_folder, mix, released, scratch, slices, utf8, written

#: Bytes of text in a shard.
SHARD_BYTES = 8 << 20
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True
STOP = np.zeros(256, bool)
STOP[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
#: kind: "ask" (a shard's names and counts for a bucket), "answer" (their numbers), "found" (a bucket's frequent
#: names), "state" (a shard's file), "total" (words of a language in a shard).
ROWS = "kind string, shard string, bucket int, a binary, b binary, c binary"
FIELDS = [("kind", pa.string()), ("shard", pa.string()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())]


def squeezed(x: np.ndarray) -> bytes:
    """Whole numbers, the first bytes of all, then the second ones, and so on, compressed."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def restored(raw: bytes, kind: type) -> np.ndarray:
    plain = pa.decompress(memoryview(raw)[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def rows(items: list[tuple]) -> pa.Table:
    columns = list(zip(*items, strict=True)) or [[]] * len(FIELDS)
    return pa.Table.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, FIELDS, strict=True)], names=[n for n, _ in FIELDS])


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words as an array of bytes, the text of each, and whether a piece ends between it and the next."""
    blank, stop = BLANK[data], STOP[data]
    apart = blank | stop
    head = np.zeros(len(data) + 1, bool)
    head[at] = True
    before = np.ones(len(data), bool)
    before[1:] = apart[:-1]
    start = np.flatnonzero(~apart & (before | head[:-1]))
    after = np.ones(len(data), bool)
    after[:-1] = apart[1:] | head[1:-1]
    end = np.flatnonzero(~apart & after) + 1
    ends = np.cumsum(end - start).astype(np.int32)
    raw = np.ascontiguousarray(LOWER[data[~apart]])
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(np.concatenate([np.zeros(1, np.int32), ends])), pa.py_buffer(raw)])
    text = np.searchsorted(at, start, side="right") - 1
    stops = np.concatenate([[0], np.cumsum(stop)])
    closed = np.ones(len(start), bool)
    closed[:-1] = (stops[start[1:]] > stops[end[:-1]]) | (text[1:] != text[:-1])
    return words, text, closed


def portions(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A text that is longer than a shard in portions that end where a piece ends; others as they are."""
    if len(at) == 2:
        while len(data) > SHARD_BYTES and (stops := np.flatnonzero(STOP[data[SHARD_BYTES:]]).tolist()[:1]):
            cut = SHARD_BYTES + stops[0] + 1
            yield data[:cut], np.array([0, cut])
            data, at = data[cut:], np.array([0, len(data) - cut])
    yield data, at


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings equal keys together, and where each group starts in it."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    return order, np.flatnonzero(new)


def ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks of pairs, in order of the first, then the second; 0 where the first is 0."""
    key = (first.astype(np.int64) << 32) | second
    key[first == 0] = 0
    order = np.argsort(key, kind="stable")
    key = key[order]
    rank = np.empty(len(key), np.int32)
    rank[order] = np.cumsum(np.diff(key, prepend=0) > 0, dtype=np.int32)
    return rank


def shifted(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[:len(x) - by] = x[by:]
    return out


def index(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of all suffixes by their first `depth` words, the word before each, and the step back:
    the place in the order of the suffix that starts one word before. Word 0 is an end."""
    known, rank = 1, words
    while known < depth:
        step = min(known, depth - known)
        rank = ranked(rank, shifted(rank, step))
        known += step
    order = np.argsort(rank, kind="stable")
    before = words[order - 1]  # the text starts with an end, and its last word is one
    return order, before, stepped(before)


def stepped(before: np.ndarray) -> np.ndarray:
    """For each place of an order the place of the suffix that starts one word before."""
    step = np.empty(len(before), np.int32)
    step[np.argsort(before, kind="stable")] = np.arange(len(before), dtype=np.int32)
    return step


def spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of these ranges, and the range of each."""
    ends = np.cumsum(size, dtype=np.int32)
    which = np.repeat(np.arange(len(size), dtype=np.int32), size)
    return np.arange(len(which), dtype=np.int32) + (start - ends + size).astype(np.int32)[which], which


def extended(start: np.ndarray, size: np.ndarray, other: np.ndarray, before: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, ...]:
    """One word more: the ranges in the order that is stepped through, those in the other order, the
    sizes, and the phrase each comes from. The other order splits a phrase's range by that word."""
    place, which = spread(start, size)
    key = (which.astype(np.int64) << 32) | before[place]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    sizes = np.diff(np.append(first, len(key))).astype(np.int32)
    head, alive = order[first], (key[first] & 0xFFFFFFFF) > 0
    origin = which[head]
    inside = (first - (np.cumsum(size, dtype=np.int64) - size)[origin]).astype(np.int32)
    return step[place[head]][alive], (other[origin] + inside)[alive], sizes[alive], origin[alive]


def bucket_of(left: np.ndarray, right: np.ndarray, buckets: int) -> np.ndarray:
    key = mix(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64))
    return (key % np.uint64(buckets)).astype(np.int64)


def parts(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cut)).tolist():
        yield b, order[cut[b]:cut[b + 1]]


class Miner:
    """The steps of a shard and of a bucket, each a function on their rows."""

    def __init__(self, folder: str, depth: int, least: int, buckets: int):
        """Files of words, indexes and each round's ranges have folders of their own below folder."""
        self.folder, self.depth, self.least, self.buckets = folder, depth, least, buckets

    def shards(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Numbers the words of a task's texts, some megabytes at a time, and keeps each such shard in a file."""
        held: list[tuple] = []
        room = 0
        for batch in batches:
            for part in slices(batch, "_text", 1 << 20):
                for data, at in portions(*utf8(part.column("_text"))):
                    held.append((*words_of(data, at), part.column("_lang")))
                    room += len(data)
                    if room >= SHARD_BYTES:
                        yield from self.shard(held).to_batches()
                        held, room = [], 0
        if held:
            yield from self.shard(held).to_batches()

    def shard(self, held: list[tuple]) -> pa.Table:
        names = pa.chunked_array([h[3] for h in held]).combine_chunks().dictionary_encode()
        kinds = pa.chunked_array([h[0] for h in held]).combine_chunks().dictionary_encode()
        langs = names.dictionary
        shift = np.cumsum([0, *(len(h[3]) for h in held)])
        text = np.concatenate([h[1] + s for h, s in zip(held, shift, strict=False)])
        closed = np.concatenate([h[2] for h in held])
        lang = names.indices.to_numpy()[text].astype(np.int64)
        total = np.bincount(lang, minlength=len(langs))
        # a word of one language: its number is the place of the pair among the shard's own
        pairs, numbers, counts = np.unique(kinds.indices.to_numpy().astype(np.int64) * max(1, len(langs)) + lang, return_inverse=True, return_counts=True)
        word, of_lang = kinds.dictionary.take(pa.array(pairs // max(1, len(langs)))), pairs % max(1, len(langs))
        file = save(f"{self.folder}/words", numbers=numbers.astype(np.int32), closed=closed, buckets=np.zeros(0))
        items = [("state", file, None, None, None, None)]
        items += [("total", file, None, name.encode(), int(n).to_bytes(8, "little"), None) for name, n in zip(langs.to_pylist(), total, strict=True)]
        names_of = pc.binary_join_element_wise(langs.cast(pa.binary()).take(pa.array(of_lang)), word, b"\0")
        return rows([*items, ("words", file, None, packed_words(names_of), squeezed(counts.astype(np.int64)), None)])

    def ask_words(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Deals a shard's words out to the buckets that add up their counts."""
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] != "words":
                    yield from rows([tuple(row[n] for n, _ in FIELDS)]).to_batches()
                    continue
                words, counts = unpacked_words(row["a"]), restored(row["b"], np.int64)
                items = [("ask", row["shard"], b, packed_words(words.take(pa.array(own))), squeezed(counts[own]), squeezed(own.astype(np.int32)))
                         for b, own in parts(word_bucket(words, self.buckets), self.buckets)]
                yield from rows(items).to_batches()

    def count_words(self, group: pa.Table) -> pa.Table:
        """Numbers for the words of a bucket that are frequent in the corpus."""
        group = group.sort_by("shard")
        asked = [unpacked_words(a) for a in group.column("a").to_pylist()]
        counts = np.concatenate([restored(b, np.int64) for b in group.column("b").to_pylist()])
        kinds = pa.chunked_array(asked).combine_chunks().dictionary_encode()
        which = kinds.indices.to_numpy()
        total = np.zeros(len(kinds.dictionary), np.int64)
        np.add.at(total, which, counts)
        frequent = np.flatnonzero(total >= self.least)
        bucket = group.column("bucket")[0].as_py()
        number = np.zeros(len(total), np.int64)
        number[frequent] = (np.arange(len(frequent)) * self.buckets + bucket) + 1
        found = ("found", None, bucket, squeezed(number[frequent]), packed_words(kinds.dictionary.take(pa.array(frequent))), squeezed(total[frequent]))
        spots = [restored(c, np.int32) for c in group.column("c").to_pylist()]
        return self.answers(group, which, number, [len(a) for a in asked], spots, found)

    def answers(self, group: pa.Table, which: np.ndarray, number: np.ndarray, sizes: list[int], spots: list[np.ndarray], found: tuple) -> pa.Table:
        cut = np.split(number[which], np.cumsum(sizes)[:-1])
        items = [("answer", s, found[2], squeezed(x[x > 0]), squeezed(spot[x > 0]), None)
                 for s, x, spot in zip(group.column("shard").to_pylist(), cut, spots, strict=True) if (x > 0).any()]
        return rows([found, *items])

    def count_phrases(self, group: pa.Table) -> pa.Table:
        """Numbers for the phrases of a bucket that are frequent in the corpus."""
        group = group.sort_by("shard")
        asked = [restored(a, np.int64).reshape(2, -1) for a in group.column("a").to_pylist()]
        for names in asked:
            np.cumsum(names[0], out=names[0])
        names = np.concatenate(asked, axis=1)
        counts = np.concatenate([restored(b, np.int32) for b in group.column("b").to_pylist()]).astype(np.int64)
        order, first = grouped(names[0], names[1])
        which = np.empty(len(order), np.int64)
        which[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        total = np.add.reduceat(counts[order], first)
        frequent = np.flatnonzero(total >= self.least)
        bucket = group.column("bucket")[0].as_py()
        number = np.zeros(len(total), np.int64)
        number[frequent] = (np.arange(len(frequent)) * self.buckets + bucket) + 1
        found = ("found", None, bucket, squeezed(number[frequent]), squeezed(names[:, order[first[frequent]]].ravel()), squeezed(total[frequent]))
        sizes = [a.shape[1] for a in asked]
        starts = [int.from_bytes(c, "little") for c in group.column("c").to_pylist()]
        spots = [np.arange(x, x + n, dtype=np.int32) for x, n in zip(starts, sizes, strict=True)]
        return self.answers(group, which, number, sizes, spots, found)

    def answered(self, group: pa.Table, many: int) -> tuple[str, np.ndarray]:
        """The shard's file, and the numbers of what it asked; 0 for what is not frequent."""
        out, file = np.zeros(many, np.int64), None
        for kind, shard, a, b in zip(*(group.column(n).to_pylist() for n in ("kind", "shard", "a", "b")), strict=True):
            file = shard
            if kind == "answer":
                out[restored(b, np.int32)] = restored(a, np.int64)
        return file, out

    def build(self, group: pa.Table) -> pa.Table:
        """The indexes of a shard over its frequent words; asks for its phrases of two words."""
        file = group.column("shard")[0].as_py()
        kept = load(f"{self.folder}/words", file)
        numbers, closed = kept["numbers"], kept["closed"]
        _, ids = self.answered(group, int(numbers.max(initial=-1)) + 1)
        alive = ids > 0
        local = np.where(alive, np.cumsum(alive), 0).astype(np.int32)
        # words with an end behind each piece and in place of each rare word; the text starts with one
        slot = np.arange(len(numbers)) + np.concatenate([[0], np.cumsum(closed)[:-1]]) + 1 if len(numbers) else np.zeros(0, np.int64)
        words = np.zeros(len(numbers) + int(closed.sum()) + 2, np.int32)
        words[slot] = local[numbers]
        del numbers, closed, kept, slot
        keep = np.ones(len(words), bool)
        keep[1:] = (words[1:] > 0) | (words[:-1] > 0)
        words = words[keep]
        if words[-1]:
            words = np.append(words, np.int32(0))
        _, before, back = index(words, self.depth)
        _, behind, forth = index(words[::-1].copy(), self.depth)
        counts = np.bincount(words, minlength=int(alive.sum()) + 1).astype(np.int32)
        size = counts[1:]
        start = np.cumsum(counts, dtype=np.int32)[:-1]
        index_file = save(f"{self.folder}/index", before=before, behind=behind)
        return self.step(index_file, 1, before, back, behind, forth, start, start, size, ids[alive])

    def step(self, index_file: str, h: int, before, back, behind, forth, start, other, size, ids) -> pa.Table:
        """Phrases one word longer than these, where the steps to both sides meet."""
        a_start, a_other, a_size, a_from = extended(start, size, other, before, back)
        b_other, b_start, _, b_from = extended(other, size, start, behind, forth)
        at = np.full(len(before), -1, np.int32)
        at[b_start] = np.arange(len(b_start), dtype=np.int32)
        meet = at[a_start]
        both = np.flatnonzero(meet >= 0)
        # on the left one word was put before its last words, on the right one behind its first
        left, right = ids[b_from[meet[both]]], ids[a_from[both]]
        bucket = bucket_of(left, right, self.buckets)
        # in the order of buckets and names: a bucket's names are a stretch of the file, and pack well
        order = np.lexsort((right, left, bucket))
        own = both[order]
        left, right, sizes = left[order], right[order], a_size[own]
        file = save(f"{self.folder}/ranges-{h}", start=a_start[own], other=a_other[own], size=sizes)
        cut = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        asks = [("ask", index_file, b, squeezed(np.concatenate([np.diff(left[x:y], prepend=0), right[x:y]])), squeezed(sizes[x:y].astype(np.int32)),
                 int(x).to_bytes(8, "little")) for b, (x, y) in enumerate(zip(cut.tolist(), cut[1:].tolist())) if y > x]
        return rows([("state", index_file, None, file.encode(), None, None), *asks])

    def extend(self, group: pa.Table, h: int) -> pa.Table:
        """Phrases one word longer than those of the shard that are frequent."""
        kinds = group.column("kind").to_pylist()
        state = kinds.index("state")
        ranges = load(f"{self.folder}/ranges-{h - 1}", group.column("a")[state].as_py().decode())
        file, ids = self.answered(group, len(ranges["size"]))
        own = np.flatnonzero(ids)
        kept = load(f"{self.folder}/index", file)
        before, behind = kept["before"], kept["behind"]
        return self.step(file, h, before, stepped(before), behind, stepped(behind),
                         ranges["start"][own], ranges["other"][own], ranges["size"][own], ids[own])


def packed_words(words: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("w", pa.binary())])) as out:
        out.write_batch(pa.record_batch([words.cast(pa.binary())], names=["w"]))
    return sink.getvalue().to_pybytes()


def unpacked_words(raw: bytes) -> pa.Array:
    return pa.ipc.open_stream(raw).read_all().column("w").combine_chunks()


def word_bucket(words: pa.Array, buckets: int) -> np.ndarray:
    """Which bucket adds up a word: by its first and last eight bytes and its length, so all shards agree."""
    data, at = utf8(words)
    first, last = at[:-1], at[1:]
    key = (last - first).astype(np.uint64)
    for i in range(8):
        for spot in (first + i, last - 1 - i):
            inside = (spot >= first) & (spot < last)
            byte = np.zeros(len(first), np.uint64)
            byte[inside] = data[spot[inside]]
            key = key * np.uint64(0x100000001B3) + byte + np.uint64(1)
    return (mix(key) % np.uint64(buckets)).astype(np.int64)


def frequent(docs: DataFrame, lang: str = "lang", text: str = "text", depth: int = 5, least: int = 100) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n): all words of each language; and for 1 to `depth` words the phrases that occur at
    least `least` times in a language: number, left and right (the numbers of the phrases without the last and
    without the first word), a (the count); for single words lang and word in place of left and right.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = scratch(spark, "phrases")
    source = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("_lang"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    miner = Miner(folder, depth, least, 1)
    shards = written(source.mapInArrow(miner.shards, ROWS), "phrases-shards")
    many = max(1, shards.where("kind = 'state'").count())
    miner = Miner(folder, depth, least, many)
    totals = shards.where("kind = 'total'").mapInArrow(total_rows, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))
    totals = written(totals, "phrases-totals")
    asked = written(shards.where("kind IN ('state', 'words')").repartition(many).mapInArrow(miner.ask_words, ROWS), "phrases-asked")
    discard(shards)
    levels: list[DataFrame] = []
    for h in range(1, depth + 1):
        counted = written(asked.where("kind = 'ask'").groupBy("bucket").applyInArrow(counts_of(miner, h), ROWS), "phrases-counted")
        found = counted.where("kind = 'found'")
        if h == 1:
            found = found.mapInArrow(word_rows, "number long, lang string, word string, a long")
        else:
            found = found.mapInArrow(phrase_rows, "number long, left long, right long, a long")
        levels.append(written(found, "phrases-found"))
        # what later steps do not read goes before the next one writes
        states = written(asked.where("kind = 'state'"), "phrases-states")
        discard(asked)
        del found
        released(spark)
        if h < depth:
            back = states.unionByName(counted.where("kind = 'answer'"))
            asked = written(back.groupBy("shard").applyInArrow(longer_of(miner, h), ROWS), "phrases-asked")
            del back
        discard(states)
        discard(counted)
        discard_folder(spark, f"{folder}/words" if h == 1 else f"{folder}/ranges-{h - 1}")
    discard_folder(spark, folder)
    return totals, levels


def counts_of(miner: Miner, h: int):
    def run(group: pa.Table) -> pa.Table:
        return miner.count_words(group) if h == 1 else miner.count_phrases(group)
    return run


def longer_of(miner: Miner, h: int):
    def run(group: pa.Table) -> pa.Table:
        return miner.build(group) if h == 1 else miner.extend(group, h)
    return run


def total_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [int.from_bytes(b, "little") for b in batch.column("b").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("a").cast(pa.string()), pa.array(counts, pa.int64())], names=["lang", "n"])


def word_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            names = [w.split(b"\0", 1) for w in unpacked_words(row["b"]).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(restored(row["a"], np.int64)), pa.array([x.decode() for x, _ in names], pa.string()),
                                              pa.array([x.decode() for _, x in names], pa.string()), pa.array(restored(row["c"], np.int64))],
                                             names=["number", "lang", "word", "a"])


def phrase_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            left, right = restored(row["b"], np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (restored(row["a"], np.int64), left, right, restored(row["c"], np.int64))],
                                             names=["number", "left", "right", "a"])


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", depth: int = 5, least: int = 100, keep: int = 2000,
                 covered: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to `depth` words of each language.

    Texts are lower-cased (A-Z), cut into pieces at `[.,;:!?\\x0A-\\x0D]` and into words at blanks and tabs; n
    counts the words of a language, a the occurrences of the phrase inside pieces. For each cut, l and
    r count its two parts; the score is the least floor(1000 a n / (l r)) of all cuts, the first of equal ones. A phrase goes
    when a longer one of the table holds it and has at least `covered` percent of its occurrences.

    A null language is `und`, a null or empty text has no words. Equal rows count each. Tables without
    words or without frequent phrases give no rows. Other columns are not looked at. A word keeps its other bytes as they are.
    A language's name with a zero byte is not told apart from its beginning. A text longer than a
    shard is dealt to several, piece by piece; a piece is in one shard, whatever its length.
    """
    totals, levels = frequent(docs, lang, text, depth, least)
    words = written(levels[0].select("number", "lang", F.col("word").alias("phrase"), "a", F.array("a").alias("heads"), F.array("a").alias("tails")), "phrases-1")
    before, tables = words, []
    for h in range(2, depth + 1):
        # heads: counts of the first 1, 2, ... words; tails: of the last 1, 2, ... words
        head = before.select(F.col("number").alias("left"), "lang", "heads", "phrase")
        tail = before.select(F.col("number").alias("right"), "tails", F.col("phrase").alias("rest"))
        level = levels[h - 1].join(head, "left").join(tail, "right")
        last = F.element_at(F.split("rest", " "), -1)
        level = level.select("number", "left", "right", "lang", F.concat_ws(" ", "phrase", last).alias("phrase"), "a",
                             F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails"))
        before = written(level, f"phrases-{h}")
        tables.append(before)
    rest = []
    for h, level in enumerate(tables):
        if h + 1 < len(tables):
            longer = tables[h + 1]
            sides = longer.select(F.col("left").alias("number"), F.col("a").alias("b")).unionByName(longer.select(F.col("right").alias("number"), F.col("a").alias("b")))
            level = level.join(sides.groupBy("number").agg(F.max("b").alias("b")), "number", "left")
            level = level.where(F.col("b").isNull() | (100 * F.col("b").cast("decimal(19,0)") < covered * F.col("a").cast("decimal(19,0)")))
        rest.append(level.select("number", "lang", "phrase", "a", "heads", "tails"))
    every = rest[0]
    for level in rest[1:]:
        every = every.unionByName(level)
    every = every.join(totals, "lang")
    many = F.size("heads")
    cuts = F.expr("""transform(sequence(1, size(heads) - 1), k -> struct(
        cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))
          div (cast(heads[k - 1] as decimal(19,0)) * cast(tails[size(heads) - k - 1] as decimal(19,0))) as score,
        k as k, heads[k - 1] as l, tails[size(heads) - k - 1] as r))""")
    scored = every.withColumn("cut", F.array_min(cuts)).select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"),
                                                              F.pmod(F.xxhash64("number", many), F.lit(64)).alias("salt"))
    best = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each share first, so that no task has all phrases of a language
    scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= keep)
    ranked_ = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= keep)
    return ranked_.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
