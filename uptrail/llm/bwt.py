"""Repeated byte strings over a corpus, by merging the Burrows-Wheeler transforms of its shards.

Texts are cut into phrases at places that their own bytes decide, so equal strings are cut alike.
Each shard of documents gets the transform of its phrase sequences. The transforms are merged by
refining their interleave: a round knows, for every string of h phrases that occurs at least twice
in the corpus, which range of each shard's order it fills; one backward step in each shard turns
those ranges into those of h + 1 phrases, and the counts of all shards, added up, tell which are
still repeated. The round in which a suffix drops out is its longest common prefix with any other;
no suffix is compared or sorted across shards. What phrases leave open at the ends of a repeat, an
exact check of the byte windows there decides.

Strings are made of bytes, or of words: then the same steps run over codes of words.

Between shards go codes of strings and counts, packed in arrays: a string that fills a third of the
corpus is one code for each shard. Codes have 64 bits.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from uptrail.llm.common import (
    LOWER, ROLL, STEP, RollingCodes, codes_of, discard, discard_folder, mix, place, released, scratch, slices, utf8, word_bounds, written)

WORD_ROLL = RollingCodes(4)
#: Bytes that decide about a cut, besides the radius on both sides. They make one 64-bit number.
GRAM = 8
#: Symbols whose windows get their codes at a time.
PIECE_SYMBOLS = 1 << 18
#: Bytes of text in a shard. A longer text is a shard by itself.
SHARD_BYTES = 16 << 20
#: Shards that a task of a round takes, and the tasks that are not fewer for it: rounds are many and short.
PART_SHARDS, LEAST_PARTS = 3, 16
ROWS = "kind string, shard int, bucket int, file string, a binary, b binary"


def radius_of(length: int, gram: int = GRAM) -> int:
    """A phrase is longer than this. About six phrases make a string of the length looked for."""
    return max(1, min(32, (length - gram) // 11))


class Bytes:
    """The bytes of texts as the symbols that strings are made of."""

    gram, roll = GRAM, ROLL
    #: Whether the texts are wanted without the spans.
    strips = True

    def least_bytes(self, length: int) -> int:
        """A text with fewer bytes has no string of that length."""
        return length

    def places(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The first symbol of each text (and the number of all), and what values() and bounds() take."""
        return at, ()

    def values(self, data: np.ndarray, known: tuple) -> np.ndarray:
        """The symbols."""
        return data

    def codes(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of ranges of symbols, equal for equal ones."""
        return codes_of(values, first, last)

    def bounds(self, known: tuple, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes at which the first symbols start and the last ones end."""
        return first, last + 1

    def grams(self, data: np.ndarray) -> np.ndarray:
        """A number for each gram, equal for equal grams."""
        many = max(0, len(data) - GRAM + 1)
        raw = np.ascontiguousarray(data)
        return np.ndarray((many,), "<u8", buffer=raw, strides=(1,)) * STEP if many else np.zeros(0, np.uint64)


class Words(Bytes):
    """The words of texts, A-Z lower-cased, whatever white space is between them: a code for each."""

    gram, roll = 1, WORD_ROLL
    strips = False

    def least_bytes(self, length: int) -> int:
        return 2 * length - 1

    def places(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, tuple]:
        start, end, first = word_bounds(data, at)
        return first, (start, end)

    def values(self, data: np.ndarray, known: tuple) -> np.ndarray:
        return codes_of(LOWER[data], *known)

    def codes(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return codes_of(values.view(np.uint8), 8 * first, 8 * last)

    def bounds(self, known: tuple, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return known[0][first], known[1][last]

    def grams(self, data: np.ndarray) -> np.ndarray:
        return data


def least_of(x: np.ndarray, r: int) -> np.ndarray:
    """The least of the r values from each place on, where there are as many."""
    width = 1
    while width < r:
        step = min(width, r - width)
        x = np.minimum(x[:-step], x[step:])
        width += step
    return x


def cut(data: np.ndarray, at: np.ndarray, r: int, symbols: Bytes = Bytes()) -> np.ndarray:
    """Bounds of the phrases of all texts, ends of texts included.

    A place is a cut if the code of the gram there is below those of the r places before and after
    it. All symbols that decide lie within r before and r + gram after the place.
    """
    inner = np.zeros(0, np.int64)
    if len(data) - symbols.gram + 1 > 2 * r:
        code = (symbols.grams(data) >> np.uint64(32)).astype(np.uint32)
        least, own = least_of(code, r), code[r:len(code) - r]
        inner = r + np.flatnonzero((own < least[:len(own)]) & (own < least[r + 1:]))
        text = np.searchsorted(at, inner, side="right") - 1
        inner = inner[(inner - r >= at[text]) & (inner + r + symbols.gram <= at[text + 1])]
    out = np.sort(np.concatenate([inner, at]))
    return out[np.append(True, np.diff(out) > 0)]


def phrases(docs: DataFrame, kinds: list[tuple[int, Bytes]]) -> DataFrame:
    """_of, _key, _size (bytes), _start and _stop (the bytes of its symbols), _lengths and _codes of the
    phrases, for each length and its symbols (_of counts them) of each text of at least that many symbols."""
    def cut_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 1 << 20):
                data, begin = utf8(part.column("_text"))
                for of, (length, symbols) in enumerate(kinds):
                    at, known = symbols.places(data, begin)
                    kept = np.flatnonzero(np.diff(at) >= length)
                    values = symbols.values(data, known)
                    bounds = cut(values, at, radius_of(length, symbols.gram), symbols)
                    codes = symbols.codes(values, bounds[:-1], bounds[1:])
                    ends = np.searchsorted(bounds, at)
                    start, stop = symbols.bounds(known, at[kept], at[kept + 1] - 1)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(kept), of, np.int32)),
                        part.column("_key").take(pa.array(kept)), pa.array(np.diff(begin)[kept], pa.int64()),
                        pa.array(start - begin[kept], pa.int64()), pa.array(stop - begin[kept], pa.int64()),
                        pa.array([np.diff(bounds[ends[i]:ends[i + 1] + 1]).astype(np.int32).tobytes() for i in kept], pa.binary()),
                        pa.array([codes[ends[i]:ends[i + 1]].tobytes() for i in kept], pa.binary())],
                        names=["_of", "_key", "_size", "_start", "_stop", "_lengths", "_codes"])

    return docs.select("_key", "_text").mapInArrow(
        cut_up, "_of int, _key binary, _size long, _start long, _stop long, _lengths binary, _codes binary")


def save(folder: str, **arrays: np.ndarray) -> str:
    """A file of arrays in the shared folder. A task that runs again writes another one."""
    system, root = place(folder)
    system.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}.npz.zst"
    with system.open_output_stream(f"{root}/{name}") as out:
        out.write(packed(**arrays))
    return name


def load(folder: str, name: str) -> dict[str, np.ndarray]:
    system, root = place(folder)
    with system.open_input_stream(f"{root}/{name}") as source:
        return unpacked(source.read())


def packed(**arrays: np.ndarray) -> bytes:
    data = io.BytesIO()
    np.savez(data, **arrays)
    size = data.tell()
    return size.to_bytes(8, "little") + pa.compress(data.getbuffer(), "zstd", asbytes=True)


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    raw = pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return dict(np.load(io.BytesIO(raw), allow_pickle=False))


def rows(items: list[tuple]) -> pa.Table:
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary()]
    cols = list(zip(*items, strict=True)) or [[]] * 6
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                names=[c.split()[0] for c in ROWS.split(", ")])


def asked(shard: int, buckets: int, codes: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """Rows that carry the codes, in order, to the buckets which count them over all shards."""
    bucket = (codes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [("ask", shard, b, None, codes[order[x:y]].tobytes(), np.minimum(counts[order[x:y]], 2).astype(np.uint8).tobytes())
            for b, (x, y) in enumerate(zip(ends, ends[1:], strict=False)) if y > x]


def answer(group: pa.Table) -> pa.Table:
    """For each asking row, one byte for each of its codes: whether the shards have it twice or more."""
    codes = [np.frombuffer(x, np.uint64) for x in group.column("a").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint8) for x in group.column("b").to_pylist()])
    _, which = np.unique(np.concatenate(codes), return_inverse=True)
    twice = (np.bincount(which, weights=counts) >= 2)[which].astype(np.uint8)
    parts = np.split(twice, np.cumsum([len(x) for x in codes])[:-1])
    return rows([("answer", s, b, None, x.tobytes(), None) for s, b, x in zip(
        group.column("shard").to_pylist(), group.column("bucket").to_pylist(), parts, strict=True)])


def answered(group: pa.Table, buckets: int, codes: np.ndarray) -> np.ndarray:
    """The answers in the order of the codes that were asked."""
    out = np.zeros(len(codes), bool)
    bucket = (codes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for kind, b, x in zip(group.column("kind").to_pylist(), group.column("bucket").to_pylist(), group.column("a").to_pylist(), strict=True):
        if kind == "answer":
            out[order[ends[b]:ends[b + 1]]] = np.frombuffer(x, np.uint8) > 0
    return out


def state_of(group: pa.Table) -> tuple[int, str, bytes | None]:
    i = group.column("kind").to_pylist().index("state")
    return group.column("shard")[i].as_py(), group.column("file")[i].as_py(), group.column("a")[i].as_py()


class Merge:
    """The steps of a merge, each a function on the rows of one shard."""

    def __init__(self, folder: str, length: int, buckets: int, symbols: Bytes = Bytes()):
        self.folder, self.length, self.buckets, self.symbols = folder, length, buckets, symbols
        self.radius = radius_of(length, symbols.gram)
        self.depth = (length - 1) // (self.radius + 1) + 4

    def start(self, docs: pa.Table) -> pa.Table:
        """Keeps the shard's documents in a file and asks which phrases are repeated."""
        shard = docs.column("_shard")[0].as_py()
        lengths = [np.frombuffer(x, np.int32) for x in docs.column("_lengths").to_pylist()]
        codes = np.concatenate([np.frombuffer(x, np.uint64) for x in docs.column("_codes").to_pylist()])
        many = np.array([len(x) for x in lengths])
        weight = np.minimum(docs.column("_copies").to_numpy(), 2)
        keys = np.frombuffer(b"".join(docs.column("_key").to_pylist()), np.uint8)
        file = save(self.folder, keys=keys, lengths=np.concatenate(lengths), many=many, codes=codes, weight=weight.astype(np.uint8))
        kinds, which = np.unique(codes, return_inverse=True)
        counts = np.bincount(which, weights=np.repeat(weight, many))
        return rows([("state", shard, None, file, None, None), *asked(shard, self.buckets, kinds, counts)])

    def transform(self, group: pa.Table) -> pa.Table:
        """Builds the shard's transform over the phrases that the corpus repeats; first step."""
        shard, file, _ = state_of(group)
        docs = load(self.folder, file)
        kinds, which = np.unique(docs["codes"], return_inverse=True)
        live = np.flatnonzero(answered(group, self.buckets, kinds)[which])
        doc = np.repeat(np.arange(len(docs["many"])), docs["many"])
        size = docs["lengths"]
        n = len(live)
        follows = np.zeros(n, bool)
        follows[:-1] = (np.diff(live) == 1) & (doc[live[1:]] == doc[live[:-1]])
        # order of the suffixes, far enough for the longest string that is looked at
        rank = which[live] + 1
        step = 1
        link = np.where(follows, np.arange(n) + 1, n)
        while step < self.depth and n:
            after = np.append(rank, 0)[link]
            order = np.lexsort((after, rank))
            fresh = np.ones(n, np.int64)
            fresh[1:] = (np.diff(rank[order]) != 0) | (np.diff(after[order]) != 0)
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh)
            link = np.append(link, n)[link]
            step *= 2
        order = np.argsort(rank, kind="stable")
        spot = np.empty(n, np.int64)
        spot[order] = np.arange(n)
        back = np.full(n, -1, np.int64)  # the suffix one phrase longer, in the same order
        back[spot[1:][follows[:-1]]] = spot[:-1][follows[:-1]]
        code = docs["codes"][live[order]]
        static = save(self.folder, back=back.astype(np.int32), code=code, size=size[live[order]].astype(np.int32),
                      weight=docs["weight"][doc[live[order]]], live=live[order].astype(np.int32))
        new = np.ones(n, bool)
        new[1:] = code[1:] != code[:-1]
        low = np.flatnonzero(new)
        state = {"low": low, "high": np.append(low[1:], n), "code": code[low], "inner": np.zeros(len(low), np.int64),
                 "longest": np.zeros(n, np.uint8), "depth": np.array([1])}
        return self.extended(shard, f"{file}/{static}", state, np.ones(len(low), bool), load(self.folder, static))

    def extended(self, shard: int, file: str, state: dict, kept: np.ndarray, static: dict) -> pa.Table:
        """Marks the strings that are repeated, and makes one backward step from each of them."""
        low, high = state["low"][kept].astype(np.int64), state["high"][kept].astype(np.int64)
        depth = int(state["depth"][0])
        longest = state["longest"].copy()
        cover = np.repeat(np.arange(len(low)), high - low)
        member = np.arange(len(cover)) + (low - np.cumsum(high - low) + (high - low))[cover]
        longest[member] = depth
        # a string is extended while it may still be needed to judge a window
        grows = state["inner"][kept] < self.length
        owner = np.full(len(longest), -1, np.int64)
        inside = grows[cover] & (static["back"][member] >= 0)
        owner[static["back"][member[inside]]] = cover[inside]
        spots = np.flatnonzero(owner >= 0)
        code, own = static["code"][spots], owner[spots]
        new = np.ones(len(spots), bool)
        new[1:] = (np.diff(spots) > 1) | (code[1:] != code[:-1]) | (own[1:] != own[:-1])
        head = np.flatnonzero(new)
        lows = spots[head]
        highs = spots[np.append(head[1:], len(spots))[:len(head)] - 1] + 1
        weights = np.concatenate([[0], np.cumsum(static["weight"], dtype=np.int64)])
        codes = mix(state["code"][kept][own[head]] * STEP + code[head])
        inner = state["inner"][kept][own[head]] + static["size"][lows]
        out = packed(low=lows.astype(np.int32), high=highs.astype(np.int32), code=codes, inner=inner.astype(np.int32), longest=longest,
                     depth=np.array([depth + 1]))
        order = np.unique(codes, return_inverse=True)
        counts = np.bincount(order[1], weights=weights[highs] - weights[lows]) if len(codes) else np.zeros(0)
        return rows([("state", shard, None, file, out, None), *asked(shard, self.buckets, order[0], counts)])

    def refine(self, group: pa.Table) -> pa.Table:
        shard, file, data = state_of(group)
        state = unpacked(data)
        if not len(state["code"]):
            return rows([("state", shard, None, file, data, None)])
        kinds, which = np.unique(state["code"], return_inverse=True)
        return self.extended(shard, file, state, answered(group, self.buckets, kinds)[which], load(self.folder, file.split("/")[1]))

    def cells(self, file: str, data: bytes) -> tuple[dict, ...]:
        """The windows of all documents that may be repeated, in runs that lie alike between the cuts:
        document, base of its places, start, stop; whether the phrases around are repeated (then so are
        the windows); and the code of those within, which are repeated (else the windows are not).

        Phrases within a window are the same wherever its string occurs; 0 stands for none.
        """
        docs, state = load(self.folder, file.split("/")[0]), unpacked(data)
        static = load(self.folder, file.split("/")[1])
        many = docs["many"]
        first = np.cumsum(many + 1) - many - 1
        doc_of = np.repeat(np.arange(len(many)), many)
        edge = first[doc_of] + np.arange(len(doc_of)) - (np.cumsum(many) - many)[doc_of]
        cuts = np.zeros(len(edge) + len(many), np.int64)
        cuts[edge + 1] = docs["lengths"]
        cuts = np.cumsum(cuts)
        cuts -= np.repeat(cuts[first], many + 1)
        longest, code = np.zeros(len(cuts), np.int64), np.zeros(len(cuts), np.uint64)
        longest[edge[static["live"]]] = state["longest"]
        code[edge] = docs["codes"]
        r, need, gram = self.radius, self.length, self.symbols.gram
        ends = cuts[first + many]
        # all documents on one line, far enough apart
        base = np.cumsum(ends + 4 * need) - ends
        line = cuts + np.repeat(base, many + 1)
        last = base + ends - need  # the last window's start
        doc = np.repeat(np.arange(len(many)), many + 1)
        marks = [line, line - need + 1, line - r + 1, line - need + r + gram]
        marks = [np.minimum(np.maximum(m, base[doc]), last[doc] + 1) for m in marks]
        start = np.sort(np.concatenate([*marks, base, last + 1]))
        start = start[np.append(True, np.diff(start) > 0)]
        stop = np.append(start[1:], start[-1:])
        owner = np.searchsorted(base, start, side="right") - 1
        fine = (start <= last[owner]) & (stop > start)
        start, stop, owner = start[fine], stop[fine], owner[fine]
        stop = np.minimum(stop, last[owner] + 1)
        x = np.searchsorted(line, start + r)
        y = np.searchsorted(line, start + need - r - gram, side="right") - 1
        fine = (y <= x) | (longest[x] >= y - x)
        start, stop, owner, x, y = start[fine], stop[fine], owner[fine], x[fine], y[fine]
        u = np.searchsorted(line, start, side="right") - 1
        v = np.searchsorted(line, start + need)
        inside = np.where(y > x, code[np.maximum(y - 1, 0)], 0).astype(np.uint64)
        for back in range(2, int((y - x).max(initial=0)) + 1):
            deep = np.flatnonzero(y - x >= back)
            inside[deep] = mix(inside[deep] * STEP + code[y[deep] - back])
        return docs, {"doc": owner, "base": base[owner], "start": start, "stop": stop, "sure": longest[u] >= v - u,
                      "inside": inside}

    def judge(self, group: pa.Table) -> pa.Table:
        """Asks which strings of phrases lie within a window that the phrases leave open."""
        shard, file, data = state_of(group)
        _, c = self.cells(file, data)
        some = c["inside"] > 0
        kinds, which = np.unique(c["inside"][some], return_inverse=True)
        left = np.bincount(which, weights=~c["sure"][some], minlength=len(kinds))
        return rows([("state", shard, None, file, data, None), *asked(shard, self.buckets, kinds, 2 * (left > 0))])

    def spans(self, group: pa.Table) -> pa.Table:
        """For each document: ranges of window starts that are repeated for sure, and those to check.

        To check are open windows, and the sure ones that could hold the same string as an open one.
        """
        shard, file, data = state_of(group)
        docs, c = self.cells(file, data)
        some = c["inside"] > 0
        kinds, which = np.unique(c["inside"][some], return_inverse=True)
        check = c["inside"] == 0
        check[some] = answered(group, self.buckets, kinds)[which]
        lone = docs["weight"] < 2
        out = []
        for chosen in (c["sure"] & lone[c["doc"]], check):
            a, b, d = c["start"][chosen] - c["base"][chosen], c["stop"][chosen] - c["base"][chosen], c["doc"][chosen]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != b[:-1]) | (d[1:] != d[:-1])
            head = np.flatnonzero(new)
            out.append((d[head], a[head], b[np.append(head[1:], len(a))[:len(head)] - 1]))
        keys = docs["keys"].reshape(len(lone), -1)
        touched = np.unique(np.concatenate([out[0][0], out[1][0]]))
        cols = [[keys[i].tobytes() for i in touched]]
        for d, a, b in out:
            spot = np.searchsorted(d, touched), np.searchsorted(d, touched, side="right")
            cols.append([np.stack([a[i:j], b[i:j]]).astype(np.int64).tobytes() for i, j in zip(*spot, strict=True)])
        return pa.Table.from_arrays([pa.array(x, pa.binary()) for x in cols] + [
            pa.array([shard] * len(touched), pa.int32()), pa.array(lone[touched], pa.bool_())],
            names=["_key", "_sure", "_open", "_shard", "_lone"])

    def windows(self, group: pa.Table) -> pa.Table:
        """Keeps the texts in a file and asks about the windows to check."""
        shard = group.column("_shard")[0].as_py()
        texts = [x.encode() for x in group.column("_text").to_pylist()]
        spans = [np.frombuffer(x, np.int64).reshape(2, -1) for x in group.column("_open").to_pylist()]
        sure = [np.frombuffer(x, np.int64).reshape(2, -1) for x in group.column("_sure").to_pylist()]
        lone = np.array(group.column("_lone").to_pylist(), bool)
        data, at = joined(texts)
        first, known = self.symbols.places(data, at)
        data = self.symbols.values(data, known)
        a, b = np.concatenate(spans, axis=1)
        many = np.array([x.shape[1] for x in spans])
        codes = self.window_codes(data, first, a, b, many)
        counts = np.repeat(np.where(np.repeat(lone, many), 1, 2), b - a)
        file = save(self.folder, keys=np.frombuffer(b"".join(group.column("_key").to_pylist()), np.uint8),
                    text=np.frombuffer(b"".join(texts), np.uint8), size=np.array([len(t) for t in texts], np.int64),
                    sure=np.concatenate(sure, axis=1), many_sure=np.array([s.shape[1] for s in sure]),
                    lone=lone, open=np.stack([a, b]), many_open=many)
        kinds, which = np.unique(codes, return_inverse=True)
        return rows([("state", shard, None, file, None, None), *asked(shard, self.buckets, kinds, np.bincount(which, weights=counts))])

    def window_codes(self, data: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray, ranges: np.ndarray) -> np.ndarray:
        """Of the windows that start in the ranges of each text; only the symbols that they cover are read, many ranges at a time."""
        a, b = (x + np.repeat(first[:-1], ranges) for x in (a, b))
        roll, more = self.symbols.roll, self.length - 1
        out = [np.zeros(0, np.uint64)]
        batch = np.cumsum(b - a + more) // PIECE_SYMBOLS
        heads = np.flatnonzero(np.append(True, np.diff(batch) > 0)) if len(a) else []
        for x, y in zip(heads, [*heads[1:], len(a)], strict=True):
            parts = np.concatenate([data[i:j + more] for i, j in zip(a[x:y].tolist(), b[x:y].tolist(), strict=True)])
            many = (b - a)[x:y]
            # where each range's part starts, less the windows before it
            at = np.arange(many.sum()) + np.repeat(np.arange(y - x) * more, many)
            out.append(roll.of(roll.sums(parts), at, at + self.length))
        return np.concatenate(out)

    def kept(self, group: pa.Table) -> pa.Table:
        """What is left of each text, and the spans that go."""
        shard, file, _ = state_of(group)
        held = load(self.folder, file)
        at = np.concatenate([[0], np.cumsum(held["size"])])
        first, known = self.symbols.places(held["text"], at)
        at_sure, at_open = np.cumsum(held["many_sure"]), np.cumsum(held["many_open"])
        keys = held["keys"].reshape(len(held["size"]), -1)
        out = []
        # made again: they take more room than the texts
        codes = self.window_codes(self.symbols.values(held["text"], known), first, *held["open"], held["many_open"])
        kinds, which = np.unique(codes, return_inverse=True)
        twice = answered(group, self.buckets, kinds)[which]
        spot = 0
        for i, (head, tail) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            gone = np.zeros(tail - head + 1, np.int32)
            a, b = held["sure"][:, at_sure[i] - held["many_sure"][i]:at_sure[i]]
            np.add.at(gone, a, 1)
            np.add.at(gone, b - 1 + self.length, -1)
            for x, y in held["open"][:, at_open[i] - held["many_open"][i]:at_open[i]].T.tolist():
                hit = x + np.flatnonzero(twice[spot:spot + y - x])
                spot += y - x
                np.add.at(gone, hit, 1)
                np.add.at(gone, hit + self.length, -1)
            gone = np.cumsum(gone)[:-1] > 0
            if held["lone"][i] and gone.any():
                raw = held["text"][at[i]:at[i + 1]]
                flip = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
                a, b = (x - at[i] for x in self.symbols.bounds(known, head + np.flatnonzero(flip == 1), head + np.flatnonzero(flip == -1) - 1))
                edges = np.stack([np.append(0, b), np.append(a, len(raw))]).T.tolist() if self.symbols.strips else []
                out.append((keys[i].tobytes(), a.tolist(), b.tolist(), b"".join(raw[x:y].tobytes() for x, y in edges)))
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        digests = [hashlib.sha256(x).hexdigest() for x in cols[3]]
        longs = pa.list_(pa.int64())
        return pa.Table.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], longs), pa.array(cols[2], longs),
                                     pa.array([x.decode(errors="ignore") for x in cols[3]], pa.string()), pa.array(digests, pa.string())],
                                    names=["_key", "starts", "ends", "kept", "sha256"])


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and the offsets in it."""
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def dealt(state: DataFrame, column: str, parts: int):
    """Groups by shard or bucket, spread over as many tasks: rows are few, but long to work on."""
    return state.repartition(parts, column).groupBy(column)


def exchange(state: DataFrame, parts: int):
    """For each shard its state and the answers to what it asked."""
    answers = dealt(state.where("kind = 'ask'"), "bucket", parts).applyInArrow(answer, ROWS)
    return dealt(state.where("kind = 'state'").union(answers), "shard", parts)


def repeats(docs: DataFrame, text: str = "text", length: int = 400) -> DataFrame:
    """_key (SHA-256 of the text), starts, ends, kept, sha256: for each different text of which
    something goes, the spans of bytes that go, what is left of it and its digest.

    A byte goes if a string of `length` bytes that covers it also starts anywhere else, in another
    row or at another place of its own text. Rows with equal texts are each other's repeats: such a
    text of that length goes whole. Null texts are empty; shorter texts have no such string.
    kept leaves out the bytes of characters that a span cuts in two; sha256 is of all bytes left.
    """
    return merged(docs, text, [(length, Bytes())])[0]


def passages(docs: DataFrame, text: str = "text", words: int = 50) -> DataFrame:
    """_key (SHA-256 of the text), starts, ends: for each different text with words in passages that
    are repeated, the spans of bytes from the first word of such words in a row to the last.

    A word is in one if `words` words in a row that hold it also start anywhere else, as in repeats().
    A-Z are lower-cased, and any white space between words is the same.
    """
    return merged(docs, text, [(words, Words())])[0].drop("kept", "sha256")


def covered() -> F.Column:
    """The bytes in all spans of a row."""
    return F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)


def counted(passages_: DataFrame) -> DataFrame:
    """_key, n_passages and n_passage_bytes of the texts that passages() has."""
    return passages_.select("_key", F.size("starts").cast("long").alias("n_passages"), covered().alias("n_passage_bytes"))


def passage_counts(docs: DataFrame, text: str = "text", words: int = 50) -> DataFrame:
    """text_sha256 (lowercase hex), n_passages and n_passage_bytes of the texts that passages() has."""
    return counted(passages(docs, text, words)).select(F.lower(F.hex("_key")).alias("text_sha256"), "n_passages", "n_passage_bytes")


def merged(docs: DataFrame, text: str, kinds: list[tuple[int, Bytes]]) -> list[DataFrame]:
    """For each length and its symbols _key, starts, ends, kept and sha256, as repeats() has them (of words, the last two are empty).

    Their rounds are the same jobs: each has shards of its own, and a task takes shards of any.
    """
    spark = docs.sparkSession
    least = min(symbols.least_bytes(length) for length, symbols in kinds)
    keyed = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text")).where(F.octet_length("_text") >= least).withColumn(
        "_key", F.unhex(F.sha2("_text", 256)))
    schema = "_key binary, starts array<long>, ends array<long>, kept string, sha256 string"
    firsts = [F.first(c).alias(c) for c in ("_size", "_start", "_stop", "_lengths", "_codes")]
    texts = written(phrases(keyed, kinds).groupBy("_of", "_key").agg(F.count("*").alias("_copies"), *firsts), "bwt-texts")
    released(spark)
    total = {r[0]: -(-r[1] // SHARD_BYTES) for r in texts.groupBy("_of").agg(F.sum("_size")).collect()}
    if not total:
        return [spark.createDataFrame([], schema)] * len(kinds)
    many = [total.get(of, 0) for of in range(len(kinds))]
    starts = [sum(many[:of]) for of in range(len(kinds))]
    shards = sum(many)
    parts = max(min(shards, LEAST_PARTS), -(-shards // PART_SHARDS))
    folder = scratch(spark, "bwt-shards")
    merges = [Merge(folder, length, parts, symbols) for length, symbols in kinds]
    number = F.lit(starts[0]) + F.pmod(F.xxhash64("_key"), F.lit(many[0] or 1))
    for of in range(1, len(kinds)):
        number = F.when(F.col("_of") == of, starts[of] + F.pmod(F.xxhash64("_key"), F.lit(many[of] or 1))).otherwise(number)

    def step(name: str, column: str = "shard"):
        """The step of the merge whose shard it is."""
        def run_step(group: pa.Table) -> pa.Table:
            return getattr(merges[bisect_right(starts, group.column(column)[0].as_py()) - 1], name)(group)
        return run_step

    state = written(dealt(texts.withColumn("_shard", number.cast("int")), "_shard", shards).applyInArrow(step("start", "_shard"), ROWS), "bwt-0")
    copied = written(texts.where("_copies > 1").select("_of", "_key", "_start", "_stop"), "bwt-copied")
    discard(texts)

    def following(name: str, to: str) -> DataFrame:
        new = written(exchange(state, parts).applyInArrow(step(name), ROWS), to)
        discard(state)
        return new

    state = following("transform", "bwt-1")
    released(spark)
    depth = 1
    while not state.where("kind = 'ask'").isEmpty():
        depth += 1
        state = following("refine", f"bwt-{depth}")
    ended = state
    state = written(dealt(ended, "shard", shards).applyInArrow(step("judge"), ROWS), "bwt-cells")
    discard(ended)
    marks = written(exchange(state, shards).applyInArrow(
        step("spans"), "_key binary, _sure binary, _open binary, _shard int, _lone boolean"), "bwt-marks")
    discard(state)
    discard_folder(spark, folder)  # of the shards' files nothing is read any more
    released(spark)
    out = []
    for of, (length, symbols) in enumerate(kinds):  # one after the other: the texts and their windows take most of the room
        own = marks.where(F.col("_shard").between(starts[of], starts[of] + many[of] - 1))
        # copies are brought down to one text before the join, so that no key is frequent in it
        single = keyed.where(F.octet_length("_text") >= symbols.least_bytes(length)).groupBy("_key").agg(F.first("_text").alias("_text"))
        state = written(dealt(single.join(own, "_key"), "_shard", shards).applyInArrow(step("windows", "_shard"), ROWS), "bwt-windows")
        released(spark)
        part = exchange(state, parts).applyInArrow(step("kept"), schema)
        gone = copied.where(F.col("_of") == of).select(
            "_key", F.array("_start").alias("starts"), F.array("_stop").alias("ends"), F.lit("").alias("kept"), F.sha2(F.lit(""), 256).alias("sha256"))
        out.append(written(part.union(gone), "bwt-passages" if isinstance(symbols, Words) else "bwt-repeats"))
        discard(state)
        discard_folder(spark, folder)
        released(spark)
    for left in (marks, copied):
        discard(left)
    return out


def stripped(docs: DataFrame, text: str = "text", length: int = 400, words: int | None = None) -> DataFrame:
    """The rows with their texts stripped of repeats, and n_bytes, n_removed, n_spans, kept_sha256;
    columns of these names are replaced. Every row stays, also one that is left empty; a null text
    that loses nothing stays null. With `words` also n_passages and n_passage_bytes: the passages()
    of that many words in each text as it was, found in the same jobs; they are not stripped."""
    gone, *others = merged(docs, text, [(length, Bytes()), *([(words, Words())] if words else [])])
    gone = gone.select(*[F.col(c).alias(f"_gone_{c.strip('_')}") for c in gone.columns], covered().alias("_gone_removed"))
    names = ["n_passages", "n_passage_bytes"] if words else []
    for other in others:
        gone = gone.join(counted(other).select(F.col("_key").alias("_gone_key"), *[F.col(c).alias(f"_gone_{c}") for c in names]), "_gone_key", "full")
    rows_ = docs.drop("n_bytes", "n_removed", "n_spans", "kept_sha256", *names)
    whole = F.coalesce(F.col(text), F.lit(""))
    out = rows_.withColumns({"_gone_bytes": F.octet_length(whole).cast("long"), "_gone_sha": F.sha2(whole, 256)})
    out = out.join(gone, F.unhex("_gone_sha") == F.col("_gone_key"), "left")
    kept = F.when(F.col("_gone_removed").isNotNull(), F.col("_gone_kept")).otherwise(F.col(text)).alias(text)
    return out.select(*[kept if c == text else F.col(c) for c in rows_.columns], F.col("_gone_bytes").alias("n_bytes"),
                      F.coalesce("_gone_removed", F.lit(0)).alias("n_removed"), F.coalesce(F.size("_gone_starts"), F.lit(0)).cast("long").alias("n_spans"),
                      F.coalesce("_gone_sha256", "_gone_sha").alias("kept_sha256"), *[F.coalesce(f"_gone_{c}", F.lit(0)).alias(c) for c in names])
