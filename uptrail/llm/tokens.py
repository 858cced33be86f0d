"""Token ids in files of patched frame-of-reference blocks."""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from uptrail.llm.common import Rolling, place, scratch, slices, utf8, written

MAGIC = b"PFOR0001"
BLOCK = 256
#: Of a block's values so many fit the width; the others are exceptions.
PERCENTILE = 95
#: Head of a block: minimum, width in bits, number of exceptions.
HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("patches", "<u2")])
#: Ids that are packed at a time.
CHUNK = BLOCK << 12


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The blocks of these ids, and where each starts. The last one is filled up with its last id.

    A block: head, then (id - minimum) in `width` bits each, then the places (u2) of the exceptions,
    then their whole differences (u4). Exceptions have zero bits in the packed part.
    """
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    n = -(-len(ids) // BLOCK)
    values = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[-1])]).astype(np.int64).reshape(n, BLOCK)
    least = values.min(axis=1)
    values = values - least[:, None]
    rank = min(BLOCK - 1, BLOCK * PERCENTILE // 100)
    limit = np.partition(values, rank, axis=1)[:, rank]
    width = np.ceil(np.log2(limit + 1)).astype(np.int64)
    over = values >> width[:, None] > 0
    patches = over.sum(axis=1)
    size = HEAD.itemsize + width * BLOCK // 8 + patches * 6
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    heads = np.zeros(n, HEAD)
    heads["least"], heads["width"], heads["patches"] = least, width, patches
    out[start[:, None] + np.arange(HEAD.itemsize)] = heads.view(np.uint8).reshape(n, HEAD.itemsize)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            low = np.where(over[own], 0, values[own])
            bits = (low[:, :, None] >> np.arange(w)) & 1
            packed = np.packbits(bits.astype(np.uint8).reshape(len(own), -1), axis=1, bitorder="little")
            out[(start[own] + HEAD.itemsize)[:, None] + np.arange(packed.shape[1])] = packed
    row, col = np.nonzero(over)
    nth = np.arange(len(row)) - (np.cumsum(patches) - patches)[row]
    at = start[row] + HEAD.itemsize + width[row] * BLOCK // 8
    for base, step, kind, what in ((at, 2, "<u2", col), (at + 2 * patches[row], 4, "<u4", values[row, col])):
        raw = what.astype(kind).view(np.uint8).reshape(-1, step)
        out[(base + step * nth)[:, None] + np.arange(step)] = raw
    return out.tobytes(), start


def unpack(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start there, as one array with whole blocks."""
    n = len(start)
    if not n:
        return np.zeros(0, np.uint32)
    heads = data[start[:, None] + np.arange(HEAD.itemsize)].copy().view(HEAD).reshape(n)
    width, patches = heads["width"].astype(np.int64), heads["patches"].astype(np.int64)
    values = np.zeros((n, BLOCK), np.int64)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            raw = data[(start[own] + HEAD.itemsize)[:, None] + np.arange(w * BLOCK // 8)]
            bits = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(own), BLOCK, w)
            values[own] = bits.astype(np.int64) @ (1 << np.arange(w, dtype=np.int64))
    row = np.repeat(np.arange(n), patches)
    nth = np.arange(len(row)) - (np.cumsum(patches) - patches)[row]
    at = start[row] + HEAD.itemsize + width[row] * BLOCK // 8
    col = data[(at + 2 * nth)[:, None] + np.arange(2)].copy().view("<u2").reshape(-1)
    big = data[(at + 2 * patches[row] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    values[row, col] = big
    return (values + heads["least"].astype(np.int64)[:, None]).astype(np.uint32).reshape(-1)


class Writer:
    """A file: magic, blocks, block starts (u8), documents (id i8, id is set u1, number of ids u8), and
    the four numbers of the foot: ids, blocks, documents, crc32 of the index."""

    def __init__(self, out):
        self.out, self.ids, self.held = out, 0, []
        self.at, self.starts, self.docs = len(MAGIC), [], []
        out.write(MAGIC)

    def add(self, keys: list, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs += zip(keys, lengths.tolist(), strict=True)
        self.ids += len(ids)
        self.held.append(ids)
        if sum(map(len, self.held)) >= CHUNK:
            self.flush(False)

    def flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for at in range(0, whole, CHUNK):
            data, start = pack(ids[at:min(at + CHUNK, whole)])
            self.starts.append(start + self.at)
            self.at += len(data)
            self.out.write(data)
        self.held = [ids[whole:]]

    def close(self) -> None:
        self.flush(True)
        starts = np.concatenate(self.starts) if self.starts else np.zeros(0, np.int64)
        keys = np.array([k or 0 for k, _ in self.docs], "<i8")
        present = np.array([k is not None for k, _ in self.docs], np.uint8)
        index = starts.astype("<u8").tobytes() + keys.tobytes() + present.tobytes() + np.array(
            [n for _, n in self.docs], "<u8").tobytes()
        self.out.write(index + struct.pack("<QQQI", self.ids, len(starts), len(self.docs), zlib.crc32(index)))
        self.out.close()


FOOT = struct.calcsize("<QQQI")


class Reader:
    """Reads a file by its index; holds the index and the blocks asked for."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        self.ids, blocks, docs, crc = struct.unpack("<QQQI", source.read_at(FOOT, size - FOOT))
        length = 8 * blocks + 17 * docs
        index = source.read_at(length, size - FOOT - length)
        if source.read_at(len(MAGIC), 0) != MAGIC or zlib.crc32(index) != crc:
            raise ValueError("not a file of token blocks")
        self.starts = np.append(np.frombuffer(index, "<u8", blocks).astype(np.int64), size - FOOT - length)
        keys = np.frombuffer(index, "<i8", docs, 8 * blocks).tolist()
        present = np.frombuffer(index, np.uint8, docs, 8 * (blocks + docs)).tolist()
        self.keys = [k if p else None for k, p in zip(keys, present, strict=True)]
        self.lengths = np.frombuffer(index, "<u8", docs, 8 * blocks + 9 * docs).astype(np.int64)

    def tokens(self, first: int, last: int) -> np.ndarray:
        """The ids from place first to before last: only their blocks are read."""
        if first >= last:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, -(-last // BLOCK)
        raw = np.frombuffer(self.source.read_at(int(self.starts[b] - self.starts[a]), int(self.starts[a])), np.uint8)
        return unpack(raw, self.starts[a:b] - self.starts[a])[first - a * BLOCK:last - a * BLOCK]

    def documents(self, limit: int = CHUNK) -> Iterator[tuple[int | None, np.ndarray]]:
        """Key and ids of each document; about limit ids are unpacked at a time."""
        ends = np.cumsum(self.lengths)
        at = 0
        while at < len(ends):
            first = int(ends[at] - self.lengths[at])
            stop = max(at + 1, int(np.searchsorted(ends, first + limit, side="right")))
            ids = self.tokens(first, int(ends[stop - 1]))
            for i in range(at, stop):
                yield self.keys[i], ids[int(ends[i] - self.lengths[i]) - first:int(ends[i]) - first]
            at = stop


def bytes_of(*ranges: range) -> np.ndarray:
    out = np.zeros(256, bool)
    for r in ranges:
        out[r] = True
    return out


SOLID = bytes_of(range(0x21, 0x7F))
DIGIT = bytes_of(range(0x30, 0x3A))
LETTER = bytes_of(range(0x41, 0x5B), range(0x61, 0x7B))
MARK = SOLID & ~DIGIT & ~LETTER
#: First byte of U+00C0 to U+00FF, which are letters but for two second bytes.
LATIN, NOT_LETTERS = 0xC3, (0x97, 0xB7)
ROLL = Rolling(8)
#: Distinct pieces a Python worker remembers before it starts afresh.
MEMORY = 1_500_000


def byte_names() -> dict[int, str]:
    """How byte-level vocabularies write bytes: visible Latin-1 as it is, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Encodes texts with the tokenizers library; equal pieces of a text are encoded once.

    A text is cut only where the pattern of byte-level vocabularies always ends a piece: before a
    single blank that a letter, digit or mark follows, around a lone line break, and between a
    letter and a mark. Pieces that the pattern does not cut further go to the library's model at
    once, others through its whole pipeline. Pieces are known by a 64-bit hash and their length.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.model.get_added_tokens_decoder().values() if t.content]
        self.names = byte_names()
        self.reset()

    def reset(self) -> None:
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # in order of hashes
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)  # in order of learning

    def cuts(self, data: np.ndarray, at: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Where pieces start; the starts of texts are among them."""
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            solid = SOLID[data] | (data == LATIN)
            ends = np.zeros(len(data) + 1, bool)
            ends[at] = True
            inside = ~ends[1:-1]  # the next byte belongs to the same text
            cut[:len(data) - 1] |= (data[:-1] == 0x20) & solid[1:] & inside
            shown = SOLID[data] | letter
            alone = np.flatnonzero((data[1:-1] == 0x0A) & shown[:-2] & solid[2:] & inside[:-1] & inside[1:]) + 1
            cut[alone] = cut[alone + 1] = True
            cut[1:len(data)] |= letter[:-1] & (data[:-1] != LATIN) & MARK[data[1:]]
            raw = data.tobytes()
            for token in self.special:
                spot = raw.find(token)
                while spot >= 0:
                    cut[spot + 1:spot + len(token)] = False
                    spot = raw.find(token, spot + 1)
        cut[at] = True
        return np.flatnonzero(cut)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the number of ids of each."""
        letter = LETTER[data]
        latin = np.flatnonzero(data[:-1] == LATIN)
        latin = latin[~np.isin(data[latin + 1], NOT_LETTERS)]
        letter[latin] = letter[latin + 1] = True
        bounds = self.cuts(data, at, letter)
        start, end = bounds[:-1], bounds[1:]
        sums = ROLL.sums(data)
        keys = ROLL.of(sums, start, end) ^ (end - start).astype(np.uint64)
        kinds, first, kind = np.unique(keys, return_index=True, return_inverse=True)
        self.learn(data, letter, kinds, start[first], end[first])
        where = self.slots[np.searchsorted(self.hashes, kinds)]
        size = (self.starts[1:] - self.starts[:-1])[where]
        lengths = size[kind]
        total = np.cumsum(lengths)
        source = np.repeat(self.starts[:-1][where][kind] - total + lengths, lengths) + np.arange(total[-1] if len(total) else 0)
        edges = np.concatenate([[0], total])[np.searchsorted(bounds, at)]
        return self.ids[source], np.diff(edges)

    def learn(self, data: np.ndarray, letter: np.ndarray, kinds: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        if len(self.hashes) > MEMORY:
            self.reset()
        spot = np.searchsorted(self.hashes, kinds)
        known = np.zeros(len(kinds), bool)
        inside = spot < len(self.hashes)
        known[inside] = self.hashes[spot[inside]] == kinds[inside]
        new = np.flatnonzero(~known)
        if not len(new):
            return
        a, b = start[new], end[new]
        first = a + ((b > a) & (data[np.minimum(a, len(data) - 1)] == 0x20)) if len(data) else a
        whole = np.zeros(len(new), bool)
        for kind in (letter, MARK[data], DIGIT[data]):
            sums = np.concatenate([[0], np.cumsum(kind)])
            whole |= (sums[b] - sums[first] == b - first) & (b > first)
        raw = data.tobytes()
        pieces = [raw[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        found: list = [None] * len(pieces)
        apart = np.flatnonzero(~whole).tolist()
        encoded = self.model.encode_batch_fast([pieces[i].decode() for i in apart], add_special_tokens=False)
        for i, e in zip(apart, encoded, strict=True):
            found[i] = e.ids
        tokenize, names = self.model.model.tokenize, self.names
        for i in np.flatnonzero(whole).tolist():
            found[i] = [t.id for t in tokenize(pieces[i].decode("latin-1").translate(names))]
        sizes = np.array([len(x) for x in found], np.int64)
        spots = np.searchsorted(self.hashes, kinds[new])
        self.slots = np.insert(self.slots, spots, len(self.starts) - 1 + np.arange(len(new)))
        self.hashes = np.insert(self.hashes, spots, kinds[new])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(found), np.uint32))


ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker: what it has learnt serves its later tasks."""
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes the texts and writes the ids in ascending order of key; returns the table of files.

    A null text is empty, an empty one has the end id alone. A null key comes first. Rows that repeat
    a key are all written, ordered by a hash of their text. The rows are dealt by ranges of the key:
    a file holds a range, and part is its place among the files.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange(F.asc_nulls_first("key"), tie).sortWithinPartitions(F.asc_nulls_first("key"), tie)

    def files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer)
        system, root = place(folder)
        system.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.pfor"
        out = None
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                if out is None:
                    out = Writer(system.open_output_stream(f"{root}/{name}"))
                ids, lengths = model.encode(*utf8(part.column("text")))
                ends = np.cumsum(lengths)
                out.add(part.column("key").to_pylist(), lengths + 1, np.insert(ids, ends, end_id))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "part": [TaskContext.get().partitionId()],
                                              "documents": [len(out.docs)], "ids": [out.ids]})

    return written(rows.mapInArrow(files, "file string, part long, documents long, ids long"), "token-files")


def read(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files. start counts the ids of
    all documents before it. The table of files has a row for each file, no more is numbered here."""
    many = max(1, files.count())
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = files.withColumn("before", F.coalesce(before, F.lit(0))).select("file", "before").repartition(many)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                with system.open_input_file(f"{root}/{file}") as source:
                    rows: list = []
                    for key, ids in Reader(source).documents():
                        rows.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return files.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Writes the files in the shared folder and reads them back."""
    folder = scratch(docs.sparkSession, "tokens")
    return read(write(docs, folder, tokenizer, end_id), folder)
