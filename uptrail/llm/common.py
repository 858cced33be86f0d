"""Helpers the operators share: the shared folder, Arrow batches, byte buffers, rolling hashes."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"
_LOCAL: list[str] = []
#: The paths this driver has asked for, in order.
CREATED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. A temporary one only for local sessions without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="llm-"))
    return _LOCAL[0]


BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keeps the Arrow batches of the session to some megabytes: long texts come by the thousand."""
    for name, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", 2000)):
        key = f"spark.sql.execution.arrow.{name}"
        number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", spark.conf.get(key).lower()).groups()
        now = int(number) << 10 * " kmgt".index(unit or " ")
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    bounded_batches(spark)
    CREATED.append(path := f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, computed once and kept as a table in the shared folder: safe when executors go."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a written table that nothing will read again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        discard_folder(df.sparkSession, folder)


def discard_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of jobs that are over: it does so when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path in the shared folder, and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:/", "file:///", 1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def n_words(text: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def slices(batch: pa.RecordBatch, column: str, limit: int = 512 << 10) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about limit bytes of text; a longer text is a piece by itself. What is
    computed on a piece takes some hundred bytes for each of its own."""
    ends = offsets(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()  # a worker serves many tasks; what it keeps is the next one's


def offsets(column: pa.Array) -> np.ndarray:
    """Where each text starts, and where the last ends. A null is an empty text."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    raw = column.buffers()[1]
    if raw is None or not len(column):
        return np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(raw, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and the offsets in it."""
    at = offsets(column)
    raw = column.buffers()[2]
    if raw is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(raw, np.uint8)[at[0]:at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (the finalizer of SplitMix64), in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


PRIME = np.uint64((1 << 31) - 1)
#: The bases of the two polynomials.
BASES = (1_481_765_933, 1_085_377_743)
BLOCK = 1 << 14
#: The powers of the bases and of their inverses, for all hashes of a process.
POWERS: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, np.uint32), np.ones(1, np.uint32))] * 2


def folded(x: np.ndarray) -> np.ndarray:
    """Below 2^33, and the same modulo PRIME."""
    return (x & PRIME) + (x >> np.uint64(31))


def reduced(x: np.ndarray) -> np.ndarray:
    """Modulo PRIME."""
    x = folded(folded(x))
    return np.where(x >= PRIME, x - PRIME, x)


def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """At least n powers of each base and of its inverse."""
    for i, base in enumerate(BASES):
        if len(POWERS[i][0]) < n:
            both = []
            for b, known in zip((base, pow(base, -1, int(PRIME))), POWERS[i], strict=True):
                while len(known) < n:  # what is known, times the power that comes next
                    more = reduced(known.astype(np.uint64) * np.uint64(pow(b, len(known), int(PRIME)))).astype(np.uint32)
                    known = np.concatenate([known, more])
                both.append(known)
            POWERS[i] = tuple(both)
    return POWERS


class Rolling:
    """Hashes of any byte ranges of a buffer, equal for equal bytes wherever they stand: two polynomials
    modulo 2^31 - 1, a prime. (Modulo a power of two, some plain words share their hash for every base.)"""

    def __init__(self, seed: int):
        self.values = np.random.default_rng(seed).integers(1, int(PRIME), (2, 256), dtype=np.uint64)

    def terms(self, data: np.ndarray, which: int) -> np.ndarray:
        """What the symbols stand for in one of the polynomials: numbers below PRIME, in a new array."""
        return self.values[which][data]

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        out = np.zeros((2, n + 1), np.uint64)
        for which, (into, (up, _)) in enumerate(zip(out, powers(n + 1), strict=True)):
            for a in range(0, n, BLOCK):  # so much stays in the cache
                b = min(a + BLOCK, n)
                terms = self.terms(data[a:b], which)
                terms *= up[a:b]
                high = terms >> np.uint64(31)
                terms &= PRIME
                terms += high
                terms[0] += into[a]
                np.cumsum(terms, out=into[a + 1:b + 1])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.joined([(s[end] - s[start]) for s in sums], [down[start] for _, down in powers(sums.shape[1])])

    def windows(self, sums: np.ndarray, length: int) -> np.ndarray:
        """Those of all ranges of one length, in order: as of() gives them."""
        n = max(0, sums.shape[1] - length)
        return self.joined([s[length:] - s[:n] for s in sums], [down[:n] for _, down in powers(sums.shape[1])])

    def joined(self, parts: list[np.ndarray], down: list[np.ndarray]) -> np.ndarray:
        high, low = (reduced(folded(folded(x)) * d) for x, d in zip(parts, down, strict=True))
        return mix(high << np.uint64(31) | low)


class RollingCodes(Rolling):
    """The same for buffers of 64-bit codes, each half of which is a number of one polynomial."""

    def terms(self, data: np.ndarray, which: int) -> np.ndarray:
        return reduced(data >> np.uint64(32) if which else data & np.uint64(0xFFFFFFFF))


ROLL = Rolling(4)
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a range that is read in blocks of eight; of longer ones the rolling sums are taken.
SHORT = 1 << 9
#: The bytes of a block that belong to a range of which 0 to 8 are left.
LEFT = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def codes_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Codes of byte ranges of a buffer, equal for equal bytes wherever they stand: a block of all ranges at a time."""
    out = np.empty(len(start), np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))
    for i in range(0, len(start), 1 << 15):  # so much stays in the cache
        at = start[i:i + (1 << 15)]
        size = end[i:i + (1 << 15)] - at
        code = mix(size.astype(np.uint64) * STEP)
        code ^= blocks[at] & LEFT[np.minimum(size, 8)]
        code = mix(code * STEP)
        more = np.flatnonzero((size > 8) & (size <= SHORT))
        for done in range(8, SHORT, 8):
            more = more[size[more] > done]
            if not len(more):
                break
            code[more] = mix((code[more] ^ blocks[at[more] + done] & LEFT[np.minimum(size[more] - done, 8)]) * STEP)
        out[i:i + (1 << 15)] = code
    long = np.flatnonzero(end - start > SHORT)
    if len(long):
        size = np.cumsum(np.append(0, (end - start)[long]))
        parts = np.concatenate([data[a:z] for a, z in zip(start[long].tolist(), end[long].tolist(), strict=True)])
        out[long] = ROLL.of(ROLL.sums(parts), size[:-1], size[1:])
    return out


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the first word of each text (with the number of all at the end)."""
    blank = SPACE[data]
    head = np.zeros(len(data) + 1, bool)
    head[at] = True  # no word crosses the border of two texts
    before = np.ones(len(data), bool)
    before[1:] = blank[:-1]
    start = np.flatnonzero(~blank & (before | head[:-1]))
    after = np.ones(len(data), bool)
    after[:-1] = blank[1:] | head[1:-1]
    end = np.flatnonzero(~blank & after) + 1
    return start, end, np.searchsorted(start, at)
