"""Encoding and decoding with a BPE vocabulary of words, cut up at forced boundaries.

A pair of neighbouring bytes that stands inside no token of the vocabulary can never be merged over:
every text can be cut there, its fragments encoded alone, and the ids put one after the other. Blanks
stand in no token, so texts fall apart into chunks; inside a chunk the tokenizer's own pattern ends
words, and inside a word every pair that no token holds is a cut. A fragment that ends its word is
encoded with the mark of a word's end, the others without it. Equal fragments are encoded once.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from uptrail.llm.common import bounded_batches, offsets, slices, utf8

#: Distinct chunks a Python worker remembers before it starts afresh.
MEMORY = 400_000
#: Bytes of text that are encoded at a time.
STEP = 1 << 20
#: Longer chunks are cut further, and are not remembered.
LONG = 1 << 12
#: Byte-level names of bytes have code points below this.
NAMES = 512
BLANK = re.compile(rb"[ \t-\r]+")
#: Where a word always ends: an ASCII letter or digit before an ASCII digit or mark.
WORD_END = re.compile(rb"(?<=[A-Za-z0-9])(?=[!-@\[-`{-~])")
ODD_BLANK = re.compile(r"\s")


class Ragged:
    """Lists of ids one after the other, that grow."""

    def __init__(self):
        self.starts, self.ids, self.many = np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.uint32), 0

    def add(self, sizes: np.ndarray, ids: np.ndarray) -> None:
        ends = self.starts[self.many] + np.cumsum(sizes)
        while len(self.starts) <= self.many + len(sizes):
            self.starts = np.append(self.starts, np.zeros_like(self.starts))
        while len(sizes) and len(self.ids) < ends[-1]:
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.ids[self.starts[self.many]:self.starts[self.many] + len(ids)] = ids
        self.starts[self.many + 1:self.many + 1 + len(sizes)] = ends
        self.many += len(sizes)

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these lists one after the other, and where each ends."""
        first = self.starts[slots]
        sizes = self.starts[slots + 1] - first
        ends = np.cumsum(sizes)
        where = np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[where], ends


class Encoder:
    """One tokenizer file: BPE with byte-level names, whose pattern drops blanks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model["type"] != "BPE" or [w for w, _ in self.whole.pre_tokenizer.pre_tokenize_str("a b")] != ["a", "b"]:
            raise ValueError("needs a BPE tokenizer whose words hold no blanks")
        suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.end = self.whole.model
        self.inner = BPE(model["vocab"], merges) if suffix else self.end
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values() if t.content]
        self.inside = np.zeros((NAMES, NAMES), bool)
        for token in model["vocab"]:
            codes = np.frombuffer(token.removesuffix(suffix).encode("utf-16-le"), np.uint16)
            self.inside[codes[:-1], codes[1:]] = True
        self.reset()

    def reset(self) -> None:
        self.chunks: dict[bytes, int] = {}
        self.fragments: tuple[dict[str, int], dict[str, int]] = ({}, {})  # inside a word, at its end
        self.of_chunk, self.of_fragment = Ragged(), Ragged()

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text ends."""
        words = [text.split() for text in texts]
        chunks = [c for w in words for c in w]
        if len(self.chunks) + len(chunks) > MEMORY and self.chunks:
            self.reset()
        known = self.chunks
        new = [c for c in dict.fromkeys(chunks) if c not in known]
        if new:
            self.learn(new)
        slots = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
        ids, ends = self.of_chunk.take(slots)
        last = np.cumsum([len(w) for w in words])
        return ids, np.concatenate([[0], ends])[last] if len(last) else last

    def learn(self, new: list[bytes]) -> None:
        texts = [c.decode() for c in new]
        apart = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        odd = {i for i, t in enumerate(texts) if i not in apart and not t.isascii() and ODD_BLANK.search(t)}
        plain = [i for i in range(len(texts)) if i not in apart and i not in odd]
        owners, words = self.split([texts[i] for i in plain])
        owners = [plain[i] for i in owners]
        for i in odd:  # blanks inside would be taken for the ends of chunks
            inner = self.split_one(texts[i])
            owners += [i] * len(inner)
            words += inner
        slots, bounds = self.pieces(words)
        ids, ends = self.of_fragment.take(slots)
        ends = np.concatenate([[0], ends])[bounds]  # of words
        order = np.argsort(np.array(owners, np.int64), kind="stable")
        sizes = np.bincount(np.array(owners, np.int64), np.diff(ends, prepend=0), len(new)).astype(np.int64)
        word_sizes = np.diff(ends, prepend=0)
        first = (ends - word_sizes)[order]
        moved = word_sizes[order]
        at = np.repeat(first - np.cumsum(moved) + moved, moved) + np.arange(int(moved.sum()))
        ids = ids[at]
        if apart:
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for i in apart:
                parts[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, np.uint32)
                sizes[i] = len(parts[i])
            ids = np.concatenate(parts)
        self.chunks.update(zip(new, range(self.of_chunk.many, self.of_chunk.many + len(new)), strict=True))
        self.of_chunk.add(sizes, ids)

    def split_one(self, text: str) -> list[str]:
        return [w for w, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(text))]

    def split(self, texts: list[str]) -> tuple[list[int], list[str]]:
        """The words of these chunks, and the chunk of each."""
        whole = " ".join(texts)
        if self.whole.normalizer is not None:
            whole = self.whole.normalizer.normalize_str(whole)
        at = np.cumsum([0, *(len(p) + 1 for p in whole.split(" "))])
        if len(at) != len(texts) + 1:
            words = [self.split_one(t) for t in texts]
            return [i for i, w in enumerate(words) for _ in w], [x for w in words for x in w]
        found = self.whole.pre_tokenizer.pre_tokenize_str(whole)
        owners = np.searchsorted(at, [a for _, (a, _) in found], side="right") - 1
        return owners.tolist(), [w for w, _ in found]

    def pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The fragments of all words, as slots, and how many the words up to each have."""
        whole = "".join(words)
        codes = np.frombuffer(whole.encode("utf-16-le"), np.uint16)
        ends = np.cumsum([len(w) for w in words])
        if not len(codes):
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        cut = np.ones(len(codes), bool)  # behind each character
        cut[:-1] = ~self.inside[codes[:-1], codes[1:]]
        is_end = np.zeros(len(codes), bool)
        is_end[ends - 1] = True
        cut |= is_end
        last = np.flatnonzero(cut) + 1
        kind = is_end[last - 1].tolist()
        slots = np.zeros(len(last), np.int64)
        start, lists, many = 0, [], self.of_fragment.many
        for i, (stop, at_end) in enumerate(zip(last.tolist(), kind, strict=True)):
            piece, start = whole[start:stop], stop
            known = self.fragments[at_end]
            slot = known.get(piece)
            if slot is None:
                slot = known[piece] = many
                many += 1
                lists.append([t.id for t in (self.end if at_end else self.inner).tokenize(piece)])
            slots[i] = slot
        if lists:
            self.of_fragment.add(np.array([len(x) for x in lists]), np.array([y for x in lists for y in x], np.uint32))
        return slots, np.searchsorted(last, ends, side="right")


def stretches(text: bytes, special: list[str], limit: int = STEP) -> Iterator[bytes]:
    """A long text in stretches of about limit bytes that can be encoded one after the other: cut at
    blanks, or inside longer runs without them where a word always ends, but not in a special token."""
    wide = max((len(s) for s in special), default=1)
    start = 0
    while len(text) - start > limit:
        found = BLANK.search(text, start + limit)
        stop = found.end() if found else len(text)
        if stop - start > 2 * limit:
            spot = WORD_END.search(text, start + limit)
            while spot and spot.start() < stop and any(s.encode() in text[max(0, spot.start() - wide):spot.start() + wide] for s in special):
                spot = WORD_END.search(text, spot.start() + 1)
            stop = min(stop, spot.start()) if spot else stop
        yield text[start:stop]
        start = stop
    yield text[start:]


ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker: what it has learnt serves its later tasks."""
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with a column of token ids, as little-endian unsigned 32-bit numbers, in place of the text.

    The ids are those of the tokenizer without special tokens added, truncation and padding; the
    strings of special tokens in a text are those tokens. A null or empty text, or one of blanks, has no ids.
    Other columns stay as they are, whatever their names; ``ids`` may not be one of them. Equal rows stay. A text is encoded
    in stretches of about a megabyte; a run of more than that without a blank, a digit or an ASCII
    mark after a letter is one stretch.
    """
    if ids in docs.columns and ids != text:
        raise ValueError(f"{ids} is a column already")
    bounded_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != text]
    fields = [f for f in docs.schema.fields if f.name != text]
    names = {c: f"_c{i}" for i, c in enumerate(kept)}
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"), *[F.col(f"`{c}`").alias(names[c]) for c in kept])
    schema = ", ".join([*(f"`{names[f.name]}` {f.dataType.simpleString()}" for f in fields), "_ids binary"])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path)
        for batch in batches:
            for part in slices(batch, "_text", STEP):
                data, at = utf8(part.column("_text"))
                raw = data.tobytes()
                if len(raw) > 2 * STEP:  # a long text, by itself
                    found = [model.encode([s])[0] for s in stretches(raw, model.special)]
                    lists = [np.concatenate(found)]
                else:
                    got, ends = model.encode([raw[a:b] for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)])
                    lists = np.split(got, ends[:-1])
                done = pa.array([x.astype("<u4").tobytes() for x in lists], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], done], names=[*part.schema.names[1:], "_ids"])

    out = rows.mapInArrow(encode, schema)
    return out.select(*[F.col(names[c]).alias(c) for c in kept], F.col("_ids").alias(ids))


def decoded(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text that their ids decode to, special tokens included, in a further column.

    Without a decoder in its file a tokenizer writes its tokens with blanks between them. Null ids
    give an empty text; ids that are no tokens give nothing.
    """
    if text in rows.columns:
        raise ValueError(f"{text} is a column already")
    bounded_batches(rows.sparkSession)
    names = {c: f"_c{i}" for i, c in enumerate(rows.columns)}
    renamed = rows.select(F.coalesce(F.col(f"`{ids}`"), F.lit(b"")).alias("_ids"), *[F.col(f"`{c}`").alias(names[c]) for c in rows.columns])
    schema = ", ".join([*(f"`{names[f.name]}` {f.dataType.simpleString()}" for f in rows.schema.fields), "_decoded binary"])

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path).whole
        known = [model.id_to_token(i) for i in range(model.get_vocab_size(with_added_tokens=True))]
        tokens = [None if t is None else t.encode() for t in known]

        def text_of(raw: bytes) -> bytes:
            numbers = np.frombuffer(raw, "<u4")
            if model.decoder is not None:
                return model.decode(numbers.tolist(), skip_special_tokens=False).encode()
            found = [tokens[i] for i in numbers[numbers < len(tokens)].tolist()]
            return b" ".join(t for t in found if t is not None) if None in found else b" ".join(found)

        for batch in batches:
            at = offsets(batch.column("_ids"))
            for part in (p for p in slices(batch, "_ids", STEP)) if at[-1] - at[0] > STEP else [batch]:
                texts = pa.array([text_of(x) for x in part.column("_ids").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], texts], names=[*part.schema.names[1:], "_decoded"])

    out = renamed.mapInArrow(decode, schema)
    return out.select(*[F.col(names[c]).alias(c) for c in rows.columns], F.col("_decoded").cast("string").alias(text))
