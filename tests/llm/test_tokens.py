"""Token files: blocks, the library's ids, the whole round trip."""

import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from uptrail.llm import tokens

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2 ** 32 - 1)), max_size=1200))
def test_blocks_round_trip(ids):
    x = np.array(ids, np.uint32)
    data, start = tokens.pack(x)
    assert (tokens.unpack(np.frombuffer(data, np.uint8), start)[:len(x)] == x).all()


def test_few_large_values_are_exceptions():
    x = np.tile(np.arange(16, dtype=np.uint32), 16)
    x[7] = 2 ** 31
    data, _ = tokens.pack(x)
    assert len(data) == tokens.HEAD.itemsize + 256 * 4 // 8 + 6


class Source:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at:at + n]


def test_any_range_of_a_file():
    class Out(io.BytesIO):
        def close(self):
            self.held = self.getvalue()

    out, rng = Out(), np.random.default_rng(2)
    docs = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (0, 1, 255, 256, 300, 5000, 0)]
    w = tokens.Writer(out)
    w.add([None, 1, 2, 3, 4, 5, 5], np.array([len(d) for d in docs]), np.concatenate(docs))
    w.close()
    r = tokens.Reader(Source(out.held))
    every = np.concatenate(docs)
    for a, b in ((0, 0), (0, len(every)), (255, 257), (700, 900), (len(every) - 1, len(every))):
        assert (r.tokens(a, b) == every[a:b]).all()
    back = list(r.documents(limit=300))
    assert [k for k, _ in back] == [None, 1, 2, 3, 4, 5, 5] and all((x == y).all() for (_, x), y in zip(back, docs))
    with pytest.raises(ValueError):
        tokens.Reader(Source(out.held[:-30] + b"x" + out.held[-29:]))


TEXTS = ["", "plain words, and  two blanks\n\nlines\n a\tb", "don't 's 'll it's", "<|endoftext|> a<|endoftext|>b <|end", "É école naïve çà × ÷ x×y",
         "漢字 \U0001F600 — “quoted” …", "a\x1cb \x1c c\x00", "x" * 5000, " ", "\n", "\n\n a", "tab\t\tend ", "1234 56,78 $9.50", "a\u00a0b \u3000c\u2003 d"]


def test_ids_are_those_of_the_library():
    e = tokens.Encoder(PATH)
    raw = [t.encode() for t in TEXTS * 2]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, lengths = e.encode(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    want = [e.model.encode(t, add_special_tokens=False).ids for t in TEXTS * 2]
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_files_of_documents(spark):
    model = tokens.Encoder(PATH)
    rows = [(k, t, 0) for k, t in zip([5, 3, 9, -2, 7, 1, 20, 21, 22, 23, 24, 25, 26, 27], TEXTS)] + [(9, "again", 0), (None, "no key", 0), (4, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(4)
    got = sorted((tuple(r) for r in tokens.round_trip(df, PATH).collect()), key=lambda r: r[1])
    want = {}
    for k, t, _ in rows:
        ids = np.array([*model.model.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.setdefault(k, []).append((len(ids), zlib.crc32(ids.tobytes())))
    assert [r[0] for r in got] == sorted((k for k, _, _ in rows), key=lambda k: (k is not None, k))
    at = 0
    for key, start, n, crc in got:
        assert start == at and (n, crc) in want[key]
        want[key].remove((n, crc))
        at += n
    assert tokens.round_trip(df.limit(0), PATH).collect() == []
