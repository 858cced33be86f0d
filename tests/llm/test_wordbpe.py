"""Encoding at forced boundaries against the tokenizers library on whole texts."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from uptrail.llm import wordbpe


@pytest.fixture(scope="module")
def path():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("word_bpe_49k.json")


def samples():
    rng = random.Random(6)
    letters = ["a", "e", "th", "ing", "é", "é", "ß", "İ", "Σ", "ς", "漢", "字", "ㄱ", "한", "가", "1", "23", "'s", "'LL", "'", "!", "...", "<|", "|>",
               "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", " ", "\u0085", " ", "　", "​", "́", "\x0b", "\x0c", "\x1c", "\x00", "\n", "\r\n", "\t", " ", "  ",
               "qz", "xj", "zx", "😀", "👩‍👩‍👧", "_", "-", "²", "½", "Ⅷ", "٣", "ﬁ", "ŉ", "Ǆ", "﻿", "", "\U0010ffff"]
    out = ["", " ", "\n\t ", "don't WON'T i'm", "a" * 5000, "zqxjvk" * 3000, "1" * 3000, "é" * 700, "!'s", "x's!'re", " ́a", "a ́b", "word,word.word"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(2500)]
    return out


def test_like_the_library(path):
    whole = Tokenizer.from_file(path)
    model = wordbpe.Encoder(path)
    texts = samples()
    for _ in range(2):  # the second time from memory
        for at in range(0, len(texts), 100):
            part = texts[at:at + 100]
            ids, ends = model.encode([t.encode() for t in part])
            for text, got in zip(part, np.split(ids, ends[:-1]), strict=True):
                assert got.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_pairs_that_no_token_holds_are_cut(path):
    model = wordbpe.Encoder(path)
    _, bounds = model.pieces(["qzxj", "the"])
    assert bounds[0] > 1 and bounds[1] - bounds[0] == 1
    assert not model.inside[ord("q"), ord("z")] or not model.inside[ord("z"), ord("x")] or not model.inside[ord("x"), ord("j")]


def test_rows(spark, path, monkeypatch):
    whole = Tokenizer.from_file(path)
    long = "Lorem ipsum dolor sit amet, " * 3000
    texts = [None, *samples()[:300], long, "a1" * 40000 + "<|endoftext|>" + "b,c" * 30000, long]
    monkeypatch.setattr(wordbpe, "STEP", 1 << 14)
    df = spark.createDataFrame([(i, t, "x", [i]) for i, t in enumerate(texts)], "doc_id long, text string, _c0 string, _ids array<int>").repartition(3)
    got = wordbpe.decoded(wordbpe.encoded(df, path), path)
    assert got.columns == ["doc_id", "_c0", "_ids", "ids", "decoded"]
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r._ids == [r.doc_id]
        assert r.decoded == whole.decode(ids, skip_special_tokens=False)
    assert wordbpe.decoded(wordbpe.encoded(df.limit(0), path), path).collect() == []


def test_stretches(path):
    text = b"ab1," * 50 + b"<|endoftext|>" * 3 + b" zz" * 30 + b"q" * 100 + b" end"
    parts = list(wordbpe.stretches(text, ["<|endoftext|>"], 16))
    assert b"".join(parts) == text and len(parts) > 10
    whole = Tokenizer.from_file(path)
    assert sum((whole.encode(p.decode(), add_special_tokens=False).ids for p in parts), []) == whole.encode(text.decode(), add_special_tokens=False).ids
