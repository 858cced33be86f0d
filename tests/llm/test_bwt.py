"""Repeats against a plain count of all windows."""

import hashlib
import random
import re
from collections import Counter

import pytest

from uptrail.llm import bwt
from uptrail.llm.queries import op4_repeated_bytes


def plain(texts, length):
    """(bytes, removed, spans, digest) of each text, from the counts of all its windows."""
    raw = [(t or "").encode() for t in texts]
    counts = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if counts[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdefgh éß\n"
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [some(rng.randint(30, 160)) for _ in range(6)]
    texts = [None, "", "a", "é" * 300, "ab" * 150, "ab" * 151, "x" * 40, "x" * 40, "y" * 41, some(39)]
    for _ in range(60):
        parts = [some(rng.randint(0, 120)) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            parts.insert(rng.randint(0, len(parts)), p[a:a + rng.randint(20, 160)])
        texts.append("".join(parts))
    texts += [texts[-1], texts[-1], texts[-2]]
    for t in texts[20:35]:  # near copies
        at = rng.randrange(max(1, len(t)))
        texts.append(t[:at] + "Z" + t[at + 1:])
    texts.append(some(5000) + passages[0] + some(3000))
    return texts


@pytest.mark.parametrize("seed,length,size", [(1, 40, 700), (2, 40, 10 ** 6), (3, 60, 2000), (4, 13, 900)])
def test_like_counting_all_windows(spark, monkeypatch, seed, length, size):
    monkeypatch.setattr(bwt, "SHARD_BYTES", size)
    texts = corpus(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kept", bwt.F.lit(1))
    got = bwt.stripped(df, "text", length)
    assert got.columns == ["doc_id", "text", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rows = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.drop("kept").collect()}
    assert [rows[i] for i in range(len(texts))] == plain(texts, length)


def test_production_length_and_empty_tables(spark):
    rng = random.Random(9)
    some = lambda n: "".join(rng.choice("abcdefghijklmnopqrst ") for _ in range(n))
    p = [some(399), some(400), some(1500)]
    texts = [some(700) + p[0] + some(30), some(12) + p[0] + some(900), p[1] + some(100), some(200) + p[1],
             some(3000) + p[2], p[2][:900] + some(50) + p[2][850:] + some(10), some(20000), ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in bwt.stripped(df).collect()}
    assert [rows[i] for i in range(len(texts))] == plain(texts, 400)
    assert bwt.stripped(df.limit(0)).collect() == []
    assert [tuple(r) for r in bwt.stripped(spark.createDataFrame([(None, None)], "doc_id long, text string")).collect()] == [
        (None, None, 0, 0, 0, hashlib.sha256(b"").hexdigest())]


def plain_passages(texts, words):
    """The spans of each text, from the counts of all its windows of words."""
    found = [list(re.finditer(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()))) for t in texts]
    windows = [[tuple(m.group() for m in f[i:i + words]) for i in range(len(f) - words + 1)] for f in found]
    counts = Counter(w for x in windows for w in x)
    out = []
    for f, x in zip(found, windows):
        gone = sorted({i + k for i, w in enumerate(x) if counts[w] > 1 for k in range(words)})
        out.append([(f[i].start(), f[j].end()) for i, j in zip(
            [i for i in gone if i - 1 not in gone], [i for i in gone if i + 1 not in gone])])
    return out


def worded(seed, words):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4)))
    line = lambda n: [word() for _ in range(n)]
    known = [line(words + n) for n in (-1, 0, 1, 2, 9, 80)]
    texts = [None, "", " \n ", "a " * (3 * words), "a b " * words, word()]
    for _ in range(40):
        own = line(rng.randint(0, 3 * words))
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(known)
            at = rng.randint(0, len(own))
            own[at:at] = p[rng.randint(0, 2):]
        own = [w.upper() if rng.random() < 0.2 else w for w in own]
        texts.append("".join(rng.choice([" ", " ", "\t", "  ", "\n"]) + w for w in own))
    return texts + [texts[8], texts[8], texts[9] + " x", "  " + " ".join(known[2]) + " \n", "  " + " ".join(known[2]) + " \n"]


@pytest.mark.parametrize("seed,words,size", [(1, 50, 900), (2, 50, 10 ** 6), (3, 13, 2000), (4, 3, 700)])
def test_passages_like_counting_all_windows_of_words(spark, monkeypatch, seed, words, size):
    monkeypatch.setattr(bwt, "SHARD_BYTES", size)
    texts = worded(seed, words)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {bytes(r["_key"]): [*zip(r["starts"], r["ends"])] for r in bwt.passages(df, "text", words).collect()}
    assert [got.get(hashlib.sha256((t or "").encode()).digest(), []) for t in texts] == plain_passages(texts, words)
    counts = {r["text_sha256"]: (r["n_passages"], r["n_passage_bytes"]) for r in bwt.passage_counts(df, "text", words).collect()}
    assert counts == {k.hex(): (len(x), sum(b - a for a, b in x)) for k, x in got.items()}
    assert bwt.passages(df.limit(0)).collect() == []


def test_query_shows_a_passage_of_less_than_400_bytes(spark, tmp_path):
    rng = random.Random(5)
    line = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    passage = line(52)
    texts = [f"{line(80)} {passage} {line(80)}", f"{line(60)}\n{passage} {line(90)}", line(200), None, "", f"{passage[:100]} {line(100)}", passage]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in op4_repeated_bytes(spark, str(tmp_path)).collect()}
    assert [(rows[i]["n_bytes"], rows[i]["n_removed"], rows[i]["n_spans"], rows[i]["kept_sha256"]) for i in range(7)] == plain(texts, 400)
    assert [(rows[i]["n_removed"], rows[i]["n_passages"], rows[i]["n_passage_bytes"]) for i in range(7)] == [
        (0, 1, 259), (0, 1, 259), (0, 0, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0), (0, 1, 259)]


def test_bytes_and_words_share_their_rounds(spark, monkeypatch):
    names = []
    monkeypatch.setattr(bwt, "SHARD_BYTES", 900)
    monkeypatch.setattr(bwt, "PIECE_SYMBOLS", 200)
    monkeypatch.setattr(bwt, "written", lambda df, name, f=bwt.written: names.append(name) or f(df, name))
    texts = worded(7, 13)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in bwt.stripped(df, "text", 40, 13).collect()}
    assert [(rows[i]["n_bytes"], rows[i]["n_removed"], rows[i]["n_spans"], rows[i]["kept_sha256"]) for i in range(len(texts))] == plain(texts, 40)
    assert [(rows[i]["n_passages"], rows[i]["n_passage_bytes"]) for i in range(len(texts))] == [
        (len(x), sum(b - a for a, b in x)) for x in plain_passages(texts, 13)]
    assert rows[0]["text"] is None and rows[2]["text"] == texts[2]
    assert names.count("bwt-texts") == names.count("bwt-1") == names.count("bwt-marks") == 1


def test_codes_are_equal_for_equal_bytes_only():
    rng = random.Random(3)
    strings = [b"", b"\0", b"\0\0", b"a", b"a\0", *(bytes(rng.choice(b"ab") for _ in range(n)) for n in (7, 8, 9, 16, 17, 511, 512, 513, 520, 3000))]
    strings += [s[:-1] + b"c" for s in strings[5:]] + [b"c" + s[1:] for s in strings[5:]]
    order = [s for s in strings * 2 for _ in range(2)]
    rng.shuffle(order)
    ends = bwt.np.cumsum([len(s) for s in order])
    codes = bwt.codes_of(bwt.np.frombuffer(b"".join(order), bwt.np.uint8), ends - [len(s) for s in order], ends).tolist()
    assert len(set(codes)) == len(set(strings)) == len(set(zip(codes, order)))
