"""Collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np

from uptrail.llm import phrases


def plain(rows, depth=5, least=100, keep=2000):
    out = []
    by_lang = {}
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        by_lang.setdefault("und" if lang is None else lang, []).extend(re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\x0a-\x0d]", low))
    for lang, pieces in by_lang.items():
        f = Counter(tuple(p[i:i + h]) for p in pieces for h in range(1, depth + 1) for i in range(len(p) - h + 1))
        n = sum(map(len, pieces))
        some = {g: a for g, a in f.items() if len(g) >= 2 and a >= least}
        inner = {g[i:j] for g, a in some.items() for i in range(len(g)) for j in range(i + 2, len(g) + 1) if j - i < len(g) and a >= f[g[i:j]]}
        scored = []
        for g, a in some.items():
            if g not in inner:
                score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:keep])]
    return sorted(out)


def check(spark, rows, parts=3, **options):
    df = spark.createDataFrame([(lang, text, 1, 2) for lang, text in rows], "lang string, text string, n int, score int").repartition(parts)
    got = sorted(tuple(r) for r in phrases.collocations(df, **options).collect())
    assert got == plain(rows, **{k: v for k, v in options.items()})
    return got


def texts(seed, many):
    rng = random.Random(seed)
    words = ["a", "b", "A", "c", "Dd", "é", "漢", "x\x00y", "and"]
    fixed = ["new York city", "to be or not to be", "a a a a a a a", "É b"]
    out = []
    for _ in range(many):
        bits = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randint(0, 40))]
        out.append((rng.choice(["en", "de", None, ""]), "".join(b + rng.choice([" ", "  ", "\t", " ", ", ", ".", "\n", "\x0b", "\x1f"]) for b in bits)))
    return out


def test_like_plain_counts(spark, monkeypatch):
    rows = [*texts(1, 260), ("en", "to be. " * 300 + "a b " * 400), ("en", None), ("en", ""), (None, " \t\n"), ("fr", "only. once"), ("en", "!?")]
    monkeypatch.setattr(phrases, "SHARD_BYTES", 900)
    assert len(check(spark, rows, least=9)) > 40
    monkeypatch.setattr(phrases, "SHARD_BYTES", 8 << 20)
    check(spark, rows, 1, least=5, depth=3, keep=7)


def test_nothing(spark):
    assert check(spark, texts(2, 30), least=10**6) == []
    assert check(spark, [("en", ""), ("en", None)], least=1) == []
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).collect() == []
    assert len(check(spark, [("en", "x y z x y z")] * 3, least=3)) > 0


def test_two_sided_steps():
    rng = np.random.default_rng(2)
    words = np.concatenate([[0], rng.integers(0, 4, 400), [0]]).astype(np.int32)
    _, before, back = phrases.index(words, 4)
    _, behind, forth = phrases.index(words[::-1].copy(), 4)
    counts = np.bincount(words, minlength=4)
    start = np.cumsum(counts)[:-1]
    a_start, a_other, a_size, _ = phrases.extended(start, counts[1:], start, before, back)
    b_other, b_start, b_size, _ = phrases.extended(start, counts[1:], start, behind, forth)
    a, b = (sorted(zip(*x, strict=True)) for x in ((a_start, a_other, a_size), (b_start, b_other, b_size)))
    assert [tuple(map(int, x)) for x in a] == [tuple(map(int, x)) for x in b]
    pairs = Counter(zip(words.tolist(), words[1:].tolist()))
    assert sorted(a_size.tolist()) == sorted(v for (x, y), v in pairs.items() if x and y)
