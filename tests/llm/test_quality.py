"""Counts and divergences against plain loops."""

import math
import random
import re
from collections import Counter

from uptrail.llm import quality
from uptrail.llm.quality import CLASSES, Limits, WORDS


def counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def kind(c):
    for name, chars in (("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", "0123456789"),
                        ("blank", " \t\n\v\f\r"), ("stop", ".,;:!?-"), ("quote", "'\"()[]{}"), ("symbol", "#*$%&|<>")):
        if c in chars:
            return name
    if 0xC0 <= ord(c) <= 0xFF:
        return "latin"
    return "other" if ord(c) < 0x80 else "two" if ord(c) < 0x800 else "three" if ord(c) < 0x10000 else "four"


def histograms(text):
    chars = Counter(map(kind, text or ""))
    words = Counter()
    for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
        w = w[:-1] if w[-1] in ".,;:!?" else w
        words[w if w in WORDS else ""] += 1
    return [chars[c] for c in CLASSES], [words[w] for w in [*WORDS, ""]]


def js(p, q):
    if not sum(p) or not sum(q):
        return None
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    part = lambda a, b: a * math.log2(2 * a / (a + b)) if a else 0.0
    return sum(part(a, b) + part(b, a) for a, b in zip(p, q)) / 2


def plain(rows, limits):
    refs = {}
    for _, lang, text in rows:
        if lang is not None:
            for total, own in zip(refs.setdefault(lang, ([0] * len(CLASSES), [0] * (len(WORDS) + 1))), histograms(text)):
                total[:] = [a + b for a, b in zip(total, own)]
    out = []
    for key, lang, text in rows:
        c = counts(text)
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        kept = not failed
        if lang is not None:
            (chars, words), (rc, rw) = histograms(text), refs[lang]
            if sum(chars) >= limits.min_chars and sum(rc) >= limits.min_reference and js(chars, rc) > limits.chars:
                kept = False
            if c[0] >= limits.min_words and sum(rw) >= limits.min_reference and js(words, rw) > limits.words:
                kept = False
        out.append((key, *c, failed, kept))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(8)
    common = "the of and to in is that for it as with on by at this an be are from".split()
    word = lambda: rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice("abcdefghiké") for _ in range(rng.randint(2, 9)))
    texts = [None, "", "\n\n", "a", "x\x0b\x0cy\r\nz", "é漢\U0001F600 " * 90, "a b c d e f g h " * 2, "line\nline\n line\nline ", "## ** $ %%& | < >" * 20]
    for i in range(120):
        words = [word() for _ in range(rng.randint(1, 300))]
        if i % 10 == 0:
            words = [w + "###" for w in words]
        if i % 15 == 0:
            words = words[:20] * 5 + words
        texts.append("".join(w + rng.choice([" ", " ", " ", ".\n", ", "]) for w in words))
    rows = [(i, ["en", "en", "en", "de", None][i % 5], t) for i, t in enumerate(texts)]
    return rows + [rows[20], (None, "rare", texts[30])]


def test_like_plain_loops(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, lang string, text string, kept int, _lang int")
    for limits in (Limits(), Limits(0.02, 0.05, 50, 10, 100)):
        got = quality.judged(df, limits=limits)
        assert got.columns == ["doc_id", "lang", "text", "_lang", *quality.COUNTS, "base_failed", "char_js", "word_js", "kept"]
        found = got.select("doc_id", *quality.COUNTS, "base_failed", "kept").collect()
        assert sorted((tuple(r) for r in found), key=str) == plain(rows, limits)
    assert quality.judged(df.limit(0)).collect() == []


def test_one_long_text_like_many_pieces(spark):
    text = ("some words of a long text, again and again. \n" * 60_000)
    df = spark.createDataFrame([(1, "en", text)], "doc_id long, lang string, text string")
    assert tuple(quality.judged(df, carry=["doc_id"]).select(*quality.COUNTS).first()) == counts(text)


def test_registered_limits_reject_by_words_alone(spark):
    rng = random.Random(21)
    common = "the of and to in is that for it as with on by at this an be are from".split()
    rare = ["".join(rng.choice("abcdefghiklmnoprst") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    rare = [w for w in rare if w not in WORDS]
    good = [" ".join(rng.choice(common if rng.random() < 0.27 else rare) for _ in range(300)) for _ in range(100)]
    rows = [(i, "en", t) for i, t in enumerate(good)] + [(100, "en", " ".join(rng.choice(rare) for _ in range(300)))]
    got = {r["doc_id"]: r for r in quality.judged(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    assert all(got[i]["kept"] for i in range(100))
    assert not got[100]["base_failed"] and got[100]["char_js"] < Limits().chars and got[100]["word_js"] < 0.25 and not got[100]["kept"]
