"""Passages against all windows of 50 words."""

import random
import re

import pytest

from uptrail.llm import paragraphs, passages

SPACES = r"[^\x20\x09-\x0D]+"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows, words):
    """For each row, the byte places covered by a repeated window, and by one that is not the first."""
    places = {}
    for r, (key, text) in enumerate(rows):
        found = list(re.finditer(SPACES.encode(), lowered(text).encode()))
        for i in range(len(found) - words + 1):
            places.setdefault(tuple(m.group() for m in found[i:i + words]), []).append(
                ((key is not None, key or 0, r, i), r, found[i].start(), found[i + words - 1].end()))
    every, gone = {}, {}
    for where in places.values():
        if len(where) > 1:
            for x in where:
                every.setdefault(x[1], set()).update(range(x[2], x[3]))
                if x != min(where):
                    gone.setdefault(x[1], set()).update(range(x[2], x[3]))
    return every, gone


def corpus():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefé") for _ in range(rng.randint(3, 7)))
    line = lambda n: [word() for _ in range(n)]
    known = [line(n) for n in (49, 50, 51, 54, 64, 90)]
    texts = [None, "", "\n\n", "a " * 70]
    for _ in range(40):
        own = line(rng.randint(0, 150))
        for _ in range(rng.randint(1, 2)):
            at = rng.randint(0, len(own))
            own[at:at] = rng.choice(known)
        own = [w.upper() if rng.random() < 0.2 else w for w in own]
        texts.append("".join(w + rng.choice([" ", " ", " ", "\t", "  ", "\n" if rng.random() < 0.3 else " "]) for w in own))
    texts += [texts[8], texts[9] + " x"]
    return [(i if i != 11 else None, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size", [2000, 10 ** 7])
def test_like_all_windows(spark, monkeypatch, size):
    monkeypatch.setattr(passages, "SHARD_BYTES", size)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    every, gone = plain(rows, 50)
    number = {key: r for r, (key, _) in enumerate(rows)}
    got, cut = {}, {}
    for r in passages.passages(df).collect():
        span = range(r["start"], r["stop"])
        text = rows[number[r["doc_id"]]][1].encode()
        assert len(text[r["start"]:r["stop"]].split()) == r["n_words"] >= 50
        assert text[:r["start"]].count(b"\n") == r["paragraph"] and r["cluster_key"] in number
        got.setdefault(number[r["doc_id"]], set()).update(span)
        if r["removed"]:
            cut.setdefault(number[r["doc_id"]], set()).update(span)
    assert got == every and cut == gone
    left = {r["doc_id"]: r["text"] for r in passages.stripped(df).collect()}
    for r, (key, text) in enumerate(rows):
        raw = (text or "").encode()
        assert left[key] == (None if text is None else bytes(b for i, b in enumerate(raw) if i not in gone.get(r, ())).decode())


def shared():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    line = lambda n: [word() for _ in range(n)]
    passage = line(52)  # under 400 bytes, in lines that are not alike
    return [(1, " ".join(line(80) + passage + line(80))), (2, " ".join(line(60) + passage[:30]) + "\n" + " ".join(passage[30:] + line(90)))], " ".join(passage)


def test_query_reaches_a_passage_in_longer_lines(spark):
    df = spark.createDataFrame(shared()[0], "doc_id long, text string")
    assert paragraphs.clusters(df).collect() == []
    got = {(r["doc_id"], r["n_words"], r["removed"], r["unit"]) for r in paragraphs.repeats(df).collect()}
    assert got == {(1, 52, False, "passage"), (2, 52, True, "passage")}


def test_rows_that_repeat_a_key_and_a_text_keep_one(spark):
    rows = [(7, shared()[1]), (7, shared()[1]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r["text"] or "" for r in passages.stripped(df).collect())) == ["", "", rows[0][1]]
    assert passages.passages(df.limit(0)).collect() == []
