"""Paragraph clusters against all pairs."""

import random
import re

from uptrail.llm import paragraphs
from uptrail.llm.paragraphs import Banding


def plain(rows, b):
    found = []
    for key, text in rows:
        at = 0
        for number, line in enumerate((text or "").split("\n")):
            w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in line))
            size = len(line.encode())
            if len(w) >= b.min_words:
                found.append((key, number, at, len(w), {tuple(w[i:i + b.n]) for i in range(len(w) - b.n + 1)}))
            at += size + 1
    root = list(range(len(found)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(found):
        for j in range(i):
            both = len(x[4] & found[j][4])
            if 100 * both >= b.percent * (len(x[4]) + len(found[j][4]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(found)):
        groups.setdefault(find(i), []).append(found[i])
    rank = lambda x: (x[0] is not None, x[0] or 0, x[1])
    out = []
    for g in groups.values():
        if len(g) > 1:
            first = min(g, key=rank)
            out += [(x[0], x[1], x[2], x[3], first[0], first[1], (x[0], x[1]) != (first[0], first[1])) for x in g]
    return sorted(out, key=str)


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 5)))
    line = lambda n: [word() for _ in range(n)]
    known = [line(rng.randint(18, 120)) for _ in range(12)]
    texts = [None, "", "\n", "\n\n", " ".join(line(19)), " ".join(line(20))]
    for _ in range(50):
        lines = []
        for _ in range(rng.randint(1, 6)):
            own = list(rng.choice(known)) if rng.random() < 0.4 else line(rng.randint(1, 60))
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = word()
            lines.append(rng.choice([" ", "  ", "\t"]).join(own))
        texts.append("\n".join(lines))
    texts += [texts[-1], texts[-1].upper(), texts[-2] + "\n"]
    return [(i if i != 20 else None, t) for i, t in enumerate(texts)]


def test_like_all_pairs(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, _set int")
    for size, b in ((3000, Banding(block=4)), (10 ** 7, Banding())):
        monkeypatch.setattr(paragraphs, "SHARD_BYTES", size)
        got = paragraphs.clusters(df, b=b)
        columns = [got[c] for c in ("doc_id", "paragraph", "start", "n_words", "cluster_key", "cluster_paragraph", "removed")]
        assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == plain(rows, b)


def test_stripped_and_empty(spark):
    rows = [(1, "a " * 30 + "\nshort\n" + "b c " * 20), (2, "x\n" + "A " * 30), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in paragraphs.stripped(df).collect()) == [rows[0], (2, "x"), (3, None)]
    assert paragraphs.clusters(df.limit(0)).collect() == []


def test_bands_for_recall():
    b = Banding()
    assert 1 - (1 - 0.8 ** b.band) ** b.bands >= b.recall > 1 - (1 - 0.8 ** b.band) ** (b.bands - 1)


def test_stripped_where_rows_repeat_a_key(spark):
    rows = [(0, "x " * 30), (1, "x " * 30), (1, " ".join(f"y{i}" for i in range(30))), (None, "x " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in paragraphs.stripped(df).collect()]
    assert sorted(got, key=str) == sorted([(0, ""), (1, ""), rows[2], rows[3]], key=str)
