"""The join against all pairs."""

import random
import re

import pytest

from uptrail.llm import jaccard
from uptrail.llm.jaccard import Join


def plain(rows, join):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        k = join.n
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= join.percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None and sets[i]:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((key, len(s), least.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 5)))
    texts = [None, "", "  \n", "a", "A", "a b", "b a", "a b c", "A\tB c", "a b c d"]
    for _ in range(6):
        base = [word() for _ in range(rng.randint(30, 160))]
        for _ in range(rng.randint(1, 25)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.3:
                own = own[:-rng.randint(1, 12)]
            texts.append(" ".join(own))
    passage = [word() for _ in range(40)]
    for _ in range(30):
        texts.append(" ".join([word() for _ in range(rng.randint(0, 60))] + passage + [word() for _ in range(rng.randint(0, 60))]))
    texts += [texts[20]] * 5 + [texts[21].upper()]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [(None if i == 30 else i, t) for i, t in rows] + [rows[0], (None, "lone words of no other text")]


@pytest.mark.parametrize("seed,join", [(1, Join()), (2, Join(block=4)), (3, Join(n=5, percent=80, block=8))])
def test_like_all_pairs(spark, seed, join):
    rows = corpus(seed)
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, _n int, root int")
    got = jaccard.joined(df, join=join)
    assert got.columns == ["doc_id", "text", "_n", "root", "n_shingles", "component_id"]
    assert sorted(((r[0], r[4], r[5]) for r in got.collect()), key=str) == plain(rows, join)


def test_empty_table(spark):
    assert jaccard.joined(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_words_made_to_collide(spark):
    """Two words of 1024 letters that polynomials modulo 2^64 cannot tell apart, whatever the base."""
    word = "a"
    while len(word) < 1024:
        word += word.translate({97: "b", 98: "a"})
    df = spark.createDataFrame([(1, word), (2, word.translate({97: "b", 98: "a"})), (3, word)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard.joined(df).collect()} == {1: 1, 2: 2, 3: 1}
