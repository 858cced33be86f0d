"""Sampled segmentations against all paths of small texts, the library's decoder, and a round trip."""

import math
from collections import Counter

import numpy as np
import pytest

from uptrail.llm import pieces
from uptrail.llm.pieces import MARK, Sampling

public = pytest.importorskip("public_tokenizers")
PATH = public.path("piece_bpe_32k.model")


def every(text, v, alpha):
    """All segmentations with their log probabilities, by plain recursion over the vocabulary."""
    known = {}
    for i, raw in enumerate(v.text):
        where = np.flatnonzero(v.piece == i)
        if len(where):
            known[raw] = (i, float(v.score[where[0]]))
    raw = (" " + text).encode()
    found = {}

    def go(at, ids, score):
        if at == len(raw):
            found[tuple(ids)] = score
        for n in range(1, len(raw) - at + 1):
            if raw[at:at + n] in known:
                i, s = known[raw[at:at + n]]
                go(at + n, [*ids, i], score + alpha * s)

    go(0, [], 0.0)
    top = max(found.values())
    total = top + math.log(sum(math.exp(s - top) for s in found.values()))
    return {k: s - total for k, s in found.items()}


@pytest.mark.parametrize("text,alpha", [("the cat", 0.001), ("inand", 0.0001), ("ab, cd", 0.0)])
def test_like_all_paths(text, alpha):
    lattices = pieces.Lattices(pieces.Vocabulary(PATH), alpha)
    exact = every(text, lattices.v, alpha)
    n = 4000
    salts = np.random.default_rng(3).integers(0, 1 << 63, n, dtype=np.uint64)
    first, second = Counter(), Counter()
    kept = {}
    for rows in pieces.top_k([text] * n, salts, lattices, 2):
        ids = [tuple(r[0].tolist()) for r in rows]
        assert len(set(ids)) == min(2, len(exact)) and rows[0][2] >= rows[-1][2]
        for i, r in zip(ids, rows):
            assert abs(exact[i] - r[1]) < 1e-6 * max(1, abs(r[1]))
            kept.setdefault(i, []).append(1 / r[3])
        first[ids[0]] += 1
        second[tuple(ids)] += 1
    for i, lp in exact.items():
        p = math.exp(lp)
        assert abs(first[i] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 2e-3
        # one over the inclusion probability is an unbiased count
        if p > 0.1:  # rarer ones vary too much
            assert abs(sum(kept.get(i, [])) / n - 1) < 0.1
    for (i, j), seen in second.items():
        p = math.exp(exact[i]) * math.exp(exact[j]) / (1 - math.exp(exact[i]))
        assert abs(seen / n - p) < 5 * math.sqrt(p / n) + 2e-3


def test_all_paths_once_when_k_is_large():
    lattices = pieces.Lattices(pieces.Vocabulary(PATH), 0.0)
    exact = every("abc", lattices.v, 0.0)
    rows = pieces.top_k(["abc"], np.array([7], np.uint64), lattices, len(exact) + 5)[0]
    assert {tuple(r[0].tolist()) for r in rows} == set(exact)
    assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True) and rows[-1][3] == 1.0


def test_round_trip_in_spark(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ["", "a", "  two  blanks ", "line\nline\ttab", "漢字 \U0001F600 é", "word " * 2000, "x" * 3000, None, "same", "same"]
    df = spark.createDataFrame([(i if i < 8 else 8, t, 0) for i, t in enumerate(texts)] + [(None, "null key", 0)], "doc_id long, text string, ids int")
    got = pieces.sampled(df, PATH, sampling=Sampling(k=3))
    back = pieces.decoded(got, PATH).collect()
    want = {i: t or "" for i, t in enumerate(texts) if i < 8} | {8: "same", None: "null key"}
    for r in back:
        assert r["text"] == want[r["doc_id"]] and sp.decode(list(r["ids"])) == r["text"].replace(MARK, " ")
        assert r["n_pieces"] == len(r["ids"]) and 0 <= r["inclusion"] <= 1
    assert {r["doc_id"] for r in back} == set(want)
    same = [tuple(r["ids"]) + (r["rank"],) for r in back if r["doc_id"] == 8]
    assert len(same) == 2 * len(set(same))
    again = pieces.sampled(df.repartition(3), PATH, sampling=Sampling(k=3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got.collect()))
    assert pieces.sampled(df.limit(0), PATH).collect() == []
