"""Hard negatives against plain whole-number sums."""

import math

import numpy as np

from uptrail.llm import negatives


def plain(rows, wanted, positives, negs, low, high):
    fine = [(i, v, lab) for i, v, lab in rows if i is not None and lab is not None and v
            and all(x is not None and math.isfinite(x) for x in v)]
    fine = [(i, [math.floor(256 * x) for x in v], str(lab)) for i, v, lab in fine]
    anchors = {}
    for i, v, lab in fine:
        if wanted(i):
            anchors[i] = min(anchors.get(i, (lab, v)), (lab, v))
    out = []
    for a, (lab, v) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, w, other in fine if i != a and len(w) == len(v))
        for score, i, _ in [s for s in scored if s[2] == lab][:positives]:
            inside = [s for s in scored if s[2] != lab and low * -score <= 100 * -s[0] <= high * -score][:negs]
            out += [(a, i, n + 1, j, -score, -s) for n, (s, j, _) in enumerate(inside)]
    return sorted(out)


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, v, lab, 0, 0) for i, v, lab in rows], "vec_id long, embedding array<double>, label int, score int, shard int")
    got = negatives.mined(df, lambda c: c % 10 == 0, **options).collect()
    wanted = plain(rows, lambda i: i % 10 == 0, options.get("positives", 5), options.get("negatives", 3), options.get("low", 50), options.get("high", 95))
    assert sorted(tuple(r) for r in got) == wanted
    return got


def test_like_plain_sums(spark, monkeypatch):
    rng = np.random.default_rng(3)
    heart = rng.normal(size=(4, 6)) * 3
    rows = [(i, [float(x) for x in heart[i % 4] + rng.normal(size=6) * (0.1 + i % 3)], i % 5) for i in range(260)]
    rows += [(300 + i, rows[i][1], i % 4) for i in range(40)]  # copies under other labels: ties
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 6, 2), (403, [None] + [1.0] * 5, 1), (404, [math.nan] * 6, 1), (405, [math.inf] * 6, 2),
             (None, [1.0] * 6, 1), (406, [1.0] * 6, None), (410, [0.0] * 6, 3), (420, [1e5] * 6, 1), (421, [-1e5] * 6, 2), (430, [2.0, 1.0], 1), (431, [2.0, 0.5], 1), (432, [1.0, 0.5], 2)]
    for sizes in ((40, 2, 8, 4), (4096, 4, 1024, 32)):
        for name, value in zip(("TREE_ROWS", "TREES", "ANCHORS", "LEAF"), sizes):
            monkeypatch.setattr(negatives, name, value)
        assert len(check(spark, rows)) > 50
        check(spark, rows, positives=2, negatives=9, low=-20, high=90)


def test_repeated_and_missing(spark):
    twice = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [2.0, 2.0], 1), (2, [1.5, 1.0], 2), (2, [1.5, 1.0], 2)]
    got = [tuple(r) for r in negatives.mined(spark.createDataFrame(twice, "vec_id long, embedding array<float>, label int"), lambda c: c == 0).collect()]
    assert sorted(got) == [(0, 1, 1, 2, 393216, 229376), (0, 1, 2, 2, 393216, 229376)]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mined(none, lambda c: c == 0).collect() == []
    check(spark, [(0, [1.0], 1), (1, [1.0], 1)])
    check(spark, [(10, [1.0], 1), (11, [0.7], 2)])
    check(spark, [(1, [1.0], 1), (11, [0.7], 2)])


def test_trees_cover_and_bounds_hold():
    rng = np.random.default_rng(4)
    heart = rng.normal(size=(12, 8))
    x = np.floor(256 * (heart[rng.integers(0, 12, 900)] + 0.05 * rng.normal(size=(900, 8)))).astype(np.int64)
    tree = negatives.grown(np.arange(900), x)
    assert sorted(tree["ids"].tolist()) == list(range(900)) and len(tree["leaves"]) > 10
    assert (tree["vectors"] == x[tree["ids"]]).all()
    anchors = np.floor(256 * rng.normal(size=(30, 8))).astype(np.int64)
    search = negatives.Search(np.arange(30) - 100, anchors, np.arange(30), np.full(30, negatives.LOWEST), np.full(30, -negatives.LOWEST), 5)
    most, least = search.bounds(tree)
    exact = anchors @ tree["vectors"].T.astype(np.int64)
    for leaf, (a, b) in enumerate(zip(tree["first"], tree["last"])):
        assert (exact[:, a:b].max(axis=1) <= most[:, leaf]).all() and (exact[:, a:b].min(axis=1) >= least[:, leaf]).all()
    seen = []
    search.verified, plain_verified = lambda t, w, n: seen.append((len(w), n)) or plain_verified(t, w, n), search.verified
    search.visit(tree, np.ones(30, bool))
    assert sum(n for n, _ in seen) < 0.6 * 30 * len(tree["leaves"])  # outside leaves are skipped
    assert (np.sort(search.score.reshape(30, 5))[:, ::-1] == np.sort(exact, axis=1)[:, :-6:-1]).all()
