"""Nearest neighbours against plain sums."""

import math

import numpy as np

from uptrail.llm import neighbours


def plain(rows, wanted, k):
    fine = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    queries = {}
    for i, v in fine:
        if wanted(i):
            queries[i] = min(queries.get(i, v), v)
    for q, v in queries.items():
        scored = []
        for i, w in fine:
            if i != q and len(w) == len(v):
                s = 0.0
                for a, b in zip(v, w):
                    s += a * b
                scored.append((-s, i))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_like_plain_sums(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=9).astype(np.float32)]) for i in range(160)]
    rows += [(200 + i, rows[i][1]) for i in range(30)]  # ties
    rows += [(300, None), (301, []), (302, [0.0] * 9), (303, [None] + [1.0] * 8), (304, [math.nan] * 9), (305, [math.inf] * 9),
             (None, [1.0] * 9), (10, rows[10][1]), (20, [2.0] * 9), (40, [1.0, 2.0]), (60, [1e-30] * 9), (80, [1e20] * 9)]
    rows += [(400 + i, [float(i), 1.0]) for i in range(5)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    for query_block, candidate_block in ((16, 32), (1024, 2048)):
        monkeypatch.setattr(neighbours, "QUERY_BLOCK", query_block)
        monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", candidate_block)
        got = neighbours.nearest(df.where("vec_id % 20 = 0"), df, 7).collect()
        assert sorted(tuple(r) for r in got) == plain(rows, lambda i: i % 20 == 0, 7)


def test_fewer_candidates_than_wanted_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -1.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    got = neighbours.nearest(df.where("vec_id = 0"), df, 20).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 2, 1.5), (0, 2, 1, 1.0)]
    assert neighbours.nearest(df.limit(0), df, 3).collect() == []
    assert neighbours.nearest(df, df.limit(0), 3).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(50, 33)), rng.normal(size=(60, 33)) * 10.0 ** rng.integers(-20, 20, (60, 1))
    (a, s, e, n), (b, t, f, m) = neighbours.quantised(x), neighbours.quantised(y)
    near = (a.astype(float) * s[:, None]) @ (b.astype(float) * t[:, None]).T
    bound = e[:, None] * m[None, :] + (n + e)[:, None] * f[None, :]
    assert (abs(x @ y.T - near) <= bound * (1 + 1e-9)).all()
