"""Budgets and prefixes against plain loops."""

import hashlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from uptrail.llm import mixing
from uptrail.llm.mixing import Mix, escaped


def weight(mix, path):
    if path in mix.paths:
        return mix.paths[path]
    level = len(path)
    return mix.weights[level - 1].get(path[-1], 1) if level <= len(mix.weights) else 1


def plain(rows, mix):
    """key -> (budget, copies, tokens taken), for rows (key, levels, tokens) with different keys."""
    leaves = {}
    for key, path, n in rows:
        leaves.setdefault(path, []).append((key, n))
    whole = mix.budget if mix.budget is not None else sum(n for _, _, n in rows) * mix.share[0] // mix.share[1]

    def can(path):
        if path in leaves:
            return sum(n for _, n in leaves[path]) * mix.epochs if weight(mix, path) > 0 else 0
        below = {p[:len(path) + 1] for p in leaves if p[:len(path)] == path}
        return sum(can(p) for p in below) if not path or weight(mix, path) > 0 else 0

    budgets = {}

    def share(path, budget):
        if path in leaves:
            budgets[path] = budget
            return
        open_ = [p for p in {p[:len(path) + 1] for p in leaves if p[:len(path)] == path} if weight(mix, p) > 0 and can(p) > 0]
        left = budget
        while True:  # whoever can use less than a fair share gets that
            total = sum(weight(mix, p) for p in open_)
            full = [p for p in open_ if can(p) <= Fraction(left * weight(mix, p), total)]
            if not full:
                break
            for p in full:
                open_.remove(p)
                left -= can(p)
                share(p, can(p))
        done = 0
        total = sum(weight(mix, p) for p in open_)
        for p in sorted(open_, key=lambda p: "/".join(map(escaped, p))):
            given = left * (done + weight(mix, p)) // total - left * done // total
            done += weight(mix, p)
            share(p, given)

    share((), whole)
    out = {}
    for path, docs in leaves.items():
        budget, tokens = budgets.get(path, 0), sum(n for _, n in docs)
        epochs = budget // tokens if tokens else 0
        rest = budget - epochs * tokens
        past = 0
        place = lambda d: hashlib.md5(f"{mix.seed}:{epochs}:{'-' if d[0] is None else d[0]}".encode()).hexdigest()
        for key, n in sorted(docs, key=lambda d: (place(d), str(d[0]))):
            took = past < rest
            if epochs + took:
                out[key] = (budget, epochs + took, epochs * n + (min(n, rest - past) if took else 0))
            past += n
    return out


def corpus():
    out = []
    for i in range(300):
        lang = [None, "en", "en", "en", "de", "a/b"][i % 6]
        source = f"s{i % 7}" if i % 11 else None
        out.append((i if i else None, ("d%d" % (i % 3), lang, source), 0 if i % 13 == 0 else (i * 37) % 90 + 1))
    return out + [(1000, ("tiny", "en", "s"), 5), (1001, ("off", "en", "s"), 500), (1002, ("none", "x", "y"), 0)]


@pytest.mark.parametrize("mix", [
    Mix(), Mix(share=(1, 3), seed=4), Mix(weights=({"tiny": 50, "off": 0},), share=(2, 1), epochs=3),
    Mix(weights=({"d0": 7}, {"en": 3, None: 2}), paths={("d1", "de"): 0, ("d2", "en", "s3"): 40}, share=(1, 2), epochs=2, seed=9),
    Mix(budget=17), Mix(budget=0), Mix(budget=10 ** 9, epochs=2)])
def test_like_plain_loops(spark, mix):
    rows = corpus()
    df = spark.createDataFrame([(k, *p, n, 1, 2) for k, p, n in rows], "doc_id long, a string, b string, c string, n int, budget int, _n int")
    got = mixing.mixed(df, [F.col("a"), F.col("b"), F.col("c")], "doc_id", F.col("n"), mix)
    assert got.columns == ["doc_id", "a", "b", "c", "n", "_n", "budget", "copies", "tokens_taken"]
    found = {r["doc_id"]: (r["budget"], r["copies"], r["tokens_taken"]) for r in got.collect()}
    assert found == plain(rows, mix)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x", 10), (1, "x", 10), (2, "x", 10), (3, "y", None)], "doc_id long, s string, n int")
    got = mixing.mixed(df, [F.col("s")], "doc_id", F.col("n"), Mix(budget=25)).collect()
    ids = [r["doc_id"] for r in got]
    assert ids.count(1) in (0, 2) and 3 not in ids
    assert mixing.mixed(df.limit(0), [F.col("s")], "doc_id", F.col("n"), Mix()).collect() == []


@pytest.mark.parametrize("budget", [7, 20])
@pytest.mark.parametrize("chunk", [2])
def test_rows_with_one_key_share_the_budget(spark, monkeypatch, budget, chunk):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    rows = [(1, "x", 3, {"a": 1})] * 5 + [(1, "x", 3, None), (1, "x", 1, {"a": 2}), (1, None, 2, {})]
    df = spark.createDataFrame(rows, "doc_id long, s string, n int, m map<string,int>")
    for epochs in (1, 3):
        got = mixing.mixed(df, [F.lit("all")], "doc_id", F.col("n"), Mix(budget=budget, epochs=epochs)).collect()
        assert sum(r["tokens_taken"] for r in got) == min(budget, 21 * epochs)
        assert all(r["n"] * (r["copies"] - 1) <= r["tokens_taken"] <= r["n"] * r["copies"] for r in got)
        # no row is made up: each kind is there as often as in the table, or less often
        kinds = [str((r["doc_id"], r["s"], r["n"], r["m"])) for r in got]
        assert all(kinds.count(k) <= [str(x) for x in rows].count(k) for k in kinds)
