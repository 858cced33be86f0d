"""Each stage on its own input, against the plain versions of the operators' tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import test_bwt as bwt_plain  # noqa: E402
import test_jaccard as jaccard_plain  # noqa: E402
import test_mixing as mixing_plain  # noqa: E402
import test_quality as quality_plain  # noqa: E402

import corpus_pipeline  # noqa: E402
from uptrail.llm import jaccard, quality  # noqa: E402
from uptrail.llm.common import table, written  # noqa: E402
from uptrail.llm.queries import MIX  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near-duplicates", "repeats", "mix", "segmentations"]
    for out in stages[1:-1]:
        assert out.columns == stages[0].columns


def test_quality(stages):
    rows = [(r["doc_id"], r["lang"], r["text"]) for r in stages[0].collect()]
    kept = {r[0] for r in quality_plain.plain(rows, quality.Limits()) if r[-1]}
    assert {r["doc_id"] for r in stages[1].collect()} == kept and stages[1].count() == len(kept)


def test_near_duplicates(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    lead = {key for key, _, group in jaccard_plain.plain(rows, jaccard.Join(n=5, percent=80)) if key == group}
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(lead)


def test_repeats(stages):
    rows = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in stages[2].collect())
    want = {key: (gone, n) for (key, _, n), (_, gone, _, _) in zip(rows, bwt_plain.plain([t for _, t, _ in rows], 400))}
    after = {r["doc_id"]: r for r in stages[3].collect()}
    assert set(after) == set(want)
    for key, text, n in rows:
        if want[key][0] == 0:
            assert after[key]["text"] == text and after[key]["n_chars"] == n
        else:
            assert after[key]["n_chars"] == len(after[key]["text"]) < n


def test_mix(stages):
    rows = []
    for r in stages[3].collect():
        domain = "d" + str(int(r["source"][-1]) % 4) if r["source"][-1:].isdigit() else None
        rows.append((r["doc_id"], (domain, r["lang"], r["source"]), quality_plain.counts(r["text"])[0]))
    want = {key: copies for key, (_, copies, _) in mixing_plain.plain(rows, MIX).items()}
    got = {}
    for r in stages[4].collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == want


def test_segmentations(stages, spark):
    from uptrail.llm import pieces

    texts = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    for r in pieces.decoded(stages[5], corpus_pipeline.piece_bpe()).collect():
        assert r["text"] == texts[r["doc_id"]]


def test_one_each_with_repeats_and_nulls(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text), (1, text), (2, text + " "), (None, text), (None, "other words of a text without any key at all"),
            (None, "other words of a text without any key at all"), (5, None), (5, ""), (6, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in jaccard.one_each(df).collect())
    assert got == sorted([("1", text), ("None", rows[4][1]), ("5", ""), ("5", ""), ("6", "alone")])


def test_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"test-empty-{name}")
        assert docs.count() == 0
