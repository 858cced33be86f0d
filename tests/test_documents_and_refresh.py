import json

import pytest
from pyspark.sql import functions as F

from tests.test_plans import D, P, Fixture
from uptrail.plans import refresh
from uptrail.plans.availability import availability
from uptrail.sinks import store
from uptrail.sources import documents
from uptrail.sources.defaults import tenant_operations


def operations_file(tmp_path, change):
    document = {"states": ["UP", "DOWN"], "default_down": "DOWN", "default_missing": "DOWN", "default_unknown": "DOWN",
                "operations": {"AND": [{"A": "UP", "B": "UP", "X": "UP"}, {"A": "UP", "B": "DOWN", "X": "DOWN"},
                                       {"A": "DOWN", "B": "DOWN", "X": "DOWN"}]}}
    change(document["operations"]["AND"])
    path = tmp_path / "operations.json"
    path.write_text(json.dumps(document))
    return str(path)


def test_good_document(spark, tmp_path):
    ops = documents.read_operations(spark, operations_file(tmp_path, lambda cells: None))
    assert ops.combine("AND", 1, 0) == 1 and ops.kinds == {"AND": "rank"}


@pytest.mark.parametrize("change,problem", [
    (lambda cells: cells.pop(), "no result"),
    (lambda cells: cells.append({"A": "DOWN", "B": "UP", "X": "UP"}), "two results"),
    (lambda cells: cells.append({"A": "UP", "B": "LEFT", "X": "UP"}), "unknown state")])
def test_bad_documents(spark, tmp_path, change, problem):
    path = operations_file(tmp_path, change)
    with pytest.raises(documents.BadDocument, match=problem):
        documents.read_operations(spark, path)
    if problem == "no result":
        assert documents.read_operations(spark, path, complete=False).combine("AND", 1, 1) == -1


def listed(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_batches_lead_to_the_results_of_the_whole_day(spark, tmp_path):
    fx = Fixture(spark, tenant_operations(), 5)
    root = str(tmp_path / "out")
    rows = fx.md.withColumn("part", F.pmod(F.xxhash64(*fx.md.columns), F.lit(3)))
    counts = []
    for part in (0, 1, 1, 2):  # the second batch comes twice
        counts.append(refresh.apply_batch(spark, rows.where(F.col("part") == part).drop("part"), [fx.report], fx.ops, root, P, D))
    assert counts[0] == 6 and counts[2] == 0
    plan = availability(spark, fx.md, [fx.report], fx.ops, P, D)
    for table, wanted in (("service_ar", plan.service_ar()), ("endpoint_group_ar", plan.group_ar())):
        assert listed(store.read_results(spark, root, table)) == listed(wanted)


def test_a_batch_that_failed_half_way(spark, tmp_path, monkeypatch):
    fx = Fixture(spark, tenant_operations(), 6)
    root = str(tmp_path / "out")
    refresh.apply_batch(spark, fx.md.where("metric = 'm1'"), [fx.report], fx.ops, root, D)
    real, calls = store.overwrite_partitions, []

    def failing(df, path, partitions, format="parquet"):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("gone")
        real(df, path, partitions, format)

    monkeypatch.setattr(store, "overwrite_partitions", failing)
    with pytest.raises(OSError):
        refresh.apply_batch(spark, fx.md, [fx.report], fx.ops, root, D)
    monkeypatch.setattr(store, "overwrite_partitions", real)
    assert refresh.apply_batch(spark, fx.md, [fx.report], fx.ops, root, D) > 0
    assert listed(store.read_results(spark, root, "service_ar")) == listed(availability(spark, fx.md, [fx.report], fx.ops, D).service_ar())
