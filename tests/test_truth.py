import itertools

import pytest
from pyspark.sql import functions as F

from uptrail.functions.truth import Operations
from uptrail.operators import fold as fo
from uptrail.sources.defaults import STATES, grid_operations, tenant_operations


def test_kinds():
    assert tenant_operations().kinds == {"AND": "rank", "OR": "rank"}
    assert grid_operations().kinds == {"AND": "rank", "OR": "ordered"}


def test_cells():
    ops = grid_operations()
    c = ops.code
    assert ops.combine("OR", c("CRITICAL"), c("DOWNTIME")) == c("DOWNTIME")
    assert ops.combine("OR", c("CRITICAL"), c("UNKNOWN")) == c("CRITICAL")
    assert ops.combine("OR", c("UNKNOWN"), c("DOWNTIME")) == c("UNKNOWN")
    assert ops.combine("AND", c("CRITICAL"), c("DOWNTIME")) == c("DOWNTIME")
    assert tenant_operations().combine("AND", c("CRITICAL"), c("DOWNTIME")) == c("CRITICAL")


def test_document_and_undefined_cells():
    doc = {"states": ["A", "B", "C"], "default_down": "C", "default_missing": "B",
           "default_unknown": "B",
           "operations": {"X": [{"A": "A", "B": "B", "X": "B"}, {"A": "A", "B": "A", "X": "A"},
                                {"A": "B", "B": "B", "X": "B"}, {"A": "C", "B": "C", "X": "C"}]}}
    ops = Operations.from_document(doc)
    assert ops.combine("X", 1, 0) == 1 and ops.combine("X", 0, 2) == -1
    assert ops.combine("X", -1, 0) == -1
    one_way = Operations.from_document(doc, mirror=False)
    assert one_way.combine("X", 1, 0) == -1


def lattice():
    """Two incomparable states below a top one: order-free, but no rank."""
    states = ["LOW", "LEFT", "RIGHT", "TOP"]
    def join(a, b):
        return a if a == b or b == 0 else b if a == 0 else 3
    table = tuple(tuple(join(a, b) for b in range(4)) for a in range(4))
    return Operations(tuple(states), {"JOIN": table}, "TOP", "LOW", "LOW")


def wide_lattice():
    """Twelve incomparable states between a lowest and a top one."""
    top = 13
    table = tuple(tuple(a if a == b or b == 0 else b if a == 0 else top for b in range(14)) for a in range(14))
    return Operations(tuple(f"S{i}" for i in range(14)), {"JOIN": table}, "S13", "S0", "S0")


def test_order_free_tables_of_any_size_are_sets():
    assert wide_lattice().kinds == {"JOIN": "set"}


@pytest.mark.parametrize("ops,op", [(wide_lattice(), "JOIN"), (tenant_operations(), "AND"), (tenant_operations(), "OR"),
                                    (lattice(), "JOIN"), (grid_operations(), "OR")])
def test_fold_states_all_triples(spark, ops, op):
    triples = list(itertools.product(range(ops.size), repeat=3))
    rows = [(i, f"m{j}", code) for i, t in enumerate(triples) for j, code in enumerate(t)]
    df = spark.createDataFrame(rows, "k int, member string, code int")
    got = {r.k: r.code for r in fo.fold_states(df, ["k"], "member", "code", ops, op).collect()}
    assert got == {i: ops.fold_codes(op, list(t)) for i, t in enumerate(triples)}


def test_apply_op_matches_table(spark):
    ops = grid_operations()
    pairs = [(a, b) for a in range(-1, 6) for b in range(-1, 6)]
    df = spark.createDataFrame(pairs, "a int, b int").withColumn(
        "x", ops.apply_op("OR", F.col("a"), F.col("b")))
    assert all(r.x == ops.combine("OR", r.a, r.b) for r in df.collect())


def test_state_names(spark):
    ops = tenant_operations()
    df = spark.createDataFrame([(s,) for s in [*STATES, "NOPE"]], "s string").withColumn(
        "c", ops.state_code(F.col("s"))).withColumn("n", ops.state_name(F.col("c")))
    assert [(r.c, r.n) for r in df.collect()] == [*enumerate(STATES), (-1, None)]
