"""Each branch of the decision chain, and the edges of its thresholds."""

from __future__ import annotations

import pytest

from trajlake.operators import relations as R
from trajlake.operators import uniqueness as U

COLUMNS = "scene string, room string, id string, category string, key long, min_x double, min_y double, min_z double, max_x double, max_y double, max_z double"


def relate(spark, a, b):
    rows = [("s", "r", "a", "ca", 1, *map(float, a)), ("s", "r", "b", "cb", 2, *map(float, b))]
    got = R.relations(spark.createDataFrame(rows, COLUMNS)).collect()
    return (got[0]["rel_a"], got[0]["rel_b"]) if got else "far"


UNIT = (0, 0, 0, 1, 1, 1)
CASES = [
    ((1.75, 0, 0, 2, 1, 1), "far"),  # 0.75 apart
    ((1.5, 0, 0, 2, 1, 1), ("near", "near")),  # exactly 0.5
    ((0, 0, 1.25, 1, 1, 2), ("below", "above")),
    ((0, 0, -1.25, 1, 1, -0.25), ("above", "below")),
    ((0, 0, 1.046875, 1, 1, 2), ("below", "on")),  # a gap of less than 0.05: support, not above
    ((1.25, 0, 0, 2, 1, 1), ("near", "near")),
    ((0.25, 0.25, 0.25, 0.75, 0.75, 0.75), ("contain", "in")),
    ((-1, -1, -1, 2, 2, 2), ("in", "contain")),
    ((0, 0, -1, 1.2, 1, 0), ("on", "below")),
    ((0, 0, 1, 1, 1.2, 2), ("below", "on")),
    ((0.9, 0.9, 0.1, 1.9, 1.9, 1.1), (None, None)),  # corners overlap: no rule holds
    ((0.5, 0.5, 0.5, 0.5, 0.5, 0.5), ("near", "near")),  # no area
]


@pytest.mark.parametrize(("b", "want"), CASES)
def test_branches(spark, b, want):
    assert relate(spark, UNIT, b) == want


def test_symmetry_and_pruning(spark):
    rows = []
    for i in range(120):
        x, y = (i * 37 % 50) / 4, (i * 91 % 50) / 4
        rows.append(("s", f"r{i % 3}", f"o{i}", "c", i, x, y, 0.0, x + 1 + i % 3, y + 2, 1.0 + i % 2))
    boxes = spark.createDataFrame(rows, COLUMNS)
    got = {(r["a_id"], r["b_id"]): r["dist"] for r in R.close_pairs(boxes, cell=1.5).collect()}
    gap = lambda a, b, k: max(a[5 + k] - b[8 + k], b[5 + k] - a[8 + k], 0.0)
    want = {}
    for a in rows:
        for b in rows:
            if a[1] == b[1] and a[4] < b[4] and (d := sum(gap(a, b, k) ** 2 for k in range(3)) ** 0.5) <= 0.5:
                want[a[2], b[2]] = d
    assert got == pytest.approx(want)
    inverse = {"above": {"below"}, "below": {"above", "on"}, "in": {"contain"}, "contain": {"in"}, "on": {"below"}, "near": {"near"}}
    edges = {(r["src"], r["dst"]): r["rel"] for r in R.edges(R.relations(boxes)).collect()}
    assert all(edges[b, a] in inverse[rel] for (a, b), rel in edges.items())


def test_uniqueness_rules(spark):
    e = [("s", "a", "b", "near", "lamp_x"), ("s", "a", "c", "near", "chair"), ("s", "b", "a", "near", "desk"), ("s", "c", "a", "on", None), ("s", "c", "d", "near", None), ("s", "c", "b", "near", None)]
    edges = spark.createDataFrame(e, "scene string, src string, dst string, rel string, dst_category string")
    kinds = {(r["src"], r["dst"]): r["kind"] for r in U.unique_edges(edges).collect()}
    assert kinds == {("a", "b"): "semantic", ("a", "c"): "semantic", ("b", "a"): "relational", ("c", "a"): "relational", ("c", "d"): None, ("c", "b"): None}
    both = U.mutual_goals(edges).collect()
    assert {frozenset((r["object_1_id"], r["object_2_id"])) for r in both} == {frozenset("ab"), frozenset("ac")}
    assert U.mutual_goals(edges, deny_sources=["b"], deny_targets=["b"]).count() == 1
