from __future__ import annotations

import numpy as np
import pytest

from trajlake.llm import onebit

SCHEMA = "vec_id long, embedding array<float>, v int"


def brute(rows: list[tuple[int, np.ndarray]], k: int) -> list[tuple[int, list[float]]]:
    """The best scores of each query row among all other rows, as (query_id, scores)."""
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    out = []
    for n in np.flatnonzero(ids % 20 == 0):
        s = x @ x[n]
        order = [i for i in np.lexsort((ids, -s)) if i != n][:k]
        out.append((int(ids[n]), ids[order].tolist(), s[order].tolist()))
    return out


def found(frame) -> dict[int, list[tuple[int, float]]]:
    out: dict[int, list] = {}
    for r in frame.orderBy("query_id", "rank", "vec_id").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_ties_repeated_keys_and_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=64).astype(np.float32).astype(float)) for i in range(900)]
    for i in range(40, 90):  # many equal ones
        good[i] = (i, good[40][1])
    good += [(7, good[7][1]), (7, good[8][1])]  # rows that share a key are rows of their own
    bad = [(2000, None), (2020, []), (2040, [0.0] * 64), (2060, [None] + [1.0] * 63), (2080, [float("nan")] * 64), (2100, [float("inf")] * 64), (None, [1.0] * 64), (2120, [1.0] * 3)]
    rows = [(i, x.tolist(), 0) for i, x in good] + [(i, x, 2) for i, x in bad]
    index, space = onebit.encode(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", cell=50)
    assert index.count() == 902 and len(space.centroids) == 18
    want = {q: (ids, scores) for q, ids, scores in brute(good, 20)}
    for exact in (True, False):
        got = found(onebit.search(index, index.where("vec_id % 20 = 0"), space, 20, query_block=16, vector_block=20, exact=exact))
        assert set(got) == set(want)
        hits = sum(np.isclose([s for _, s in got[q]], want[q][1], rtol=1e-9).sum() for q in want)
        assert hits >= (0.99 if exact else 0.97) * 20 * len(want)
    assert [i for i, _ in got[40]] == want[40][0]  # ties by vec_id


@pytest.mark.parametrize(("n", "spread"), [(3000, 1.0), (12000, 0.35)])
def test_recall_at_two_sizes(spark, n, spread):
    """Vectors without any structure, and vectors in clusters, where most cells needn't be asked."""
    rng = np.random.default_rng(n)
    middles = rng.normal(size=(40, 32))
    x = (middles[rng.integers(0, 40, n)] * (1 - spread) + spread * rng.normal(size=(n, 32))).astype(np.float32).astype(float)
    rows = [(i, v) for i, v in enumerate(x)]
    index, space = onebit.encode(spark.createDataFrame([(i, v.tolist(), 0) for i, v in rows], SCHEMA), "vec_id", "embedding", cell=100)
    asked = index.where("vec_id % 20 = 0")
    got, want = found(onebit.search(index, asked, space, 20)), {q: ids for q, ids, _ in brute(rows, 20)}
    hits = sum(len({i for i, _ in got[q]} & set(want[q])) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    if spread < 1:
        assert onebit._probes(asked, space, 20, onebit.REACH, False).count() < 0.6 * asked.count() * len(space.centroids)


def test_estimates_from_packed_bits():
    rng = np.random.default_rng(1)
    for dim in (3, 64, 100, 130):
        q, signs = rng.normal(size=dim), rng.integers(0, 2, (500, dim)).astype(bool)
        guess, cut = onebit.estimates(q, onebit.pack(signs))
        error = guess - (2.0 * signs - 1) @ q
        assert np.abs(error).max() <= 6 * cut + 1e-9 and error.std() <= 2.5 * cut


def test_few_vectors_and_none(spark):
    rows = [(0, [1.0, 0.0], 0), (20, [0.5, 1.0], 0), (3, [2.0, 2.0], 0)]
    index, space = onebit.encode(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    got = sorted(map(tuple, onebit.search(index, index.where("vec_id % 20 = 0"), space).collect()))
    assert got == [(0, 1, 3, 2.0), (0, 2, 20, 0.5), (20, 1, 3, 3.0), (20, 2, 0, 0.5)]
    index, space = onebit.encode(spark.createDataFrame([], SCHEMA), "vec_id", "embedding")
    assert onebit.search(index, index.where("vec_id % 20 = 0"), space).count() == 0
    index, space = onebit.encode(spark.createDataFrame(rows, "id long, code array<double>, cell int"), "id", "code")  # columns of other names that clash
    assert index.count() == 3
