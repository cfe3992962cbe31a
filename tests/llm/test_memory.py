"""What executors hold: no Python workers for a driver's small table, few blocks side by side, ids held once."""

from __future__ import annotations

import tracemalloc

import numpy as np

from trajlake.llm import idcoder, idfiles, mixing


def _peak_mb(f) -> float:
    tracemalloc.start()
    try:
        f()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_small_tables_need_no_python_worker(spark):
    rows = [(None, 3, 0.5, 1), ("é", 2**40, 1.25, 2)]
    schema = "mix_key string, mix_source_size long, mix_target double, mix_shards long"
    got = mixing._small(spark, rows, schema)
    assert "PythonRDD" not in got._jdf.rdd().toDebugString()
    assert [f"{n} {t}" for n, t in got.dtypes] == schema.replace("long", "bigint").split(", ")
    assert [tuple(r) for r in got.collect()] == rows
    none = mixing._small(spark, [], schema)
    assert none.dtypes == got.dtypes and none.collect() == []


def test_few_blocks_are_coded_side_by_side():
    ids = np.random.default_rng(1).integers(0, 5000, 3584 * 32).astype("<u4")
    table = idcoder.Table.of(ids)
    assert _peak_mb(lambda: idcoder.encode(ids[: 2048 * 32], table, 32)) < 45
    blocks = idcoder.encode(ids, table, 32)
    assert _peak_mb(lambda: idcoder.decode(blocks, table)) < 70
    assert np.array_equal(np.concatenate(idcoder.decode(blocks, table)), ids)
    assert idcoder.decode([], table) == []


def test_held_ids_are_not_copied_as_more_come():
    held, rng, all_ids, sizes = idfiles.Held(7), np.random.default_rng(2), [], []
    for k in range(20):
        counts = rng.integers(0, 2000, 100)
        new = rng.integers(10, 50000, int(counts.sum())).astype("<u4")
        for a, b in zip(np.cumsum(counts) - counts, np.cumsum(counts), strict=True):
            all_ids.append(np.append(new[a:b], np.uint32(7)))
            sizes.append(int(b - a) + 1)
        keys = list(range(100 * k, 100 * k + 100))
        if k == 19:
            assert _peak_mb(lambda: held.add(keys, new, counts)) < 4  # 2 million ids, 8 MB, are there already
        else:
            held.add(keys, new, counts)
    assert held.n_ids == sum(sizes)
    took = []
    while held.keys:
        keys, size, ids = held.take(300_001)
        assert held.n_ids == 0 or int(size[:-1].sum()) < 300_001 <= len(ids)
        took.append((keys, size, ids))
    assert len(took) > 3 and held.n_ids == 0 and not held.pieces
    assert [k for t in took for k in t[0]] == list(range(2000))
    assert np.array_equal(np.concatenate([t[1] for t in took]), sizes)
    assert np.array_equal(np.concatenate([t[2] for t in took]), np.concatenate(all_ids))
