from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from trajlake.llm import suffixdedup as S


def brute(texts: list[str | None], length: int) -> list[tuple]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return out


def texts(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeéü", k=rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    common, other = prose(14), prose(30)
    out: list[str | None] = [None, "", "short", prose(60), "ab" * 120, "z" * 300, "z" * 90]
    out += [prose(rng.randrange(5, 40)) + common + prose(rng.randrange(5, 40)) for _ in range(12)]
    out += [prose(10) + other + prose(5) + other[5:-5] for _ in range(3)]
    out += [out[3], out[3] + "!", prose(40)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("hot", "seed"), [(1024, 0), (3, 1), (0, 2)])
def test_agrees_with_brute_force(spark, hot, seed):
    t = texts(seed)
    rows = [(i, x, 0) for i, x in enumerate(t)]
    got = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, runs int"), length=60, gram=12, hot=hot).orderBy("doc_id").collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == brute(t, 60)


def brute_passages(texts: list[str | None], words: int) -> list[int]:
    split = [(t or "").encode().lower().split() for t in texts]  # bytes: only A-Z have a lower case
    holders: dict[tuple, set] = {}
    for n, w in enumerate(split):
        for i in range(len(w) - words + 1):
            holders.setdefault(tuple(w[i : i + words]), set()).add(n)
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - words + 1):
            if len(holders[tuple(w[i : i + words])]) > 1:
                gone[i : i + words] = [True] * words
        out.append(sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1])))
    return out


@pytest.mark.parametrize("hot", [1024, 0, 2])
def test_passages_in_several_documents_against_brute_force(spark, hot):
    from pyspark.sql import functions as F

    rng = random.Random(hot)
    prose = lambda n: " ".join("".join(rng.choices("abcdé", k=rng.randrange(1, 6))) for _ in range(n))
    shared = [prose(n) for n in (8, 9, 10, 11, 12, 25, 60)]
    own = [prose(30) + " la la" * 20 for _ in range(4)]  # repeats inside a document alone
    texts = [None, "", *own, *(f"{prose(rng.randrange(0, 20))} {rng.choice(shared)}  {prose(rng.randrange(0, 20))}\n{rng.choice(shared).upper()}" for _ in range(40)), own[0].split(" la")[0] + " end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = S._rows(docs, "doc_id", "text").join(S.shared_passages(docs, "doc_id", "text", 10, 3, hot), "rid", "left").select("doc_id", F.coalesce("n_passages", F.lit(0)).alias("n")).orderBy("doc_id").collect()
    want = brute_passages(texts, 10)
    assert [r["n"] for r in got] == want and sum(want) > 20


def test_texts_are_read_and_handed_over_in_small_batches(spark, monkeypatch):
    import pyarrow as pa

    keys = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before, own, limits, sizes = [spark.conf.get(k) for k in keys], S.stage, {}, []

    def measured(df, what):
        limits[what] = [spark.conf.get(k) for k in keys]
        if what == "anchors":  # as many texts as would be one batch of 32 MB
            texts = spark.range(0, 8000, 1, 1).selectExpr("repeat('0123', 1000) AS text")
            count = lambda batches: (pa.RecordBatch.from_pydict({"n": pa.array([b.nbytes], pa.int64())}) for b in batches)
            sizes.extend(r["n"] for r in texts.mapInArrow(count, "n long").collect())
        return own(df, what)

    monkeypatch.setattr(S, "stage", measured)
    t = texts(4)
    got = S.remove_repeats(spark.createDataFrame(list(enumerate(t)), "doc_id long, text string"), length=60, gram=12).orderBy("doc_id").collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == brute(t, 60)
    assert {"anchors", "texts", "cold", "blocks", "windows", "cut"} <= set(limits) and set(map(tuple, limits.values())) == {(str(1 << 21), "512")}
    assert sum(sizes) >= 2 * 32e6 and max(sizes) < 3e6
    assert [spark.conf.get(k) for k in keys] == before


def test_empty_null_keys_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert S.remove_repeats(spark.createDataFrame([], schema)).count() == 0
    got = S.remove_repeats(spark.createDataFrame([(1, "q" * 30 + "xyz" * 9), (1, "q" * 30 + "xyz" * 9), (None, "ab" * 31), (None, "cd" * 4)], schema), length=20, gram=5).collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in got) == [(8, 0), (57, 57), (57, 57), (62, 62)]


def test_family_holds_few_levels_and_batches_make_no_difference(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 3000).astype(np.uint8).tobytes()
    data += data[500:900]
    monkeypatch.setattr(S, "PIECE", 256)
    key, place, first, last = S.anchors(np.frombuffer(data, np.uint8), 40, 8)
    segments = [data[a : b + 40] for a, b in zip(first, last, strict=True)]
    hits = []
    for size in (len(key), 5):
        family = S.Family(40, 8)
        for at in range(0, len(key), size):
            s = slice(at, at + size)
            family.add(segments[s], (place - first)[s], np.arange(len(key))[s])
            if size == 5 and at == 50:  # a family that was written goes on where it was
                family = S.Family.load(family.save(), 40, 8)
        assert len(family.levels) <= 2 + np.log2(len(key))
        for level in family.levels:
            assert (level.keys[1:] >= level.keys[:-1]).all()
        hits.append({row: found.tolist() for row, found in family.result()})
    assert hits[0] == hits[1]
    assert sum(map(sum, hits[0].values())) >= 2 * 361
