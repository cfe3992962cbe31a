"""Near duplicates against brute force over full sets."""

from __future__ import annotations

import random

import numpy as np
import pytest

from trajlake.llm import neardup
from trajlake.llm.components import components
from trajlake.llm.shingles import OnePermutation, shingle_set


def brute(rows: list[tuple[int, str | None]], width: int, percent: int) -> dict[int, int]:
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) > width else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out: dict[int, int] = {}
    for i, (k, _) in enumerate(rows):
        out[find(i)] = min(out.get(find(i), k), k)
    return {k: out[find(i)] for i, (k, _) in enumerate(rows)}


def group(rng: random.Random, n: int, words: int, changes: int) -> list[str]:
    """A base and copies that each differ from it by some words: near the base, less near each other."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        own = list(base)
        for _ in range(changes):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize(("width", "small", "block"), [(2, 128, 64), (2, 4, 3), (5, 6, 4)])
def test_groups_agree_with_brute_force(spark, monkeypatch, width, small, block):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(width)
    texts: list[str | None] = [None, "", "  \t\n ", "one", "ONE", "one two", "One  two", "a b c", "A b\tc"]
    for changes in (1, 2, 3, 5, 8):
        texts += group(rng, 12, 90, changes)
    texts += [" ".join(f"c{i}" for i in range(s, s + 60)) for s in range(0, 60, 4)]  # a chain
    texts += ["same text again and again and more of it"] * 30
    texts += [" ".join(f"u{rng.randrange(10**7)}" for _ in range(rng.randrange(1, 80))) for _ in range(40)]
    rng.shuffle(texts)
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width).collect()
    want = brute(rows, width, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(got) == len(rows)


def test_empty_table_extra_columns_and_repeated_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, cls string, n int")
    assert neardup.near_duplicates(none).count() == 0
    assert neardup.keep_one(none).columns == none.columns
    rows = [(5, "a b c d e f", "x", 1), (5, "a b c d e f", "x", 1), (7, "a b c d e f", "y", 2), (9, None, None, None), (None, "p q", "z", 3)]
    docs = spark.createDataFrame(rows, none.schema)
    assert sorted(neardup.keep_one(docs).collect(), key=str) == sorted([docs.collect()[i] for i in (0, 3, 4)], key=str)


def test_rows_of_one_key_are_judged_by_their_texts(spark):
    a, b = "a b c d e f g", "p q r s t u v"
    rows = [(3, a, 0), (5, a, 1), (5, b, 2), (7, a, 3), (None, a, 4), (None, "x y z", 5), (None, "x y z", 6), (9, b, 7), (2, None, 8), (2, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stays int")
    got = sorted(tuple(r) for r in neardup.keep_one(docs).collect() if r["text"] not in (None, "x y z"))
    assert got == [(3, a, 0), (5, b, 2)]
    rest = [tuple(r) for r in neardup.keep_one(docs).collect() if r["text"] in (None, "x y z")]
    assert len([r for r in rest if r[1]]) == 1 and len([r for r in rest if r[1] is None]) == 2
    found = sorted(map(tuple, neardup.near_duplicates(docs).collect()), key=str)
    assert found == sorted([(3, 3, 3, True), (5, 3, 3, False), (5, 3, 5, True), (7, 3, 3, False), (None, 3, 3, None), (None, 1, None, None), (None, 1, None, None), (9, 3, 5, False), (2, 0, 2, True), (2, 0, 2, True)], key=str)


def test_filter_lets_all_keys_through_and_few_others(spark, monkeypatch):
    from pyspark.sql import functions as F

    from trajlake.llm import common

    rows = spark.range(4000).select("id", F.xxhash64("id").alias("h"))
    for words in (1 << 18, 3):
        monkeypatch.setattr(common, "FILTER_WORDS", words)
        some, clear = common.split_by(rows, "h", common.key_filter(rows.where("id % 10 = 0"), "h"))
        ids = {r["id"] for r in some.collect()}
        assert ids >= set(range(0, 4000, 10)) and ids.isdisjoint(r["id"] for r in clear.collect())
        assert len(ids) + clear.count() == 4000 and (words < 9 or len(ids) < 420)


def test_signature_of_small_sets_is_full_and_equal_sets_agree():
    oph = OnePermutation(8, 4)
    for text in ("one", "one two three", "a b c d e f g h i j k l m"):
        s = shingle_set(text, 2)
        assert (oph.signature(s) != 0).all()
        assert (oph.buckets(s) == oph.buckets(shingle_set(text.upper(), 2))).all()
    estimates = []
    rng = np.random.default_rng(0)
    for _ in range(60):
        u = rng.permutation(np.unique(rng.integers(0, 1 << 64, 300, np.uint64)))
        estimates.append((OnePermutation(40, 4).signature(np.sort(u[:270])) == OnePermutation(40, 4).signature(np.sort(u[30:]))).mean())
    assert abs(np.mean(estimates) - 240 / 300) < 0.02


def test_long_words_and_pieces(monkeypatch):
    from trajlake.llm import shingles

    text = " ".join(["x" * 50, "y" * 7, "zed", "Zed", "q" * 300] * 20)
    whole = shingles.word_hashes(text)
    monkeypatch.setattr(shingles, "PIECE", 64)
    assert (shingles.word_hashes(text) == whole).all()
    assert whole[2] == whole[3]


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(1000, 1000 + i) for i in range(1, 50)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["root"] for r in got} == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(50)}
