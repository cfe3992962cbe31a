from __future__ import annotations

import random
from fractions import Fraction

from trajlake.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, mix_note int"


def webster(votes: list[int], seats: int) -> list[int]:
    got = [0] * len(votes)
    for _ in range(seats):
        i = max(range(len(votes)), key=lambda i: (Fraction(votes[i], 2 * got[i] + 1), -i))
        got[i] += 1
    return got


def test_sainte_lague_is_the_highest_quotients():
    rng = random.Random(0)
    for _ in range(80):
        votes = [rng.randrange(0, 1000) for _ in range(rng.randrange(1, 12))]
        if not any(votes):
            continue
        seats = rng.randrange(0, 120)
        assert M.sainte_lague(votes, seats) == webster(votes, seats)
    assert M.sainte_lague([5, 5], 7, [2, 9]) == [2, 5] and M.sainte_lague([0, 0], 3) == [0, 0]


def test_targets_reshare_what_is_above_the_cap():
    assert M.targets([10, 100, 100], [1, 2, 3], 210) == [30, 72, 108]
    assert M.targets([0, 10], [1, 1], 10) == [0, 10]
    assert sum(M.targets([1, 1, 1000, 3], [3, 2, 1, 1], 1005)) == 1005


def run(spark, rows, **how):
    docs = spark.createDataFrame(rows, SCHEMA)
    sized = M.sized(docs, "doc_id", "text", "source", 17)
    return M.take(sized, *M.quotas(sized, **how))


def test_sums_come_near_targets_and_reruns_agree(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), rng.choice(["a", "a", "a", "b", "é", None, "tiny"] if i > 5 else ["tiny"]), i) for i in range(900)]
    rows += [(5, None, "b", 0), (5, "", None, 0), (None, "x y z", "a", 0), (7, "p q", "a", 0), (7, "p q", "a", 0)]
    got = run(spark, rows, shard_docs=64).collect()
    assert len(got) == len(rows)
    by: dict = {}
    for r in got:
        assert 0 <= r["mix_taken"] <= 3 * r["mix_size"] and r["mix_size"] == len((r["text"] or "").split())
        s = by.setdefault(r["source"], [0, 0, r["mix_target"], r["mix_source_size"]])
        s[0], s[1] = s[0] + r["mix_taken"], s[1] + r["mix_size"]
    total = sum(s[1] for s in by.values())
    names = sorted(by, key=lambda x: (x is None, x or ""))
    want = M.targets([by[n][1] for n in names], [1 + i % 3 for i in range(len(names))], total)
    for n, t in zip(names, want, strict=True):
        assert by[n][3] == by[n][1] and abs(by[n][2] - t) < 1e-6
        assert abs(by[n][0] - t) <= max(3, 0.02 * t)
    key = lambda r: (str(r["doc_id"]), str(r["text"]), str(r["source"]), r["mix_note"], r["mix_taken"])
    assert sorted(map(key, got)) == sorted(map(key, run(spark, list(reversed(rows)), shard_docs=64).collect()))


def test_taken_words_of_each_document_against_a_plain_mix(spark):
    """Shard by shard: whole rounds for all, and once more the first words of the seeded order."""
    rng = random.Random(6)
    rows = [(i if i % 9 else None, " ".join(["w"] * rng.randrange(0, 30)) + f" {i}", rng.choice("aab"), i) for i in range(300)]
    sized = M.sized(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "source", 17)
    by_source, by_shard = M.quotas(sized, shard_docs=40)
    shards = {r["mix_key"]: r["mix_shards"] for r in by_source.collect()}
    words = {(r["mix_key"], r["mix_place"]): r["mix_words"] for r in by_shard.collect()}
    want: dict[int, int] = {}
    for name, n in shards.items():
        own = [r for r in sized.collect() if r["mix_source"] == name]
        assert n > 1 and sum(r["mix_size"] for r in own)
        for k in range(n):
            row = sorted((r for r in own if r["mix_deal"] % n == k), key=lambda r: (r["mix_order"], r["mix_deal"]))
            line = [r["mix_note"] for r in row for _ in range(r["mix_size"])]
            for r in row:
                want[r["mix_note"]] = 0
            for i in range(words.get((name, k), 0)):
                want[line[i % len(line)]] += 1
    got = {r["mix_note"]: r["mix_taken"] for r in M.take(sized, by_source, by_shard).collect()}
    assert got == want and len({r["mix_deal"] for r in sized.collect() if r["doc_id"] is None}) > 20


def test_columns_of_the_same_names_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 5, "x"), (2, "c", "s", 6, None)], "doc_id long, text string, source string, mix_size int, Mix_Key string")
    sized = M.sized(docs, "doc_id", "text", "source", 1)
    assert {r["doc_id"]: r["mix_taken"] for r in M.take(sized, *M.quotas(sized)).collect()} == {1: 2, 2: 1}


def test_empty_and_wordless_tables(spark):
    assert run(spark, []).count() == 0
    assert [r["mix_taken"] for r in run(spark, [(1, None, "a", 0), (2, " \t", None, 0)]).collect()] == [0, 0]


def test_first_words(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(" a  b\tc", 2), ("a b", 5), ("", 1)], "t string, n long").select(M.first_words(F.col("t"), F.col("n")).alias("x")).collect()
    assert [r["x"] for r in got] == [" a  b", "a b", ""]
