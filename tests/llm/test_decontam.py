from __future__ import annotations

import random

import pytest

from trajlake.llm import decontam as D

SCHEMA = "doc_id long, text string"


def distance_to_part(item: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def edit(rng: random.Random, s: str, n: int) -> str:
    out = list(s)
    for _ in range(n):
        i, how = rng.randrange(len(out)), rng.randrange(3)
        out[i : i + 1] = {0: [], 1: [rng.choice("qxz")], 2: [out[i], rng.choice("qxz")]}[how]
    return "".join(out)


def test_myers_is_edit_distance():
    rng = random.Random(0)
    for _ in range(60):
        item = "".join(rng.choices("abcd ", k=rng.randrange(1, 90)))
        text = "".join(rng.choices("abcd ", k=rng.randrange(0, 60))) + edit(rng, item, rng.randrange(4)) + "ab"
        assert D.least_distance(D.masks(item), len(item), text, 0, len(text), 999)[0] == distance_to_part(item, text)


@pytest.mark.parametrize("block_chars", [10**6, 200])
def test_all_within_the_budget_and_no_others(spark, block_chars):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(20)) for i in range(6)] + [(6, None), (7, ""), (8, "ab")]
    docs = [(100 + n, prose(15) + " \n" + edit(rng, items[n % 6][1], n // 3).upper() + "\t " + prose(15)) for n in range(50)]
    docs += [(1, None), (2, ""), (3, items[0][1]), (3, items[0][1]), (4, items[1][1] + " " + items[2][1])]
    got = sorted((r["doc_id"], r["item_id"], r["distance"]) for r in D.leaks(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), block_chars=block_chars).collect())
    want = []
    for d, t in docs:
        for i, x in items:
            if x and t:
                n = distance_to_part(D.normal(x), D.normal(t))
                if n <= int(len(D.normal(x)) * D.RATE):
                    want.append((d, i, n))
    assert got == sorted(want) and len(want) > 15


def test_clean_keeps_rows_and_columns(spark):
    item = "an item of the benchmark that is long enough to be told apart"
    docs = spark.createDataFrame([(1, f"x {item} y", 5), (2, "nothing of it", 6), (None, "z", 7), (2, "nothing of it", 6)], "doc_id long, text string, item_id int")
    got = D.clean(docs, spark.createDataFrame([(0, item)], "item_id long, text string"))
    assert got.columns == docs.columns and sorted(r["item_id"] for r in got.collect()) == [6, 6, 7]
    assert D.clean(docs, spark.createDataFrame([], "item_id long, text string")).count() == 4
    # Rows of one key are judged by their own texts, and so are rows without a key.
    other = "some words that no benchmark has anywhere in it, as far as known"
    mixed = spark.createDataFrame([(1, item, 1), (1, other, 2), (None, item, 3), (None, other, 4), (5, None, 5), (5, item, 6)], docs.schema)
    for chars in (10**6, 30):
        kept = D.clean(mixed, spark.createDataFrame([(0, item), (1, "another of the items"), (None, "an item without a key")], "item_id long, text string"), block_chars=chars)
        assert sorted(r["item_id"] for r in kept.collect()) == [2, 4, 5]


def test_blocks_hold_no_more_characters_than_they_may(spark):
    import json

    from trajlake.llm.common import folder

    rows = [(i, f"{i} " + "x" * (i * 37 % 900)) for i in range(200)] + [(200, "y" * 9000)]
    names = D._blocks(spark.createDataFrame(rows, "item_id long, text string"), "item_id", "text", 6000)
    own = [json.loads(folder(n)[0].open_input_stream(folder(n)[1]).read()) for n in names]
    assert sorted(i for b in own for i, _ in b) == list(range(201)) and len(own) > 3
    assert all(sum(len(t) for _, t in b) <= 6000 or len(b) == 1 for b in own)


def test_a_very_long_text(spark):
    item = "an item of the benchmark that is long enough to be told apart"
    docs = spark.createDataFrame([(1, "filler words " * 150_000 + item.replace("long", "lng")), (2, "filler words " * 150_000)], SCHEMA)
    items = spark.createDataFrame([(0, item)], "item_id long, text string")
    assert [(r["doc_id"], r["distance"]) for r in D.leaks(docs, items).collect()] == [(1, 1)]
    assert [r["doc_id"] for r in D.clean(docs, items).collect()] == [2]


def test_nothing_of_nothing(spark):
    item = "an item of the benchmark that is long enough to be told apart"
    docs = spark.createDataFrame([(1, item, 5)], "doc_id long, text string, item_id int")
    assert D.leaks(docs.limit(0), spark.createDataFrame([(0, item)], "item_id long, text string")).count() == 0
