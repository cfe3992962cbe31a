"""Each stage of the pipeline on its predecessor's result, against a plain version of what it must do."""

from __future__ import annotations

import random
import zlib

import numpy as np
from test_decontam import distance_to_part
from test_neardup import brute

import corpus_pipeline as C
from trajlake.llm import decontam, mixing
from trajlake.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(7)
    alphabets = {"en": ["the", "ing", "th", "on", "er"], "de": ["ung", "sch", "ein", "der", "ich"]}
    prose = lambda lang, n: " ".join("".join(rng.choices(alphabets[lang], k=rng.randrange(1, 4))) for _ in range(n))
    items = [(i, prose("en", 25)) for i in range(3)]
    texts = [(lang, prose(lang, rng.randrange(20, 120))) for lang in ("en", "de") * 30]
    texts += [texts[0], texts[0], ("de", texts[1][1] + " mehr"), ("en", None), ("de", "12 ?!"), (None, prose("en", 40))]
    texts += [("en", prose("en", 10) + " " + items[1][1].upper() + " " + prose("en", 10))]
    rows = [(i, t, lang, rng.choice(["a", "a", "a", "b", None]), len(t) if t else None) for i, (lang, t) in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, rows[5]], items


def test_stages(spark, tmp_path):
    rows, items = fixture()
    sf = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert [n for n, _ in C.STAGES] == ["language", "near_dedup", "decontaminate", "mix", "token_ids"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, step in C.STAGES:
        out = step(spark, docs, sf)
        if name != "token_ids":
            assert out.columns == docs.columns
        path = f"{sf}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = [tuple(r) for r in docs.collect()]

    key = lambda r: (r[0], r[1] or "")
    assert sorted(seen["language"], key=key) == sorted((r for r in rows if r[1] and any(c.isalpha() for c in r[1])), key=key)
    first = {r[0]: r[1] for r in seen["language"]}
    groups = brute(list(first.items()), 5, 80)
    assert sorted(seen["near_dedup"]) == sorted({r for r in seen["language"] if groups[r[0]] == r[0]})
    bad = {r[0] for r in seen["near_dedup"] for _, x in items if distance_to_part(decontam.normal(x), decontam.normal(r[1])) <= int(len(decontam.normal(x)) * decontam.RATE)}
    assert len(bad) == 1 and sorted(seen["decontaminate"]) == sorted(r for r in seen["near_dedup"] if r[0] not in bad)

    words = lambda rs: {s: sum(len(r[1].split()) for r in rs if r[3] == s) for s in {r[3] for r in rs}}
    had, got = words(seen["decontaminate"]), words(seen["mix"])
    names = sorted(had, key=lambda s: (s is None, s or ""))
    for s, t in zip(names, mixing.targets([had[s] for s in names], [1, 2, 3], sum(had.values())), strict=True):
        assert abs(got.get(s, 0) - t) <= max(3, 0.02 * t)
    whole = {r[0]: r for r in seen["decontaminate"]}
    assert all(r == whole[r[0]] or (whole[r[0]][1].startswith(r[1]) and r[4] == len(r[1])) for r in seen["mix"])

    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(tokenizer_path()), 0
    by_start = sorted(seen["token_ids"], key=lambda r: r[1])
    for r, (doc_id, text) in zip(by_start, sorted((r[0], r[1]) for r in seen["mix"]), strict=True):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert r == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert sorted(tuple(r) for r in C.run(spark, sf).collect()) == sorted(seen["token_ids"])


def test_an_empty_table_passes_all_stages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
