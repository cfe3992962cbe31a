from __future__ import annotations

import random

import numpy as np

from trajlake.llm import langid

WORDS = {"en": "the of and thing with from this that over under".split(), "fr": "le la les dans une que pour sur été avec".split(), "de": "der die das und nicht über für mit ein auf".split()}


def corpus(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(5, 60))), lang) for i in range(n) for lang in [rng.choice(sorted(WORDS))]]


def test_held_out_accuracy_and_edges(spark):
    rows = corpus(240, 0)
    model = langid.fit(spark.createDataFrame([*rows, (1000, None, "en"), (1001, "text", None), (1002, "123 !!", "de")], "doc_id long, text string, lang string"), per_label=40, landmarks_per_label=16)
    assert model.labels == ["de", "en", "fr"]
    tests = corpus(90, 1) + [(500, None, "x"), (501, "", "x"), (502, "12 34 ?!", "x"), (503, "the " * 200_000, "en"), (None, "der die das und", "de"), (504, "the of and", "en"), (504, "the of and", "en")]
    docs = spark.createDataFrame(tests, "doc_id long, text string, lang_pred string")
    got = langid.predict(docs.withColumnRenamed("lang_pred", "lang"), model).collect()
    assert len(got) == len(tests)
    for r in got:
        if r["lang"] == "x":
            assert (r["lang_pred"], r["lang_score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] == r["lang"] and 0 < r["lang_score"] <= 1
    assert langid.predict(docs, model).columns == ["doc_id", "text", "lang_pred", "lang_score"]


def test_texts_like_none_that_were_learnt_are_rejected_on_request(spark):
    model = langid.fit(spark.createDataFrame(corpus(240, 0), "doc_id long, text string, lang string"), per_label=60)
    assert model.floor > 0
    rows = [*corpus(60, 1), (900, "Ελληνικά είναι μια γλώσσα", "x"), (901, "Русский язык это один из языков", "x"), (902, "中文是一种语言", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict(docs, model, reject=True).collect()
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {900, 901, 902}
    assert not [r for r in langid.predict(docs, model).collect() if r["lang_pred"] == "und"]


def test_no_labels_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.fit(none)
    assert model.labels == [] and langid.predict(none, model).count() == 0
    assert langid.predict(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), model).first()["lang_pred"] == "und"


def test_presence_is_that_of_all_ngrams_in_pieces(monkeypatch):
    text = "Où est la bibliothèque ? " * 40 + "Das ist ein Test, nicht wahr?"
    whole, cut = np.zeros(langid.BITS, np.uint8), np.zeros(langid.BITS, np.uint8)
    langid.spectrum(text, whole)
    monkeypatch.setattr(langid, "PIECE", 17)
    langid.spectrum(text, cut)
    assert not (whole & ~cut & 1).any()  # pieces miss nothing
    assert (cut & ~whole & 1).sum() <= 4


def test_collapsed_product_equals_kernel_regression():
    """P (L' W) is what the kernel columns P L' times W give."""
    rng = np.random.default_rng(0)
    p, marks, w = rng.integers(0, 2, (5, 64)).astype(float), rng.random((7, 64)), rng.random((7, 3))
    assert np.allclose((p @ marks.T) @ w, p @ (marks.T @ w))
