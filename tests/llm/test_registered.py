"""The registered queries themselves: names and types of the contracts, the SQL where there is one, and plain versions where there is none."""

from __future__ import annotations

import zlib
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

from trajlake.llm import decontam, mixing
from trajlake.llm.queries import ORACLES, QUERIES, tokenizer_path

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")

CONTRACT = {
    "op1_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op2_nearest_vectors": "query_id bigint, rank int, vec_id bigint, score double",
    "op3_warc_bundles": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op4_near_duplicates": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op6_repeated_bytes": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op7_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op8_token_ids": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op10_source_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
}


def read(name: str) -> pd.DataFrame:
    return duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'").df()


@pytest.fixture(scope="module")
def got(spark):
    held: dict[str, pd.DataFrame] = {}

    def run(name: str) -> pd.DataFrame:
        if name not in held:
            out = QUERIES[name](spark, str(SF))
            if name in CONTRACT:
                want = [c.split(" ") for c in CONTRACT[name].split(", ")]
                assert [[f.name, f.dataType.simpleString()] for f in out.schema][: len(want)] == want
            held[name] = out.toPandas()
        return held[name]

    return run


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(got, name):
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got(name).columns) == columns
    rows = lambda d: sorted((tuple(None if pd.isna(v) else v for v in r) for r in d[columns].itertuples(index=False)), key=repr)
    norm = lambda rs: [tuple(float(v) if isinstance(v, (int, float, np.number)) and not isinstance(v, (bool, np.bool_)) else v if isinstance(v, str) or v is None else bool(v) for v in r) for r in rs]
    assert sorted(norm(rows(got(name))), key=repr) == sorted(norm(rows(want)), key=repr)


def test_language_of_held_out_documents(got):
    d = read("documents").merge(got("op1_language_id"), on="doc_id")
    assert len(d) == len(read("documents"))
    assert (d.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in d.doc_id]).all()
    letters = np.array([t is not None and any(c.isalpha() for c in t) for t in d.text])
    assert ((d.lang_pred == "und") == ~letters).all() and d.score.between(0, 1).all()
    asked = d[d.held_out & letters & d.lang.notna()]
    assert (asked.lang_pred == asked.lang).mean() > 0.95


def test_nearest_vectors_against_all_products(got):
    e = read("embeddings")
    x = np.stack([np.asarray(v, float) for v in e.embedding])
    ids, hits = e.vec_id.to_numpy(), 0
    found = {k: v for k, v in got("op2_nearest_vectors").sort_values(["query_id", "rank"]).groupby("query_id")}
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    for q, rows in found.items():
        n = int(np.flatnonzero(ids == q)[0])
        s = x @ x[n]
        best = [i for i in np.lexsort((ids, -s)) if i != n][:20]
        assert rows["rank"].tolist() == list(range(1, 21)) and np.allclose(rows.score, s[[int(np.flatnonzero(ids == v)[0]) for v in rows.vec_id]], rtol=1e-12)
        hits += len(set(rows.vec_id) & set(ids[best].tolist()))
    assert hits >= 0.95 * 20 * len(found)


def test_leaks_against_plain_edit_distance(got):
    """Items that a text has as a whole, and no others that a plain search of each piece finds within the budget."""
    docs, items = read("documents"), read("benchmark")
    found = {(r.doc_id, r.item_id): r.distance for r in got("op5_benchmark_leaks").itertuples()}
    normal = [(i, decontam.normal(t)) for i, t in zip(items.item_id, items.text, strict=True)]
    for d, text in zip(docs.doc_id, docs.text, strict=True):
        t = decontam.normal(text)
        for i, x in normal:
            if x and x in t:
                assert found[d, i] == 0
            elif (d, i) in found:
                k = int(len(x) * decontam.RATE)
                assert 0 < found[d, i] <= k and any(p in t for _, p in decontam.pieces(x, decontam.RATE)[1])


def test_token_ids_against_the_library(got):
    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(tokenizer_path()), 0
    found = got("op8_token_ids").set_index("doc_id")
    docs = read("documents").sort_values("doc_id")
    for i, e in zip(docs.doc_id, library.encode_batch([t or "" for t in docs.text], add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 2], "<u4")
        assert tuple(found.loc[i, ["start", "n_tokens", "ids_crc32"]]) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)
    lengths = got("op9_token_counts").sort_values("length")
    n = np.bincount(found.n_tokens - 1)
    assert lengths.set_index("length").n_docs.to_dict() == {i: c for i, c in enumerate(n) if c}


def test_the_mix_comes_near_its_targets(got):
    docs, m = read("documents"), got("op10_source_mix")
    d = docs.merge(m, on="doc_id")
    words = d.text.fillna("").str.count(mixing.WORD)
    assert len(d) == len(docs) and (d["size"] == words).all() and (d.taken <= 3 * d["size"]).all() and (d.taken >= 0).all()
    names = sorted(d.source.unique(), key=lambda s: (s is None or s != s, s or ""))
    sizes = [int(d["size"][d.source == s].sum()) for s in names]
    for s, n, t in zip(names, sizes, mixing.targets(sizes, [1 + i % 3 for i in range(len(names))], sum(sizes)), strict=True):
        own = d[d.source == s]
        assert (own.source_size == n).all() and np.allclose(own.target, float(t)) and abs(own.taken.sum() - t) <= max(3, 0.02 * t)


def test_the_pipeline_returns_its_last_stage(got):
    out = got("pipeline")
    assert list(out.columns) == ["doc_id", "start", "n_tokens", "ids_crc32"] and len(out) > 50
    by = out.sort_values("start")
    assert (by.start.to_numpy()[1:] == (by.start + by.n_tokens).to_numpy()[:-1]).all() and (np.diff(by.doc_id) >= 0).all()
