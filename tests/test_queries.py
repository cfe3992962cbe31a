"""Every query of the library against DuckDB on the smallest tables, where it has SQL; the others must give rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from trajlake.plans import load_all
from trajlake.plans.catalog import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")
load_all()


def _norm(rows: list[tuple]) -> list[tuple]:
    clean = lambda v: None if v is None or v != v else float(v) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted((tuple(clean(v) for v in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.skipif(not SF.exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, str(SF))
    columns = sorted(got.columns)
    rows = [tuple(r) for r in got.select(*(f"`{c}`" for c in columns)).collect()]
    if name not in ORACLES:
        assert rows
        return
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    assert _norm(rows) == _norm(want.select(", ".join(f'"{c}"' for c in columns)).fetchall())
