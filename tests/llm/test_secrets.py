from __future__ import annotations

import hashlib
import random
import re

from trajlake.llm import secrets as S

PATTERNS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", "AKIA[A-Z0-9]+"),
    ("hex", "[0-9a-f]+"),
]


def base(text: str | None) -> list[str]:
    out = []
    for k, (name, p) in enumerate(PATTERNS):
        for m in re.finditer(p, text or "", re.ASCII):
            if (len(m[2]) >= 6) if k == 0 else len(m[0]) >= (20 if k == 1 else 24):
                out.append((m.start(), k, f"{name}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_base_spans_agree_with_a_plain_scan(spark):
    rng = random.Random(4)
    parts = ["password = ", "TOKEN:'", "api_key=", "apikey = \"", "secret:abc ", "AKIA" + "B7" * 9, "AKIASHORT", "0f" * 14, "dead", "é", "\n", "passwd=secret=abcdef", "token: token: abcdefgh", "x" * 9, " ", "Aa1" * 8, "𝄞", "=", "ſecret=abcdefgh"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 14))) for _ in range(150)] + [None, "", "password=abcdef" * 30]
    rows = [(i, t, f"s{i % 4}", 1) for i, t in enumerate(texts)]
    got = S.secrets(spark.createDataFrame(rows, "doc_id long, text string, source string, kind int")).orderBy("doc_id").collect()
    assert len(got) == len(rows)
    for r, t in zip(got, texts, strict=True):
        want = base(t)
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x.startswith(n) for x in want) for n in ("assign", "access", "hex")]
        assert set(want) <= set(r["spans"].split(","))  | ({""} if not want else set())


def test_ownership_decides_what_is_added(spark):
    live, example = "Zx9" * 9, "Ex4" * 9
    rows = [(1, f"key {live} here", "a"), (2, f"again {live}", "a")] + [(10 + i, f"see {example}", f"s{i}") for i in range(4)] + [(30, f"token={live}", None), (31, f"no owner {'Qq7' * 8}", None), (32, f"no owner {'Qq7' * 8}", None)]
    got = {r["doc_id"]: r for r in S.secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[1]["spans"] == "token:4:31" and got[2]["spans"] == "token:6:33"
    assert all(got[10 + i]["spans"] == "" for i in range(4))
    assert got[30]["spans"] == "assign:0:33" and got[30]["n_owned"] == 1
    assert got[31]["spans"] == "token:9:33"


def test_empty_table_and_repeated_rows(spark):
    schema = "doc_id long, text string, source string"
    assert S.secrets(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "password=abcdefg", "a")] * 2 + [(1, "secret: qwertyu", "b"), (None, "token=zxcvbnm", None)]
    got = sorted((r["doc_id"] or 0, r["spans"]) for r in S.secrets(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, "assign:0:13"), (1, "assign:0:15"), (1, "assign:0:16"), (1, "assign:0:16")]


def test_no_python_in_the_plan(spark):
    plan = S.secrets(spark.createDataFrame([(1, "password=abcdefg", "a")], "doc_id long, text string, source string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
