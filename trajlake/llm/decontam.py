"""Benchmark decontamination by edit distance: pigeonhole pieces, exact piece hits, and Myers' bit-parallel distance.

Texts and items are lower-cased and their white space becomes single spaces. An item of n characters may be changed in
k = floor(n * rate) places (characters put in, left out or replaced). Cut into k + 1 pieces, at least one piece stays
whole, so an automaton over all pieces finds every candidate place; there Myers' algorithm gives the least distance of the
item to any part of the text. Whole texts are searched, in no pieces.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.common import folder, fresh_folder, lean, publish, rows_of
from trajlake.llm.tokens import slices

RATE = 0.08
#: Characters of benchmark items that one automaton holds, and that the driver sends at once; a larger benchmark is matched in blocks.
BLOCK_CHARS = 2_000_000
FOUND = "doc_id long, item_id long, distance int, match_end long"


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, rate: float) -> tuple[int, list[tuple[int, str]]]:
    """The error budget, and budget + 1 pieces (offset, text) whose lengths differ by one at most."""
    k = min(int(len(item) * rate), len(item) - 1)
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return k, [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def least_distance(peq: dict[str, int], m: int, text: str, start: int, end: int, most: int) -> tuple[int, int]:
    """The least edit distance of the pattern to any part of text[start:end], and where that part ends (the first such place); -1 beyond ``most``."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    best, at = (m, start) if m <= most else (most + 1, -1)
    get = peq.get
    for i in range(start, end):
        x = get(text[i], 0) | vn
        d = ((vp + (x & vp)) ^ vp) | x
        hp = vn | ~(d | vp)
        hn = d & vp
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp <<= 1  # a match may begin anywhere, so no 1 comes in
        vp = ((hn << 1) | ~(d | hp)) & full
        vn = d & hp & full
        if score < best:
            best, at = score, i + 1
    return best, at


class Matcher:
    """Finds items in normal texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float) -> None:
        import ahocorasick

        self.items, self.automaton = [], ahocorasick.Automaton()
        at: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            if text:
                k, own = pieces(text, rate)
                for offset, piece in own:
                    at.setdefault(piece, []).append((len(self.items), offset))
                self.items.append((item_id, text, k, masks(text)))
        for piece, where in at.items():
            self.automaton.add_word(piece, (len(piece), where))
        if at:
            self.automaton.make_automaton()
        self.empty = not at

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, least distance, end) of all items within their budgets."""
        if self.empty or not text:
            return []
        windows: dict[int, list[list[int]]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for item, offset in where:
                _, pattern, k, _ = self.items[item]
                begin = end + 1 - size - offset
                a, b = max(0, begin - k), min(len(text), begin + len(pattern) + k)
                own = windows.setdefault(item, [])
                if own and a <= own[-1][1] and own[-1][0] <= b:
                    own[-1][0], own[-1][1] = min(own[-1][0], a), max(own[-1][1], b)
                else:
                    own.append([a, b])
        out = []
        for item, own in windows.items():
            item_id, pattern, k, peq = self.items[item]
            best, at = min((least_distance(peq, len(pattern), text, a, b, k) for a, b in own), key=lambda x: x[0])
            if best <= k:
                out.append((item_id, best, at))
        return out


def _blocks(items: DataFrame, item_key: str, item_text: str, block_chars: int) -> list[str]:
    """The normal items in files of the shared folder, of at most ``block_chars`` characters each (a longer item is a file); the driver holds one at a time."""
    spark = items.sparkSession
    to, names, own, size = fresh_folder(spark, "items"), [], [], 0
    rows = items.select(F.col(item_key).cast("long").alias("i"), F.col(item_text).alias("x")).where(F.col(item_text).isNotNull())

    def close() -> None:
        names.append(publish(to, f"block-{len(names):05d}", json.dumps(own).encode()))

    for r in rows.toLocalIterator():
        text = normal(r["x"])
        if own and size + len(text) > block_chars:
            close()
            own, size = [], 0
        own.append((r["i"], text))
        size += len(text)
    if own:
        close()
    return names


def _matcher(path: str, rate: float) -> Matcher:
    store, name = folder(path)
    with store.open_input_stream(name) as f:
        return Matcher([(i, t) for i, t in json.loads(f.read())], rate)


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, match_end (in the normal text): each item that a text has within its error budget, and the least distance.

    Null and empty texts and items match nothing; repeated rows match each. The items go to the shared folder in blocks of at
    most ``block_chars`` characters (a longer item is a block), each block is matched in its own scan of the texts.
    """
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    out = None
    for path in _blocks(items, item_key, item_text, block_chars) or [None]:
        found = rows.mapInArrow(lean(_scan(path, rate)), FOUND)
        out = found if out is None else out.unionByName(found)
    return out


def _scan(path: str | None, rate: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path is None:
            return
        matcher = _matcher(path, rate)
        for batch in batches:
            rows = [(k, *f) for k, t in rows_of(batch, ["k", "t"]) for f in matcher.find(normal(t))]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "distance", "match_end"])

    return scan


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows whose text has no item within its error budget, with all their columns.

    Each row is judged by its own text, whatever its key; null and empty texts stay. One pass, in which blocks of items follow one another.
    """

    def sieve(path: str):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(path, rate)
            for batch in batches:
                good = [not matcher.find(normal(t)) for part in slices(batch, text) for t in part.column(text).to_pylist()]
                yield batch.filter(pa.array(good, pa.bool_()))

        return keep

    out = docs
    for path in _blocks(items, item_key, item_text, block_chars):
        out = out.mapInArrow(lean(sieve(path)), out.schema)
    return out
