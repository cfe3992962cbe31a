"""Repeated byte strings: a logarithmic family of sparse suffix arrays, fed in batches, finds every string of ``length`` bytes that
starts at more than one place of the corpus; all bytes that such strings cover are removed.

Places to index are chosen by content. Of the ``length - GRAM + 1`` grams in a window of ``length`` bytes, the one with the least hash (the
leftmost of equals) is the window's anchor, so equal windows have their anchors at equal offsets, and each anchor stands for a run of
windows, whose bytes are its segment. A segment that the corpus has twice (same gram, same place in it, same bytes by a 64-bit fingerprint besides the
gram's) is repeated in all its windows; exact copies, however many, come down to one segment each. Segments of a gram that has several different ones
are dealt to tasks by gram, and a task keeps them in a family of suffix arrays:

* a new batch gets its suffix array: the order of the bytes from the anchors on, with the common-prefix lengths of neighbours;
* a merge scan against itself and each existing level meets suffixes with a common gram. With R bytes in common from the anchors on (the least
  common-prefix length between the two) and L bytes before them, the windows that begin length - R to L bytes before the anchor are the same;
* levels whose sizes have come equal (within a factor of two) merge into one, so an anchor is merged log(n) times.

All that a task compares are symbols: bytes of texts, or words of them as 32-bit hashes, for passages that stand in several documents. A gram with more than ``HOT`` different segments is more than a task should hold: the fingerprints of its
windows (64 bits besides the gram's) are counted by partial sums over the cluster, blocks of windows first, which gives the same windows.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.common import U64, fan_out, key_filter, lean, mix64, rows_of, small_batches, split_by, stage
from trajlake.llm.shingles import word_hashes

LENGTH, GRAM = 400, 64
#: Words in a row that make a passage, and words of a gram of it.
WORDS, WORD_GRAM = 51, 8
#: Different segments of one gram beyond which their windows are counted over the cluster; segments of a task's share, about; of a batch.
HOT, SHARE, BATCH = 1024, 20_000, 8_192
#: Pairs whose bytes are compared at once.
PAIRS = 1 << 14
#: Bytes of a text whose anchors are found at once.
PIECE = 1 << 19
_P, _Q = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_TABLES: dict = {}


def _power(base: int, n: int) -> np.ndarray:
    got = _TABLES.get(base)
    if got is None or len(got) < n:
        steps = np.full(max(n, 1 << 16), base, U64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            got = _TABLES[base] = np.multiply.accumulate(steps)
    return got


def _values(data: np.ndarray) -> np.ndarray:
    """A 64-bit value for each symbol."""
    if data.dtype != np.uint8:
        return mix64(data.astype(U64) + U64(1))
    if "bytes" not in _TABLES:
        _TABLES["bytes"] = np.random.default_rng(9).integers(1, 1 << 63, 256).astype(U64)
    return _TABLES["bytes"][data]


def fingerprints(data: np.ndarray, width: int, base: int = _P) -> np.ndarray:
    """A 64-bit fingerprint of each string of ``width`` symbols, by prefix sums of a polynomial."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    p, q = _power(base, len(data)), _power(pow(base, -1, 1 << 64), len(data))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_values(data) * p[: len(data)], out=sums[1:])
        return mix64((sums[width:] - sums[:n]) * q[:n])


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """key, place, first and last window of each run of windows that share an anchor; a run may be cut where a piece ends."""
    parts = []
    for at in range(0, max(0, len(data) - length + 1), PIECE):
        own = data[at : at + PIECE + length - 1]
        h = fingerprints(own, gram)
        v = (h & ~U64((1 << 20) - 1)) | np.arange(len(h), dtype=U64)
        span = length - gram + 1
        size = 1
        while size * 2 <= span:  # minima over 2, 4, ... grams
            v = np.minimum(v[:-size], v[size:])
            size *= 2
        v = np.minimum(v[: len(v) - (span - size)], v[span - size :]) if span > size else v
        place = (v & U64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        parts.append((h[place[first]].view(np.int64), place[first] + at, first + at, last + at))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def segment_prints(data: np.ndarray, first: np.ndarray, end: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of data[first:end] and the anchor's place in it, by the prefix sums of ``fingerprints``."""
    p, q = _power(_P, len(data)), _power(pow(_P, -1, 1 << 64), len(data))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_values(data) * p[: len(data)], out=sums[1:])
        h = mix64((sums[end] - sums[first]) * q[first])
        return mix64(h + (end - first).astype(U64) * U64(_Q) + (shift.astype(U64) << U64(20))).view(np.int64)


def _common(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes the rows of two tables have in common from the start, at most ``most``."""
    out = np.empty(len(x), np.int64)
    for at in range(0, len(x), PAIRS):
        own = slice(at, at + PAIRS)
        differ = x[own] != y[own]
        out[own] = np.where(differ.any(1), differ.argmax(1), x.shape[1])
    return np.minimum(out, most)


class Level:
    """A suffix array: anchors in the order of their suffixes, as byte tables right (from the anchor on) and left (backwards from it), and what is known to be
    repeated: found[i, d] is the window that begins d bytes before anchor i."""

    NAMES = ("right", "size", "left", "shift", "low", "found", "row", "doc")

    def __init__(self, right: np.ndarray, size: np.ndarray, left: np.ndarray, shift: np.ndarray, low: np.ndarray, found: np.ndarray, row: np.ndarray, doc: np.ndarray) -> None:
        self.right, self.size, self.left, self.shift, self.low, self.found, self.row, self.doc = right, size, left, shift, low, found, row, doc
        self.keys = np.ascontiguousarray(right).view(f"S{right.shape[1] * right.itemsize}").ravel()

    @classmethod
    def of(cls, segments: list[np.ndarray], shift: np.ndarray, row: np.ndarray, doc: np.ndarray, length: int, gram: int) -> Level:
        reach, kind = length - gram + 1, segments[0].dtype if segments else np.uint8
        right, left = np.zeros((len(segments), length), kind), np.zeros((len(segments), reach), kind)
        for i, (s, d) in enumerate(zip(segments, shift.tolist(), strict=True)):
            own = s[d : d + length]
            right[i, : len(own)] = own
            own = s[max(0, d - reach) : d][::-1]
            left[i, : len(own)] = own
        size = np.array([len(s) for s in segments], np.int64) - shift
        order = np.argsort(right.view(f"S{length * right.itemsize}").ravel(), kind="stable")
        # The last window of a segment begins ``low`` symbols before the anchor.
        return cls(right[order], np.minimum(size, length)[order], left[order], shift[order], (length - size)[order], np.zeros((len(order), reach), bool), row[order], doc[order])

    def __len__(self) -> int:
        return len(self.row)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **{n: getattr(self, n) for n in self.NAMES})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Level:
        with np.load(io.BytesIO(data)) as own:
            return cls(*(own[n] for n in cls.NAMES))


def merge(a: Level, b: Level) -> tuple[Level, np.ndarray]:
    """The suffix array of two, by a merge of the two orders, and which anchors come from the second."""
    place = np.searchsorted(a.keys, b.keys, "right") + np.arange(len(b))
    second = np.zeros(len(a) + len(b), bool)
    second[place] = True
    parts = []
    for n in Level.NAMES:
        x, y = getattr(a, n), getattr(b, n)
        both = np.empty((len(second), *x.shape[1:]), x.dtype)
        both[~second], both[second] = x, y
        parts.append(both)
    return Level(*parts), second


def scan(level: Level, length: int, gram: int, second: np.ndarray | None = None, across: bool = False) -> None:
    """Marks the windows that two different anchors of the level share; with ``second``, only pairs of one anchor from each part are compared, with
    ``across``, only those of two documents (-1: of several).

    Suffixes that are k places apart in the array have the least of the k common-prefix lengths between them in common, so R for all
    pairs of a gram comes from those of neighbours; L is compared byte by byte.
    """
    n = len(level)
    if n < 2:
        return
    near = _common(level.right[1:], level.right[:-1], np.minimum(level.size[1:], level.size[:-1]))
    i = np.flatnonzero(near >= gram)
    common, k = near[i], 1
    marks = np.zeros((n, level.found.shape[1] + 1), np.int32)
    while len(i):
        j = i + k
        ask = np.arange(len(i)) if second is None else np.flatnonzero(second[i] != second[j])
        if len(ask):
            x, y, r = i[ask], j[ask], common[ask]
            # A pair with too few bytes on both sides has no window in common.
            fit = r + np.minimum(level.shift[x], level.shift[y]) >= length
            if across:
                fit &= (level.doc[x] != level.doc[y]) | (level.doc[x] == -1)
            x, y, r = x[fit], y[fit], r[fit]
            back = _common_rows(level.left, x, y, np.minimum(level.shift[x], level.shift[y]))
            for own in (x, y):
                lo, hi = np.maximum(length - r, level.low[own]), np.minimum(back, level.shift[own])
                good = lo <= hi
                np.add.at(marks, (own[good], np.maximum(lo[good], 0)), 1)
                np.add.at(marks, (own[good], hi[good] + 1), -1)
        k += 1
        go = np.flatnonzero(i + k < n)
        i, common = i[go], common[go]
        common = np.minimum(common, near[i + k - 1])
        go = common >= gram
        i, common = i[go], common[go]
    level.found |= np.cumsum(marks, 1)[:, :-1] > 0


def _common_rows(table: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for at in range(0, len(x), PAIRS):
        own = slice(at, at + PAIRS)
        out[own] = _common(table[x[own]], table[y[own]], most[own])
    return out


class Family:
    """The logarithmic family: levels of falling size, at most one of each power of two."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM, across: bool = False) -> None:
        self.length, self.gram, self.across, self.levels = length, gram, across, []

    def add(self, segments: list[bytes], shift: np.ndarray, row: np.ndarray, doc: np.ndarray | None = None, kind: type = np.uint8) -> None:
        """A batch of anchors: a segment has all windows of an anchor's run, and the anchor's gram begins ``shift`` symbols into it."""
        own = np.arange(len(segments)) if doc is None else np.asarray(doc, np.int64)
        new = Level.of([np.frombuffer(s, kind) for s in segments], np.asarray(shift, np.int64), np.asarray(row, np.int64), own, self.length, self.gram)
        scan(new, self.length, self.gram, None, self.across)
        for k, level in enumerate(self.levels):
            both, second = merge(level, new)
            scan(both, self.length, self.gram, second, self.across)
            level.found, new.found = both.found[~second], both.found[second]
            self.levels[k] = level
        self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(merge(a, b)[0])

    def result(self) -> Iterator[tuple[int, np.ndarray]]:
        """The number of each anchor's row and its windows that are repeated, from the first of its segment on."""
        for level in self.levels:
            for row, low, shift, found in zip(level.row.tolist(), level.low.tolist(), level.shift.tolist(), level.found, strict=True):
                yield row, found[max(low, 0) : shift + 1][::-1]

    def save(self) -> list[bytes]:
        return [level.to_bytes() for level in self.levels]

    @classmethod
    def load(cls, levels: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Family:
        own = cls(length, gram)
        own.levels = [Level.from_bytes(x) for x in levels]
        return own


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).view(np.int8)))
    return edge[::2], edge[1::2] - 1


def _found_anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, list[list[int]], np.ndarray, np.ndarray]:
    """key, seg, firsts, windows - 1, shift of a text's different segments: equal ones of one text are one, with all their places."""
    key, place, first, last = anchors(data, length, gram)
    seg = segment_prints(data, first, last + length, place - first)
    order = np.lexsort((first, seg, key))
    key, seg, first, last, place = (x[order] for x in (key, seg, first, last, place))
    new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (seg[1:] != seg[:-1]))[: len(key)])
    firsts = [x.tolist() for x in np.split(first, new[1:])] if len(key) else []
    return key[new], seg[new], firsts, (last - first)[new], (place - first)[new]


def utf8(text: str) -> np.ndarray:
    """A text's bytes as symbols."""
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def words_of(text: str) -> np.ndarray:
    """A text's words as symbols of 32 bits."""
    return (word_hashes(text) >> U64(32)).astype(np.uint32)


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, symbols: Callable[[str], np.ndarray] = utf8, across: bool = False) -> tuple[DataFrame, DataFrame]:
    """``_windows``, whose tables are written with small batches."""
    with small_batches(docs.sparkSession):
        return _windows(docs, length, gram, hot, symbols, across)


def _windows(docs: DataFrame, length: int, gram: int, hot: int, symbols: Callable[[str], np.ndarray], across: bool) -> tuple[DataFrame, DataFrame]:
    """From (rid, text), where rid stands for a row and its text: the texts that have an anchor in common with any, and (rid, first, last): runs of
    windows, by their first symbols, that are repeated; with ``across``, in another row."""
    kind = symbols("a").dtype

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [], [], [], [], [])
            for r, t in rows_of(batch, ["rid", "text"]):
                key, seg, firsts, more, shift = _found_anchors(symbols(t), length, gram)
                for column, x in zip(out, (key, seg, np.full(len(key), r), firsts, more, shift), strict=True):
                    column.append(x)
            if out[0]:
                flat = [x for own in out[3] for x in own]
                columns = [pa.array(np.concatenate(x).astype(k)) for x, k in zip((*out[:3], *out[4:]), (np.int64,) * 3 + (np.int32,) * 2, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns[:3], pa.array(flat, pa.list_(pa.int32())), *columns[3:]], ["key", "seg", "rid", "firsts", "more", "shift"])

    long = docs.where(F.octet_length("text") >= length)
    all_ = stage(long.mapInArrow(lean(find), "key long, seg long, rid long, firsts array<int>, more int, shift int"), "anchors")
    # Each row has a segment once, with all its places, so a second row means another document.
    known = (F.count(F.lit(1)) if across else F.sum(F.size("firsts"))) > 1
    segs = stage(all_.groupBy("key", "seg").agg(known.alias("known"), F.min(F.struct("rid", "firsts", "more", "shift")).alias("at")), "segments")
    keys = segs.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key", (F.col("m") > hot).alias("hot"))
    copied = all_.join(segs.where("known").select("key", "seg"), ["key", "seg"]).select("rid", F.explode("firsts").alias("first"), "more")
    copied = stage(copied.select("rid", "first", (F.col("first") + F.col("more")).alias("last")), "copied")
    several = stage(segs.join(keys, "key").select("at.rid", "key", "hot", "known", "at.firsts", "at.more", "at.shift"), "several")
    asked = stage(copied.select("rid").union(several.select("rid")).distinct(), "asked")
    some, _ = split_by(long, "rid", key_filter(asked, "rid"))
    texts = stage(some.join(asked, "rid", "left_semi").dropDuplicates(["rid"]), "texts")
    cuts = several.groupBy("rid").agg(F.collect_list(F.struct("key", "hot", "known", "firsts", "more", "shift")).alias("cuts"))
    marked = texts.join(cuts, "rid")

    def cold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, t, own in rows_of(batch, ["rid", "text", "cuts"], 32):
                own = [c for c in own if not c["hot"]]
                if own:
                    data = symbols(t)
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array([c["key"] for c in own], pa.int64()), "rid": pa.array([r] * len(own), pa.int64()), "known": pa.array([c["known"] for c in own], pa.bool_()),
                        "firsts": pa.array([c["firsts"] for c in own], pa.list_(pa.int32())), "shift": pa.array([c["shift"] for c in own], pa.int32()),
                        "segment": pa.array([data[c["firsts"][0] : c["firsts"][0] + c["more"] + length].tobytes() for c in own], pa.binary())})

    def family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, rid, firsts, known = Family(length, gram, across), [], [], []
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                own, doc = batch.column("known").to_pylist(), batch.column("rid").to_numpy()
                levels.add(batch.column("segment").to_pylist(), batch.column("shift").to_numpy(), np.arange(len(rid), len(rid) + len(own)), np.where(own, -1, doc) if across else None, kind)
                rid += doc.tolist()
                firsts += batch.column("firsts").to_pylist()
                known += own
        rows: tuple[list, list, list] = ([], [], [])
        for row, hit in levels.result():
            if not known[row] and hit.any():  # of a segment that the corpus has more often all windows are known
                for a, b in zip(*_runs(hit), strict=True):
                    for first in firsts[row]:
                        for column, x in zip(rows, (rid[row], first + a, first + b), strict=True):
                            column.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(c, k)) for c, k in zip(rows, (np.int64, np.int32, np.int32), strict=True)], ["rid", "first", "last"])

    few = stage(marked.mapInArrow(lean(cold), "key long, rid long, known boolean, firsts array<int>, shift int, segment binary"), "cold")
    parts = max(fan_out(docs.sparkSession), -(-few.count() // SHARE))
    met = few.repartition(parts, "key").mapInArrow(lean(family), "rid long, first int, last int")
    return texts, copied.unionByName(met).unionByName(_hot_windows(texts, several.where("hot"), length, gram, symbols, across))


def _hot_windows(texts: DataFrame, several: DataFrame, length: int, gram: int, symbols: Callable[[str], np.ndarray], across: bool) -> DataFrame:
    """rid, first, last: repeated windows of grams with too many different segments for a task, by fingerprints that are counted over the cluster.

    The windows of a segment go in blocks by their offset to the anchor. A block whose whole string is repeated has all its windows repeated; one whose core,
    which all windows of the block hold, no other whole string has, has none. Single windows are counted only for what is left: where a passage begins or ends,
    a block for each segment.
    """
    side = max(2, int(np.sqrt(length - gram + 1)))
    lists = several.groupBy("rid").agg(F.collect_list(F.struct("key", "known", "firsts", "more", "shift")).alias("cuts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, t, own in rows_of(batch, ["rid", "text", "cuts"], 32):
                data, rows = symbols(t), []
                for c in own:
                    # Offsets of the run's windows to the anchor, in blocks.
                    low, high = c["shift"] - c["more"], c["shift"]
                    for first in c["firsts"]:
                        a = first + c["shift"]
                        for b in range(low // side, high // side + 1):
                            d0, d1 = max(b * side, low), min(b * side + side - 1, high)
                            rows.append((c["key"], c["known"], a - d1, a - d0, d1, a - b * side, a - (b * side + side - 1) + length, b))
                key, known, w0, w1, d1, begin, end, block = (np.array(x) for x in zip(*rows, strict=True))
                union = segment_prints(data, w0, w1 + length, d1)
                core = segment_prints(data, begin, end, block)
                names = ["key", "rid", "known", "first", "last", "union", "core"]
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array([r] * len(key), pa.int64()), pa.array(known, pa.bool_()), pa.array(w0.astype(np.int32)), pa.array(w1.astype(np.int32)), pa.array(union), pa.array(core)], names)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, t, own in rows_of(batch, ["rid", "text", "cuts"], 32):
                data = symbols(t)
                at = np.concatenate([np.arange(c["first"], c["last"] + 1) for c in own])
                of = np.repeat(np.arange(len(own)), [c["last"] - c["first"] + 1 for c in own])
                f = segment_prints(data, at, at + length, np.zeros(len(at), np.int64))
                key, known = np.array([c["key"] for c in own], np.int64)[of], np.array([c["known"] for c in own], bool)[of]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array([r] * len(at), pa.int64()), pa.array(at.astype(np.int32)), pa.array(f), pa.array(known)], ["key", "rid", "at", "f", "known"])

    twice = F.max("known") | ((F.min("rid") != F.max("rid")) if across else (F.count(F.lit(1)) > 1))
    blocks = stage(texts.join(lists, "rid").mapInArrow(lean(cut), "key long, rid long, known boolean, first int, last int, union long, core long"), "blocks")
    unions = stage(blocks.groupBy("key", "core", "union").agg(twice.alias("done"), F.min(F.struct("rid", "first", "last")).alias("at")), "unions")
    done = stage(blocks.join(unions.where("done").select("key", "union"), ["key", "union"]).select("rid", "first", "last"), "done")
    open_ = stage(unions.groupBy("key", "core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "core"), "open")
    one = unions.where("done").join(open_, ["key", "core"]).select("key", "at.rid", "at.first", "at.last", F.lit(True).alias("known"))
    rest = blocks.join(unions.where("not done").select("key", "union"), ["key", "union"]).join(open_, ["key", "core"]).select("key", "rid", "first", "last", F.lit(False).alias("known"))
    again = one.unionByName(rest).groupBy("rid").agg(F.collect_list(F.struct("key", "first", "last", "known")).alias("cuts"))
    single = stage(texts.join(again, "rid").mapInArrow(lean(windows), "key long, rid long, at int, f long, known boolean"), "windows")
    hit = single.groupBy("key", "f").agg(twice.alias("twice")).where("twice").select("key", "f")
    # A table of its own, so that the join on fingerprints stands alone in its stage and AQE can split what is skewed.
    hits = stage(single.join(hit, ["key", "f"]).select("rid", F.col("at").alias("first"), F.col("at").alias("last")), "hits")
    return done.unionByName(hits)


def _merged(runs: DataFrame, length: int) -> DataFrame:
    """rid, begin, end: the bytes that runs of windows cover, as maximal spans in order; a task holds a batch of runs."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int, int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rid, begin = batch.column("rid").to_numpy(), batch.column("first").to_numpy().astype(np.int64)
            end = batch.column("last").to_numpy().astype(np.int64) + length
            if held is not None:
                rid, begin, end = np.append(held[0], rid), np.append(held[1], begin), np.append(held[2], end)
            group = np.cumsum(np.append(0, rid[1:] != rid[:-1]))
            # The furthest end so far in each text; ends stay below 2^40.
            far = np.maximum.accumulate(end + (group << 40)) - (group << 40)
            new = np.append(True, (rid[1:] != rid[:-1]) | (begin[1:] > far[:-1]))
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(rid)) - 1
            spans = (rid[at], begin[at], far[last])
            held = tuple(int(x[-1]) for x in spans)
            yield pa.RecordBatch.from_arrays([pa.array(x[:-1]) for x in spans], ["rid", "begin", "end"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in held], ["rid", "begin", "end"])

    return runs.repartition("rid").sortWithinPartitions("rid", "first").mapInArrow(lean(join), "rid long, begin long, end long")


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, rid and text (null: empty); rid stands for key and text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(key).cast("long"), t).alias("rid"), t.alias("text"))


def repeated_spans(docs: DataFrame, key: str, text: str, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """The rows as (doc_id, rid, text), and the texts with repeats as (rid, text, spans): spans in the UTF-8 bytes, end exclusive."""
    rows = _rows(docs, key, text)
    texts, windows = repeated_windows(rows.select("rid", "text"), length, gram, hot)
    spans = _merged(windows, length).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    return rows, texts.join(spans, "rid")


def shared_passages(docs: DataFrame, key: str, text: str, words: int = WORDS, gram: int = WORD_GRAM, hot: int = HOT) -> DataFrame:
    """rid, n_passages: the maximal runs of words of a text that are covered by ``words`` words in a row which another row has too; texts without any have no row.

    Words are runs of other characters than white space, with A-Z in lower case, and are told apart by 32 bits each: a passage of many words by that many times as much.
    """
    _, windows = repeated_windows(_rows(docs, key, text).select("rid", "text"), words, gram, hot, words_of, True)
    return _merged(windows, words).groupBy("rid").agg(F.count(F.lit(1)).alias("n_passages"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages, one row for each input row.

    Texts are their UTF-8 bytes, null is empty. A byte goes if a string of ``length`` bytes that covers it starts anywhere else, in
    the same text too; strings are judged on the input. Rows that repeat a text repeat all its strings. What is left may
    cut a character in two. Nothing is removed for n_passages: it counts the passages of more than 50 words that another row has too, whatever their length in bytes.
    """
    rows, each = repeated_spans(docs, key, text, length, gram, hot)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for r, t, spans in rows_of(batch, ["rid", "text", "spans"], 32):
                data, digest, at = utf8(t).tobytes(), hashlib.sha256(), 0
                for s in spans:
                    digest.update(data[at : s["begin"]])
                    at = s["end"]
                digest.update(data[at:])
                for column, x in zip(out, (r, sum(s["end"] - s["begin"] for s in spans), len(spans), digest.hexdigest()), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["rid", "n_removed", "n_spans", "kept"])

    with small_batches(docs.sparkSession):
        done = stage(each.mapInArrow(lean(cut), "rid long, n_removed long, n_spans long, kept string"), "cut")
    narrow = rows.select("doc_id", "rid", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    passages = shared_passages(docs, key, text, hot=hot)
    both = narrow.join(done, "rid", "left").join(passages, "rid", "left")
    return both.select("doc_id", "n_bytes", zero("n_removed"), zero("n_spans"), F.coalesce("kept", "sha").alias("kept_sha256"), zero("n_passages"))
