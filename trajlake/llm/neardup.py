"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped candidate edges, exact links.

Texts with equal shingle sets are one class from the start. The classes' signatures are cut into bands; a bucket's members
get one edge each, to the bucket's smallest member, so a bucket of n makes n - 1 edges. The components of these edges are the
candidate clusters: any two classes that share a bucket are in one, so links are looked for inside clusters only, on the full
sets.

* A cluster of at most ``SMALL`` classes goes to one task, which counts all common shingles by matrix products.
* In a larger one stars go on: the member that shares buckets with most others is a hub, and all members are held against it; this is a row per member, and
  a skewed join that AQE can split. The next hub is one that no hub has taken, as long as hubs take a fair share of what is left.
* What is outside of the cluster's largest component then meets all of the cluster, in blocks of sets; a block returns a spanning forest of its
  links, never its pairs.

So every link between texts that share a bucket counts, whatever the size of its group. With 32 bands of 5 values, two texts
at the threshold share none with a probability of 3 in a million. Texts are fetched by a filter of fixed size, so that only rows
that may be wanted are shuffled; the plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.common import U64, key_filter, lean, rows_of, split_by, stage
from trajlake.llm.components import components
from trajlake.llm.shingles import OnePermutation, set_key, shingle_set

BANDS, ROWS = 32, 5
#: Classes of a cluster that one task compares; sets of a block.
SMALL, BLOCK = 128, 256
#: Hubs go on until ``LOW`` of them in a row have taken less than this share of the members left.
GAIN, LOW = 0.05, 2
#: Distinct shingles counted by one matrix product.
COLUMNS = 1 << 14


def common_counts(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of all sets with all (other) sets."""
    all_ = sets if others is None else [*sets, *others]
    n, m = len(sets), len(all_)
    flat = np.concatenate(all_) if m else np.zeros(0, U64)
    owner = np.repeat(np.arange(m), [len(s) for s in all_])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, bool)
    place = np.cumsum(new) - 1
    shared = np.bincount(place)[place] > 1 if len(flat) else new
    owner, place = owner[shared], np.cumsum(new[shared]) - 1
    out = np.zeros((n, m if others is None else m - n), np.float32)
    top = int(place[-1]) + 1 if len(place) else 0
    for at in range(0, top, COLUMNS):
        lo, hi = np.searchsorted(place, [at, at + COLUMNS])
        p = np.zeros((m, min(COLUMNS, top - at)), np.float32)
        p[owner[lo:hi], place[lo:hi] - at] = 1
        out += p[:n] @ (p if others is None else p[n:]).T
    return out.astype(np.int64)


def linked(common: np.ndarray, sizes: np.ndarray, other_sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether 100 * intersection >= percent * union, in whole numbers."""
    return 100 * common >= percent * (sizes[:, None] + other_sizes[None, :] - common)


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member, root) of the components of a symmetric matrix of links; the root is the smallest."""
    n = len(links)
    root = np.arange(n)
    while True:
        low = np.where(links, root[None, :], n).min(1, initial=n)
        low = np.minimum(low, root)
        low = low[low]
        if (low == root).all():
            break
        root = low
    return [(i, int(r)) for i, r in enumerate(root) if i != r]


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, t and a hash of both, which tells the rows of one key apart by their texts."""
    k, t = F.col(key).cast("long"), F.col(text)
    return docs.select(k.alias("doc_id"), F.xxhash64(k, t).alias("rid"), t.alias("t"))


def classes(docs: DataFrame, key: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, rid, cls (None without words), n (set size), buckets (of one row of each class and task only): one row for each input row, staged."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        oph = OnePermutation(bands, rows)
        sent: set[bytes] = set()
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for k, r, t in rows_of(batch, ["doc_id", "rid", "t"]):
                s = shingle_set(t, width)
                cls = set_key(s) if len(s) else None
                b = None
                if cls is not None and cls not in sent:
                    b = oph.buckets(s)
                    sent.add(cls)
                    if len(sent) > 200_000:
                        sent.clear()
                for column, x in zip(out, (k, r, cls, len(s), b), strict=True):
                    column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)], ["doc_id", "rid", "cls", "n", "buckets"])

    return stage(_rows(docs, key, text).mapInArrow(lean(sign), "doc_id long, rid long, cls binary, n long, buckets array<long>"), "classes")


def _sets(docs: DataFrame, key: str, text: str, wanted: DataFrame, width: int) -> DataFrame:
    """cls, cluster, set: the full shingle sets of the wanted (cls, cluster, rid), made anew from the texts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for cls, cluster, t in rows_of(batch, ["cls", "cluster", "t"]):
                s = shingle_set(t, width)
                if len(s) and set_key(s) == cls:
                    for column, x in zip(out, (cls, cluster, s.tobytes()), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in out], ["cls", "cluster", "shingles"])

    some, _ = split_by(_rows(docs, key, text).select("rid", "t"), "rid", key_filter(wanted, "rid"))
    found = some.join(wanted, "rid").select("cls", "cluster", "t")
    return stage(found.mapInArrow(lean(make), "cls binary, cluster binary, shingles binary"), "sets")


def _unpack(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(x, U64) for x in column]


def _small(sets: DataFrame, percent: int) -> DataFrame:
    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("cls").sort_values("cls", ignore_index=True)
        own = _unpack(pdf["shingles"])
        size = np.array([len(s) for s in own])
        found = forest(linked(common_counts(own), size, size, percent))
        return pd.DataFrame({"a": [pdf["cls"][i] for i, _ in found], "b": [pdf["cls"][r] for _, r in found]})

    return sets.groupBy("cluster").applyInPandas(links, "a binary, b binary")


def _linked_rows(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """a, b of the rows (a, b, x, y) whose sets x and y are linked."""
    for batch in batches:
        a, b = [], []
        for p, q, x, y in rows_of(batch, ["a", "b", "x", "y"], 64):
            s, t = np.frombuffer(x, U64), np.frombuffer(y, U64)
            if p != q and 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)):
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    a.append(p)
                    b.append(q)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _hub_links(sets: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    """a, b: the members linked with the hub of their cluster. One row per member is all that is compared."""
    hub_sets = hubs.join(sets.select(F.col("cls").alias("hub"), F.col("shingles").alias("hub_set")), "hub").select("cluster", "hub", "hub_set")
    rows = sets.join(hub_sets, "cluster").select(F.col("cls").alias("a"), F.col("hub").alias("b"), F.col("shingles").alias("x"), F.col("hub_set").alias("y"))
    return rows.mapInArrow(lean(lambda batches: _linked_rows(batches, percent)), "a binary, b binary")


def _block_links(sets: DataFrame, rest: DataFrame, percent: int) -> DataFrame:
    """a, b: links of the rest (cls, cluster) with all members of their clusters, block by block; a block returns a forest, not its pairs."""
    counts = rest.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    all_counts = sets.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("all_parts"))
    shape = counts.join(all_counts, "cluster")
    part = lambda n: F.pmod(F.xxhash64("cls"), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = sets.join(rest, ["cls", "cluster"]).join(shape, "cluster").select("cluster", part(F.col("parts")).alias("i"), every("all_parts").alias("j"), "cls", "shingles")
    right = sets.join(shape, "cluster").select("cluster", every("parts").alias("i"), part(F.col("all_parts")).alias("j"), "cls", "shingles")

    def links(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        s, t = _unpack(x["shingles"]), _unpack(y["shingles"])
        if not s or not t:
            return pd.DataFrame({"a": [], "b": []})
        hit = linked(common_counts(s, t), np.array([len(v) for v in s]), np.array([len(v) for v in t]), percent)
        n = len(s)
        square = np.zeros((n + len(t), n + len(t)), bool)
        square[:n, n:], square[n:, :n] = hit, hit.T
        names = [*x["cls"], *y["cls"]]
        found = [(names[i], names[r]) for i, r in forest(square) if names[i] != names[r]]
        return pd.DataFrame(found, columns=["a", "b"])

    keys = ["cluster", "i", "j"]
    # New names for the same columns: both sides come from one table.
    left, right = left.toDF(*keys, "cls", "shingles"), right.toDF(*keys, "cls", "shingles")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(links, "a binary, b binary")


def _large(large: DataFrame, popular: DataFrame, percent: int) -> DataFrame:
    """a, b: links that hold the components of large clusters (cls, cluster, shingles; popular: cls, met) together."""
    left = stage(large.select("cls", "cluster").join(popular, "cls"), "left")
    edges, n, low = None, left.count(), 0
    while n and low < LOW:
        hubs = stage(left.groupBy("cluster").agg(F.expr("max_by(cls, struct(met, cls))").alias("hub")), "hubs")
        found = stage(_hub_links(large, hubs, percent), "links")
        edges = found if edges is None else edges.unionByName(found)
        gone = found.select(F.col("a").alias("cls")).union(hubs.select("hub"))
        left = stage(left.join(gone.distinct(), "cls", "left_anti"), "left")
        before, n = n, left.count()
        low = low + 1 if before - n < GAIN * before else 0
    parts = components(edges, "a", "b")
    at = stage(large.select("cls", "cluster").join(parts, parts["node"] == F.col("cls"), "left").select("cls", "cluster", F.coalesce("root", "cls").alias("root")), "labels")
    biggest = at.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster").agg(F.expr("max_by(root, struct(n, root))").alias("main"))
    rest = stage(at.join(biggest, "cluster").where("root <> main").select("cls", "cluster"), "rest")
    return edges.unionByName(_block_links(large, rest, percent))


def grouped(docs: DataFrame, key: str, text: str, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    """doc_id, rid, n and root of each input row: rows with one root are one group; no root without words."""
    given = classes(docs, key, text, width, bands, rows)
    rep = given.where("cls is not null").groupBy("cls").agg(F.min("rid").alias("rid"))
    members = given.where("buckets is not null").select("cls", F.explode("buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high").drop("high")
    found = stage(members.join(shared, "bucket").select("cls", "low", "m"), "buckets")
    star = components(found.where("cls <> low").select("cls", "low").distinct(), "cls", "low")
    cluster = stage(star.select(F.col("node").alias("cls"), F.col("root").alias("cluster")).join(rep, "cls").select("cls", "cluster", "rid"), "clusters")
    sets = _sets(docs, key, text, cluster, width)
    many = cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > SMALL).select("cluster")
    edges = stage(_small(sets.join(many, "cluster", "left_anti"), percent), "links")
    if many.limit(1).count():
        large = stage(sets.join(many, "cluster", "left_semi").dropDuplicates(["cls"]), "large")
        popular = found.groupBy("cls").agg(F.sum("m").alias("met"))
        edges = edges.unionByName(stage(_large(large, popular, percent), "links"))
    roots = components(edges, "a", "b").select(F.col("node").alias("cls"), "root")
    return stage(given.select("doc_id", "rid", "n", "cls").join(roots, "cls", "left").select("doc_id", "rid", "n", F.coalesce("root", "cls").alias("root")), "groups")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest key reachable by links, itself included) and kept, one row for each input row.

    A link is 100 * intersection >= percent * union of the full sets. Null and empty texts, and those of white space, have
    empty sets and link with nothing. Rows with equal keys are rows of their own; those whose key is the component's are all
    kept. A null key takes no part in the choice of the smallest; kept is null where the key or the component's is.
    """
    found = grouped(docs, key, text, width, percent, bands, rows)
    lows = found.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("low"))
    low = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("low"))
    return found.join(lows, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), low.alias("component_id"), (F.col("doc_id") == low).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The input's rows and columns without near duplicates: of each group one row stays, that with the smallest key.

    Decisions are by row: rows that share a key but not a group have nothing to do with each other. Of several rows of a group with the
    smallest key one stays; a row without a key stays only if its whole group has none. Rows without words stay.
    """
    found = grouped(docs, key, text, width, percent, BANDS, ROWS).where("root is not null")
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    first = found.groupBy("root").agg(F.min(best).alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1").select("root", F.col("first.rid").alias("first"))
    # What is not the first of its group goes; a first that has its twin in the table stays once.
    asked = found.join(first, "root").groupBy("rid").agg(F.min(F.col("rid") == F.col("first")).alias("stays"), F.count(F.lit(1)).alias("rows"))
    fates = stage(asked.where("not stays or rows > 1").select(F.col("rid").alias("__rid"), F.col("stays").alias("__stays")), "fates")
    rows = docs.withColumn("__rid", F.xxhash64(F.col(key).cast("long"), F.col(text)))
    some, clear = split_by(rows, "__rid", key_filter(fates, "__rid"))
    judged = some.join(fates, "__rid", "left")
    twins = judged.where("__stays").dropDuplicates(["__rid"])
    return clear.select(*docs.columns).unionByName(judged.where("__stays is null").select(*docs.columns)).unionByName(twins.select(*docs.columns))
