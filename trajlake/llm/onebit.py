"""Nearest neighbours by inner product with randomly rotated one-bit codes, in cells of a coarse partition.

A vector is its offset from the mean of all vectors, as a length and a direction. A seeded random rotation turns the
direction, and its signs are the code: one bit for each component, packed. With the code go two scalars: the length, and the inner
product of the turned direction with its own signs. A query is turned likewise and cut to four bits a component; its inner product with
a code is then four counts of common bits for each 64 components. From these counts and the scalars follow an estimate of the inner
product and a bound of its error; those whose upper bound reaches what the best so far have for certain are reranked on the
original vectors, in double precision.

Vectors belong to the nearest of a few centroids, which are fitted on a sample of at most ``SAMPLE`` vectors (all vectors are in
the index). A query goes to its ``FIRST`` most promising cells; the ``k``-th best product there, or in the sample, is certain. Then it goes
to all other cells that may hold one of its best: those where the product with the centroid and ``REACH`` standard
deviations of the products inside the cell reach what is certain, and only products that do so come back. Each vector is in one
cell, so nothing grows with the square of the table but the products that are asked for; large cells and cells of many queries
are cut into blocks. ``exact=True`` sends every query to every cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajlake.llm.common import lean, stage

#: Queries of a block, vectors of a block, vectors of a cell, about, and the most cells.
QUERY_BLOCK, VECTOR_BLOCK, CELL, MOST_CELLS = 2048, 8192, 1024, 1024
#: Vectors that centroids and the first certain scores come from; cells that a query sees first.
SAMPLE, FIRST = 8192, 4
#: Width of the error bound of an estimate and of the products in a cell, in standard deviations.
EPS, REACH = 2.5, 3.5
_STEP, _PLANES = 128, 4
INDEX = "rid long, vec_id long, v binary, code binary, length float, fit float, cell int"


@dataclass
class Space:
    """What all workers know: the mean, the rotation, the centroids, the spread in their cells, and the sample (its rids and vectors)."""

    mean: np.ndarray
    turn: np.ndarray
    centroids: np.ndarray
    spread: np.ndarray
    rids: np.ndarray
    sample: np.ndarray


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _usable(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and vectors (in double) of the rows that take part."""
    column = batch.column("v")
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), dim), False).to_numpy(zero_copy_only=False))
    if not len(rows):
        return rows, np.zeros((0, dim))
    x = pc.list_flatten(column.take(pa.array(rows))).cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
    good = np.isfinite(x).all(1) & (x != 0).any(1)  # a null component has become NaN
    return rows[good], x[good]


def _nearest_centroid(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1)[None, :] - 2 * (x @ c.T)).argmin(1)


def centroids(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from ``k`` seeded rows; a cell that has become empty takes the row farthest from its centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        of = _nearest_centroid(x, c)
        for j in range(len(c)):
            own = x[of == j]
            c[j] = own.mean(0) if len(own) else x[((x - c[of]) ** 2).sum(1).argmax()]
    return c


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, with zeros behind."""
    packed = np.packbits(bits, axis=1)
    wide = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view(np.uint64)


def encode(vectors: DataFrame, key: str, vector: str, seed: int = 3, cell: int = CELL) -> tuple[DataFrame, Space]:
    """The staged index, a row for each usable row (rows that share a key too), and the space.

    Null, empty and zero vectors and those with null or non-finite components take no part, nor do rows without a key or with
    another number of components than most have (of equally many, the larger number).
    """
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.monotonically_increasing_id().alias("rid"), F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    dim = sizes[0]["dim"] if sizes else 0

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim), 0
        for batch in batches:
            _, x = _usable(batch, dim)
            total, n = total + x.sum(0), n + len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(dim), pa.int32()), "s": total, "n": [n] * dim})

    found = rows.mapInArrow(lean(sums), "i int, s double, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect() if dim else []
    mean, n = np.zeros(dim), 0
    for r in found:
        mean[r["i"]], n = r["s"] / r["n"], r["n"]
    turn = rotation(dim, seed) if dim else np.zeros((0, 0))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's rows with the smallest seeded hashes; no more than the whole sample."""
        held: list[tuple[int, int, bytes]] = []
        for batch in batches:
            at, x = _usable(batch, dim)
            h, rid = (batch.column(c).to_numpy()[at] for c in ("h", "rid"))
            held = sorted([*held, *((int(a), int(b), v.tobytes()) for a, b, v in zip(h, rid, x, strict=True))])[:SAMPLE]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["h", "rid", "v"])

    # Hashes below a bound keep somewhat more than the sample; the exact cut follows on that bounded rest.
    share = min(1.0, (1.3 * SAMPLE + 200) / max(n, 1))
    hashed = rows.withColumn("h", F.xxhash64("rid", F.lit(seed))).where((F.col("h").cast("double") + 2.0**63) / 2.0**64 <= share)
    drawn = hashed.mapInArrow(lean(draw), "h long, rid long, v binary").orderBy("h").limit(SAMPLE).collect() if n else []
    sample = np.frombuffer(b"".join(r["v"] for r in drawn), np.float64).reshape(-1, dim) if drawn else np.zeros((0, dim))
    c = centroids(sample, max(1, min(MOST_CELLS, n // cell, len(sample) // 8)), seed) if len(sample) else np.zeros((0, dim))
    rest = sample - c[_nearest_centroid(sample, c)] if len(sample) else sample
    space = Space(mean, turn, c, rest.T @ rest / max(1, len(rest)), np.array([r["rid"] for r in drawn], np.int64), sample)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _usable(batch, dim)
            if not len(at):
                continue
            r = (x - mean) @ turn.T
            length = np.sqrt((r * r).sum(1))
            fit = np.abs(r).sum(1) / (np.maximum(length, 1e-300) * np.sqrt(dim))
            yield pa.RecordBatch.from_arrays([
                batch.column("rid").take(pa.array(at)), batch.column("vec_id").take(pa.array(at)), pa.array([v.tobytes() for v in x], pa.binary()), pa.array([w.tobytes() for w in pack(r > 0)], pa.binary()),
                pa.array(length.astype(np.float32)), pa.array(fit.astype(np.float32)), pa.array(_nearest_centroid(x, c).astype(np.int32))], ["rid", "vec_id", "v", "code", "length", "fit", "cell"])

    return stage(rows.mapInArrow(lean(code), INDEX), "codes"), space


def estimates(q: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, float]:
    """Inner products of a turned query with the signs of packed codes, by counts of common bits, and the standard deviation of its cut to four bits."""
    top = (1 << _PLANES) - 1
    low = q.min()
    step = max((q.max() - low) / top, 1e-300)
    u = np.rint((q - low) / step).astype(np.uint8)
    common = np.zeros(len(words), np.int64)
    ones = np.zeros(len(words), np.int64)
    for w in range(words.shape[1]):
        ones += np.bitwise_count(words[:, w])
    for p in range(_PLANES):
        plane = pack((u >> p & 1)[None, :].astype(bool))[0]
        for w in range(words.shape[1]):
            common += np.bitwise_count(words[:, w] & plane[w]).astype(np.int64) << p
    # Signs are 2 bit - 1.
    return 2 * (low * ones + step * common) - (low * len(q) + step * float(u.sum())), step * np.sqrt(len(q) / 12)


def best_of_block(queries: pd.DataFrame, block: pd.DataFrame, space: Space, k: int, eps: float = EPS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query, the places in the block of its best ``k`` (ties to the smaller vec_id) and their exact inner products, nearest first."""
    mean, dim = space.mean, len(space.mean)
    q = np.frombuffer(b"".join(queries["v"]), np.float64).reshape(-1, dim)
    x = np.frombuffer(b"".join(block["v"]), np.float64).reshape(-1, dim)
    words = np.frombuffer(b"".join(block["code"]), np.uint64).reshape(len(x), -1)
    length, fit = block["length"].to_numpy(np.float64), np.maximum(block["fit"].to_numpy(np.float64), 1e-6)
    scale = length / (np.sqrt(dim) * fit)
    spread = length * np.sqrt(np.maximum(1 - fit * fit, 0)) / fit * (eps / np.sqrt(max(dim - 1, 1)))
    ids, rids, own = block["vec_id"].to_numpy(), block["rid"].to_numpy(), queries["rid"].to_numpy()
    turned, centre, norms = q @ space.turn.T, q @ mean, np.sqrt((q * q).sum(1))
    sure = queries["sure"].to_numpy()
    out = []
    for j in range(len(q)):
        guess, cut = estimates(turned[j], words)
        row = centre[j] + guess * scale
        wide = spread * norms[j] + eps * cut * scale + 1e-5 * (1 + norms[j] * length)
        row[rids == own[j]] = -np.inf
        # What is certain comes from the exact products of the best guesses.
        first = np.argpartition(-row, min(4 * k, len(row)) - 1)[: 4 * k]
        exact = x[first] @ q[j]
        exact[np.isneginf(row[first])] = -np.inf
        least = np.partition(exact, len(exact) - k)[len(exact) - k] if len(exact) >= k else -np.inf
        least = max(least, sure[j])
        some = np.flatnonzero((row + wide >= least) & ~np.isneginf(row))
        exact = x[some] @ q[j]
        some, exact = some[exact >= sure[j]], exact[exact >= sure[j]]
        order = np.lexsort((ids[some], -exact))[:k]
        out.append((some[order], exact[order]))
    return out


_ASKED = "rid long, vec_id long, v binary, sure double, cell int, bound double, place int"


def _lower(score: np.ndarray) -> np.ndarray:
    """A little less, so that sums in another order don't fall below."""
    return score - 1e-9 * (1 + np.abs(score))


def _probes(queries: DataFrame, space: Space, k: int, reach: float, exact: bool) -> DataFrame:
    """Each query with every cell that may hold one of its best: what is certain from the sample, the cell's bound, and its place among the query's cells."""
    dim, c = len(space.mean), space.centroids

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _STEP):
                batch = whole.slice(at, _STEP)
                q = np.frombuffer(b"".join(batch.column("v").to_pylist()), np.float64).reshape(-1, dim)
                bound = q @ c.T + reach * np.sqrt(np.maximum(((q @ space.spread) * q).sum(1), 0))[:, None]
                score = q @ space.sample.T
                score[batch.column("rid").to_numpy()[:, None] == space.rids[None, :]] = -np.inf
                sure = np.full(len(q), -np.inf)
                if score.shape[1] >= k and not exact:
                    sure = np.partition(score, -k, axis=1)[:, -k]
                    sure = np.where(np.isneginf(sure), sure, _lower(sure))
                place = (-bound).argsort(1, kind="stable").argsort(1, kind="stable")
                i, cell = np.nonzero((bound >= sure[:, None]) | (place < FIRST))
                own = batch.take(pa.array(i))
                yield pa.RecordBatch.from_arrays([*(own.column(n) for n in ("rid", "vec_id", "v")), pa.array(sure[i]), pa.array(cell.astype(np.int32)), pa.array(bound[i, cell]), pa.array(place[i, cell].astype(np.int32))], ["rid", "vec_id", "v", "sure", "cell", "bound", "place"])

    return stage(queries.select("rid", "vec_id", "v").mapInArrow(lean(ask), _ASKED), "probes")


def _best(index: DataFrame, asked: DataFrame, space: Space, k: int, query_block: int, vector_block: int, eps: float) -> DataFrame:
    """query (rid), query_id, vec_id, score: the best ``k`` of each asked cell's blocks that reach what is certain."""
    blocks = lambda t, size, name: t.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
    shape = F.broadcast(blocks(asked, query_block, "qs").join(blocks(index, vector_block, "vs"), "cell"))
    part = lambda n, salt: F.pmod(F.xxhash64("rid", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(shape, "cell").select("rid", "vec_id", "v", "sure", "cell", part("qs", 1).alias("a"), every("vs").alias("b"))
    right = index.join(shape, "cell").select("rid", "vec_id", "v", "code", "length", "fit", "cell", every("qs").alias("a"), part("vs", 2).alias("b"))

    def near(q: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(block):
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}).astype({"query": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"})
        found = best_of_block(q, block, space, k, eps)
        ids, sizes = block["vec_id"].to_numpy(), [len(p) for p, _ in found]
        return pd.DataFrame({"query": np.repeat(q["rid"].to_numpy(), sizes), "query_id": np.repeat(q["vec_id"].to_numpy(), sizes), "vec_id": np.concatenate([ids[p] for p, _ in found]), "score": np.concatenate([s for _, s in found])})

    keys = ["cell", "a", "b"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(near, "query long, query_id long, vec_id long, score double")


def _ranked(best: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, space: Space, k: int = 20, query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK, eps: float = EPS, reach: float = REACH, exact: bool = False) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query row's ``k`` best of all other rows of the index, ties to the smaller vec_id.

    ``queries`` are rows of the index. What is broadcast is a row for each cell, at most ``MOST_CELLS``.
    """
    asked = _probes(queries, space, k, reach, exact)
    how = (space, k, query_block, vector_block, eps)
    first = stage(_ranked(_best(index, asked.where(F.col("place") < FIRST), *how), k), "first")
    sure = first.where(F.col("rank") == k).select(F.col("query").alias("rid"), (F.col("score") - 1e-9 * (1 + F.abs("score"))).alias("found"))
    rest = asked.where(F.col("place") >= FIRST).join(sure, "rid", "left").withColumn("sure", F.greatest("sure", F.coalesce("found", F.lit(float("-inf")))))
    rest = rest if exact else rest.where(F.col("bound") >= F.col("sure"))
    more = _best(index, stage(rest.drop("found"), "rest"), *how)
    return _ranked(first.drop("rank").unionByName(more), k).select("query_id", "rank", "vec_id", "score")
