"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks, to sources and then to their shards.

A source's target is its weight's share of the budget, never above ``cap`` times what the source has; what is above goes to
the other sources by weight. The targets become whole blocks by highest quotients target / (2 q + 1). Each source's
documents are dealt to shards by a seeded hash, and the source's blocks are apportioned to its shards in the same way, by
the shards' sizes. A shard lays its documents in seeded order into one row of words, cut into blocks; it takes its quota of
blocks from the start and begins anew at its end, so that a document is repeated only after all others of the shard.

Sources in order of code point, null last, have the weights in turn, again and again. Null and empty texts have size 0 and
nothing is taken of them; a table without words takes nothing. Rows with equal keys are rows of their own.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Documents of a shard, about, and the most shards: what the driver holds and joins by broadcast is bounded by them and the number of sources.
SHARD_DOCS, MAX_SHARDS = 512, 50_000
#: Most words of a block, and the blocks that the smallest target has at least where it has as many words.
BLOCK_WORDS, LEAST_BLOCKS = 256, 400
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """The words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[int], total: int, cap: int = 3) -> list[Fraction]:
    """Shares of ``total`` by weight, each at most ``cap`` times its size; the excess goes to the others by weight until none is above."""
    out: list[Fraction] = [Fraction(0)] * len(sizes)
    open_, left = set(range(len(sizes))), Fraction(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] > cap * sizes[i] * weight]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = Fraction(cap * sizes[i])
        left -= sum(out[i] for i in full)
        open_ -= set(full)
    return out


def sainte_lague(votes: list[Fraction | int], seats: int, most: list[int] | None = None) -> list[int]:
    """Seats by highest quotients votes / (2 seats + 1), ties to the earlier; no one gets more than its ``most``.

    Starts below what the method must give (its divisor lies so that all rounded shares differ from the seats by half the
    voters at most), and deals the rest, a few seats for each voter, from a heap.
    """
    n, total = len(votes), sum(votes)
    most = most if most is not None else [seats] * n
    got = [0] * n
    if total > 0:
        got = [max(0, min(m, math.floor(Fraction(v) / total * (seats - Fraction(n, 2)) - Fraction(1, 2)))) for v, m in zip(votes, most, strict=True)]
    heap = [(-Fraction(v) / (2 * g + 1), i) for i, (v, g, m) in enumerate(zip(votes, got, most, strict=True)) if v > 0 and g < m]
    heapq.heapify(heap)
    left = seats - sum(got)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        left -= 1
        if got[i] < most[i]:
            heapq.heappush(heap, (-Fraction(votes[i]) / (2 * got[i] + 1), i))
    return got


#: What the operator adds to rows; input columns of these names are replaced.
ADDED = ("mix_size", "mix_source", "mix_deal", "mix_order", "mix_key", "mix_place", "mix_source_size", "mix_target", "mix_shards", "mix_shard", "mix_shard_size", "mix_words", "mix_taken")


def sized(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    """The input with what the mix needs of each row: mix_size (words), mix_source, and two seeded hashes of key and text.

    Rows without a key are dealt by their texts, so they don't make one shard. Input columns with a name in ``ADDED`` are replaced.
    """
    return docs.select(
        *(F.col(f"`{c}`") for c in docs.columns if c.lower() not in ADDED),
        n_words(F.col(text)).alias("mix_size"),
        F.col(source).cast("string").alias("mix_source"),
        F.xxhash64(F.col(key), F.col(text), F.lit(seed)).alias("mix_deal"),
        F.xxhash64(F.col(key), F.col(text), F.lit(seed + 1)).alias("mix_order"),
    )


def quotas(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, shard_docs: int = SHARD_DOCS, max_shards: int = MAX_SHARDS, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """From the mix_ columns of all rows: one row per source (its size, target and shards), and one per shard (its size and words to take).

    The driver holds one number per source and one per shard; there are at most ``max_shards`` shards, and one more for each source.
    """
    spark = rows.sparkSession
    per = rows.groupBy("mix_source").agg(F.sum("mix_size").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    per.sort(key=lambda r: (r["mix_source"] is None, (r["mix_source"] or "").encode("utf-32-be")))
    sizes = [r["s"] for r in per]
    docs = sum(r["n"] for r in per)
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(per))], sum(sizes), cap)
    block = max(1, min(block_words, math.floor(min((t for t in goal if t > 0), default=Fraction(1)) / LEAST_BLOCKS)))
    seats = sainte_lague(goal, round(sum(goal) / block), [math.ceil(cap * s / block) for s in sizes])
    schema = "mix_key string, mix_source_size long, mix_target double, mix_shards long"
    by_source = _small(spark, [(r["mix_source"], r["s"], float(t), max(1, min(-(-r["n"] // shard_docs), max_shards * r["n"] // docs))) for r, t in zip(per, goal, strict=True)], schema)
    shards: dict[str | None, list] = {}
    for r in _dealt(rows, by_source).groupBy("mix_source", "mix_shard").agg(F.sum("mix_size").alias("s")).collect():
        shards.setdefault(r["mix_source"], []).append((r["mix_shard"], r["s"]))
    out = []
    for r, q in zip(per, seats, strict=True):
        own = sorted(shards[r["mix_source"]])
        got = sainte_lague([s for _, s in own], q, [math.ceil(cap * s / block) for _, s in own])
        out += [(r["mix_source"], k, s, min(g * block, cap * s)) for (k, s), g in zip(own, got, strict=True)]
    return by_source, _small(spark, out, "mix_key string, mix_place long, mix_shard_size long, mix_words long")


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """The driver's own list as a table to broadcast: a row per source, or at most ``MAX_SHARDS`` and one more per source.

    It goes through Arrow: of Python rows Spark makes an RDD that each executor reads in Python workers of another daemon, which stay.
    """
    fields = [(name, {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}[kind]) for name, kind in (x.split() for x in schema.split(","))]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    table = pa.table([pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)], pa.schema(fields))
    return F.broadcast(spark.createDataFrame(table))


def _dealt(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    return rows.join(by_source, rows["mix_source"].eqNullSafe(by_source["mix_key"])).drop("mix_key").withColumn("mix_shard", F.pmod("mix_deal", "mix_shards"))


def take(rows: DataFrame, by_source: DataFrame, by_shard: DataFrame) -> DataFrame:
    """Rows that have the mix_ columns, with mix_taken: the words that the mix takes of the row, repeats counted.

    A shard with W words that must give n takes each of its documents n // W times, and once more the first n % W words of
    its seeded order. Which of several rows with equal key and text comes first makes no difference to the result.
    """
    dealt = _dealt(rows, by_source)
    placed = dealt.join(by_shard, dealt["mix_source"].eqNullSafe(by_shard["mix_key"]) & (dealt["mix_shard"] == by_shard["mix_place"])).drop("mix_key", "mix_place")
    w = Window.partitionBy("mix_source", "mix_shard").orderBy("mix_order", "mix_deal").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.greatest("mix_shard_size", F.lit(1))
    begin = F.sum("mix_size").over(w) - F.col("mix_size")
    part = F.greatest(F.lit(0), F.least(F.col("mix_size"), F.col("mix_words") % whole - begin))
    return placed.withColumn("mix_taken", (F.floor(F.col("mix_words") / whole) * F.col("mix_size") + part).cast("long"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, with the white space before it as it is."""
    parts = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(parts, F.lit(1), n.cast("int")), "")
