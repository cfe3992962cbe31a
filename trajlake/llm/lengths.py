"""Token counts: the exact histogram of encoded lengths, and what its suffix sums answer for every context limit."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajlake.llm.common import lean
from trajlake.llm.tokens import encoder, slices

#: Lengths of a block whose suffix sums are made together.
SPAN = 512


def length_histogram(docs: DataFrame, text: str, tokenizer: str) -> DataFrame:
    """length, n_docs: how many texts encode to how many ids. A null or empty text has length 0; repeated rows count each.

    A task sends one row per distinct length that it has met, never one per document.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, seen = encoder(tokenizer), Counter()
        for batch in batches:
            for some in slices(batch, "t"):
                seen.update(coder.encode_batch(some.column("t"))[1].tolist())
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.fromiter(x, np.int64)) for x in (seen.keys(), seen.values())], ["length", "n"])

    return docs.select(F.col(text).alias("t")).mapInArrow(lean(count), "length long, n long").groupBy("length").agg(F.sum("n").alias("n_docs"))


def context_table(histogram: DataFrame) -> DataFrame:
    """Per length that occurs, as a context limit: docs and tokens of that length or more, all tokens if each document is cut
    at the limit, the tokens lost, and the quantile (share of documents no longer than the limit).

    Suffix sums go in two steps, blocks of lengths and then lengths within a block, so that no task holds all lengths.
    Between two lengths that occur, ``truncated_total`` at limit L is that of the next length minus (next - L) * its docs_at_least.
    """
    block = F.floor(F.col("length") / SPAN)
    h = histogram.withColumn("block", block).withColumn("tokens", F.col("length") * F.col("n_docs"))
    sums = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("block"))
    after = sums.select("block", (F.sum("d").over(later) - F.col("d")).alias("docs_after"), (F.sum("t").over(later) - F.col("t")).alias("tokens_after"), F.sum("d").over(Window.partitionBy()).alias("all_docs"), F.sum("t").over(Window.partitionBy()).alias("all_tokens"))
    within = Window.partitionBy("block").orderBy(F.desc("length"))
    s = h.join(after, "block").select(
        "length",
        "n_docs",
        (F.sum("n_docs").over(within) + F.col("docs_after")).alias("docs_at_least"),
        (F.sum("tokens").over(within) + F.col("tokens_after")).alias("tokens_at_least"),
        "all_docs",
        "all_tokens",
    )
    kept = F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")
    return s.select(
        "length",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        kept.alias("truncated_total"),
        (F.col("all_tokens") - kept).alias("tokens_cut"),
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all_docs")).alias("quantile"),
    )


def truncated_total(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """limit, total: all tokens if each document is cut at the limit, for any stated limits."""
    each = F.explode(F.array(*(F.lit(int(x)) for x in limits)).cast("array<long>"))
    return histogram.withColumn("limit", each).groupBy("limit").agg(F.sum(F.least("length", "limit") * F.col("n_docs")).alias("total"))
