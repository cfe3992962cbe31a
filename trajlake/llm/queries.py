"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.llm import oracles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public tokenizer file lies."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from labelled documents outside the held-out quarter."""
    from trajlake.llm import langid

    docs = _read(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = langid.fit(docs.where(part != 2))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query("op8_token_ids")
def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written as range-coded files in key order and read back from them."""
    from trajlake.llm import idfiles

    manifest = idfiles.write_ids(_read(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path(), end_id=2)
    return idfiles.read_ids(manifest)


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact histogram of encoded lengths, with totals, quantiles and truncated totals for each limit that occurs."""
    from trajlake.llm import lengths
    from trajlake.llm.common import stage

    histogram = stage(lengths.length_histogram(_read(spark, sf_dir, "documents"), "text", tokenizer_path()), "lengths")
    return lengths.context_table(histogram)


@query("op10_source_mix")
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix by source weights 1, 2, 3, ... takes."""
    from trajlake.llm import mixing
    from trajlake.llm.common import stage

    docs = _read(spark, sf_dir, "documents")
    rows = stage(mixing.sized(docs, "doc_id", "text", "source", seed=17).select("doc_id", "mix_size", "mix_source", "mix_deal", "mix_order"), "mix")
    taken = mixing.take(rows, *mixing.quotas(rows))
    return taken.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"))


@query("op4_near_duplicates", oracles.NEAR)
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of two-word shingles are linked at 80 of 100."""
    from trajlake.llm import neardup

    found = neardup.near_duplicates(_read(spark, sf_dir, "documents"), width=2, percent=80)
    return found.withColumn("kept", F.coalesce("kept", F.lit(False)))


@query("op2_nearest_vectors")
def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors for every twentieth vec_id, by inner product."""
    from trajlake.llm import onebit

    index, space = onebit.encode(_read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return onebit.search(index, index.where("vec_id % 20 = 0"), space, k=20)


@query("op3_warc_bundles", oracles.WARC)
def op3_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record in seekable bundles, read back from them."""
    from trajlake.llm import warc

    index = warc.write_bundles(warc.mark_revisits(_read(spark, sf_dir, "pages"), "page_id", "url", "html", min_bytes=0))
    return warc.read_bundles(index)


@query("op5_benchmark_leaks")
def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that a document has within their error budgets."""
    from trajlake.llm import decontam

    return decontam.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@query("op7_secrets", oracles.SECRETS)
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base spans, and tokens that one source alone has."""
    from trajlake.llm import secrets

    return secrets.secrets(_read(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query("op6_repeated_bytes", oracles.REPEATS)
def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes of strings of 400 that start at more than one place."""
    from trajlake.llm import suffixdedup

    return suffixdedup.remove_repeats(_read(spark, sf_dir, "documents"))
