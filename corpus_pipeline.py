"""A corpus pipeline of five stages: language ID, near-dedup, decontamination, source mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.llm import decontam, idfiles, langid, mixing, neardup
from trajlake.llm.common import small_batches, stage
from trajlake.llm.queries import tokenizer_path

def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages. Texts that are null or have no letter go, and so do those that are like none of the texts learnt from."""
    found = langid.predict(docs, langid.fit(docs), names=("__language", "__score"), reject=True)
    return found.where(F.col("__language") != "und").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8): that with the smallest doc_id."""
    with small_batches(spark):  # for the tables that it writes on the way
        return neardup.keep_one(docs, width=5, percent=80).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item within its error budget."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole copies, and for a part of a document its first words."""
    rows = mixing.sized(docs, "doc_id", "text", "source", seed=17)
    narrow = stage(rows.select("mix_size", "mix_source", "mix_deal", "mix_order"), "mix")
    taken = mixing.take(rows, *mixing.quotas(narrow))
    whole, part = F.floor(F.col("mix_taken") / F.col("mix_size")), F.col("mix_taken") % F.col("mix_size")
    copies = taken.where(F.col("mix_taken") > 0).withColumn("mix_words_of", F.explode(F.concat(F.array_repeat(F.col("mix_size"), whole.cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))))
    cut = F.when(F.col("mix_words_of") < F.col("mix_size"), mixing.first_words(F.col("text"), F.col("mix_words_of"))).otherwise(F.col("text"))
    out = copies.withColumn("text", cut)
    return out.withColumn("n_chars", F.when(F.col("mix_words_of") < F.col("mix_size"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the id files, read back from them."""
    return idfiles.read_ids(idfiles.write_ids(docs, "doc_id", "text", tokenizer_path(), end_id=2))


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_ids", token_ids),
]

#: SQL can express neither the first stage nor the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
