"""Scene documents: whole JSON files decoded by a schema. A missing or damaged file gives no rows, or a row with a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake import schemas


def read_documents(spark: SparkSession, path: str, kind: str, pattern: str | None = None) -> DataFrame:
    """path, doc, damaged: one row per file under a path (a glob counts), decoded by a schema (DDL); damaged where it can't be."""
    r = spark.read.option("wholetext", True)
    if pattern:
        r = r.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    t = r.text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    return t.select("path", F.from_json("value", kind, {"mode": "PERMISSIVE"}).alias("doc"), "value").select("path", "doc", (F.col("doc").isNull() | F.col("value").isNull() | F.try_parse_json("value").isNull()).alias("damaged"))


def tolerant(docs: DataFrame, empty: str) -> DataFrame:
    """path, doc with damaged documents replaced by an empty one of the schema."""
    return docs.select("path", F.when(~F.col("damaged"), F.col("doc")).otherwise(F.from_json(F.lit("{}"), empty)).alias("doc"))


def splits(docs: DataFrame) -> DataFrame:
    """split, scene_id."""
    return docs.select(F.explode("doc").alias("split", "scenes")).select("split", F.explode("scenes").alias("scene_id"))


def objects(docs: DataFrame, scene: str = "scene") -> DataFrame:
    """Objects with flat boxes, from object documents that carry their scene."""
    o = docs.select(scene, F.explode("doc").alias("id", "o"))
    flat = [F.get(f"o.{m}_points", F.lit(i)).alias(f"{m}_{x}") for m in ("min", "max") for i, x in enumerate("xyz")]
    return o.select(scene, "id", "o.category", "o.scope", "o.room", *flat)


def edges(docs: DataFrame, scene: str = "scene") -> DataFrame:
    """The edges that object documents hold as maps of (relation, distance) pairs."""
    o = docs.select(scene, F.explode("doc").alias("src", "o")).select(scene, "src", F.explode("o.nearby_objects").alias("dst", "e"))
    return o.select(F.col(scene).alias("scene"), "src", "dst", F.get("e", F.lit(0)).alias("rel"), F.get("e", F.lit(1)).try_cast("double").alias("dist")).to(schemas.EDGE)


def frames(spark: SparkSession, path: str) -> DataFrame:
    """path, kind, number of the frame files below a folder: rgb_<i>.png and depth_<i>.npy in any case, in natural order by number."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    number = F.regexp_extract(name, r"^(?:rgb|depth)_(\d+)\.(?:png|npy)$", 1).try_cast("long")
    kind = F.when(name.rlike(r"^rgb_\d+\.png$"), "rgb").when(name.rlike(r"^depth_\d+\.npy$"), "depth")
    return f.select("path", "length", kind.alias("kind"), number.alias("number")).where("kind is not null")
