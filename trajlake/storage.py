"""Stage tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. Where it is unset, a local session has a folder of its own; a cluster must name one, as a folder of one machine isn't shared."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    app = context.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="trajlake-")
    return _OWN[app]


def fresh_folder(spark: SparkSession, what: str) -> str:
    """A URI below the shared folder that nobody has used."""
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, what: str = "stage") -> DataFrame:
    """Writes and rereads a table, which cuts its plan; a lost executor then costs no earlier stage."""
    path = fresh_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
