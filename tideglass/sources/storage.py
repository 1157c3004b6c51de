"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tideglass-")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset one of its own, in local mode only: other executors would not see it."""
    folder, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not folder and not (master.startswith("local") and not master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return folder.rstrip("/") if folder else _own_folder()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends in files that every executor sees."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tideglass/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tideglass_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once nothing reads it any more."""
    path = getattr(df, "_tideglass_path", None)
    if path:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
