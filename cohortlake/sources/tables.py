"""Tables that a run writes for itself, in a folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only in local mode where the session names none (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def written(df: DataFrame, label: str, partition: str | None = None) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder, by the days of `partition` if given, and read it back; that cuts the lineage too."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if partition is None:
        df.write.parquet(path)
    else:
        df.hint("rebalance", partition).write.partitionBy(partition).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of all files under a folder: tables made from it hold as long as these stay."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found, files = [], path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))
