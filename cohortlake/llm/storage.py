"""Where intermediate tables go: a folder that the driver and all executors share."""

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


#: Folders written in this driver, in order; `cleared` takes them away.
MADE: list[str] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write `df` as a Parquet table in the shared folder and read it back."""
    return stored(df, label)[0]


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Send texts to Python in batches of `rows` unless the session asks for other than the usual number: long texts by ten thousands fill memory."""
    key, usual = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if spark.conf.get(key, usual) == usual:
        spark.conf.set(key, str(rows))


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As `written`, with the folder, for a table that is dropped when its successor is there."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    MADE.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Take away a table that nothing reads any more. Only folders that `stored` made are given here."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    MADE.remove(path)


def cleared(spark: SparkSession, since: int, keep: list[str]) -> None:
    """Take away what was written after the first `since` folders of MADE, but for `keep`: the tables between a stage's input and its result."""
    for path in [p for p in MADE[since:] if p not in keep]:
        dropped(spark, path)
