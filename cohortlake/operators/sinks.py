"""Changes to tables: ranges replaced, appended to, expired, exported, and what is to be known before and after."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.sources.generations import Generations

#: Day columns of click-day tables, the only ones that expire.
CLICK_DAYS = ("date", "click_date")


def range_replace(store: Generations, table: str, new: DataFrame, start: dt.date, end: dt.date, generation: str) -> list[str]:
    """The days from start to end hold the new rows and nothing else; a day without new rows becomes empty, other days aren't touched."""
    return store.replace_range(table, new, start, end, generation)


def snapshot_replace(store: Generations, table: str, new: DataFrame, day: dt.date, generation: str) -> list[str]:
    """One day's snapshot, replaced as a whole, by nothing too."""
    return store.replace_range(table, new, day, day, generation)


def append(df: DataFrame, path: str, partition: str) -> None:
    """Add rows to a partitioned table; what is there is never touched."""
    df.write.mode("append").partitionBy(partition).parquet(path)


def export_slice(diary: DataFrame, path: str, observed_date: dt.date, account_id: int | None = None) -> None:
    """The rows of one observed day, of one account or of all, in a folder for each account."""
    rows = diary.where(F.col("observed_date") == F.lit(observed_date))
    if account_id is not None:
        rows = rows.where(F.col("account_id") == account_id)
    rows.hint("rebalance", "account_id").write.mode("overwrite").partitionBy("account_id", "observed_date").parquet(path)


def lay_out(df: DataFrame, path: str, partition: str, cluster: list[str]) -> None:
    """Write a table by day, rows of a file in the order of the cluster columns, so that readers skip by both.

    A heavy day is dealt over several tasks by its cluster columns.
    """
    df.repartition(partition, cluster[0]).sortWithinPartitions(partition, *cluster).write.mode("overwrite").partitionBy(partition).parquet(path)


def publish_guard(published: DataFrame, as_of: dt.date, override: bool = False) -> DataFrame:
    """May a run of this day replace what is published? Not if that is newer, unless told so."""
    newest = published.agg(F.max("as_of").alias("published_as_of"))
    older = F.coalesce(F.col("published_as_of") > F.lit(as_of), F.lit(False))
    return newest.select("published_as_of", F.lit(as_of).alias("run_as_of"), older.alias("is_older"), (~older | F.lit(override)).alias("may_publish"))


def expire(store: Generations, table: str, as_of: dt.date, reporting_days: int, generation: str, mode: str = "window") -> list[str]:
    """Days that retention drops: in window mode click days before the reporting window and one more; anything else is kept for good."""
    if mode != "window" or store.manifest()[table].day not in CLICK_DAYS:
        return []
    return store.expire(table, as_of - dt.timedelta(reporting_days + 1), generation)


def retention_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Tables whose days of retention differ from what they should be. A table that must never expire but does is refused."""
    a, b = expected.select("table_name", F.col("keep_days").alias("expected_days"), F.lit(1).alias("listed")), actual.select("table_name", F.col("keep_days").alias("actual_days"), F.lit(1).alias("there"))
    met = a.join(b, "table_name", "full")
    status = (
        F.when(F.col("there").isNull(), "no such table").when(F.col("listed").isNull(), "not listed").when(F.col("expected_days").eqNullSafe(F.col("actual_days")), "as expected")
        .when(F.col("expected_days").isNull(), "refused: must never expire").otherwise("differs"))
    return met.select("table_name", "expected_days", "actual_days", status.alias("status"))


def loss_preview(tables: dict[str, tuple[DataFrame, str]], cutoff: dt.date) -> DataFrame:
    """What an expiry at the cutoff would take from each table: days and rows before it, rows on it."""
    parts = []
    for name, (df, day) in tables.items():
        by = df.groupBy(F.col(day).alias("d")).agg(F.count("*").alias("n"))
        old = F.col("d") < F.lit(cutoff)
        parts.append(by.agg(F.min("d").alias("first_day"), F.count_if(old).alias("older_days"), F.coalesce(F.sum(F.when(old, F.col("n"))), F.lit(0)).alias("older_rows"), F.coalesce(F.sum(F.when(F.col("d") == F.lit(cutoff), F.col("n"))), F.lit(0)).alias("boundary_rows")).withColumn("table_name", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)
