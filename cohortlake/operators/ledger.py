"""State from event logs: the latest event of each key says what holds; and what remains to be fetched."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_events(events: DataFrame, keys: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return events.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def latest_run_state(runs: DataFrame) -> DataFrame:
    """The last event of each run; of simultaneous ones the exit."""
    return latest_events(runs, ["run_id"], [F.desc("event_ts"), F.when(F.col("event") == "EXITED", 0).otherwise(1), F.desc("event_id")])


def unfinished_runs(runs: DataFrame, since: dt.datetime) -> DataFrame:
    return latest_run_state(runs.where(F.col("event_ts") >= F.lit(since))).where("event = 'RUNNING'")


def latest_checkpoints(checkpoints: DataFrame) -> DataFrame:
    return latest_events(checkpoints, ["account_id", "chunk", "family", "query_hash"], [F.desc("event_ts"), F.desc("event_id")])


def chunk_bounds(chunks: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """First and last day of a month, within the fetched range."""
    return chunks.withColumns({"from_day": F.greatest("chunk", F.lit(start)), "to_day": F.least(F.last_day("chunk"), F.lit(end))})


def months(spark, start: dt.date, end: dt.date) -> DataFrame:
    """The first days of the months from start to end."""
    one = spark.range(1).select(F.trunc(F.lit(start), "MM").alias("a"), F.trunc(F.lit(end), "MM").alias("b"))
    return one.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("chunk"))


def pending_chunks(checkpoints: DataFrame, accounts: DataFrame, start: dt.date, run_day: dt.date, query_hash: str, families: list[str], wall_months: int = 37) -> DataFrame:
    """Months of each account that lack a family under the current hash and aren't behind the history wall."""
    spark = checkpoints.sparkSession
    wall = F.trunc(F.add_months(F.lit(run_day), -wall_months), "MM")
    chunks = months(spark, start, run_day).where(F.col("chunk") >= wall)
    have = latest_checkpoints(checkpoints).where((F.col("query_hash") == query_hash) & (F.col("event") == "DONE"))
    have = have.groupBy("account_id", "chunk").agg(F.collect_set("family").alias("have"))
    wanted = accounts.select("account_id").distinct().crossJoin(F.broadcast(chunks))  # months of a few years
    missing = F.array_except(F.array(*map(F.lit, sorted(families))), F.coalesce("have", F.array().cast("array<string>")))
    return wanted.join(have, ["account_id", "chunk"], "left").withColumn("missing", missing).where(F.size("missing") > 0).select("account_id", "chunk", F.array_join("missing", ",").alias("missing"))


def frozen_chunks(checkpoints: DataFrame, run_day: dt.date, wall_months: int = 37) -> DataFrame:
    """Months behind the history wall that were fetched: they can't be fetched again."""
    wall = F.trunc(F.add_months(F.lit(run_day), -wall_months), "MM")
    return latest_checkpoints(checkpoints).where((F.col("event") == "DONE") & (F.col("chunk") < wall)).select("account_id", "chunk").distinct()


def checkpoint_reset(checkpoints: DataFrame, stages: DataFrame, account_id: int, chunk: dt.date, run_id: str, at: str) -> tuple[DataFrame, DataFrame]:
    """Checkpoints without those of an account's month, under any hash, and the stages with an event that says so."""
    if chunk.day != 1:
        raise ValueError("a chunk is the first day of a month")
    hit = (F.col("account_id") == account_id) & (F.col("chunk") == F.lit(chunk))
    left = checkpoints.where(~F.coalesce(hit, F.lit(False)))
    event = checkpoints.where(hit).agg(F.count("*").alias("n")).select(
        F.lit(run_id).alias("run_id"), F.lit("checkpoint_reset").alias("stage"), F.lit("SUCCESS").alias("status"), F.lit(account_id).cast("bigint").alias("account_id"),
        F.concat(F.lit(chunk.strftime("%Y-%m: ")), F.col("n").cast("string")).alias("detail"), F.lit(at).cast("timestamp_ntz").alias("event_ts"))
    return left, stages.unionByName(event, allowMissingColumns=True)


def first_snapshot_rows(marks: DataFrame, runs: DataFrame, new: DataFrame) -> DataFrame:
    """Marks to add: accounts that no mark of a successful run names yet; the earliest of several new ones."""
    valid = marks.join(runs.where("status = 'SUCCESS'").select("run_id").distinct(), "run_id", "left_semi")
    fresh = new.join(valid.select("account_id").distinct(), "account_id", "left_anti")
    return fresh.groupBy("account_id").agg(F.min_by(F.struct("run_id", "first_snapshot_date"), F.struct("set_at", "run_id")).alias("m")).select("account_id", "m.*")


# A hash tree over texts: entries by the first digits of their digest, and ranges of those by fewer, up to one.
#: Digits of a range's name at each level, from the entries up. A parent has 256 ranges at most.
LEVELS = (6, 4, 2, 0)


def hash_entries(texts: DataFrame) -> DataFrame:
    """One row for each distinct (`name`, `text`): its `entry` digest, its `name`, and how often it is there as `n`. A null text is an empty one."""
    digest = F.sha2(F.concat(F.col("name"), F.lit("="), F.sha2(F.coalesce("text", F.lit("")), 256)), 256)
    return texts.select("name", digest.alias("entry")).groupBy("entry", "name").agg(F.count("*").alias("n"))


def hash_tree(entries: DataFrame) -> DataFrame:
    """(`level`, `range`, `digest`) of all ranges; the one of level 0 stands for everything.

    Entries are spread evenly by their digests, whatever their names are, so a task of the first level holds
    a sixteen-millionth of them at once, and of the others 256 digests. Texts never meet: only digests move.
    """
    now = entries.select(F.col("entry").alias("range"), F.concat("entry", F.lit(":"), F.col("n").cast("string")).alias("item"))
    parts = []
    for level in LEVELS:
        joined = F.array_join(F.array_sort(F.collect_list("item")), ";")
        made = now.groupBy(F.substring("range", 1, level).alias("range")).agg(F.sha2(joined, 256).alias("digest"))
        parts.append(made.select(F.lit(level).alias("level"), "range", "digest"))
        now = made.select("range", F.concat("range", F.lit(":"), "digest").alias("item"))
    return reduce(DataFrame.unionByName, parts)


def checkpoint_hash(texts: DataFrame, version: str) -> DataFrame:
    """A key over all texts with their names, in no order, and the version of the interface. No texts at all have a key too."""
    top = hash_tree(hash_entries(texts)).where("level = 0").agg(F.max("digest").alias("digest"))
    return top.select(F.sha2(F.concat(F.coalesce("digest", F.lit("")), F.lit("|" + version)), 256).alias("query_hash"))


def changed_texts(old: DataFrame, new: DataFrame, old_tree: DataFrame, new_tree: DataFrame) -> DataFrame:
    """(`name`, `change`) of texts that two states don't share: added, removed or changed.

    Goes down both trees and only into ranges whose digests differ; entries are looked up in those of the
    lowest level, and nothing else is compared. `old` and `new` are entries.
    """
    open_ = None
    for level in reversed(LEVELS):
        at = lambda t: t.where(F.col("level") == level).select("range", "digest")
        a, b = at(old_tree), at(new_tree).withColumnRenamed("digest", "other")
        both = a.join(b, "range", "full").where(~F.col("digest").eqNullSafe(F.col("other"))).select("range")
        if open_ is not None:
            both = both.withColumn("up", F.substring("range", 1, len_up)).join(open_.select(F.col("range").alias("up")), "up", "left_semi").select("range")
        open_, len_up = both, level
    within = lambda e: e.withColumn("range", F.substring("entry", 1, LEVELS[0])).join(open_, "range", "left_semi")
    gone, come = within(old).select("entry", "name", "n", F.lit(-1).alias("side")), within(new).select("entry", "name", "n", F.lit(1).alias("side"))
    moved = gone.unionByName(come).groupBy("name", "entry").agg(F.sum(F.col("n") * F.col("side")).alias("more")).where("more <> 0")
    sides = moved.groupBy("name").agg(F.min("more").alias("lost"), F.max("more").alias("found"))
    return sides.select("name", F.when(F.col("lost") > 0, "added").when(F.col("found") < 0, "removed").otherwise("changed").alias("change"))
