"""Figures on the health of a run's tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlake.plans.params import Params

from .checks import _union, paired
from .performance import COUNTS


def cells_of(marts: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Cells of all cohort marts with their grain; columns that a mart lacks are null."""
    out = []
    for grain, df in marts.items():
        kinds = {"asset_group_id": "bigint", "asset_id": "bigint"}
        out.append(df.select(F.lit(grain).alias("grain"), *[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in columns]))
    return _union(out)


def assumed_current(marts: dict[str, DataFrame]) -> DataFrame:
    """Share of each account's cells whose window is assumed."""
    out = cells_of(marts, ["account_id", "window_provenance"]).groupBy("account_id").agg(F.count_if(F.col("window_provenance") == "assumed-current").alias("assumed_cells"), F.count("*").alias("total_cells"))
    return out.withColumn("share", F.col("assumed_cells") / F.col("total_cells"))


def participation(asset: DataFrame, truth: DataFrame, p: Params) -> DataFrame:
    """What assets took part in against what campaigns had, by account, network and metric, on the last day."""
    keys, named = ["account_id", "ad_network_type"], [f"network_{c}" for c in COUNTS]
    day = F.col("date") == F.lit(p.as_of)
    met = paired(asset.where(day & (F.col("metric_basis") == "NETWORK")).select(*keys, *named), truth.where(day).select(*keys, *named), keys, named)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"a_network_{c}").alias("asset_sum"), F.col(f"b_network_{c}").alias("campaign_truth")) for c in COUNTS])).alias("r")
    return met.select(*keys, rows).select(*keys, "r.*").withColumn("ratio", F.try_divide("asset_sum", "campaign_truth"))


def unknown_lag(campaign: DataFrame) -> DataFrame:
    """Share of conversions whose lag isn't known, by account and basis."""
    both = F.sum(F.col("unknown_lag_conversions") + F.col("cohorted_conversions"))
    return campaign.groupBy("account_id", "metric_basis").agg(F.try_divide(F.sum("unknown_lag_conversions"), both).alias("share"))


def coverage(marts: dict[str, DataFrame]) -> DataFrame:
    """Cells by provenance and maturity, with their share of all; the window runs over the few groups only."""
    out = cells_of(marts, ["provenance", "maturity"]).groupBy("provenance", "maturity").agg(F.count("*").alias("cell_count"))
    total = F.sum("cell_count").over(Window.partitionBy(F.lit(1)))
    return out.withColumns({"total_cells": total, "share": F.col("cell_count") / total})


_EXAMPLE = ["click_date", "account_id", "campaign_id", "asset_group_id", "asset_id", "metric_basis", "cohort_day"]


def issues(marts: dict[str, DataFrame]) -> DataFrame:
    """Each cell once for each thing that is wrong with it: no answer, a late one, no cost."""
    cells = cells_of(marts, [*_EXAMPLE, "maturity", "unavailable_reason", "provenance", "missing_cost_cell_count", "stale_cell_count"])
    kind = lambda hit, name, why: F.when(hit, F.struct(F.lit(name).alias("category"), why.alias("reason")))
    three = F.array(
        kind(F.col("unavailable_reason").isNotNull(), "snapshot gap", F.col("unavailable_reason")),
        kind((F.col("stale_cell_count") > 0) & ~F.col("provenance").eqNullSafe(F.lit("unavailable")), "stale cell", F.lit("stale observation")),
        kind(F.col("missing_cost_cell_count") > 0, "NULL-cost cell", F.lit("missing cost")),
    )
    return cells.select("grain", *_EXAMPLE, "maturity", F.explode(F.array_compact(three)).alias("i")).select("grain", *_EXAMPLE, "maturity", "i.*")


def gap_summary(found: DataFrame) -> DataFrame:
    return found.groupBy("category", "grain", "reason", F.trunc("click_date", "MM").alias("month")).agg(F.count("*").alias("cells"))


def gap_examples(found: DataFrame, most: int = 50) -> DataFrame:
    """The first issues in a total order, as many as a report shows."""
    order = ["click_date", "account_id", "campaign_id", "grain", "asset_group_id", "asset_id", "metric_basis", "cohort_day", "category", "reason"]
    return found.where("category <> 'NULL-cost cell'").orderBy(*order).limit(most)


def store_results(results: DataFrame, path: str, run_id: str) -> None:
    """Append a run's assertion results to the table of all runs, in a folder of its own."""
    results.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def read_results(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """A run's assertion results as they were stored: failures first, hard ones before soft ones."""
    return spark.read.parquet(path).where(F.col("run_id") == run_id).orderBy("passed", "severity", "assertion")


def parity_event(compared: DataFrame, run_day: dt.date, query: str, at: str) -> DataFrame:
    """What a parity run leaves in the stage table: whether all keys that can be compared match, with the counts, as JSON."""
    bad = ~F.col("status").isin("matched", "no comparable score")
    counts = compared.agg(F.count("*").alias("compared"), F.count_if(bad).alias("off"))
    detail = F.to_json(F.struct(F.lit(str(run_day)).alias("date"), (F.col("off") == 0).alias("passed"), F.sha2(F.lit(query), 256).alias("query_hash"), "compared", "off"))
    return counts.select(F.lit("parity").alias("stage"), detail.alias("detail"), F.lit(at).cast("timestamp_ntz").alias("event_ts"))


def latest_parity(stages: DataFrame) -> DataFrame:
    """What the last parity run said: its detail, read as JSON."""
    last = stages.where("stage = 'parity' AND detail IS NOT NULL").orderBy(F.desc("event_ts")).limit(1)
    d = F.from_json("detail", "date string, passed boolean, query_hash string")
    return last.select(d.alias("d")).select(F.to_date("d.date").alias("run_date"), F.when(F.col("d.passed"), "PASS").otherwise("FAIL").alias("result"), F.coalesce("d.query_hash", F.lit("unknown")).alias("query_hash"))


def differs(a: Column, b: Column, absolute: float, relative: float) -> Column:
    """Do two sums differ? By more than both tolerances allow, or by what is null, not a number or infinite on one side only."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(odd(a) | odd(b), ~a.eqNullSafe(b)).otherwise(F.abs(a - b) > F.greatest(F.lit(absolute), F.abs(a) * relative))


def publish_reconcile(mart: DataFrame, published: DataFrame, p: Params, measures: list[str], absolute: float = 1e-6, relative: float = 1e-9) -> DataFrame:
    """Mart against published sums by day of the published window."""
    window = F.col("date").between(p.as_of - dt.timedelta(p.reporting_window_days), p.as_of - dt.timedelta(1))
    sums = lambda df, s: df.groupBy("date").agg(*[F.sum(m).cast("double").alias(f"{m}_{s}") for m in measures])
    met = sums(mart.where(window), "mart").join(sums(published, "published"), "date", "full")
    return met.withColumn("differs", reduce(lambda x, y: x | y, (differs(F.col(f"{m}_mart"), F.col(f"{m}_published"), absolute, relative) for m in measures)))


def reconcile_published(tables: dict[str, tuple[DataFrame, DataFrame, str, list[str]]], p: Params, absolute: float = 1e-6, relative: float = 1e-9) -> DataFrame:
    """Every published table against its mart: a row for each table, day and measure. Tables come as (mart, published, day column, measures)."""
    parts = []
    for name, (mart, published, day, measures) in tables.items():
        window = F.col(day).between(p.as_of - dt.timedelta(p.reporting_window_days), p.as_of - dt.timedelta(1))
        for df, side in ((mart.where(window), "mart"), (published, "published")):
            long = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures])).alias("x")
            by_day = df.groupBy(F.col(day).alias("day")).agg(*[F.sum(m).cast("double").alias(m) for m in measures])
            parts.append(by_day.select(F.lit(name).alias("table_name"), "day", long, F.lit(side).alias("side")).select("table_name", "day", "x.*", "side"))
    one = lambda s: F.max(F.when(F.col("side") == s, F.col("value")))
    met = reduce(DataFrame.unionByName, parts).groupBy("table_name", "day", "measure").agg(one("mart").alias("mart_value"), one("published").alias("published_value"))
    return met.withColumn("differs", differs(F.col("mart_value"), F.col("published_value"), absolute, relative))


def month_stability(before: DataFrame, after: DataFrame, cutoff) -> DataFrame:
    """Rows and cost of each month before and after a change; a month that the cutoff lies in is for review, earlier ones should stand."""
    sums = lambda df, s: df.groupBy(F.trunc("date", "MM").alias("month")).agg(F.count("*").alias(f"rows_{s}"), F.sum("cost_micros").alias(f"cost_{s}"))
    met = sums(before, "before").join(sums(after, "after"), "month", "full").fillna(0)
    last = F.last_day("month")
    say = F.when((F.col("month") <= F.lit(cutoff)) & (last >= F.lit(cutoff)), "review").when((F.col("rows_before") == F.col("rows_after")) & (F.col("cost_before") == F.col("cost_after")), "stable").otherwise("changed")
    return met.withColumns({"rows_delta": F.col("rows_after") - F.col("rows_before"), "cost_delta": F.col("cost_after") - F.col("cost_before"), "verdict": say})


def table_reconcile(tables: dict[str, tuple[DataFrame, str, str]], cutoff) -> DataFrame:
    """First day, rows and a sum of what lies before the cutoff, by table and counting."""
    parts = []
    for name, (df, day, measure) in tables.items():
        tag = F.col("cohort_counting") if "cohort_counting" in df.columns else F.lit("none")
        old = df.where(F.col(day) < F.lit(cutoff))
        parts.append(old.groupBy(F.lit(name).alias("table_name"), tag.alias("counting")).agg(F.min(day).alias("first_day"), F.count("*").alias("n"), F.sum(measure).cast("double").alias("total")))
    return _union(parts)
