"""Lookback windows: how long after a click each conversion action still counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.columns import action_id

from .performance import asof_else_earliest

KEY = ["click_date", "account_id", "conversion_action_resource_name", "conversion_action_id"]


def _lag_keys(lag: DataFrame) -> DataFrame:
    return lag.select(
        F.col("date").alias("click_date"), "account_id", F.col("conversion_action").alias("conversion_action_resource_name"),
        action_id(F.col("conversion_action")).alias("conversion_action_id"), "conversions",
    )


def action_keys(conv: DataFrame, lag: DataFrame) -> DataFrame:
    """Every (click day, account, action) that the staged action facts or lag buckets of campaigns have."""
    return _lag_keys(conv).select(*KEY).unionByName(_lag_keys(lag).select(*KEY)).distinct()


def primary_evidence(conv: DataFrame, lag: DataFrame) -> DataFrame:
    """Whether an action has conversions in the primary metric on a click day, in either source."""
    rows = _lag_keys(conv).unionByName(_lag_keys(lag))
    return rows.groupBy(*KEY).agg((F.count_if(F.coalesce("conversions", F.lit(0.0)) != 0) > 0).alias("has_primary_conversions"))


def account_default(actions: DataFrame) -> DataFrame:
    return actions.groupBy("account_id").agg(F.max("click_through_lookback_window_days").alias("default_window_days"))


def chosen_windows(conv: DataFrame, lag: DataFrame, actions: DataFrame) -> DataFrame:
    """The window of each key: of the action's snapshot as of the click day, else of its first later one, else the account's."""
    evidence = primary_evidence(conv, lag)  # one row for each key
    columns = {"click_through_lookback_window_days": "_window", "include_in_conversions_metric": "include_in_conversions_metric", "snapshot_date": "_snapshot"}
    out = asof_else_earliest(evidence, actions.where("NOT inferred_removed"), ["account_id", "conversion_action_id"], columns, "click_date")
    out = out.join(account_default(actions), "account_id", "left")
    return out.select(
        *KEY, F.coalesce("_window", "default_window_days").alias("window_days"),
        F.when(F.col("_snapshot") <= F.col("click_date"), "observed").otherwise("assumed-current").alias("window_provenance"),
        # Three-valued on purpose: a null flag without evidence stays null.
        (F.col("include_in_conversions_metric") | F.col("has_primary_conversions")).alias("is_primary"),
    )


def aggregate_windows(chosen: DataFrame) -> DataFrame:
    """The windows of the two sums over actions: of primary actions, if there are any, and of all."""
    primary, assumed = F.col("is_primary"), F.col("window_provenance") == "assumed-current"
    wide = chosen.groupBy("click_date", "account_id").agg(
        F.max(F.when(primary, F.col("window_days"))).alias("p_days"), F.count_if(primary & assumed).alias("p_assumed"), F.count_if(primary).alias("p_n"),
        F.max("window_days").alias("a_days"), F.count_if(assumed).alias("a_assumed"),
    )
    told = lambda n: F.when(F.col(n) > 0, "assumed-current").otherwise("observed")
    rows = F.array(
        F.struct(F.lit("PRIMARY").alias("metric_basis"), F.col("p_days").alias("window_days"), told("p_assumed").alias("window_provenance"), (F.col("p_n") > 0).alias("ok")),
        F.struct(F.lit("ALL_CONVERSIONS").alias("metric_basis"), F.col("a_days").alias("window_days"), told("a_assumed").alias("window_provenance"), F.lit(True).alias("ok")),
    )
    out = wide.select("click_date", "account_id", F.explode(rows).alias("r")).where("r.ok")
    return out.select("click_date", "account_id", "r.metric_basis", "r.window_days", "r.window_provenance")


def lookback_windows(chosen: DataFrame) -> DataFrame:
    by_action = chosen.withColumn("metric_basis", F.lit("CONVERSION_ACTION"))
    sums = aggregate_windows(chosen).withColumns({
        "conversion_action_resource_name": F.lit(None).cast("string"), "conversion_action_id": F.lit(None).cast("bigint"), "is_primary": F.lit(None).cast("boolean"),
    })
    return by_action.unionByName(sums)
