"""Series of the observation diary: what they hold, and that their rows are moved once."""

import datetime as dt
import re

from pyspark.sql import functions as F

from cohortlake.operators import observation, performance
from cohortlake.plans.params import Params

D = dt.date
P = Params(as_of=D(2024, 3, 10), cohort_days=(0, 1, 3))
_DIARY = "run_id string, observed_date date, account_id long, click_date date, grain string, campaign_id long, asset_group_id long, asset_id long, field_type string, ad_network_type string, metric_basis string, conversion_action string, conversion_action_name string, conversions double, conversions_value double"
_FACT = "date date, account_id long, campaign_id long, asset_group_id long, asset_id long, field_type string, ad_network_type string, metric_basis string, conversion_action_id long, conversion_action_resource_name string, conversion_action_name string, time_zone string"


def _moved(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _tables(spark):
    seen = lambda run, day, n: (run, D(2024, 3, day), 1, D(2024, 3, 1), "asset", 5, 6, 7, "LOGO", None, "PRIMARY", None, None, n, 2 * n)
    other = ("b", D(2024, 3, 3), 1, D(2024, 3, 1), "asset", 5, 6, 8, "LOGO", "SEARCH", "CONVERSION_ACTION", "c/4", "Four", 9.0, 9.0)
    diary = spark.createDataFrame([seen("a", 2, 1.0), seen("b", 3, 2.0), seen("c", 5, 3.0), seen("x", 5, 8.0), other], _DIARY)
    stages = spark.createDataFrame([(r, None, "observe", "FAILED" if r == "x" else "SUCCESS") for r in "abcx"], "run_id string, account_id long, stage string, status string")
    asset = spark.createDataFrame([(D(2024, 3, 1), 1, 5, 6, 7, "LOGO", None, "NETWORK", None, None, None, "UTC")], _FACT)
    windows = spark.createDataFrame([(D(2024, 3, 1), 1, "PRIMARY", None, 5, "observed"), (D(2024, 3, 1), 1, "CONVERSION_ACTION", "c/4", 3, "observed")], "click_date date, account_id long, metric_basis string, conversion_action_resource_name string, window_days long, window_provenance string")
    return diary, stages, asset, asset.limit(0), windows


def test_series_bring_their_readings_and_rungs(spark):
    diary, stages, asset, none, windows = _tables(spark)
    winners = observation.winning_runs(diary, stages)
    chosen = observation.selected(diary, winners)
    series = observation.series(asset, none, chosen)
    # Of fact and observations: PRIMARY with three readings, ALL_CONVERSIONS with none, and the action that only the diary has.
    assert {(r.asset_id, r.metric_basis, r.time_zone, tuple(x.run_id for x in r._seen)) for r in series.collect()} == {(7, "PRIMARY", "UTC", ("c", "b", "a")), (7, "ALL_CONVERSIONS", "UTC", ()), (8, "CONVERSION_ACTION", "UTC", ("b",))}
    bounds = observation.account_bounds(winners, P)
    got = observation.asof_reading(observation.bounded(series, windows, bounds), P)
    assert {(r.asset_id, r.cohort_day, r.is_window_rung, r.target_date.day, r.source_run_id, r.conversions) for r in got.collect()} == {
        (7, 0, False, 2, "a", 1.0), (7, 1, False, 3, "b", 2.0), (7, 3, False, 5, "c", 3.0), (8, 0, False, 2, None, None), (8, 1, False, 3, "b", 9.0), (8, 3, True, 5, "b", 9.0)}
    steps = observation.ladder(observation.keys(asset, none, chosen), windows, bounds, P)
    cols = ["asset_id", "cohort_day", "is_window_rung", "target_date"]
    assert {tuple(r) for r in steps.select(*cols).collect()} == {tuple(r) for r in got.select(*cols).collect()}


def test_rows_of_the_diary_are_not_dealt_by_account(spark):
    """However large the tables look to the planner, the diary and the series stay in place when they meet accounts and windows."""
    diary, stages, asset, none, windows = _tables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        winners = spark.createDataFrame([(1, D(2024, 3, 5), "c")], "account_id long, observed_date date, run_id string")
        assert _moved(observation.selected(diary, winners)) == 0
        bounds = spark.createDataFrame([(1, D(2024, 3, 5))], "account_id long, latest_observed_date date")
        keys = observation.keys(asset, none, diary.limit(0)).localCheckpoint()
        assert _moved(observation.ladder(keys, windows, bounds, P)) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_series_bring_the_cost_of_their_click_day(spark):
    """The cost comes with the grouping that makes the series: the same as joining it, for every basis and action, and no join of large tables."""
    diary, stages, asset, none, _ = _tables(spark)
    rows = asset.unionByName(asset.withColumns({"metric_basis": F.lit("CONVERSION_ACTION"), "conversion_action_id": F.lit(4).cast("bigint"), "conversion_action_resource_name": F.lit("c/4"), "conversion_action_name": F.lit("Four")}))
    rows = rows.withColumn("network_cost", F.when(F.col("metric_basis") == "NETWORK", F.lit("2.5")).cast("decimal(38,9)"))
    chosen = observation.selected(diary, observation.winning_runs(diary, stages))
    found = observation.series(rows, none, chosen)
    keys = performance.GRAIN_KEYS["asset"]
    joined = performance.add_cost(found.drop("click_day_cost"), rows, keys)
    cost = lambda df: {(r.asset_id, r.metric_basis, None if r.click_day_cost is None else float(r.click_day_cost)) for r in df.collect()}
    assert cost(found) == cost(joined) == {(7, "PRIMARY", 2.5), (7, "ALL_CONVERSIONS", 2.5), (7, "CONVERSION_ACTION", 2.5), (8, "CONVERSION_ACTION", None)}
    plan = observation.series(rows, none, chosen)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*campaign_id", plan)) == 1
