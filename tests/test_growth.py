"""Steps whose work must grow with their rows, told from their plans."""

import datetime as dt
import re

from cohortlake.operators import observation, performance, staging
from cohortlake.plans import queries
from cohortlake.plans.star import Star
from cohortlake.sources import adapter, observed

D = dt.date


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().lower()


def test_asof_looks_back_only(spark):
    """A frame from the current row to the end is worked out anew for every row: the square of a key's rows."""
    facts = spark.createDataFrame([(1, D(2024, 1, d)) for d in (1, 5, 9)] + [(2, D(2024, 1, 5))], "k int, date date")
    view = spark.createDataFrame([(1, D(2024, 1, 3), "x"), (1, D(2024, 1, 7), "y")], "k int, snapshot_date date, v string")
    out = performance.asof_else_earliest(facts, view, ["k"], {"v": "v"})
    assert "currentrow$(), unboundedfollowing$()" not in _plan(out).replace("\n", "")
    assert {(r.k, r.date.day, r.v) for r in out.collect()} == {(1, 1, "x"), (1, 5, "x"), (1, 9, "y"), (2, 5, None)}


def test_facts_of_few_accounts_are_not_dealt_by_account(spark):
    facts = spark.createDataFrame([(1, D(2024, 1, 5)), (None, D(2024, 1, 5))], "account_id long, date date")
    view = spark.createDataFrame([(1, D(2024, 1, 3), "EUR", "UTC")], "account_id long, snapshot_date date, currency_code string, time_zone string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = performance.with_customer(facts, view)
        assert "sortmergejoin" not in _plan(out)
        assert {(r.account_id, r.currency_code) for r in out.collect()} == {(1, "EUR"), (None, None)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_both_loads_come_from_one_grouping(spark):
    """Rows of even campaigns come twice, stale at first; the order lines are grouped once."""
    made = adapter.lines(spark, "/root/testdata/sf0.001")
    loads = adapter.landed(spark, "/root/testdata/sf0.001", "raw_volume_campaign", made)
    assert _plan(loads).count("exchange hashpartitioning(account_id") == 1
    both = {(r.campaign_id % 2, r.run_id) for r in loads.select("campaign_id", "run_id").distinct().collect()}
    assert both == {(0, "load-1"), (0, "load-2"), (1, "load-1")}


def test_key_checks_make_only_the_marts_that_they_read(spark):
    """Unique keys and nulls are asked of facts, entities and scores; cohort marts, which cost most, stay unmade."""
    star = Star(spark, "/root/testdata/sf0.001")
    asked = [queries.CHECKS[c](star) for c in ("unique_keys", "not_null")]
    assert not {key[0] for key in star._made} & {"prefixes", "cells", "cohorts", "observation_series", "cohort_series", "diary"}
    assert all(df.first().passed for df in asked)


def test_latest_rows_are_sorted_once(spark):
    """Nearly all rows are the last of their key, so cutting to the first ones before the rows are dealt sorts them twice for nothing."""
    df = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1), "r"), (1, "b", dt.datetime(2024, 1, 2), "r")], "k int, v string, loaded_at timestamp, run_id string")
    out = staging.latest_rows(df, ["k"])
    assert "windowgrouplimit" not in _plan(out) and [r.v for r in out.collect()] == ["b"]


def test_winning_runs_are_told_from_days(spark):
    """Which runs saw which accounts is told from the lines' days; neither facts are staged nor a diary written for a row for each account and day."""
    star = Star(spark, "/root/testdata/sf0.001")
    rows = lambda df: {tuple(r) for r in df.select("account_id", "observed_date", "run_id").collect()}
    won = rows(star.winners)
    assert {key[0] for key in star._made} == {"lines", "obs_stages", "winners"}
    assert rows(observed.visits(star.click_days)) == rows(star.diary())
    assert won == rows(observation.winning_runs(star.diary(), star.runs))


def test_the_diary_is_read_by_grain_and_not_written(spark):
    star = Star(spark, "/root/testdata/sf0.001")
    seen = star.selected("asset_group")
    assert {key[1] for key in star._made if key[0] == "stg"} == {"volume_asset_group", "conv_asset_group"} and ("diary",) not in star._made
    assert {r.grain for r in seen.select("grain").distinct().collect()} == {"asset_group"}


def test_series_are_named_without_entities(spark):
    """Series take the account's zone and the cost from their facts; the facts' entities and actions, looked up by far the most rows, aren't asked for."""
    star = Star(spark, "/root/testdata/sf0.001")
    keys = star.observation_keys
    assert not {key for key in star._made if key[0] in ("facts", "diary") or key[0] == "view" and key[1] != "customer"}
    assert "sortmergejoin" not in _plan(keys)
    assert keys.exceptAll(observation.keys(star.facts("asset"), star.facts("asset_group"), star.selected())).isEmpty()
    assert observation.keys(star.facts("asset"), star.facts("asset_group"), star.selected()).exceptAll(keys).isEmpty()


def test_landed_facts_are_written_only_where_asked_for(spark):
    star = Star(spark, "/root/testdata/sf0.001")
    once = star.staged("volume_campaign")
    assert ("raw", "volume_campaign") not in star._made
    other = Star(spark, "/root/testdata/sf0.001")
    again = (other.raw("volume_campaign"), other.staged("volume_campaign"))[1]
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()


def test_series_are_told_off_staged_rows(spark):
    """Every staged row brings its own readings: the same series as grouping facts and diary, and no row moves until somebody asks for a cost."""
    star = Star(spark, "/root/testdata/sf0.001")
    cells, told = star.observation_cells(), observation.told(star.packed("asset", "asset_group"))
    assert not re.search(r"hashpartitioning\([^)]*campaign_id", _plan(cells))
    assert not {key for key in star._made if key[0] in ("facts", "diary", "observation_series") and key[1:] != ("campaign",) and key[1:] != ("asset_group",)}
    costed = observation.told(star.packed("asset", "asset_group", costed=True)).where("grain = 'asset'")
    grouped = observation.series(star.facts("asset"), star.facts("asset_group"), star.selected())
    rows = lambda df, *more: df.select(*observation.KEY, "_seen", *more)
    for a, b in ((rows(told), rows(grouped)), (rows(costed, "click_day_cost"), rows(grouped.where("grain = 'asset'"), "click_day_cost"))):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_prior_rows_are_told_where_they_lie(spark):
    star = Star(spark, "/root/testdata/sf0.001")
    prior = queries._prior(star)
    assert not re.search(r"hashpartitioning\([^)]*campaign_id", _plan(prior))
    seen = star.selected().where(f"run_id <> '{queries.TODAY}' AND observed_date <= DATE '{queries.P.as_of}' AND click_date BETWEEN DATE '{queries.FROM}' AND DATE '{queries.P.as_of}' AND click_date < DATE '{queries.P.as_of}'")
    grouped = seen.where("coalesce(conversions, 0) <> 0 OR coalesce(conversions_value, 0) <> 0").groupBy(*observation.ROW).agg({"conversion_action_name": "min"})
    assert prior.exceptAll(grouped).isEmpty() and grouped.exceptAll(prior).isEmpty()


def test_checks_and_reports_make_only_the_grains_that_they_read(spark):
    """The first rungs are compared for asset groups; assets' facts and the as-of look-up of their entities are read by neither that nor the gap reports."""
    star = Star(spark, "/root/testdata/sf0.001")
    assert queries.CHECKS["cohort_observation_reconciliation"](star).first().passed is not None
    assert ("stg", "volume_asset", False) not in star._made
    star.cohorts("asset")
    assert ("facts", "asset") not in star._made
