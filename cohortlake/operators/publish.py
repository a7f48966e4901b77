"""Published tables: complete days of the reporting window, additive measures only, ratios as sum over sum."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.columns import ratio
from cohortlake.plans.params import Params

from .lag import CELL, COHORT_KEYS, SUMS
from .performance import BY_ACTION, NETWORK


def publish(facts: DataFrame, p: Params, dimensions: list[str], measures: list[str] = [*NETWORK, *BY_ACTION], day: str = "date") -> DataFrame:
    """Sums at the given dimensions over the last R complete days; array dimensions are grouped by their text."""
    window = facts.where(F.col(day).between(p.as_of - dt.timedelta(p.reporting_window_days), p.as_of - dt.timedelta(1)))
    kinds = dict(facts.dtypes)
    by = [F.array_join(c, ", ").alias(c) if kinds[c].startswith("array") else F.col(c) for c in dimensions]
    out = window.groupBy(*by).agg(*[F.sum(m).alias(m) for m in measures])
    return out.withColumns({"as_of": F.lit(p.as_of), "run_id": F.lit(p.run_id)})


def shown_cohorts(mart: DataFrame, p: Params, grain: str) -> DataFrame:
    """Cohort cells with a cost, on configured rungs and window rungs; the click day itself only for assets."""
    window = F.least("window_days", F.lit(p.reporting_window_days).cast("bigint"))
    day = F.col("cohort_day")
    shown = mart.where(F.col("click_day_cost").isNotNull() & (day <= window) & (day.isin(list(p.cohort_days)) | (F.col("is_window_rung") & (day == window))))
    return shown if grain == "asset" else shown.where(day > 0)


def publish_cohorts(mart: DataFrame, p: Params, grain: str) -> DataFrame:
    """The shown cells of the last complete click days, summed at the cohort's dimensions."""
    return publish(shown_cohorts(mart, p, grain), p, ["click_date", *COHORT_KEYS[grain], *CELL, "cohort_counting"], SUMS, "click_date")


def cohort_ratios(published: DataFrame, dimensions: list[str]) -> DataFrame:
    """CPA and ROAS of cohorts. Bases overlap and rungs are running sums, so both must be among the dimensions."""
    if not {"metric_basis", "cohort_day"} <= set(dimensions):
        raise ValueError("cohorts can't be added up over bases or rungs")
    s = published.groupBy(*dimensions).agg(*[F.sum(c).alias(c) for c in ("click_day_cost", "cohorted_conversions", "cohorted_value")])
    return s.select(*dimensions, ratio(F.col("click_day_cost"), F.col("cohorted_conversions")).alias("cpa"), ratio(F.col("cohorted_value"), F.col("click_day_cost")).alias("roas"))


def network_ratios(published: DataFrame, dimensions: list[str]) -> DataFrame:
    """CTR, CPA and ROAS at any dimensions, from sums."""
    s = published.groupBy(*dimensions).agg(*[F.sum(c).alias(c) for c in ("network_impressions", "network_clicks", "network_cost", "network_conversions", "network_conversions_value")])
    return s.select(
        *dimensions, ratio(F.col("network_clicks"), F.col("network_impressions")).alias("ctr"),
        ratio(F.col("network_cost"), F.col("network_conversions")).alias("cpa"), ratio(F.col("network_conversions_value"), F.col("network_cost")).alias("roas"),
    )
