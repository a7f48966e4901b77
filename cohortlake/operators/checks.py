"""Assertions and health figures over finished tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.columns import null_safe_join
from cohortlake.plans.params import BOUNDARY_DAYS, Params  # noqa: F401

from .lag import CAPPED, SERIES
from .performance import COUNTS


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def assertion(observed: DataFrame, detail: str) -> DataFrame:
    """One result row from a table whose single row has `observed`; it passes at zero."""
    return observed.select((F.col("observed") == 0).alias("passed"), F.col("observed").cast("string").alias("observed"), F.lit("0").alias("expected"), F.lit(detail).alias("detail"))


def unique_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """How many keys occur more than once, over all tables."""
    parts = [df.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("n")) for df, keys in tables.values()]
    return assertion(_union(parts).agg(F.sum("n").alias("observed")), "duplicate keys")


def not_null(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """How many rows have a null in a column that must not have one."""
    parts = [df.agg(F.count_if(reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))).alias("n")) for df, keys in tables.values()]
    return assertion(_union(parts).agg(F.sum("n").alias("observed")), "null keys")


def family_coherence(facts: DataFrame, histories: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Click days on which a network total and the sum over actions differ, and entity keys both observed and removed on a day."""
    pairs = [F.abs(F.coalesce(f"n_{c}", F.lit(0.0)) - F.coalesce(f"a_{c}", F.lit(0.0))) > 1e-9 for c in COUNTS]
    sums = [F.sum(f"{family}_{c}").alias(f"{family[0]}_{c}") for c in COUNTS for family in ("network", "action")]
    by = facts.groupBy("date", "account_id", "campaign_id").agg(*sums)
    parts = [by.agg(F.count_if(reduce(lambda a, b: a | b, pairs)).alias("n"))]
    for df, keys in histories.values():
        both = df.groupBy(*keys, "snapshot_date").agg(F.count_if("inferred_removed").alias("gone"), F.count_if(~F.col("inferred_removed")).alias("seen"))
        parts.append(both.where("gone > 0 AND seen > 0").agg(F.count("*").alias("n")))
    return assertion(_union(parts).agg(F.sum("n").alias("observed")), "campaign days whose families differ")


def freshness(tables: dict[str, tuple[DataFrame, str]], expected: str) -> DataFrame:
    """Rows and last day of each table, and whether it lags behind the expected day."""
    parts = [df.agg(F.count("*").alias("n"), F.max(day).alias("last_day")).select(F.lit(name).alias("table_name"), "n", "last_day") for name, (df, day) in tables.items()]
    return _union(parts).withColumn("stale", F.coalesce(F.col("last_day") < F.lit(expected).cast("date"), F.lit(True)))


def paired(left: DataFrame, right: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Both tables' sums by key, side by side as `a_` and `b_`; a key of one side only counts zero on the other.

    A union and one grouping instead of a full join: null keys meet, and one shuffle does.
    """
    side = lambda df, mine, other: df.select(*keys, *[F.col(m).alias(f"{mine}_{m}") for m in measures], *[F.lit(None).cast(dict(df.dtypes)[m]).alias(f"{other}_{m}") for m in measures])
    both = side(left, "a", "b").unionByName(side(right, "b", "a"))
    return both.groupBy(*keys).agg(*[F.coalesce(F.sum(f"{x}_{m}"), F.lit(0)).alias(f"{x}_{m}") for m in measures for x in "ab"])


def apart(m: str, relative: float = 0.0, least: float = 1e-9):
    """Do the sides differ by more than a share of the second, or a hair?"""
    return F.abs(F.col(f"a_{m}") - F.col(f"b_{m}")) > F.greatest(F.abs(F.col(f"b_{m}")) * relative, F.lit(least))


def any_of(tests):
    return reduce(lambda a, b: a | b, tests)


def cohort_integrity(marts: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Duplicate cells, and marts with a null where none may be; maturity may be null only where there is no answer."""
    parts = []
    for df, keys in marts.values():
        grain = ["click_date", *keys, "ad_network_type", "metric_basis", "conversion_action_resource_name", "cohort_day"]
        parts.append(df.groupBy(*grain).count().where("count > 1").agg(F.count("*").alias("n")))
        bad = any_of([F.col(c).isNull() for c in [*keys, "metric_basis", "cohort_day", "provenance", "cohort_counting"]] + [F.col("maturity").isNull() & (F.col("provenance") != "unavailable")])
        parts.append(df.agg((F.count_if(bad) > 0).cast("bigint").alias("n")))
    return assertion(_union(parts).agg(F.sum("n").alias("observed")), "cohort cells twice or without a key")


def observation_reconciliation(cells: DataFrame, lag_mart: DataFrame, p: Params, tolerance: float) -> DataFrame:
    """A rung of k days observed against the lag rung of k + 1, for asset groups; keys without an observation are left out.

    The first pair must agree; how many of the deeper ones differ is only told. Without a pair in the ladder, nothing is said.
    """
    pairs = sorted(d for d in p.cohort_days if d + 1 in p.cohort_days)
    if not pairs:
        return cells.sparkSession.range(1).select(F.lit(None).cast("boolean").alias("passed"), F.lit("0").alias("observed"), F.lit("0").alias("expected"), F.lit("no pair of rungs").alias("detail"))
    keys = [*[k for k in SERIES if k != "grain"], "cohort_day"]
    since = F.date_sub(F.lit(p.as_of), min(p.window_days, max(p.cohort_days) + 1))
    rows = cells.where((F.col("click_date") >= since) & (F.col("click_date") <= F.lit(p.as_of)) & (F.col("grain") == "asset_group") & F.col("cohort_day").isin(pairs))
    has = F.col("provenance").isin("measured", "carried")
    seen = rows.where(has).select(*keys, "cohorted_conversions", "cohorted_value")
    dark = rows.where("provenance = 'unavailable'").select(*keys).distinct()
    lagged = lag_mart.where((F.col("click_date") >= since) & (F.col("click_date") <= F.lit(p.as_of)) & F.col("cohort_day").isin([d + 1 for d in pairs]) & has)
    lagged = lagged.withColumn("cohort_day", F.col("cohort_day") - 1).select(*keys, "cohorted_conversions", "cohorted_value")
    met = null_safe_join(paired(seen, lagged, keys, ["cohorted_conversions", "cohorted_value"]), dark, keys, "left_anti")
    differs = any_of([F.abs(F.col(f"a_{m}") - F.col(f"b_{m}")) > tolerance for m in ("cohorted_conversions", "cohorted_value")])
    return met.agg((F.count_if((F.col("cohort_day") == 0) & differs) == 0).alias("passed"), F.count_if((F.col("cohort_day") > 0) & differs).cast("string").alias("observed")).select("passed", "observed", F.lit("0").alias("expected"), F.lit("first pair must agree").alias("detail"))


def row_count_floor(truth: DataFrame, staged: DataFrame) -> DataFrame:
    """Days on which the truth has not as many rows as staging."""
    one = lambda df: df.select("date", F.lit(1).alias("n"))
    met = paired(one(truth), one(staged), ["date"], ["n"])
    return assertion(met.agg(F.count_if(F.col("a_n") != F.col("b_n")).alias("observed")), "days whose rows differ")


def asset_not_over_campaign(asset: DataFrame, truth: DataFrame, p: Params) -> DataFrame:
    """Campaign networks of the last day with an asset credited more than all of it."""
    keys, named = ["date", "account_id", "campaign_id", "ad_network_type"], [f"network_{c}" for c in COUNTS]
    day = F.col("date") == F.lit(p.as_of)
    top = asset.where(day & (F.col("metric_basis") == "NETWORK")).groupBy(*keys).agg(*[F.max(c).alias(c) for c in named])
    met = paired(top, truth.where(day).select(*keys, *named), keys, named)
    over = any_of([F.col(f"a_{c}") > F.col(f"b_{c}") + F.greatest(F.abs(F.col(f"b_{c}")) * p.tolerances["asset"], F.lit(1e-9)) for c in named])
    return assertion(met.agg(F.count_if(over).alias("observed")), "assets credited above their campaign")


def campaign_reconciliation(facts: DataFrame, truth: DataFrame, p: Params) -> DataFrame:
    """Campaign networks of the last day on which mart and truth differ: counts at all, cost by a micro, conversions beyond tolerance."""
    keys, named = ["date", "account_id", "campaign_id", "ad_network_type"], [f"network_{c}" for c in COUNTS]
    whole = ["network_impressions", "network_clicks"]
    pick = lambda df: df.where(F.col("date") == F.lit(p.as_of)).select(*keys, *whole, "network_cost", *named)
    met = paired(pick(facts.where("metric_basis = 'NETWORK'")), pick(truth), keys, [*whole, "network_cost", *named])
    bad = [F.col(f"a_{c}") != F.col(f"b_{c}") for c in whole] + [F.abs(F.col("a_network_cost") - F.col("b_network_cost")) > F.lit("0.000001").cast("decimal(38,9)")] + [apart(c, p.tolerances["campaign"]) for c in named]
    return assertion(met.agg(F.count_if(any_of(bad)).alias("observed")), "campaign networks that differ")


def cross_grain_identity(campaign: DataFrame, asset_group: DataFrame, p: Params) -> DataFrame:
    """Cohort cells of campaigns that their asset groups' cells don't add up to."""
    keys = ["click_date", "account_id", "campaign_id", "ad_network_type", "metric_basis", "conversion_action_resource_name", "cohort_day"]
    named = ["cohorted_conversions", "cohorted_value", "unknown_lag_conversions", "unknown_lag_value"]
    since = F.col("click_date").between(F.date_sub(F.lit(p.as_of), max(p.cohort_days)), F.lit(p.as_of))
    met = paired(campaign.where(since), asset_group.where(since), keys, named)
    bad = any_of([F.abs(F.col(f"a_{m}") - F.col(f"b_{m}")) > p.tolerances["grain"] for m in named])
    return assertion(met.agg(F.count_if(bad).alias("observed")), "cohort cells that differ between grains")


def cohort_reconciliation(marts: dict[str, DataFrame], facts: dict[str, DataFrame], basis: DataFrame, p: Params) -> DataFrame:
    """Window rungs with unknown lags against performance; capped ones against their buckets, summed anew; those without an answer are left out."""
    none = F.lit(None)
    since = lambda c: F.col(c).between(F.date_sub(F.lit(p.as_of), max(p.cohort_days)), F.lit(p.as_of))
    want, have = [], []
    for grain, df in facts.items():
        group = F.col("asset_group_id") if grain == "asset_group" else none.cast("bigint")
        net = F.array(*[F.struct(F.lit(b).alias("metric_basis"), F.col(f"network_{x}conversions").alias("p"), F.col(f"network_{x}conversions_value").alias("pv")) for b, x in (("PRIMARY", ""), ("ALL_CONVERSIONS", "all_"))])
        act = F.array(F.struct(F.lit("CONVERSION_ACTION").alias("metric_basis"), F.col("action_conversions").alias("p"), F.col("action_conversions_value").alias("pv")))
        rows = df.where(since("date")).select(
            F.lit(grain).alias("grain"), F.col("date").alias("click_date"), "account_id", "campaign_id", group.alias("asset_group_id"), "ad_network_type",
            F.when(F.col("metric_basis") == "CONVERSION_ACTION", F.col("conversion_action_resource_name")).alias("conversion_action_resource_name"), F.explode(F.when(F.col("metric_basis") == "NETWORK", net).otherwise(act)).alias("b"))
        want.append(rows.select("*", "b.*").drop("b").select(*SERIES, F.lit(1).alias("p_n"), "p", "pv"))
        cells = marts[grain].where(since("click_date") & F.col("is_window_rung"))
        capped, dark = F.col("window_provenance").eqNullSafe(F.lit(CAPPED)), F.col("provenance").eqNullSafe(F.lit("unavailable"))
        c, v = F.col("cohorted_conversions") + F.col("unknown_lag_conversions"), F.col("cohorted_value") + F.col("unknown_lag_value")
        own, cut = ~dark & ~capped, ~dark & capped
        have.append(cells.withColumns({"grain": F.lit(grain), "asset_group_id": group}).select(
            *SERIES, F.when(own, c).alias("c"), F.when(own, v).alias("cv"), F.when(cut, c).alias("k"), F.when(cut, v).alias("kv"), own.cast("int").alias("own"), cut.cast("int").alias("cut"), dark.cast("int").alias("dark")))
    within = F.col("upper_day").isNull() | (F.col("upper_day") <= F.least(F.lit(p.reporting_window_days), F.col("action_window_days")))
    buckets = basis.where(since("click_date")).select(*SERIES, F.when(within, F.col("conversions")).otherwise(0.0).alias("b"), F.when(within, F.col("conversions_value")).otherwise(0.0).alias("bv"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*want, *have, buckets])
    met = rows.groupBy(*SERIES).agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("p_n", "p", "pv", "c", "cv", "k", "kv", "b", "bv", "own", "cut", "dark")])
    met = met.where("p_n + own + cut + dark > 0")
    off = lambda x, y: F.abs(F.col(x) - F.col(y)) > F.greatest(F.abs(F.col(y)) * p.tolerances["campaign"], F.lit(1e-9))
    bad = (((F.col("own") > 0) | (F.col("dark") + F.col("cut") == 0)) & (off("c", "p") | off("cv", "pv"))) | ((F.col("cut") > 0) & (off("k", "b") | off("kv", "bv")))
    told = F.concat(F.lit("window cells without an answer: "), F.coalesce(F.sum("dark"), F.lit(0)).cast("string"))
    return met.agg((F.count_if(bad) == 0).alias("passed"), F.count_if(bad).cast("string").alias("observed"), F.lit("0").alias("expected"), told.alias("detail"))


def required_nonempty(tables: dict[str, DataFrame], customers: DataFrame, campaigns: DataFrame, marks: DataFrame, p: Params) -> DataFrame:
    """Required tables without rows; on a day on which every account is seen for the first time, none is required."""
    counts = _union([df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t, df in tables.items()])
    first = marks.where(F.col("first_snapshot_date") == F.lit(p.as_of)).select("account_id", F.lit(1).alias("new")).distinct()
    state = customers.select("account_id").distinct().join(first, "account_id", "left").agg(F.count("*").alias("accounts"), F.count("new").alias("new"))
    start = campaigns.agg(F.min("first_seen_date").alias("start"))
    spared = (F.col("accounts") > 0) & (F.col("new") == F.col("accounts")) & (F.col("start") >= F.lit(p.window_start))
    empty = counts.crossJoin(state).crossJoin(start).where((F.col("n") == 0) & ~F.coalesce(spared, F.lit(False)))  # one row each
    names = F.array_join(F.array_sort(F.collect_list("table_name")), ", ")
    told = F.when(F.count("*") > 0, F.concat(F.lit("empty: "), names)).otherwise("none is empty")
    return empty.agg((F.count("*") == 0).alias("passed"), F.count("*").cast("string").alias("observed"), F.lit("0").alias("expected"), told.alias("detail"))


def zero_cost(campaigns: DataFrame, truth: DataFrame, p: Params) -> DataFrame:
    """Enabled campaigns with a budget that cost nothing on the last day."""
    keys = ["account_id", "campaign_id"]
    cost = truth.where(F.col("date") == F.lit(p.as_of)).groupBy(*keys).agg(F.sum("network_cost").alias("cost"))
    live = campaigns.where("NOT inferred_removed AND status = 'ENABLED' AND budget_amount > 0").groupBy(*keys).agg(F.max("budget_amount").alias("budget_amount"))
    return live.join(cost, keys, "left").where("coalesce(cost, 0) = 0").select(*keys, "budget_amount")


def serving_budget_has_cost(campaigns: DataFrame, truth: DataFrame, p: Params) -> DataFrame:
    return assertion(zero_cost(campaigns, truth, p).agg(F.count("*").alias("observed")), "serving campaigns without cost")


#: Severity of each assertion; what isn't soft blocks publication.
SOFT = frozenset(["cohort_observation_reconciliation", "asset_not_over_campaign", "campaign_reconciliation", "cross_grain_identity", "cohort_reconciliation", "serving_budget_has_cost"])


def collected(results: dict[str, DataFrame]) -> DataFrame:
    """All assertions' rows with name and severity; an answer that is neither true nor false counts as failed."""
    parts = []
    for name, df in results.items():
        unsure = F.col("passed").isNull()
        parts.append(df.select(
            F.lit(name).alias("assertion"), F.lit("SOFT" if name in SOFT else "HARD").alias("severity"), F.coalesce("passed", F.lit(False)).alias("passed"), "observed", "expected",
            F.when(unsure, F.coalesce("detail", F.lit("no answer"))).otherwise(F.col("detail")).alias("detail")))
    return _union(parts)


def run_decision(rows: DataFrame) -> DataFrame:
    """May the run publish? Not if a hard assertion failed, or none ran."""
    hard, soft = (F.count_if((F.col("severity") == s) & ~F.col("passed")).alias(f"{s.lower()}_failed") for s in ("HARD", "SOFT"))
    out = rows.agg(F.count("*").alias("checks"), hard, soft)
    verdict = F.when(F.col("checks") == 0, "SKIPPED").when(F.col("hard_failed") > 0, "FAIL").otherwise("PASS")
    return out.withColumns({"may_publish": (F.col("checks") > 0) & (F.col("hard_failed") == 0), "decision": verdict})
