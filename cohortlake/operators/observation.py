"""The observation diary: what each run saw of each click day, and the cohorts read from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlake.functions.columns import MONEY, action_id, null_safe_join
from cohortlake.plans.params import Params

from .lag import ASSUMED, CAPPED, label, local_date, rungs  # noqa: F401

GRAINS = ("campaign", "asset_group", "asset")
#: What names a row of the diary within an observed day; null parts are equal to each other.
ROW = ["account_id", "click_date", "grain", "campaign_id", "asset_group_id", "asset_id", "field_type", "ad_network_type", "metric_basis", "conversion_action"]
#: Entity rows by grain: the table, and what names an entity.
PRESENT = {"campaign": ("entities_campaign", ["account_id", "campaign_id"]), "asset_group": ("entities_asset_group", ["account_id", "campaign_id", "asset_group_id"]), "asset": ("entities_asset_group_asset", ["account_id", "campaign_id", "asset_group_id", "asset_id", "field_type"])}
#: Titles of the sums over actions, and the longest gap over which a reading is carried.
TITLES = {"PRIMARY": "Primary conversions", "ALL_CONVERSIONS": "All conversions"}
LONGEST_GAP = 5


def _succeeded(stages: DataFrame) -> DataFrame:
    return stages.where("stage = 'observe' AND status = 'SUCCESS'").select(F.col("run_id").alias("_run"), F.col("account_id").alias("_account")).distinct()


def winning_runs(diary: DataFrame, stages: DataFrame) -> DataFrame:
    """The last run of each account and observed day among those that succeeded, for the account or as a whole."""
    seen = diary.select("account_id", "observed_date", "run_id").distinct()
    ok = _succeeded(stages)
    met = seen.join(ok, (ok._run == seen.run_id) & (ok._account.isNull() | (ok._account == seen.account_id)))
    return met.groupBy("account_id", "observed_date").agg(F.max("run_id").alias("run_id"))


def selected(diary: DataFrame, winners: DataFrame) -> DataFrame:
    """The winners' rows; accounts are few and winners one a day for each, so they go to the diary and its rows stay where they are."""
    return diary.join(F.broadcast(winners), ["account_id", "observed_date", "run_id"], "left_semi")


def landed(volume: dict[str, DataFrame], conv: dict[str, DataFrame], run_id: str, observed_date, start, end) -> DataFrame:
    """What one run saw: all grains, under three bases. `volume` and `conv` are landed facts by grain."""
    parts = []
    for grain in GRAINS:
        for df, bases in ((volume[grain], ("PRIMARY", "ALL_CONVERSIONS")), (conv[grain], ("CONVERSION_ACTION",))):
            rows = df.where((F.col("run_id") == run_id) & F.col("date").between(F.lit(start), F.lit(end)) & (F.col("date") < F.lit(observed_date)))
            pick = lambda b: F.struct(F.lit(b).alias("metric_basis"), *[F.col(("all_" if b[0] == "A" else "") + c).alias(c) for c in ("conversions", "conversions_value")])
            own = lambda c, t: F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c)
            parts.append(rows.select(
                F.lit(run_id).alias("run_id"), F.lit(observed_date).alias("observed_date"), "account_id", F.col("date").alias("click_date"), F.datediff(F.lit(observed_date), "date").alias("lag"), F.lit(grain).alias("grain"),
                "campaign_id", own("asset_group_id", "bigint"), own("asset_id", "bigint"), own("field_type", "string"), "ad_network_type", own("conversion_action", "string"), own("conversion_action_name", "string"),
                F.explode(F.array(*map(pick, bases))).alias("b"),
            ).select("*", "b.*").drop("b"))
    return reduce(DataFrame.unionByName, parts)


def prior_nonzero(packed: DataFrame, run_id: str, observed_date, start, end) -> DataFrame:
    """Rows that some earlier winning run saw with a conversion or a value, from a diary with one row for each name."""
    some = lambda x: (F.coalesce(x["conversions"], F.lit(0.0)) != 0) | (F.coalesce(x["conversions_value"], F.lit(0.0)) != 0)
    before = F.exists("_seen", lambda x: (x["run_id"] != run_id) & (x["observed_date"] <= F.lit(observed_date)) & some(x))
    return packed.where(F.col("click_date").between(F.lit(start), F.lit(end)) & (F.col("click_date") < F.lit(observed_date)) & before).select(*ROW, "conversion_action_name")


def grain_complete(customers: DataFrame, entities: dict[str, DataFrame], run_id: str, day) -> DataFrame:
    """(grain, account): the account's customer row is there, and at least one entity of the grain, by this run on this day."""
    today = lambda df: df.where((F.col("snapshot_date") == F.lit(day)) & (F.col("run_id") == run_id)).select("account_id").distinct()
    parts = [today(customers).join(today(df), "account_id", "left_semi").select(F.lit(g).alias("grain"), "account_id") for g, df in entities.items()]
    return reduce(DataFrame.unionByName, parts)


def synthetic_zeros(prior: DataFrame, seen: DataFrame, complete: DataFrame, entities: dict[str, DataFrame], run_id: str, observed_date, day) -> DataFrame:
    """A zero for what was nonzero before and isn't there now, if the grain came whole and the entity still is."""
    gone = null_safe_join(prior.join(complete, ["grain", "account_id"], "left_semi"), seen.select(*ROW), ROW, "left_anti")
    parts = []
    for grain, df in entities.items():
        keys = PRESENT[grain][1]
        there = df.where((F.col("snapshot_date") == F.lit(day)) & (F.col("run_id") == run_id)).select(*keys).distinct()
        parts.append(null_safe_join(gone.where(F.col("grain") == grain), there, keys, "left_semi"))
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(run_id).alias("run_id"), F.lit(observed_date).alias("observed_date"), *ROW, "conversion_action_name", F.datediff(F.lit(observed_date), "click_date").alias("lag"),
        F.lit(0.0).alias("conversions"), F.lit(0.0).alias("conversions_value"))


def observed_dates(customers: DataFrame, instant: str, override: str | None = None) -> DataFrame:
    """Each account's calendar day at an instant (UTC); an account without a zone, where none is given, is an error."""
    zone = F.coalesce(F.lit(override), F.nullif(F.trim("time_zone"), F.lit("")))
    day = local_date(F.lit(instant).cast("timestamp"), zone)
    return customers.select("account_id", F.when(zone.isNotNull(), day).otherwise(F.raise_error(F.concat(F.lit("no time zone for account "), F.col("account_id").cast("string")))).alias("observed_date"))


def latest_actions(customers: DataFrame, actions: DataFrame, stages: DataFrame) -> DataFrame:
    """The conversion actions of each account's last snapshot whose load succeeded."""
    ok = stages.where("stage = 'load' AND status = 'SUCCESS'").select("run_id").distinct()
    last = customers.join(ok, "run_id", "left_semi").groupBy("account_id").agg(F.max("snapshot_date").alias("snapshot_date"))
    return actions.join(last, ["account_id", "snapshot_date"], "left_semi")


def depth_contract(actions: DataFrame, p: Params) -> DataFrame:
    """How many days back a run must look: ladder and longest window, a day more and the margin, within the reporting window."""
    top, r, m = max(p.cohort_days, default=0), p.reporting_window_days, p.restatement_margin_days
    w = F.max("click_through_lookback_window_days")
    out = actions.agg(w.alias("longest_window_days"), F.count_distinct("account_id").alias("accounts"))
    deep = F.greatest(F.lit(top + 1).cast("bigint"), F.col("longest_window_days") + 1) + m
    return out.withColumns({
        "depth_days": F.least(F.lit(r).cast("bigint"), F.when(F.col("longest_window_days").isNotNull(), deep).otherwise(F.lit(top + 1 + m).cast("bigint"))),
        "depth_source": F.when(F.col("longest_window_days").isNotNull(), "action windows").otherwise("ladder"),
    })


def forfeited_actions(actions: DataFrame, p: Params) -> DataFrame:
    """Actions whose window the reporting window cuts, with the rungs that can't be measured and those within the margin."""
    r, m, w = p.reporting_window_days, p.restatement_margin_days, F.col("click_through_lookback_window_days")
    span = lambda a: F.concat(F.lit(f"D{a}..D"), w.cast("string"))
    return actions.where(w > max(0, r - m)).select("account_id", "conversion_action_id", w.alias("window_days"), F.when(w >= r, span(r)).alias("unmeasurable_rungs"), span(max(0, r - m)).alias("margin_rungs"))


def account_bounds(winners: DataFrame, p: Params) -> DataFrame:
    """The last observed day of each account up to as_of, whatever click days it covers; winners are told day by day, so later days change none."""
    return winners.where(F.col("observed_date") <= F.lit(p.as_of)).groupBy("account_id").agg(F.max("observed_date").alias("latest_observed_date"))


KEY = ["click_date", "account_id", "grain", "campaign_id", "asset_group_id", "asset_id", "field_type", "ad_network_type", "metric_basis", "conversion_action_id", "conversion_action_resource_name", "conversion_action_name", "time_zone"]


#: What names a series of readings, and what its keys say besides.
OWN = [c for c in ROW if c != "conversion_action"] + ["conversion_action_resource_name"]
TOLD = [c for c in KEY if c not in OWN]
#: What series of one click day, entity and network share, whatever their basis and action.
SHARED = [c for c in OWN if c not in ("metric_basis", "conversion_action_resource_name")]
_READ = "struct<observed_date: date, run_id: string, conversions: double, conversions_value: double>"


def _sources(asset: DataFrame, asset_group: DataFrame, chosen: DataFrame) -> DataFrame:
    """A row for each fact and observation that names a series, observations with their reading in `_read`, and of
    the series that a network's fact names the first with the fact's cost in `_cost` (assets)."""
    none = lambda t: F.lit(None).cast(t)
    parts = []
    first = next(iter(TITLES))
    for grain, facts in (("asset", asset), ("asset_group", asset_group)):
        sums = F.array(*[F.struct(F.lit(b).alias("metric_basis"), none("bigint").alias("conversion_action_id"), none("string").alias("conversion_action_resource_name"), F.lit(t).alias("conversion_action_name")) for b, t in TITLES.items()])
        own = F.array(F.struct("metric_basis", "conversion_action_id", "conversion_action_resource_name", "conversion_action_name"))
        part = facts.select(
            F.col("date").alias("click_date"), "account_id", F.lit(grain).alias("grain"), "campaign_id", "asset_group_id", (F.col("asset_id") if grain == "asset" else none("bigint")).alias("asset_id"),
            (F.col("field_type") if grain == "asset" else none("string")).alias("field_type"), "ad_network_type", "time_zone", (F.col("network_cost") if grain == "asset" and "network_cost" in facts.columns else none(MONEY)).alias("_cost"), F.explode(F.when(F.col("metric_basis") == "NETWORK", sums).otherwise(own)).alias("b"))
        parts.append(part.select("*", "b.*").select(*KEY, none(_READ).alias("_read"), F.when(F.col("metric_basis") == first, F.col("_cost")).alias("_cost")))
    zones = asset.where("time_zone IS NOT NULL").groupBy("account_id", F.col("date").alias("click_date")).agg(F.min("time_zone").alias("time_zone"))
    title = F.col("conversion_action_name")
    for b, t in TITLES.items():
        title = F.when(F.col("metric_basis") == b, t).otherwise(title)
    seen = chosen.where(F.col("grain").isin("asset", "asset_group")).withColumns({"conversion_action_id": action_id(F.col("conversion_action")), "conversion_action_name": title}).withColumnRenamed("conversion_action", "conversion_action_resource_name")
    parts.append(seen.join(F.broadcast(zones), ["account_id", "click_date"], "left").select(*KEY, F.struct("observed_date", "run_id", "conversions", "conversions_value").cast(_READ).alias("_read"), none(MONEY).alias("_cost")))
    return reduce(DataFrame.unionByName, parts)


def keys(asset: DataFrame, asset_group: DataFrame, chosen: DataFrame) -> DataFrame:
    """All series that facts or observations have, at the grains of assets and asset groups."""
    return _sources(asset, asset_group, chosen).select(*KEY).distinct()


def series(asset: DataFrame, asset_group: DataFrame, chosen: DataFrame) -> DataFrame:
    """The same keys with their readings, the last one first, in `_seen`, and with the cost of their click day: all come from
    one dealing of the rows by what the series of a click day share, so that neither readings nor cost need a join."""
    one = _sources(asset, asset_group, chosen).select(*OWN, F.struct(*TOLD).alias("_key"), "_read", "_cost").repartition(*SHARED)
    packed = one.groupBy(*OWN).agg(F.collect_set("_key").alias("_keys"), F.sort_array(F.collect_list("_read"), asc=False).alias("_seen"), F.sum("_cost").alias("_cost"))
    costed = packed.withColumn("click_day_cost", F.sum("_cost").over(Window.partitionBy(*SHARED)))
    return costed.withColumn("_key", F.explode("_keys")).select(*[F.col(f"_key.{c}").alias(c) if c in TOLD else F.col(c) for c in KEY], "_seen", "click_day_cost")


def with_cost(rows: DataFrame) -> DataFrame:
    """Names of the diary with the cost of their click day, entity and network: one dealing of them, before bases and rungs become rows."""
    return rows.withColumn("click_day_cost", F.sum("network_cost").over(Window.partitionBy(*SHARED)))


def told(packed: DataFrame) -> DataFrame:
    """The series of a diary with one row for each name, with zones and readings: what `series` gives from facts and a diary in rows. Each row is a series, none moves."""
    title = F.col("conversion_action_name")
    for b, t in TITLES.items():
        title = F.when(F.col("metric_basis") == b, t).otherwise(title)
    out = packed.withColumns({"conversion_action_id": action_id(F.col("conversion_action")), "conversion_action_name": title}).withColumnRenamed("conversion_action", "conversion_action_resource_name")
    return out.select(*KEY, "_seen", *[c for c in ("click_day_cost",) if c in out.columns])


def capped_windows(windows: DataFrame, p: Params) -> DataFrame:
    """Lookback windows cut to the reporting window; a window as long as that counts as cut."""
    r = F.lit(p.reporting_window_days).cast("bigint")
    return windows.select("click_date", "account_id", "metric_basis", "conversion_action_resource_name", F.least("window_days", r).alias("window_days"), F.when(F.col("window_days") >= r, CAPPED).otherwise(F.col("window_provenance")).alias("window_provenance"))


def bounded(keys_: DataFrame, windows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Series with their window and their account's last observed day: a row for each account, click day and action at most meets them where they are."""
    met = null_safe_join(keys_, F.broadcast(windows), ["click_date", "account_id", "metric_basis", "conversion_action_resource_name"], "inner")
    return met.join(F.broadcast(bounds), "account_id")


def reached(p: Params) -> Column:
    """The rungs that the account's observations have reached. A rung of k days is read on the morning after them."""
    last = F.datediff("latest_observed_date", "click_date")
    return F.filter(rungs(list(p.cohort_days), F.col("window_days")), lambda k: F.least(k + 1, F.lit(p.reporting_window_days)) <= last)


def ladder(keys_: DataFrame, windows: DataFrame, bounds: DataFrame, p: Params) -> DataFrame:
    """Series on the rungs that they have reached."""
    step = bounded(keys_, windows, bounds).withColumn("cohort_day", F.explode(reached(p)))
    return step.withColumns({"is_window_rung": F.col("cohort_day") == F.col("window_days"), "target_date": F.date_add("click_date", (F.col("cohort_day") + 1).cast("int"))})


def first_snapshots(marks: DataFrame, stages: DataFrame) -> DataFrame:
    """Each account's first snapshot; marks of runs that didn't succeed for the account are ignored."""
    ok = _succeeded(stages)
    return marks.join(ok, (ok._run == marks.run_id) & (ok._account == marks.account_id), "left_semi").groupBy("account_id").agg(F.min("first_snapshot_date").alias("first_snapshot_date"))


def asof_reading(found: DataFrame, p: Params) -> DataFrame:
    """The last reading up to each rung's target, from series with their readings, window and bounds. Readings are looked up
    before the rungs become rows, so that no row carries all readings of its series. The rungs are those of `reached`, written out."""
    after = lambda k: F.date_add("click_date", (k + 1).cast("int"))
    last = lambda k: F.get(F.filter("_seen", lambda x: x["observed_date"] <= after(k)), F.lit(0))
    window, upto = F.col("window_days"), F.datediff("latest_observed_date", "click_date")
    step_of = lambda k, there: F.when(there & (F.least(k + 1, F.lit(p.reporting_window_days)) <= upto), F.struct(k.alias("k"), last(k).alias("hit")))
    days = [F.lit(d).cast("bigint") for d in dict.fromkeys(p.cohort_days)]
    own = ~F.coalesce(window.isin(list(p.cohort_days)), F.lit(False))
    steps = F.array(*[step_of(k, k <= window) for k in days], step_of(window, own))
    step = found.withColumn("_s", F.explode(steps)).where("_s IS NOT NULL").drop("_seen")
    rung, hit = F.col("_s.k"), F.col("_s.hit")
    return step.select(
        *[c for c in step.columns if c != "_s"], rung.alias("cohort_day"), (rung == F.col("window_days")).alias("is_window_rung"), after(rung).alias("target_date"),
        hit["observed_date"].alias("observed_date"), hit["conversions"].alias("conversions"), hit["conversions_value"].alias("conversions_value"), hit["run_id"].alias("source_run_id"))


def resolution(p: Params) -> Column:
    """(provenance, reason) of a reading; the first case that holds decides."""
    target, seen, first = F.col("target_date"), F.col("observed_date"), F.col("first_snapshot_date")
    gap = F.datediff(target, seen)
    say = lambda a, b: F.struct(F.lit(a).alias("provenance"), F.lit(b).cast("string").alias("reason"))
    return (
        F.when(target > F.date_add("click_date", p.reporting_window_days), say("unavailable", CAPPED))
        .when((F.col("grain") == "asset") & (F.col("cohort_day") == 0) & first.isNull(), say("unavailable", "first snapshot unknown"))
        .when(target < first, say("unavailable", "before first snapshot"))
        .when(seen == target, say("measured", None))
        .when(seen == first, say("unavailable", "seed only"))
        .when(gap.between(1, LONGEST_GAP), say("carried", None))
        .otherwise(say("unavailable", "gap exceeded"))
    )


def cells(readings: DataFrame, p: Params) -> DataFrame:
    """Observation cells: numbers only where measured or carried; assets' click days before the first snapshot drop out."""
    out = readings.withColumn("_r", resolution(p))
    has = F.col("_r.provenance") != "unavailable"
    shown = (F.col("cohort_day") != 0) | (F.col("grain") == "asset_group") | F.col("first_snapshot_date").isNull() | (F.col("target_date") >= F.col("first_snapshot_date"))
    grown = F.when(F.col("latest_observed_date") >= F.col("target_date"), "complete").otherwise("immature")
    none = F.lit(None).cast("double")
    return out.where(shown).select(
        *KEY[:-1], "cohort_day", "is_window_rung", label().alias("cohort_label"), "window_days", "window_provenance",
        F.when(has, F.col("conversions")).alias("cohorted_conversions"), F.when(has, F.col("conversions_value")).alias("cohorted_value"), none.alias("unknown_lag_conversions"), none.alias("unknown_lag_value"),
        F.col("_r.provenance").alias("provenance"), F.col("_r.reason").alias("unavailable_reason"), F.when(has, grown).alias("maturity"),
        F.to_utc_timestamp(F.col("observed_date").cast("timestamp"), F.coalesce("time_zone", F.lit("UTC"))).alias("observed_through"), F.col("observed_date").alias("source_refresh_date"), "source_run_id",
        F.lit(p.run_id).alias("built_by_run_id"), F.lit("arp_calendar").alias("cohort_counting"), *[c for c in ("click_day_cost",) if c in out.columns])


def baseline(diary: DataFrame) -> DataFrame:
    return diary.agg(F.count("*").alias("n"), F.count_distinct("observed_date").alias("days"), F.max("observed_date").alias("last_day"))


def depth_by_account(dates: DataFrame, actions: DataFrame, p: Params) -> DataFrame:
    """`depth_days` of each account by its own actions' longest window: the rule of `depth_contract`, account by account."""
    top, r, m = max(p.cohort_days, default=0), p.reporting_window_days, p.restatement_margin_days
    longest = actions.groupBy("account_id").agg(F.max("click_through_lookback_window_days").alias("longest"))
    days = F.greatest(F.lit(top + 1).cast("bigint"), F.coalesce(F.col("longest") + 1, F.lit(top + 1).cast("bigint"))) + m
    return dates.join(longest, "account_id", "left").select(*dates.columns, F.least(F.lit(r).cast("bigint"), days).cast("int").alias("depth_days"))


def window_clamp(dates: DataFrame, fetched_from) -> DataFrame:
    """Each account's window of click days: as deep as its `depth_days`, but no earlier than what was fetched, so that unfetched days can't turn into zeros."""
    start = F.greatest(F.date_sub("observed_date", F.col("depth_days")), F.lit(fetched_from))
    return dates.select("account_id", "observed_date", "depth_days", start.alias("window_start"), F.date_sub("observed_date", 1).alias("window_end"))


def window_scan(facts: DataFrame, windows: DataFrame, fetched_from, day: str = "date") -> DataFrame:
    """Facts of every account's own window, with its observed date and the lag, in one pass over the days that any account needs.

    Windows become (account, day) rows, and facts are looked up there by equality: on facts kept by day only
    the folders of those days are opened, which are known at run time. An account without a window has no rows.
    """
    days = windows.where("window_start <= window_end").select("account_id", "observed_date", F.explode(F.sequence("window_start", "window_end")).alias(day)).where(F.col(day) >= F.lit(fetched_from))
    return facts.join(days, ["account_id", day]).withColumn("lag", F.datediff("observed_date", day))
