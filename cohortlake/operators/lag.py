"""Lag buckets: conversions by how long after the click they came."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.columns import action_id, null_safe_join
from cohortlake.plans.params import BOUNDARY_DAYS, Params
from cohortlake.sources.adapter import BUCKETS

from .performance import add_cost

METRICS = ["conversions", "conversions_value", "all_conversions", "all_conversions_value"]


def timezones(*facts: DataFrame) -> DataFrame:
    """Each account's time zone; the smallest where facts disagree, so that the answer doesn't vary."""
    rows = facts[0].select("account_id", "time_zone")
    for f in facts[1:]:
        rows = rows.unionByName(f.select("account_id", "time_zone"))
    return rows.groupBy("account_id").agg(F.min("time_zone").alias("time_zone"))


def local_date(instant: Column, zone: Column) -> Column:
    """The calendar day of an instant in a zone that may differ by row; without one, in UTC."""
    return F.to_date(F.from_utc_timestamp(instant, F.coalesce(zone, F.lit("UTC"))))


def upper_day(bucket: Column) -> Column:
    """The last day that a bucket covers; null for unknown lags."""
    pairs = [x for name, day in BUCKETS.items() for x in (F.lit(name), F.lit(day))]
    return F.element_at(F.create_map(*pairs), bucket)


#: What names a series of buckets; null parts are equal to each other.
SERIES = ["grain", "click_date", "account_id", "campaign_id", "asset_group_id", "ad_network_type", "metric_basis", "conversion_action_resource_name"]
#: Window of an action without one, and what windows and cells say of themselves.
DEFAULT_WINDOW = 90
CAPPED, ASSUMED, OBSERVED = "capped by reporting window", "assumed-current", "observed"
NO_BOUNDARY = "reporting window is not a lag bucket boundary"


def source_buckets(campaign: DataFrame, asset_group: DataFrame, zones: DataFrame) -> DataFrame:
    """The buckets of both grains in one table, with their load's day in the account's zone; the campaign grain has no asset group."""
    keys = ["date", "account_id", "campaign_id", "asset_group_id", "ad_network_type", "conversion_action", "conversion_action_name", "conversion_lag_bucket"]
    more = [*METRICS, "loaded_at", "source_run_id"]
    top = campaign.withColumn("asset_group_id", F.lit(None).cast("bigint")).select(F.lit("campaign").alias("grain"), *keys, *more)
    out = top.unionByName(asset_group.select(F.lit("asset_group").alias("grain"), *keys, *more))
    out = out.withColumnRenamed("date", "click_date").withColumn("upper_day", upper_day(F.col("conversion_lag_bucket")))
    return out.join(zones, "account_id", "left").withColumn("refresh_date", local_date(F.col("loaded_at"), F.col("time_zone"))).drop("time_zone").withColumnRenamed("loaded_at", "refresh_ts")


def action_buckets(buckets: DataFrame, windows: DataFrame, evidence: DataFrame) -> DataFrame:
    """Buckets with their action's window, and whether the action counts as primary."""
    own = windows.where("metric_basis = 'CONVERSION_ACTION'").select("click_date", "account_id", F.col("conversion_action_resource_name").alias("conversion_action"), "window_days", "window_provenance", "is_primary")
    told = evidence.groupBy("click_date", "account_id", F.col("conversion_action_resource_name").alias("conversion_action")).agg(F.bool_or("has_primary_conversions").alias("shown"))
    out = buckets.join(own, ["click_date", "account_id", "conversion_action"], "left")
    out = null_safe_join(out, told, ["click_date", "account_id", "conversion_action"])
    false = F.lit(False)
    return out.withColumns({
        "action_window_days": F.coalesce("window_days", F.lit(DEFAULT_WINDOW)).cast("bigint"), "action_window_provenance": F.coalesce("window_provenance", F.lit(ASSUMED)),
        "contributes_to_primary": F.coalesce("is_primary", false) | F.coalesce("shown", false),
    }).drop("window_days", "window_provenance", "is_primary", "shown")


def basis_buckets(buckets: DataFrame) -> DataFrame:
    """Each bucket under its action, under all conversions, and, if its action is primary, under primary conversions: one scan."""
    none = F.lit(None)

    def basis(name, id_, resource, title, count, value):
        return F.struct(F.lit(name).alias("metric_basis"), id_.cast("bigint").alias("conversion_action_id"), resource.cast("string").alias("conversion_action_resource_name"), title.alias("conversion_action_name"), F.col(count).alias("conversions"), F.col(value).alias("conversions_value"))

    name = F.col("conversion_action")
    three = F.array(
        basis("CONVERSION_ACTION", action_id(name), name, F.col("conversion_action_name"), "conversions", "conversions_value"),
        basis("ALL_CONVERSIONS", none, none, F.lit("All conversions"), "all_conversions", "all_conversions_value"),
        F.when(F.col("contributes_to_primary"), basis("PRIMARY", none, none, F.lit("Primary conversions"), "conversions", "conversions_value")),
    )
    kept = ["grain", "click_date", "account_id", "campaign_id", "asset_group_id", "ad_network_type", "upper_day", "refresh_date", "refresh_ts", "source_run_id", "action_window_days", "action_window_provenance"]
    return buckets.select(*kept, F.explode(F.array_compact(three)).alias("b")).select(*kept, "b.*")


def keys_with_window(basis: DataFrame, p: Params) -> DataFrame:
    """Each series and action title with its window, cut to the reporting window."""
    r = p.reporting_window_days
    out = basis.groupBy(*SERIES, "conversion_action_id", "conversion_action_name").agg(F.max("action_window_days").alias("w"), F.count_if(F.col("action_window_provenance") == ASSUMED).alias("assumed"))
    told = F.when(F.col("w") > r, CAPPED).when(F.col("assumed") > 0, ASSUMED).otherwise(OBSERVED)
    return out.withColumns({"window_days": F.least("w", F.lit(r).cast("bigint")), "window_provenance": told}).drop("w", "assumed")


def ladder_days(spark, p: Params) -> DataFrame:
    """The configured days after the click day; a typed table even if there are none."""
    return spark.createDataFrame([(d,) for d in p.cohort_days if d > 0], "cohort_day bigint")


def rungs(days: list[int], window: Column, kept: Column | None = None) -> Column:
    """The configured days up to the window, and the window itself, once each."""
    wide = F.array(*[F.lit(d).cast("bigint") for d in days]) if days else F.array().cast("array<bigint>")
    return F.array_distinct(F.concat(F.filter(wide, lambda d: d <= window), F.array(window)))


def ladder(keys: DataFrame, p: Params) -> DataFrame:
    """Every key on each of its rungs."""
    out = keys.withColumn("cohort_day", F.explode(rungs([d for d in p.cohort_days if d > 0], F.col("window_days"))))
    return out.withColumn("is_window_rung", F.col("cohort_day") == F.col("window_days"))


def prefix_sums(steps: DataFrame, basis: DataFrame) -> DataFrame:
    """What had come in by each rung. A series' buckets are summed by upper day and action window and packed
    first: a few dozen numbers meet a rung, whatever the number of rows behind them."""
    known = F.col("upper_day").isNotNull()
    by = basis.groupBy(*SERIES, "upper_day", "action_window_days").agg(
        F.sum("conversions").alias("c"), F.sum("conversions_value").alias("v"), F.max("refresh_date").alias("d"), F.max("refresh_ts").alias("t"), F.min("source_run_id").alias("r"))
    packed = by.groupBy(*SERIES).agg(
        F.collect_list(F.when(known, F.struct(F.least("upper_day", F.lit(1 << 30)).alias("u"), F.col("action_window_days").alias("w"), "c", "v"))).alias("_cells"),
        F.sum(F.when(~known, F.col("c")).otherwise(0.0)).alias("unknown_lag_conversions"), F.sum(F.when(~known, F.col("v")).otherwise(0.0)).alias("unknown_lag_value"),
        F.max("d").alias("bucket_refresh_date"), F.max("t").alias("bucket_refresh_ts"), F.min("r").alias("bucket_run_id"))
    out = null_safe_join(steps, packed, SERIES, "inner")

    def upto(what: str) -> Column:
        come = F.filter("_cells", lambda x: x["u"] <= F.least(F.col("cohort_day"), x["w"]))
        return F.aggregate(come, F.lit(0.0), lambda a, x: a + F.coalesce(x[what], F.lit(0.0)))

    return out.withColumns({"prefix_conversions": upto("c"), "prefix_value": upto("v")}).drop("_cells")


def totals(staged: dict[tuple[str, str], DataFrame], zones: DataFrame) -> DataFrame:
    """What a click day had in all, by grain and basis: of volume rows twice, of action rows once."""
    parts = []
    for (grain, kind), df in staged.items():
        group = F.col("asset_group_id") if grain == "asset_group" else F.lit(None).cast("bigint")
        pair = lambda name, a, b: F.struct(F.lit(name).alias("metric_basis"), F.col(a).alias("total_conversions"), F.col(b).alias("total_value"))
        if kind == "volume":
            bases, action = [pair("PRIMARY", "conversions", "conversions_value"), pair("ALL_CONVERSIONS", "all_conversions", "all_conversions_value")], F.lit(None).cast("string")
        else:
            bases, action = [pair("CONVERSION_ACTION", "conversions", "conversions_value")], F.col("conversion_action")
        own = [F.lit(grain).alias("grain"), F.col("date").alias("click_date"), "account_id", "campaign_id", group.alias("asset_group_id"), "ad_network_type", action.alias("conversion_action_resource_name"), F.col("loaded_at").alias("total_refresh_ts"), F.col("source_run_id").alias("total_run_id")]
        parts.append(df.select(*own, F.explode(F.array(*bases)).alias("b")).select(*[c if isinstance(c, str) else F.col(n) for c, n in zip(own, ["grain", "click_date", "account_id", "campaign_id", "asset_group_id", "ad_network_type", "conversion_action_resource_name", "total_refresh_ts", "total_run_id"])], "b.*"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.join(zones, "account_id", "left").withColumn("total_refresh_date", local_date(F.col("total_refresh_ts"), F.col("time_zone"))).drop("time_zone")


def resolve(prefixes: DataFrame, all_: DataFrame, p: Params) -> DataFrame:
    """A window rung off the bucket boundaries reads the click day's total, unless the reporting window cut it; at the cut it has no answer."""
    off = ~F.col("window_days").isin(list(BOUNDARY_DAYS))
    marked = prefixes.withColumns({
        "reads_total": F.col("is_window_rung") & (F.col("window_provenance") != CAPPED) & off,
        "no_answer": F.col("is_window_rung") & (F.col("cohort_day") == p.reporting_window_days) & off,
    })
    # Only rungs that read a total meet one; the others stay where they are.
    met = null_safe_join(marked.where("reads_total"), all_, SERIES).unionByName(marked.where("NOT reads_total"), allowMissingColumns=True)
    pick = lambda a, b: F.when(F.col("reads_total"), F.col(a)).otherwise(F.col(b))
    return met.withColumns({
        "cohorted_conversions": pick("total_conversions", "prefix_conversions"), "cohorted_value": pick("total_value", "prefix_value"), "source_refresh_date": pick("total_refresh_date", "bucket_refresh_date"),
        "observed_through": pick("total_refresh_ts", "bucket_refresh_ts"), "source_run_id": pick("total_run_id", "bucket_run_id"),
    }).drop("total_conversions", "total_value", "total_refresh_date", "total_refresh_ts", "total_run_id", "prefix_conversions", "prefix_value", "bucket_refresh_date", "bucket_refresh_ts", "bucket_run_id", "reads_total")


def label() -> Column:
    return F.concat(F.lit("D"), F.col("cohort_day").cast("string"), F.when(F.col("is_window_rung"), " window").otherwise(""))


def labelled(cells: DataFrame, p: Params) -> DataFrame:
    """Cells with label, provenance and maturity."""
    no = F.col("no_answer")
    grown = F.when(F.col("source_refresh_date") >= F.date_add("click_date", F.col("cohort_day").cast("int")), "complete").otherwise("immature")
    return cells.withColumns({
        "cohort_label": label(), "window_provenance": F.when(no, CAPPED).otherwise(F.col("window_provenance")),
        "cohorted_conversions": F.when(~no, F.col("cohorted_conversions")), "cohorted_value": F.when(~no, F.col("cohorted_value")),
        "provenance": F.when(no, "unavailable").otherwise("measured"), "unavailable_reason": F.when(no, NO_BOUNDARY), "maturity": F.when(~no, grown),
        "built_by_run_id": F.lit(p.run_id), "cohort_counting": F.lit("google_lag"),
    }).drop("no_answer")


COHORT_KEYS = {"campaign": ["account_id", "campaign_id"], "asset_group": ["account_id", "campaign_id", "asset_group_id"], "asset": ["account_id", "campaign_id", "asset_group_id", "asset_id", "field_type"]}
CELL = ["ad_network_type", "metric_basis", "conversion_action_id", "conversion_action_resource_name", "conversion_action_name", "cohort_day", "is_window_rung", "cohort_label", "window_days", "window_provenance", "provenance", "unavailable_reason", "maturity", "observed_through"]
SUMS = ["click_day_cost", "cohorted_conversions", "cohorted_value", "unknown_lag_conversions", "unknown_lag_value", "stale_cell_count", "missing_cost_cell_count"]


def cohort_mart(cells: DataFrame, facts: DataFrame | None, grain: str, p: Params) -> DataFrame:
    """The cells of a grain with the cost of their click day, unless they bring it; cells without one, and immature ones, are counted."""
    keys = COHORT_KEYS[grain]
    out = cells.where(F.col("grain") == grain)
    out = out if "click_day_cost" in cells.columns else add_cost(out, facts, keys)
    late = F.col("provenance").isin("measured", "carried") & (F.col("maturity") == "immature")
    return out.select(
        "click_date", *keys, *CELL, "click_day_cost", "cohorted_conversions", "cohorted_value", "unknown_lag_conversions", "unknown_lag_value", "source_refresh_date",
        F.col("click_day_cost").isNull().cast("int").alias("missing_cost_cell_count"), F.coalesce(late, F.lit(False)).cast("int").alias("stale_cell_count"), "source_run_id", F.lit(p.run_id).alias("run_id"), "cohort_counting")
