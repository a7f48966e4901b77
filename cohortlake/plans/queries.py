"""Registered queries: every operator over the whole tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions.columns import action_id, currency, flat
from cohortlake.operators import entities as ent
from cohortlake.operators import checks, lag, ledger, lookback, observation, parity, performance, pseudonyms, publish, reports, scores, sinks, staging, text
from cohortlake.sources import declared, landing, observed, upstream
from cohortlake.sources.generations import Generations
from cohortlake.sources.tables import shared_dir

from .params import Params
from .star import Star

P = Params()
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ENTITIES = list(ent.KEYS)
GRAINS = list(performance.GRAIN_KEYS)
#: Dimensions of published performance tables.
DIMENSIONS = {
    "campaign": ["date", "account_id", "campaign_id", "campaign_name", "campaign_status", "ad_network_type", "metric_basis", "conversion_action_id", "conversion_action_name", "currency_code", "attribute_provenance"],
    "asset_group": ["date", "account_id", "campaign_id", "asset_group_id", "asset_group_name", "asset_group_status", "ad_strength", "ad_network_type", "metric_basis", "conversion_action_id", "conversion_action_name", "currency_code", "attribute_provenance"],
    "asset": ["date", "account_id", "campaign_id", "asset_group_id", "asset_id", "field_type", "asset_name", "asset_type", "asset_status", "ad_network_type", "metric_basis", "conversion_action_id", "conversion_action_name", "currency_code", "attribute_provenance"],
}


def query(name: str):
    def put(f: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: flat(f(Star.of(spark, sf_dir, P)))
        return f

    return put


def stamp(df: DataFrame) -> DataFrame:
    """Results carry days and text, no load times."""
    return df.drop("loaded_at")


def tally(df: DataFrame, by: list[str], sums: list[str] = ()) -> DataFrame:
    """Rows and sums by group: what a query shows of a long intermediate table whose rows a later one shows in full."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in sums])


@query("src_family_scan")
def _(s: Star) -> DataFrame:
    return stamp(s.raw("volume_campaign"))


for _t in staging.GRAINS:
    if _t != "volume_campaign":
        query(f"src_family_scan_{_t}")(lambda s, t=_t: stamp(s.raw(t)))


@query("src_swap_bounds")
def _(s: Star) -> DataFrame:
    return staging.swap_bounds(s.raw("volume_campaign"), s.staged("volume_campaign"), P)


@query("src_coerce")
def _(s: Star) -> DataFrame:
    raw = s.raw("entities_asset").drop("loaded_at")
    return staging.coerce(raw.select([F.col(c).cast("string").alias(c) for c in raw.columns]))


@query("src_lineage")
def _(s: Star) -> DataFrame:
    return stamp(staging.with_lineage(s.staged("conv_campaign"), "run-x", "1998-07-01 00:00:00", "SELECT 1"))


@query("src_date_bounds")
def _(s: Star) -> DataFrame:
    return staging.date_bounds(s.raw("volume_campaign"))


@query("src_window_clip")
def _(s: Star) -> DataFrame:
    return stamp(staging.clip(s.raw("volume_asset_group"), P))


@query("src_channel_filter")
def _(s: Star) -> DataFrame:
    return stamp(staging.in_channel(s.report("campaigns"))).select("account_id", "campaign_id", "snapshot_date", "run_id", "status")


@query("src_channel_window")
def _(s: Star) -> DataFrame:
    """One channel and the window's days of a report that has others too."""
    return stamp(landing.in_window(s.report("volume"), "date", P.window_start, P.as_of, "PERFORMANCE_MAX"))


@query("src_snapshot_day_scan")
def _(s: Star) -> DataFrame:
    """Facts of the days on which account 3 has a complete snapshot, of one channel."""
    days = s.days.where("account_id = 3").select("snapshot_date")
    return stamp(landing.on_days(staging.in_channel(s.report("volume"), "SEARCH"), days, "date"))


def _landed_json(s: Star) -> str:
    """Folder of the first family as JSON lines. The first of each month has broken lines too, for some campaigns: cut off, with a field or a value too much."""

    def write() -> str:
        raw = s.raw("volume_campaign")
        line = F.to_json(F.struct(*raw.columns), {"timestampFormat": "yyyy-MM-dd HH:mm:ss"})
        odd = F.array(F.expr("left(value, length(value) - 9)"), F.concat(F.lit('{"surprise":1,'), F.expr("substr(value, 2)")), F.regexp_replace("value", '"clicks":[0-9]+', F.lit('"clicks":"many"')), F.regexp_replace("value", '"date":"[^"]*"', F.lit('"date":""')))
        lines = raw.select("date", "campaign_id", line.alias("value"))
        planted = lines.where((F.dayofmonth("date") == 1) & (F.col("campaign_id") % 10 == 3)).select(F.explode(odd).alias("value"))
        path = _folder(s, "landed")
        lines.select("value").unionByName(planted).write.text(path)
        return path

    return s.kept("landed-json", write)


@query("src_landed_json")
def _(s: Star) -> DataFrame:
    return stamp(landing.read_landed(s.spark, _landed_json(s), "volume_campaign")[0])


@query("src_landed_json_staged")
def _(s: Star) -> DataFrame:
    return staging.stage(landing.read_landed(s.spark, _landed_json(s), "volume_campaign")[0], "volume_campaign", P).drop("loaded_at")


query("src_landed_outcomes")(lambda s: landing.reconciled(s.spark, _landed_json(s), "volume_campaign"))
query("src_landed_broken")(lambda s: landing.read_landed(s.spark, _landed_json(s), "volume_campaign")[1].select("reason", F.get_json_object("value", "$.campaign_id").try_cast("bigint").alias("campaign_id")))


@query("src_snapshot_stamp")
def _(s: Star) -> DataFrame:
    return staging.stamp_day(s.staged("entities_customer").drop("snapshot_date"), P)


for _t in staging.GRAINS:
    query(f"stg_{_t}")(lambda s, t=_t: s.staged(t))


def _by_loads(s: Star, table: str) -> DataFrame:
    """The stage of a table, load by load: all days of the first, then the second's in two windows, the later one first and twice."""
    raw, day = s.raw(table), staging.day_column(table)
    g = Generations(s.spark, _folder(s, f"stage-{table}"))
    g.commit({table: raw.limit(0)}, "empty", {table: day})
    middle = P.as_of - dt.timedelta(30)
    spans = [("load-1", P.window_start, P.as_of), ("load-2", middle, P.as_of), ("load-2", P.window_start, middle - dt.timedelta(1)), ("load-2", middle, P.as_of)]
    for k, (run, start, end) in enumerate(spans):
        staging.merge_load(g, table, raw.where(F.col("run_id") == run), start, end, f"{run}-{k}")
    return staging.finished(g.read(table), table).drop("loaded_at")


for _t in ("volume_campaign", "conv_asset", "lag_campaign", "entities_asset_group"):
    query(f"stg_loads_{_t}")(lambda s, t=_t: _by_loads(s, t))


@query("ent_complete_days")
def _(s: Star) -> DataFrame:
    return s.days


@query("ent_seen_bounds")
def _(s: Star) -> DataFrame:
    return ent.seen_bounds(s.entity_rows("campaign"), s.days, ent.KEYS["campaign"], P.as_of)


@query("ent_next_complete")
def _(s: Star) -> DataFrame:
    return ent.next_complete(ent.seen_bounds(s.entity_rows("campaign"), s.days, ent.KEYS["campaign"], P.as_of), s.days)


for _e in ENTITIES:
    query(f"ent_{_e}")(lambda s, e=_e: s.history(e, True))
    query(f"ent_view_{_e}")(lambda s, e=_e: s.view(e))
    query(f"mart_entities_{_e}")(lambda s, e=_e: ent.mart(s.view(e), P.as_of))


@query("ent_customer_asset")
def _(s: Star) -> DataFrame:
    return s.account_links().where(F.col("snapshot_date") == F.lit(P.as_of))


@query("prf_metric_union")
def _(s: Star) -> DataFrame:
    return performance.metric_union(s.staged("volume_campaign"), s.staged("conv_campaign"), "campaign")


@query("prf_micros_to_currency")
def _(s: Star) -> DataFrame:
    return s.staged("volume_campaign").select("account_id", "campaign_id", "date", "ad_network_type", currency(F.col("cost_micros")).alias("cost"))


@query("prf_action_id")
def _(s: Star) -> DataFrame:
    return s.staged("conv_campaign").select("conversion_action", action_id(F.col("conversion_action")).alias("conversion_action_id")).distinct()


@query("prf_asof_join")
def _(s: Star) -> DataFrame:
    return performance.asof_else_earliest(s.staged("volume_campaign"), s.view("campaign"), ent.KEYS["campaign"], {"status": "status", "snapshot_date": "snapshot_date"}).select("date", "account_id", "campaign_id", "ad_network_type", "status", "snapshot_date")


@query("prf_provenance")
def _(s: Star) -> DataFrame:
    f = performance.with_entity(performance.metric_union(s.staged("volume_campaign"), s.staged("conv_campaign"), "campaign"), s.view("campaign"), "campaign")
    return f.groupBy("metric_basis", "attribute_provenance").agg(F.count("*").alias("n"))


@query("prf_asof_customer")
def _(s: Star) -> DataFrame:
    return performance.with_customer(s.staged("volume_campaign"), s.view("customer")).select("date", "account_id", "campaign_id", "ad_network_type", "currency_code", "time_zone")


@query("prf_asof_action")
def _(s: Star) -> DataFrame:
    f = performance.metric_union(s.staged("volume_campaign"), s.staged("conv_campaign"), "campaign")
    return performance.with_action(f, s.view("conversion_action")).select("date", "account_id", "campaign_id", "ad_network_type", "metric_basis", "conversion_action_resource_name", *performance.ACTION_COLUMNS)


for _g in GRAINS:
    query(f"int_performance_{_g}")(lambda s, g=_g: s.facts(g))
    query(f"mart_performance_{_g}")(lambda s, g=_g: s.facts(g).where(F.col("date").between(P.window_start, P.as_of)))
    query(f"pub_performance_{_g}")(lambda s, g=_g: publish.publish(s.facts(g), P, DIMENSIONS[g]))


@query("mart_asset_performance")
def _(s: Star) -> DataFrame:
    return s.facts("asset").select("date", "account_id", "campaign_id", "asset_group_id", "asset_id", "field_type", "ad_network_type", "metric_basis", "conversion_action_resource_name", "asset_primary_status", "asset_primary_status_reasons", *performance.NETWORK, *performance.BY_ACTION)


@query("mart_campaign_truth")
def _(s: Star) -> DataFrame:
    return s.truth()


@query("pub_asset_performance")
def _(s: Star) -> DataFrame:
    return publish.publish(s.facts("asset"), P, ["date", "account_id", "campaign_id", "asset_id", "field_type", "asset_primary_status", "asset_primary_status_reasons", "ad_network_type", "metric_basis"])


@query("pub_campaign_truth")
def _(s: Star) -> DataFrame:
    return publish.publish(s.truth(), P, ["date", "account_id", "campaign_id", "campaign_name", "ad_network_type", "currency_code"], performance.NETWORK)


@query("ratio_performance")
def _(s: Star) -> DataFrame:
    return publish.network_ratios(publish.publish(s.facts("campaign"), P, DIMENSIONS["campaign"]), ["account_id", "campaign_id"])


@query("ratio_campaign_truth")
def _(s: Star) -> DataFrame:
    t = publish.publish(s.truth(), P, ["date", "account_id", "campaign_id"], performance.NETWORK)
    return publish.network_ratios(t, ["account_id"])


@query("lbk_action_keys")
def _(s: Star) -> DataFrame:
    return lookback.action_keys(s.staged("conv_campaign"), s.staged("lag_campaign"))


@query("lbk_primary_evidence")
def _(s: Star) -> DataFrame:
    return lookback.primary_evidence(s.staged("conv_campaign"), s.staged("lag_campaign"))


@query("lbk_account_default")
def _(s: Star) -> DataFrame:
    return lookback.account_default(s.history("conversion_action"))


query("lbk_chosen_action")(lambda s: s.chosen)
query("lbk_aggregate")(lambda s: lookback.aggregate_windows(s.chosen))
query("int_lookback_windows")(lambda s: s.windows)


def _docs(s: Star) -> DataFrame:
    return s.spark.read.parquet(f"{s.sf_dir}/documents.parquet")


@query("txt_redact")
def _(s: Star) -> DataFrame:
    return _docs(s).select("doc_id", text.redact(F.col("text")).alias("text"))


@query("txt_redact_line")
def _(s: Star) -> DataFrame:
    return s.spark.read.parquet(f"{s.sf_dir}/conversations.parquet").select("conv_id", "turn", text.redact_line(F.col("text")).alias("text"))


@query("txt_secret_scan")
def _(s: Star) -> DataFrame:
    return text.secret_scan(_docs(s), terms=["apache license"]).withColumnRenamed("id", "doc_id")


SEED = "7"


@query("txt_pseudonymise_ids")
def _(s: Star) -> DataFrame:
    return s.staged("entities_campaign").select("campaign_id", pseudonyms.number(F.col("campaign_id"), "campaign_id", SEED).alias("pseudonym"))


@query("txt_pseudonymise_resources")
def _(s: Star) -> DataFrame:
    """Facts with their ids and action names, and so that they can be compared, the old action."""
    facts = s.staged("conv_campaign").select("account_id", "campaign_id", "date", "ad_network_type", "conversion_action", "conversion_action_name", F.col("conversion_action").alias("old_action"))
    return pseudonyms.rewritten(facts, SEED, ["account_id", "campaign_id"], ["conversion_action"], ["conversion_action_name"])


@query("txt_pseudonymise_text")
def _(s: Star) -> DataFrame:
    return s.staged("entities_campaign").select("campaign_id", pseudonyms.label(F.col("campaign_name"), "campaign_name", SEED).alias("name"))


@query("txt_pseudonymise_media")
def _(s: Star) -> DataFrame:
    """Addresses, video ids and texts of assets, an address of its own for each."""
    a = s.staged("entities_asset").withColumns({"image_url": F.concat(F.lit("https://example.com/"), F.when(F.col("asset_id") % 2 == 0, F.concat(F.lit("i/"), F.col("asset_id").cast("string"), F.lit(".png?w=1"))).otherwise(F.lit("")))})
    keys = ["account_id", "campaign_id", "asset_group_id", "asset_id"]
    return pseudonyms.rewritten(a.select(*keys, "image_url", "video_id", "asset_name", "text", "video_title"), SEED, [], [], ["asset_name", "text", "video_title"], ["image_url"], ["video_id"])


def _id_mapping(s: Star, below: int = pseudonyms.RANGE) -> DataFrame:
    """All ids of four tables, those inside resource names too."""
    entities, facts = s.staged("entities_asset_group_asset"), s.staged("conv_campaign")
    links = s.staged("entities_campaign_asset")
    return pseudonyms.mapping([
        (entities, ["account_id", "campaign_id", "asset_group_id", "asset_id"], []), (facts, ["account_id", "campaign_id"], ["conversion_action"]),
        (links, ["account_id", "campaign_id", "asset_id"], ["asset_resource_name"]), (s.staged("entities_campaign"), ["account_id", "campaign_id", "budget_id"], []),
    ], SEED, below)


query("txt_id_mapping")(_id_mapping)
#: So few numbers that some ids meet, which the real range has none of.
query("txt_id_clashes")(lambda s: pseudonyms.clashes(_id_mapping(s, 1000)))


@query("txt_perturb_metrics")
def _(s: Star) -> DataFrame:
    return s.staged("volume_campaign").select("account_id", "campaign_id", "date", "ad_network_type", text.perturbed(F.col("conversions_value"), [F.col("campaign_id"), F.col("date"), F.col("ad_network_type")], 7).alias("conversions_value"))


@query("txt_repair_identities")
def _(s: Star) -> DataFrame:
    keys = ["account_id", "campaign_id", "date", "ad_network_type", "conversion_action"]
    lags = text.at_least(s.staged("lag_campaign"), {"conversions": "all_conversions", "conversions_value": "all_conversions_value"})
    doubled = s.staged("conv_campaign").withColumn("conversions", F.col("conversions") * 2)
    return text.repaired_lags(lags, doubled, keys, ["conversion_lag_bucket"]).select(*keys, "conversion_lag_bucket", "conversions", "all_conversions")


query("lag_ladder_days")(lambda s: lag.ladder_days(s.spark, P).join(s.ladder.groupBy("cohort_day").agg(F.count("*").alias("rungs"), F.count_if("is_window_rung").alias("window_rungs")), "cohort_day", "left").fillna(0))
query("lag_timezones")(lambda s: s.zones)
query("lag_source_buckets")(lambda s: lag.source_buckets(s.loaded("lag_campaign"), s.loaded("lag_asset_group"), s.zones).drop("upper_day"))
query("lag_action_buckets")(lambda s: s.action_buckets)
query("lag_basis_buckets")(lambda s: s.basis_buckets)
query("lag_keys")(lambda s: lag.keys_with_window(s.basis_buckets, P))
query("lag_ladder")(lambda s: tally(s.ladder, ["grain", "metric_basis", "window_days", "window_provenance", "cohort_day", "is_window_rung"]))
query("lag_prefix_sums")(lambda s: s.prefixes)
query("lag_totals")(lambda s: s.totals)
query("lag_resolve_total")(lambda s: tally(s.resolved, ["grain", "click_date", "metric_basis", "cohort_day", "is_window_rung", "no_answer", "source_run_id"], ["cohorted_conversions", "cohorted_value"]))
query("lag_label_maturity")(lambda s: tally(s.cells, ["grain", "click_date", "cohort_label", "window_provenance", "provenance", "unavailable_reason", "maturity", "cohort_counting"], ["cohorted_conversions"]))


@query("lag_bucket_upper_day")
def _(s: Star) -> DataFrame:
    return s.action_buckets.groupBy("grain", "conversion_lag_bucket", "upper_day").agg(F.sum("conversions").alias("conversions"))


@query("lag_refresh_date")
def _(s: Star) -> DataFrame:
    rows = s.raw("lag_campaign").join(s.zones, "account_id", "left")
    return rows.select("account_id", "run_id", lag.local_date(F.col("loaded_at"), F.col("time_zone")).alias("refresh_date")).distinct()


for _g in ("campaign", "asset_group"):
    query(f"int_lag_prefix_{_g}")(lambda s, g=_g: s.cells.where(F.col("grain") == g).drop("grain", *(["asset_group_id"] if g == "campaign" else [])))
for _g in GRAINS:
    query(f"mart_cohort_{_g}")(lambda s, g=_g: s.cohorts(g))
    query(f"pub_cohort_{_g}")(lambda s, g=_g: publish.publish_cohorts(s.cohorts(g, together=True), P, g))


@query("ratio_cohort")
def _(s: Star) -> DataFrame:
    return publish.cohort_ratios(publish.publish_cohorts(s.cohorts("campaign"), P, "campaign"), ["account_id", "metric_basis", "cohort_day"])


# A reporting window shorter than some actions' windows: 25 days end inside a bucket, 30 days at the end of one.
SHORT, EVEN = 25, 30
query("lag_keys_capped")(lambda s: lag.keys_with_window(s.basis_buckets, s.under(SHORT).p))
query("int_lag_prefix_campaign_capped")(lambda s: s.under(SHORT).cells.where("grain = 'campaign'").drop("grain", "asset_group_id"))
query("int_lag_prefix_campaign_even")(lambda s: s.under(EVEN).cells.where("grain = 'campaign'").drop("grain", "asset_group_id"))
query("mart_cohort_campaign_capped")(lambda s: s.under(SHORT).cohorts("campaign"))
query("obs_windows_capped")(lambda s: observation.capped_windows(s.windows, s.under(SHORT).p))


# Observation diary. Today's run is the second load; its window is what the diary looks back.
TODAY = "load-2"
FROM = P.as_of - dt.timedelta(observed.DEPTH)


def _entities(s: Star) -> dict[str, DataFrame]:
    return {g: s.raw(t) for g, (t, _) in observation.PRESENT.items()}


def _landed(s: Star) -> DataFrame:
    return s.table(("landed",), lambda: observation.landed({g: s.raw(f"volume_{g}") for g in GRAINS}, {g: s.raw(f"conv_{g}") for g in GRAINS}, TODAY, P.as_of, FROM, P.as_of))


def _prior(s: Star) -> DataFrame:
    return observation.prior_nonzero(s.packed(), TODAY, P.as_of, FROM, P.as_of)


def _complete(s: Star) -> DataFrame:
    # Odd accounts' customer rows came with the first load only, so either load's row makes an account complete here.
    return observation.grain_complete(s.raw("entities_customer").withColumn("run_id", F.lit(TODAY)), _entities(s), TODAY, P.as_of)


def _zeros(s: Star) -> DataFrame:
    seen = _landed(s)  # first, so that landed facts are written before staging reads them
    return observation.synthetic_zeros(_prior(s), seen, _complete(s), _entities(s), TODAY, P.as_of, P.as_of)


query("obs_winning_runs")(lambda s: s.winners)
query("obs_selected")(lambda s: s.selected())
query("obs_landed")(_landed)
query("obs_prior_nonzero")(_prior)
query("obs_grain_complete")(_complete)
query("obs_synthetic_zeros")(_zeros)
query("obs_diary")(lambda s: _landed(s).unionByName(_zeros(s)))
query("obs_observed_date")(lambda s: observation.observed_dates(s.mart("customer"), "1998-07-01 03:00:00"))


def _latest_actions(s: Star) -> DataFrame:
    actions = s.staged("entities_conversion_action", True)
    return observation.latest_actions(s.raw("entities_customer"), actions, s.runs)


query("obs_depth_contract")(lambda s: observation.depth_contract(_latest_actions(s), P))
query("obs_forfeited_actions")(lambda s: observation.forfeited_actions(_latest_actions(s), P))
query("obs_account_bounds")(lambda s: s.observation_bounds)
query("obs_keys")(lambda s: tally(s.observation_keys, ["grain", "click_date", "account_id", "metric_basis", "conversion_action_id", "conversion_action_name", "time_zone"]))
query("obs_windows")(lambda s: observation.capped_windows(s.windows, P))


@query("obs_ladder")
def _(s: Star) -> DataFrame:
    """Series that share a window are counted before they meet it and become rungs."""
    by = ["grain", "click_date", "account_id", "metric_basis"]
    few = tally(s.observation_keys, [*by, "conversion_action_resource_name"])
    steps = observation.ladder(few, s.observation_windows, s.observation_bounds, P)
    return steps.groupBy(*by, "cohort_day", "is_window_rung", "target_date", "latest_observed_date").agg(F.sum("n").alias("n"))


query("obs_first_snapshot")(lambda s: s.first_snapshots)
query("obs_asof_reading")(lambda s: tally(s.asof_readings(), ["grain", "click_date", "account_id", "cohort_day", "observed_date", "source_run_id", "first_snapshot_date"], ["conversions", "conversions_value"]))


@query("obs_resolve")
def _(s: Star) -> DataFrame:
    r = s.asof_readings().withColumn("r", observation.resolution(P))
    return r.groupBy("grain", "cohort_day", F.col("r.provenance").alias("provenance"), F.col("r.reason").alias("reason")).agg(F.count("*").alias("n"))


query("int_observation_cells")(lambda s: s.observation_cells())
query("obs_baseline")(lambda s: observation.baseline(s.diary()))
def _windows(s: Star) -> DataFrame:
    dates = observation.observed_dates(s.mart("customer"), "1998-07-01 03:00:00")
    return observation.window_clamp(observation.depth_by_account(dates, _latest_actions(s), P), P.window_start)


query("obs_window_clamp")(_windows)
query("obs_window_scan")(lambda s: stamp(observation.window_scan(s.report("volume"), _windows(s), P.window_start)).select("account_id", "campaign_id", "date", "ad_network_type", "run_id", "observed_date", "lag", "conversions"))


@query("bps_asset_group_count")
def _(s: Star) -> DataFrame:
    return scores.asset_group_count(s.history("asset"), s.history("asset_group"), P.as_of)


@query("bps_audience_count")
def _(s: Star) -> DataFrame:
    return scores.audience_count(s.history("asset_group_signal"), P.as_of)


query("bps_sitelinks")(lambda s: scores.sitelinks(s.history("campaign"), s.history("campaign_asset"), s.account_links(), P.as_of))
query("bps_action_items")(lambda s: scores.action_items(s.mart("asset_group")))
query("bps_asset_counts")(lambda s: s.asset_counts)
query("mart_bp_campaign")(lambda s: s.bp_campaign)
query("mart_bp_asset_group")(lambda s: s.bp_asset_group)
query("mart_bp_extended")(lambda s: s.bp_extended)


# Parity: the second chain
class _Second:
    """Its tables, from the entity marts of the last day."""

    def __init__(self, s: Star):
        self.s = s
        self.assets, self.signals = upstream.assets(s.mart("asset")), upstream.signals(s.mart("asset_group_signal"))
        self.settings, self.summary, self.ocid = upstream.settings(s.mart("campaign")), upstream.summary(s.mart("asset_group"), s.mart("campaign")), upstream.ocid(s.mart("customer"))
        self.goals = (upstream.category(s.staged("conv_campaign")), upstream.custom(s.mart("campaign")), upstream.goal_names(s.mart("customer")))

    def data(self) -> DataFrame:
        settings = self.settings.withColumn("url_expansion_opt_out", parity.url_opt_out(F.col("asset_automation_settings"))).drop("asset_automation_settings")
        today = F.col("snapshot_date") == F.lit(P.as_of)
        own = upstream.links(self.s.history("campaign_asset").where(today & ~F.col("inferred_removed")), ["account_id", "campaign_id"])
        shared = upstream.links(self.s.account_links().where(today), ["account_id"])
        return parity.campaign_data(settings, self.assets, self.signals, own, shared, parity.primary_action_pmax(*self.goals), parity.primary_action_search(*self.goals), self.ocid)

    def practices(self) -> DataFrame:
        return parity.asset_group_practices(self.summary, parity.image_assets(self.assets, self.summary), parity.text_assets(self.assets, self.summary), parity.video_assets(self.assets, self.summary), self.signals, self.settings, self.ocid)

    def theirs(self) -> DataFrame:
        return parity.their_rows(parity.campaign_score(self.data()), self.practices())

    def ours(self) -> DataFrame:
        return parity.our_rows(self.s.bp_campaign, self.s.bp_asset_group)


query("par_image_assets")(lambda s: (lambda t: parity.image_assets(t.assets, t.summary))(_Second(s)))
query("par_text_assets")(lambda s: (lambda t: parity.text_assets(t.assets, t.summary))(_Second(s)))
query("par_video_assets")(lambda s: (lambda t: parity.video_assets(t.assets, t.summary))(_Second(s)))
query("par_primary_action_pmax")(lambda s: parity.primary_action_pmax(*_Second(s).goals))
query("par_primary_action_search")(lambda s: parity.primary_action_search(*_Second(s).goals))
query("par_campaign_data")(lambda s: _Second(s).data())
query("par_campaign_score")(lambda s: parity.campaign_score(_Second(s).data()))
query("par_asset_group_practices")(lambda s: _Second(s).practices())
query("par_url_opt_out")(lambda s: _Second(s).settings.select("account_id", "campaign_id", parity.url_opt_out(F.col("asset_automation_settings")).alias("url_expansion_opt_out")))
query("par_score_rows")(lambda s: _Second(s).theirs().unionByName(_Second(s).ours()))
query("par_compare")(lambda s: parity.compare(_Second(s).theirs(), _Second(s).ours(), P.tolerances["parity"]))
query("par_paused_excluded")(lambda s: parity.paused_excluded(s.bp_campaign, s.bp_asset_group))


# Assertions
_FACT = ["account_id", "campaign_id"]
_BASIS = ["metric_basis", "ad_network_type", "conversion_action_id", "conversion_action_resource_name"]
_GROUP, _ASSET = [*_FACT, "asset_group_id"], [*_FACT, "asset_group_id", "asset_id", "field_type"]
#: Mart -> what names a row of it.
MART_KEYS = {
    "performance_campaign": ["date", *_FACT, *_BASIS], "performance_asset_group": ["date", *_GROUP, *_BASIS], "performance_asset": ["date", *_ASSET, *_BASIS], "asset_performance": ["date", *_ASSET, *_BASIS],
    "campaign_truth": ["date", *_FACT, "ad_network_type"], **{f"entities_{e}": ["snapshot_date", *k] for e, k in ent.KEYS.items()},
    "bp_campaign": ["snapshot_date", *_FACT], "bp_asset_group": ["snapshot_date", *_GROUP], "bp_extended": ["snapshot_date", *_GROUP],
}


def _keyed(s: Star, nullable: tuple[str, ...] = ()) -> dict[str, tuple[DataFrame, list[str]]]:
    marts = s.marts()
    return {m: (marts[m](), [k for k in keys if k not in nullable]) for m, keys in MART_KEYS.items()}


def _cohort_keys(s: Star) -> dict[str, tuple[DataFrame, list[str]]]:
    return {g: (s.cohorts(g, together=True), lag.COHORT_KEYS[g]) for g in GRAINS}


CHECKS = {
    "unique_keys": lambda s: checks.unique_keys(_keyed(s)),
    "not_null": lambda s: checks.not_null(_keyed(s, ("ad_network_type", "conversion_action_id", "conversion_action_resource_name"))),
    "cohort_integrity": lambda s: checks.cohort_integrity(_cohort_keys(s)),
    "cohort_observation_reconciliation": lambda s: checks.observation_reconciliation(s.observation_cells("asset_group"), s.cohorts("asset_group"), P, P.tolerances["grain"]),
    "row_count_floor": lambda s: checks.row_count_floor(s.truth(), s.staged("volume_campaign")),
    "family_coherence": lambda s: checks.family_coherence(s.facts("campaign"), {e: (s.history(e), ent.KEYS[e]) for e in ENTITIES if e != "customer"}),
    "asset_not_over_campaign": lambda s: checks.asset_not_over_campaign(s.facts("asset"), s.truth(), P),
    "campaign_reconciliation": lambda s: checks.campaign_reconciliation(s.facts("campaign"), s.truth(), P),
    "cross_grain_identity": lambda s: checks.cross_grain_identity(s.cohorts("campaign"), s.cohorts("asset_group"), P),
    "cohort_reconciliation": lambda s: checks.cohort_reconciliation({g: s.cohorts(g) for g in ("campaign", "asset_group")}, {g: s.facts(g) for g in ("campaign", "asset_group")}, s.basis_buckets, P),
    "required_tables_nonempty": lambda s: checks.required_nonempty(
        {**{f"mart_performance_{g}": s.facts(g) for g in ("campaign", "asset_group")}, **{f"int_lag_prefix_{g}": s.cells.where(F.col("grain") == g) for g in ("campaign", "asset_group")}, **{f"mart_cohort_{g}": s.cohorts(g) for g in ("campaign", "asset_group")}},
        s.mart("customer"), s.mart("campaign"), observed.first_snapshot_marks(s.spark, s.sf_dir), P),
    "serving_budget_has_cost": lambda s: checks.serving_budget_has_cost(s.mart("campaign"), s.truth(), P),
}
for _n, _days in (("capped", SHORT), ("even", EVEN)):
    query(f"assert_cohort_reconciliation_{_n}")(lambda s, d=_days: checks.cohort_reconciliation({g: s.under(d).cohorts(g) for g in ("campaign", "asset_group")}, {g: s.facts(g) for g in ("campaign", "asset_group")}, s.basis_buckets, s.under(d).p))
for _c, _f in CHECKS.items():
    query(f"assert_{_c}")(_f)


def _results(s: Star) -> DataFrame:
    return s.table(("assertion_results",), lambda: checks.collected({c: f(s) for c, f in CHECKS.items()}))


@query("rpt_assertion_results")
def _(s: Star) -> DataFrame:
    """Two runs' results, appended to one table; the last run's are read back, failures first."""
    path = _folder(s, "results")
    for run in ("run-before", P.run_id):
        reports.store_results(_results(s), path, run)
    return reports.read_results(s.spark, path, P.run_id)


query("assert_run_decision")(lambda s: checks.run_decision(_results(s)))


# Reports
def _cohort_marts(s: Star) -> dict[str, DataFrame]:
    return {g: s.cohorts(g) for g in GRAINS}


def _published(s: Star) -> dict[str, DataFrame]:
    """The eight published tables."""
    out = {f"performance_{g}": publish.publish(s.facts(g), P, DIMENSIONS[g]) for g in GRAINS}
    out["asset_performance"] = publish.publish(s.facts("asset"), P, ["date", "account_id", "campaign_id", "asset_id", "field_type", "asset_primary_status", "asset_primary_status_reasons", "ad_network_type", "metric_basis"])
    out["campaign_truth"] = publish.publish(s.truth(), P, ["date", "account_id", "campaign_id", "campaign_name", "ad_network_type", "currency_code"], performance.NETWORK)
    return out | {f"cohort_{g}": publish.publish_cohorts(s.cohorts(g, together=True), P, g) for g in GRAINS}


@query("rpt_freshness")
def _(s: Star) -> DataFrame:
    """All staged tables and marts up to the last day, published tables up to the day before."""
    day = lambda df: next(d for d in ("date", "click_date", "snapshot_date") if d in df.columns)
    now = {t: (s.staged(t), staging.day_column(t)) for t in staging.GRAINS} | {f"mart_{m}": (df, day(df)) for m, df in s.assembled().items()}
    before = {f"pub_{m}": (df, day(df)) for m, df in _published(s).items()}
    return checks.freshness(now, str(P.as_of)).unionByName(checks.freshness(before, str(P.as_of - dt.timedelta(1))))


query("rpt_assumed_current")(lambda s: reports.assumed_current(_cohort_marts(s)))
query("rpt_participation")(lambda s: reports.participation(s.facts("asset"), s.truth(), P))
query("rpt_unknown_lag")(lambda s: reports.unknown_lag(s.cohorts("campaign")))
query("rpt_coverage")(lambda s: reports.coverage(_cohort_marts(s)))
query("rpt_gap_summary")(lambda s: reports.gap_summary(reports.issues(_cohort_marts(s))))
query("rpt_gap_examples")(lambda s: reports.gap_examples(reports.issues(_cohort_marts(s))))
query("rpt_zero_cost")(lambda s: checks.zero_cost(s.mart("campaign"), s.truth(), P))
query("rpt_publish_reconcile")(lambda s: reports.publish_reconcile(s.facts("campaign"), publish.publish(s.facts("campaign"), P, DIMENSIONS["campaign"]), P, ["network_cost", "network_conversions", "action_conversions"]))


@query("rpt_publish_reconcile_all")
def _(s: Star) -> DataFrame:
    """All eight published tables and all of their measures."""
    marts = {**{f"performance_{g}": s.facts(g) for g in GRAINS}, "asset_performance": s.facts("asset"), "campaign_truth": s.truth(), **{f"cohort_{g}": publish.shown_cohorts(s.cohorts(g), P, g) for g in GRAINS}}
    measures = lambda t: lag.SUMS if t.startswith("cohort") else performance.NETWORK if t == "campaign_truth" else [*performance.NETWORK, *performance.BY_ACTION]
    day = lambda t: "click_date" if t.startswith("cohort") else "date"
    return reports.reconcile_published({t: (marts[t], df, day(t), measures(t)) for t, df in _published(s).items()}, P)


query("rpt_month_stability")(lambda s: reports.month_stability(s.raw("volume_campaign").where("run_id = 'load-1'"), s.staged("volume_campaign"), P.as_of - dt.timedelta(45)))
query("rpt_table_reconcile")(lambda s: reports.table_reconcile(
    {"volume_campaign": (s.staged("volume_campaign"), "date", "cost_micros"), **{f"cohort_{g}": (s.cohorts(g), "click_date", "cohorted_conversions") for g in GRAINS}}, P.as_of - dt.timedelta(30)))


@query("rpt_latest_parity")
def _(s: Star) -> DataFrame:
    """Two parity runs of the day, the first without any tolerance, are appended to the stage table; the last one is read back."""
    path = _folder(s, "stages")
    theirs, ours = s.table(("parity", "theirs"), lambda: _Second(s).theirs()), s.table(("parity", "ours"), lambda: _Second(s).ours())
    for hour, tolerance in (("01", 0.0), ("02", P.tolerances["parity"])):
        reports.parity_event(parity.compare(theirs, ours, tolerance), P.as_of, "score rows", f"1998-07-01 {hour}:00:00").write.mode("append").parquet(path)
    return reports.latest_parity(s.spark.read.parquet(path))


# Ledger: users' events stand for runs and for checkpoints
def _runs(s: Star) -> DataFrame:
    """A run is a user; purchases end it, errors fail it. Times are whole days, so that events tie."""
    event = F.when(F.col("event_type") == "purchase", "EXITED").when(F.col("event_type") == "error", "FAILED").otherwise("RUNNING")
    return s.given("events").select(F.col("user_id").alias("run_id"), F.to_date("ts").alias("event_ts"), event.alias("event"), "event_id")


def _checkpoints(s: Star) -> DataFrame:
    """A purchase or signup marks a month of an account as done for a family, under one of two hashes."""
    e = s.given("events").where("event_type IN ('purchase', 'signup')")
    return e.select((F.col("user_id") % 5).alias("account_id"), F.add_months(F.trunc("ts", "MM"), (-(F.col("event_id") % 45)).cast("int")).alias("chunk"), F.element_at(F.array(*map(F.lit, "ABCD")), (F.col("user_id") % 4 + 1).cast("int")).alias("family"),
                    F.concat(F.lit("h"), (F.col("event_id") % 2).cast("string")).alias("query_hash"), F.lit("DONE").alias("event"), F.col("ts").alias("event_ts"), "event_id")


RUN_DAY, HISTORY = dt.date(2024, 1, 31), dt.date(2020, 1, 1)
query("ops_latest_run_state")(lambda s: ledger.latest_run_state(_runs(s)))
query("ops_unfinished_runs")(lambda s: ledger.unfinished_runs(_runs(s), dt.date(2024, 1, 16)))
query("ops_latest_checkpoints")(lambda s: ledger.latest_checkpoints(_checkpoints(s)))
query("ops_pending_chunks")(lambda s: ledger.pending_chunks(_checkpoints(s), _checkpoints(s), HISTORY, RUN_DAY, "h0", list("ABCD")))
query("ops_frozen_chunks")(lambda s: ledger.frozen_chunks(_checkpoints(s), RUN_DAY))
query("ops_chunk_bounds")(lambda s: ledger.chunk_bounds(_checkpoints(s).select("account_id", "chunk").distinct(), dt.date(2023, 11, 10), dt.date(2024, 1, 20)))


def _reset(s: Star) -> tuple[DataFrame, DataFrame]:
    stages = _runs(s).select(F.col("run_id").cast("string").alias("run_id"), F.lit("run").alias("stage"), F.col("event").alias("status"), F.lit(None).cast("bigint").alias("account_id"), F.lit(None).cast("string").alias("detail"), F.col("event_ts").cast("timestamp_ntz").alias("event_ts"))
    return ledger.checkpoint_reset(_checkpoints(s), stages, 2, dt.date(2024, 1, 1), "reset-1", "2024-02-01 00:00:00")


@query("ops_checkpoint_reset")
def _(s: Star) -> DataFrame:
    left, stages = _reset(s)
    return left.groupBy("account_id", "chunk").agg(F.count("*").alias("n")).unionByName(stages.where("stage = 'checkpoint_reset'").select("account_id", F.lit(None).cast("date").alias("chunk"), F.split("detail", ": ")[1].cast("bigint").alias("n")))


@query("ops_first_snapshot")
def _(s: Star) -> DataFrame:
    e = s.given("events")
    mark = lambda df: df.select((F.col("user_id") % 20).alias("account_id"), F.concat(F.lit("r"), (F.col("user_id") % 7).cast("string")).alias("run_id"), F.to_date("ts").alias("first_snapshot_date"), F.col("event_id").alias("set_at"))
    runs = e.select(F.concat(F.lit("r"), (F.col("user_id") % 7).cast("string")).alias("run_id"), F.when(F.col("user_id") % 7 < 2, "SUCCESS").otherwise("FAILED").alias("status"))
    return ledger.first_snapshot_rows(mark(e.where("event_type = 'purchase' AND user_id < 40")), runs, mark(e.where("event_type = 'signup'")))


def _named(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("string").alias("name"), "text")


query("ops_checkpoint_hash")(lambda s: ledger.checkpoint_hash(_named(s.given("documents")), "v1"))


@query("ops_hash_ranges")
def _(s: Star) -> DataFrame:
    """The upper levels of the tree."""
    return ledger.hash_tree(ledger.hash_entries(_named(s.given("documents")))).where("level <= 2")


@query("ops_changed_texts")
def _(s: Star) -> DataFrame:
    """The documents against a state in which some have another text, some are gone and some are new; found by going down the trees."""
    docs = s.given("documents").select("doc_id", "text")
    later = docs.where("doc_id % 101 <> 1").withColumn("text", F.when(F.col("doc_id") % 97 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit("!"))).otherwise(F.col("text")))
    later = later.unionByName(docs.where("doc_id % 89 = 5").withColumn("doc_id", F.col("doc_id") + 10**9))
    entries = [s.table(("entries", k), lambda d=d: ledger.hash_entries(_named(d))) for k, d in (("old", docs), ("new", later))]
    trees = [s.table(("tree", k), lambda e=e: ledger.hash_tree(e)) for k, e in zip(("old", "new"), entries)]
    return ledger.changed_texts(*entries, *trees)


# Sinks. Each writes under the session's shared folder and gives what a reader then finds.
def _folder(s: Star, name: str) -> str:
    return f"{shared_dir(s.spark)}/{name}-{uuid.uuid4().hex}"


def _first_load(s: Star) -> DataFrame:
    return stamp(s.raw("volume_campaign")).where("run_id = 'load-1'")


WEEK = (P.as_of - dt.timedelta(20), P.as_of - dt.timedelta(14))


def _next(label: str) -> str:
    """The id of a generation that a query makes."""
    return f"{label}-{uuid.uuid4().hex}"


@query("snk_range_replace")
def _(s: Star) -> DataFrame:
    """A week of the first load gives way to the second load's rows of it."""
    g, new = s.store(), stamp(s.raw("volume_campaign")).where((F.col("run_id") == TODAY) & F.col("date").between(*WEEK))
    sinks.range_replace(g, "volume", new, *WEEK, _next("week"))
    return g.read("volume")


@query("snk_snapshot_replace")
def _(s: Star) -> DataFrame:
    """The last day's snapshot gives way to the second load's."""
    g, raw = s.store(), stamp(s.raw("entities_campaign"))
    sinks.snapshot_replace(g, "campaigns", raw.where((F.col("run_id") == TODAY) & (F.col("snapshot_date") == F.lit(P.as_of))), P.as_of, _next("snapshot"))
    return g.read("campaigns")


@query("snk_observation_append")
def _(s: Star) -> DataFrame:
    path = _folder(s, "observations")
    for part in ("observed_date < '1998-06-29'", "observed_date >= '1998-06-29'"):
        sinks.append(s.diary().where(part), path, "observed_date")
    return tally(s.spark.read.parquet(path), ["observed_date", "run_id", "account_id", "grain", "metric_basis"], ["conversions", "conversions_value"])


@query("snk_slice_export")
def _(s: Star) -> DataFrame:
    path = _folder(s, "slice")
    sinks.export_slice(s.selected(), path, P.as_of - dt.timedelta(1))
    return s.spark.read.schema(s.selected().schema).parquet(path)


@query("snk_slice_export_account")
def _(s: Star) -> DataFrame:
    """One account's rows of a day; only its folder is read, of the diary and of the export."""
    path = _folder(s, "slice")
    sinks.export_slice(s.selected(), path, P.as_of - dt.timedelta(1), 2)
    return s.spark.read.schema(s.selected().schema).parquet(path)


@query("snk_table_layout")
def _(s: Star) -> DataFrame:
    path = _folder(s, "laid-out")
    df = s.staged("conv_campaign")
    sinks.lay_out(df, path, "date", ["account_id", "campaign_id"])
    return s.spark.read.schema(df.schema).parquet(path)


@query("snk_clustered_asof")
def _(s: Star) -> DataFrame:
    """Facts and snapshots in two declared tables of one clustering, empty at first; the as-of join moves neither."""
    keys, frames = tuple(ent.KEYS["campaign"]), {"facts": s.staged("volume_campaign"), "view": s.view("campaign").select(*ent.KEYS["campaign"], "snapshot_date", "status")}
    tables = {}
    for kind, df in frames.items():
        day = "date" if kind == "facts" else "snapshot_date"
        name = f"{kind}_{uuid.uuid4().hex}"
        layout = declared.Layout(dict(df.dtypes), keys, 8, (*keys, day))
        if not declared.declare(s.spark, name, layout, _folder(s, name)).isEmpty():
            raise ValueError(f"{name} is not empty")
        tables[kind] = declared.fill(df, name, layout)
    out = performance.asof_in_place(tables["facts"], tables["view"], list(keys), {"status": "status", "snapshot_date": "snapshot_date"})
    return out.select("date", "account_id", "campaign_id", "ad_network_type", "status", "snapshot_date")


@query("snk_publish_generation")
def _(s: Star) -> DataFrame:
    g = Generations(s.spark, _folder(s, "published"))
    g.commit(_published(s), P.run_id)
    g = Generations(s.spark, g.root)
    parts = [g.read(t).agg(F.count("*").alias("n"), F.min("as_of").alias("as_of"), F.min("run_id").alias("run_id")).select(F.lit(t).alias("table_name"), "n", "as_of", "run_id") for t in sorted(_published(s))]
    return checks._union(parts)


query("snk_publish_guard")(lambda s: sinks.publish_guard(publish.publish(s.truth(), P, ["date", "account_id"], performance.NETWORK), dt.date(1998, 6, 29)))
@query("snk_retention_expire")
def _(s: Star) -> DataFrame:
    g = s.store()
    sinks.expire(g, "landed", P.as_of, P.reporting_window_days, _next("expired"))
    return g.read("landed")


@query("snk_retention_drift")
def _(s: Star) -> DataFrame:
    """What tables keep, told from their days, against what they should."""
    tables = {t: (s.raw(t), staging.day_column(t)) for t in ("volume_campaign", "conv_campaign", "entities_campaign", "entities_customer")}
    have = checks._union([df.agg(F.datediff(F.max(d), F.min(d)).alias("keep_days")).select(F.lit(t).alias("table_name"), "keep_days") for t, (df, d) in tables.items()])
    want = checks._union([df.limit(1).select(F.lit(t).alias("table_name"), (F.lit(119) if d == "date" else F.lit(None)).cast("int").alias("keep_days")) for t, (df, d) in tables.items() if t != "conv_campaign"])
    return sinks.retention_drift(want, have)


query("snk_loss_preview")(lambda s: sinks.loss_preview({t: (s.raw(t), "date") for t in staging.GRAINS if staging.day_column(t) == "date"}, P.as_of - dt.timedelta(100)))


@query("snk_quarantine")
def _(s: Star) -> DataFrame:
    """Rows without a network, of the days that have some, move to a table of their own."""
    g = s.store()
    g.quarantine("staged", F.col("ad_network_type").isNull() & (F.dayofmonth("date") < 8), _next("quarantine"))
    rows = lambda t: g.read(t).withColumn("is_aside", F.lit(t != "staged"))
    return rows("staged").unionByName(rows("staged_quarantine"))


@query("snk_restore_range")
def _(s: Star) -> DataFrame:
    """The second load takes the place of the first one's days; then a week is as it was."""
    g = s.store()
    second = stamp(s.raw("volume_campaign")).where(F.col("run_id") == TODAY)
    g.replace_range("volume", second, dt.date(1990, 1, 1), P.as_of, _next("second"))
    g.restore_range("volume", "one", *WEEK, _next("restored"))
    return g.read("volume")


@query("snk_inventory")
def _(s: Star) -> DataFrame:
    """After the week was replaced: which days of the table a change wrote, and which it took over."""
    g, new = s.store(), stamp(s.raw("volume_campaign")).where((F.col("run_id") == TODAY) & F.col("date").between(*WEEK))
    made = _next("week")
    g.replace_range("volume", new, *WEEK, made)
    return g.inventory(made).where("table_name = 'volume'").select("table_name", F.col("day").cast("date").alias("day"), (F.col("generation") == made).alias("is_new"))
