"""A second, independent chain of best-practice scores, and its comparison with the first one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scores import GROUP, IMAGES, TEXTS, VIDEOS, geo_good, geo_score, kind_counts, share_met, sitelink_score, uploaded

NAMES = ["account_id", "account_name", "campaign_id", "campaign_name", "asset_group_id", "asset_group_name"]
#: What is recommended, and the most that fits, by count; and the sums that count as images.
WANTED = {
    "Recommended": {"descriptions": 4, "headlines": 11, "long_headlines": 2, "images": 12, "landscape": 4, "square": 4, "portrait": 2, "logos": 2, "square_logos": 1, "landscape_logos": 1, "videos": 3},
    "Maximum": {"descriptions": 5, "headlines": 15, "long_headlines": 5, "images": 20, "landscape": 4, "square": 4, "portrait": 2, "logos": 2, "square_logos": 1, "landscape_logos": 1, "videos": 5},
}
SHOWN = ("landscape", "square", "portrait", "logos")


def counted(assets: DataFrame, summary: DataFrame, names: list[str], more: list[str] = ()) -> DataFrame:
    """Counts of each asset group in one pass, zero for groups without assets."""
    counts = kind_counts()
    by = assets.groupBy(*GROUP).agg(*[F.count_if(counts[n]).alias(n) for n in names], F.max(uploaded()).alias("_up"))
    out = summary.select(*NAMES, *more).distinct().join(by, GROUP, "left").fillna(0, names)
    return out


def image_assets(assets: DataFrame, summary: DataFrame) -> DataFrame:
    return counted(assets, summary, ["count_images", "count_logos", "count_landscape", "count_square", "count_portrait", "count_square_logos", "count_landscape_logos"]).drop("_up")


def text_assets(assets: DataFrame, summary: DataFrame) -> DataFrame:
    return counted(assets, summary, ["count_headlines", "count_short_headlines", "count_long_headlines", "count_descriptions", "count_short_descriptions"]).drop("_up")


def video_assets(assets: DataFrame, summary: DataFrame) -> DataFrame:
    out = counted(assets, summary, ["count_videos"], ["ad_strength"])
    return out.withColumn("is_video_uploaded", F.when(F.coalesce("_up", F.lit(False)), "Yes").otherwise("X")).drop("_up")


def _listed(c: str) -> Column:
    """Names as one text, in their order, so that the text doesn't vary."""
    return F.array_join(F.array_sort(F.collect_list(c)), ",")


def goals(category: DataFrame, custom: DataFrame, names: DataFrame) -> DataFrame:
    """The conversion goals of each campaign as one text: those of its categories, and its custom ones."""
    own = ["account_id", "campaign_id", "campaign_type"]
    plain = category.select(*own, "conversion_name").distinct().groupBy(*own).agg(_listed("conversion_name").alias("conversion_name"))
    special = custom.join(names, ["account_id", "custom_conversion_goal_id"]).select(*own, F.col("custom_conversion_goal_name").alias("conversion_name"))
    return plain.unionByName(special).groupBy(*own).agg(_listed("conversion_name").alias("conversion_name"))


def primary_action_pmax(category: DataFrame, custom: DataFrame, names: DataFrame) -> DataFrame:
    """The most used goal of each campaign. Frequencies are taken by campaign, so all of them rank first, as published."""
    g = goals(category, custom, names).where("campaign_type = 'PERFORMANCE_MAX'")
    often = g.groupBy("account_id", "conversion_name", "campaign_type", "campaign_id").agg(F.count_distinct("campaign_id").alias("n"))
    top = often.withColumn("r", F.rank().over(Window.partitionBy("account_id", "campaign_type").orderBy(F.desc("n")))).where("r = 1")
    return top.groupBy("account_id", "campaign_id").agg(_listed("conversion_name").alias("conversion_name"))


def primary_action_search(category: DataFrame, custom: DataFrame, names: DataFrame) -> DataFrame:
    """The goals that most search campaigns of an account use; ties all count."""
    g = goals(category, custom, names).where("campaign_type = 'SEARCH'")
    often = g.groupBy("account_id", "campaign_type", "conversion_name").agg(F.count_distinct("campaign_id").alias("n"))
    return often.withColumn("r", F.rank().over(Window.partitionBy("account_id", "campaign_type").orderBy(F.desc("n")))).where("r = 1").select("account_id", "conversion_name").distinct()


def campaign_data(settings: DataFrame, assets: DataFrame, signals: DataFrame, campaign_assets: DataFrame, customer_assets: DataFrame, pmax: DataFrame, search: DataFrame, ocid: DataFrame) -> DataFrame:
    """Settings of each campaign with targets by precedence, missing extensions, location flags and audiences."""
    c, a = "campaign_id", "account_id"
    targets = settings.groupBy(a, c).agg(
        F.max(F.coalesce("campaign_mcv_troas", "campaign_troas", "bidding_strategy_mcv_troas", "bidding_strategy_troas")).alias("troas"), F.max(F.coalesce("campaign_mc_tcpa", "campaign_tcpa", "bidding_strategy_mc_tcpa", "bidding_strategy_tcpa")).alias("tcpa"))
    kinds = {"SITELINK": "sitelinks", "CALLOUT": "callouts", "STRUCTURED_SNIPPET": "snippets"}
    count = lambda df, key, who: df.groupBy(key).agg(*[F.count_if(F.col("asset_type") == k).alias(f"{who}_{n}") for k, n in kinds.items()])
    out = settings.join(targets, [a, c], "left").join(search.withColumnRenamed("conversion_name", "primary_conversion_search"), a, "left")
    out = out.join(pmax.withColumnRenamed("conversion_name", "pmax_conversion"), [a, c], "left")
    out = out.join(assets.groupBy(c).agg(F.count_distinct("asset_group_id").alias("number_of_asset_groups")), c, "left").join(signals.groupBy(c).agg(F.count_distinct("audience_signals").alias("heard")), c, "left")
    out = out.join(count(campaign_assets, c, "own"), c, "left").join(count(customer_assets, a, "shared"), a, "left").join(ocid.withColumnRenamed("customer_id", a), a, "left")
    have = lambda n: F.coalesce(f"own_{n}", F.lit(0)) + F.coalesce(f"shared_{n}", F.lit(0))
    miss = lambda n, want: F.greatest(F.lit(want) - have(n), F.lit(0)).cast("bigint")
    cpa, roas = F.col("tcpa") > 0, F.col("troas") > 0
    return out.select(
        "date", a, "account_name", c, "campaign_name", "campaign_status", "url_expansion_opt_out", "troas", "tcpa", "pmax_conversion", "primary_conversion_search", "negative_geo_target_type", "positive_geo_target_type",
        F.coalesce("heard", F.lit(0)).alias("number_of_audience_signals"), "number_of_asset_groups", geo_good("negative_geo_target_type").alias("negative_geo_target_type_configured_good"), geo_good("positive_geo_target_type").alias("positive_geo_target_type_configured_good"),
        miss("sitelinks", 4).alias("missing_sitelinks"), miss("callouts", 1).alias("missing_callouts"), miss("snippets", 1).alias("missing_structured_snippets"),
        F.when(cpa, "tCPA").when(roas, "tROAS").otherwise("null").alias("target_type"), F.when(cpa, F.col("tcpa")).when(roas, F.col("troas")).alias("target_value"),
        F.when(F.col("heard").isNull(), 0.0).otherwise(F.try_divide(F.col("heard").cast("double"), F.col("number_of_asset_groups").cast("double"))).alias("audience_signals_score"), "ocid")


def campaign_score(data: DataFrame) -> DataFrame:
    """The published campaign score, and the mean of the three parts besides URL expansion."""
    rest = F.col("audience_signals_score") + sitelink_score(F.col("missing_sitelinks")) + geo_score(F.col("positive_geo_target_type_configured_good"), F.col("negative_geo_target_type_configured_good"))
    url = F.when(F.col("url_expansion_opt_out"), 1.0).otherwise(0.0)
    return data.select("date", "account_id", "account_name", "campaign_id", "campaign_name", F.round((url + rest) / 4, 2).alias("campaign_bp_score"), F.round(rest / 3, 2).alias("score_without_url")).distinct()


def asset_group_practices(summary: DataFrame, images: DataFrame, texts: DataFrame, videos: DataFrame, signals: DataFrame, settings: DataFrame, ocid: DataFrame) -> DataFrame:
    """What each group lacks of the recommended and of the most, one row for each of both."""
    parts = [images.drop(*NAMES[1::2]).withColumn("image_score", share_met(IMAGES)), texts.drop(*NAMES[1::2]).withColumn("text_score", share_met(TEXTS)), videos.drop(*NAMES[1::2], "ad_strength").withColumn("video_score", share_met(VIDEOS))]
    out = summary.join(settings.select("campaign_id").distinct(), "campaign_id", "left_semi")
    for part in parts:
        out = out.join(part, GROUP)
    out = out.join(signals.select("campaign_id", "asset_group_id", F.lit("Yes").alias("audience_signals")).distinct(), ["campaign_id", "asset_group_id"], "left").join(ocid.withColumnRenamed("customer_id", "account_id"), "account_id", "left")
    shown = sum((F.col(f"count_{n}") for n in SHOWN[1:]), F.col(f"count_{SHOWN[0]}"))
    have = lambda n: shown if n == "images" else F.col(f"count_{n}")
    gaps = F.array(*[F.struct(F.lit(kind).alias("recommendation_type"), *[F.greatest(F.lit(n) - have(c), F.lit(0)).cast("bigint").alias(f"missing_{c}") for c, n in want.items()]) for kind, want in WANTED.items()])
    return out.select("date", *NAMES, "ad_strength", "is_video_uploaded", "video_score", "text_score", "image_score", F.coalesce("audience_signals", F.lit("X")).alias("audience_signals"), "ocid", F.explode(gaps).alias("g")).select("*", "g.*").drop("g")


def url_opt_out(settings: Column) -> Column:
    """True if the list of settings has the expansion opted out; null without a list."""
    return F.exists(settings, lambda s: (F.upper(s["asset_automation_type"]) == "FINAL_URL_EXPANSION_TEXT_ASSET_AUTOMATION") & (F.upper(s["asset_automation_status"]) == "OPTED_OUT"))


KEY = ["entity_type", "account_id", "campaign_id", "asset_group_id", "metric"]
_FOUR = ["video_score", "text_score", "image_score", "asset_group_bp_score"]


def _long(groups: DataFrame) -> DataFrame:
    rows = groups.unpivot(GROUP, _FOUR, "metric", "score").where("score IS NOT NULL")
    return rows.select(F.lit("asset_group").alias("entity_type"), *GROUP, "metric", "score", F.lit(None).cast("double").alias("score_without_url"), F.lit(None).cast("boolean").alias("url_expansion_known"))


def score_rows(campaigns: DataFrame, groups: DataFrame) -> DataFrame:
    """Scores in long form, one row for each entity and metric."""
    top = campaigns.select(F.lit("campaign").alias("entity_type"), "account_id", "campaign_id", F.lit(None).cast("bigint").alias("asset_group_id"), F.lit("campaign_bp_score").alias("metric"), F.col("campaign_bp_score").alias("score"), "score_without_url", "url_expansion_known")
    return top.unionByName(_long(groups))


def their_rows(scores: DataFrame, practices: DataFrame) -> DataFrame:
    mean = F.round((F.col("video_score") + F.col("text_score") + F.col("image_score")) / 3, 2)
    return score_rows(scores.withColumn("url_expansion_known", F.lit(None).cast("boolean")), practices.where("recommendation_type = 'Recommended'").withColumn("asset_group_bp_score", mean))


def our_rows(campaigns: DataFrame, groups: DataFrame) -> DataFrame:
    """Ours, of enabled entities only."""
    return score_rows(campaigns.where("campaign_status = 'ENABLED'").withColumn("score_without_url", F.lit(None).cast("double")), groups.where("campaign_status = 'ENABLED' AND asset_group_status = 'ENABLED'"))


def compare(theirs: DataFrame, ours: DataFrame, tolerance: float) -> DataFrame:
    """One row for each key of either side: duplicate, missing, ours only, matched or mismatched.

    Where we don't know the URL rule, their score without it is compared. Differences are taken in decimals, the bound included.
    """
    pack = lambda df, s: df.groupBy(*KEY).agg(F.count("*").alias(f"n_{s}"), F.max("score").alias(s), F.max("score_without_url").alias(f"bare_{s}"), F.bool_and("url_expansion_known").alias(f"known_{s}"))
    x, y = pack(theirs, "theirs"), pack(ours, "ours")
    y = y.withColumnsRenamed({k: f"_{k}" for k in KEY})
    met = x.join(y, [x[k].eqNullSafe(y[f"_{k}"]) for k in KEY], "full")
    blind = (F.coalesce("entity_type", "_entity_type") == "campaign") & F.col("known_ours").eqNullSafe(F.lit(False))
    score = F.when(blind, F.col("bare_theirs")).otherwise(F.col("theirs"))
    gap = F.abs(score.cast("decimal(20,6)") - F.col("ours").cast("decimal(20,6)"))
    status = (
        F.when((F.coalesce("n_theirs", F.lit(0)) > 1) | (F.coalesce("n_ours", F.lit(0)) > 1), "duplicate key").when(F.col("n_ours").isNull(), "missing in ours").when(F.col("n_theirs").isNull(), "ours only")
        .when(score.isNull(), "no comparable score").when(gap <= F.lit(tolerance).cast("decimal(20,6)"), "matched").otherwise("mismatch"))
    return met.select(*[F.coalesce(k, f"_{k}").alias(k) for k in KEY], score.alias("their_score"), F.col("ours").alias("our_score"), F.coalesce(blind, F.lit(False)).alias("without_url_rule"), status.alias("status"))


def paused_excluded(campaigns: DataFrame, groups: DataFrame) -> DataFrame:
    """How many entities the comparison leaves out as not enabled."""
    a = campaigns.agg(F.count_if(F.col("campaign_status") != "ENABLED").alias("a"))
    b = groups.agg(F.count_if((F.col("campaign_status") != "ENABLED") | (F.col("asset_group_status") != "ENABLED")).alias("b"))
    return a.crossJoin(b).select((F.col("a") + F.col("b")).alias("paused_excluded"))  # one row each
