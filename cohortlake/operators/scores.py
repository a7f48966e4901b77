"""Counts behind the best-practice scores of campaigns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.plans.params import Params

SITELINKS_WANTED = 4
GROUP = ["account_id", "campaign_id", "asset_group_id"]
#: The kinds of assets that a full feed covers, and how many of each kind score.
FEED = ["HEADLINE", "LONG_HEADLINE", "DESCRIPTION", "MARKETING_IMAGE", "SQUARE_MARKETING_IMAGE", "PORTRAIT_MARKETING_IMAGE", "LOGO", "YOUTUBE_VIDEO"]
VIDEOS = {"count_videos": 3}
TEXTS = {"count_descriptions": 4, "count_headlines": 11, "count_long_headlines": 2}
IMAGES = {"count_landscape": 4, "count_square": 4, "count_portrait": 4, "count_landscape_logos": 1, "count_square_logos": 1}


def asset_group_count(assets: DataFrame, groups: DataFrame, as_of: dt.date) -> DataFrame:
    """Enabled groups of each campaign that have an enabled asset of the advertiser's own."""
    day = F.col("snapshot_date") == F.lit(as_of)
    own = assets.where(day & (F.col("status") == "ENABLED") & (F.col("source") == "ADVERTISER")).select("account_id", "campaign_id", "asset_group_id")
    live = groups.where(day & (F.col("status") == "ENABLED")).select("account_id", "campaign_id", "asset_group_id")
    return live.join(own, ["account_id", "campaign_id", "asset_group_id"], "left_semi").groupBy("account_id", "campaign_id").agg(F.count_distinct("asset_group_id").alias("asset_groups"))


def audience_count(signals: DataFrame, as_of: dt.date) -> DataFrame:
    """Distinct audiences among a campaign's signals."""
    on = signals.where((F.col("snapshot_date") == F.lit(as_of)) & (F.col("audience") != ""))
    return on.groupBy("account_id", "campaign_id").agg(F.count_distinct("audience").alias("audiences"))


def sitelinks(campaigns: DataFrame, campaign_assets: DataFrame, customer_assets: DataFrame, as_of: dt.date) -> DataFrame:
    """Sitelinks of each campaign and of its account, and how many are missing."""
    day = F.col("snapshot_date") == F.lit(as_of)
    live = day & (F.col("field_type") == "SITELINK") & (F.col("status") == "ENABLED")
    own = campaign_assets.where(live).groupBy("account_id", "campaign_id").agg(F.count("*").alias("campaign_sitelinks"))
    shared = customer_assets.where(live).groupBy("account_id").agg(F.count("*").alias("account_sitelinks"))
    out = campaigns.where(day).select("account_id", "campaign_id").join(own, ["account_id", "campaign_id"], "left").join(shared, "account_id", "left")
    out = out.fillna(0, ["campaign_sitelinks", "account_sitelinks"])
    return out.withColumn("missing_sitelinks", F.greatest(F.lit(SITELINKS_WANTED) - F.col("campaign_sitelinks") - F.col("account_sitelinks"), F.lit(0).cast("bigint")))


def geo_good(column: str) -> Column:
    """Anything but the wide setting counts as not good; a missing one counts as good."""
    return F.when(F.col(column) != "PRESENCE_OR_INTEREST", "X").otherwise("Yes")


def geo_score(positive: Column, negative: Column) -> Column:
    return ((positive == "Yes").cast("double") + (negative == "Yes").cast("double")) / 2


def sitelink_score(missing: Column) -> Column:
    """Full marks if none is missing; else, as published, a quarter for each one that is."""
    return F.when(missing == 0, 1.0).otherwise(missing.cast("double") / SITELINKS_WANTED)


def campaign_score(campaigns: DataFrame, groups: DataFrame, audiences: DataFrame, links: DataFrame, p: Params) -> DataFrame:
    """The score of each campaign: URL expansion where it is known, audiences by asset group, sitelinks, locations; their mean."""
    keys = ["account_id", "campaign_id"]
    c = campaigns.where("advertising_channel_type = 'PERFORMANCE_MAX' AND NOT coalesce(inferred_removed, FALSE)")
    c = c.join(groups, keys, "left").join(audiences, keys, "left").join(links, keys, "left")
    known = F.col("url_expansion_opt_out").isNotNull()
    out = c.select(
        "snapshot_date", *keys, "campaign_name", F.col("status").alias("campaign_status"), "url_expansion_opt_out", known.alias("url_expansion_known"), F.col("url_expansion_opt_out").cast("double").alias("url_expansion_score"),
        F.coalesce("audiences", F.lit(0)).alias("audience_signals_count"), F.coalesce("asset_groups", F.lit(0)).alias("asset_group_count"),
        F.when(F.col("audiences").isNull(), 0.0).otherwise(F.try_divide(F.col("audiences").cast("double"), F.col("asset_groups").cast("double"))).alias("audience_signals_score"),
        (F.coalesce("campaign_sitelinks", F.lit(0)) + F.coalesce("account_sitelinks", F.lit(0))).alias("sitelink_count"), F.coalesce("missing_sitelinks", F.lit(SITELINKS_WANTED)).alias("missing_sitelinks"),
        "positive_geo_target_type", "negative_geo_target_type", geo_good("positive_geo_target_type").alias("positive_geo_target_type_configured_good"), geo_good("negative_geo_target_type").alias("negative_geo_target_type_configured_good"),
    )
    out = out.withColumns({"sitelink_score": sitelink_score(F.col("missing_sitelinks")), "geo_target_score": geo_score(F.col("positive_geo_target_type_configured_good"), F.col("negative_geo_target_type_configured_good"))})
    rest = F.col("audience_signals_score") + F.col("sitelink_score") + F.col("geo_target_score")
    return out.withColumns({
        "campaign_bp_score": F.when(F.col("url_expansion_known"), F.round((F.col("url_expansion_score") + rest) / 4, 2)).otherwise(F.round(rest / 3, 2)),
        "url_expansion_parity_mode": F.when(F.col("url_expansion_known"), "KNOWN").otherwise("PARITY_NEUTRAL_UNKNOWN"), "run_id": F.lit(p.run_id),
    })


def kind_counts() -> dict[str, Column]:
    """What is counted among a group's assets, in one pass."""
    of = lambda *kinds: F.col("field_type").isin(*kinds)
    shape = F.round(F.try_divide(F.col("image_width_pixels").cast("double"), F.col("image_height_pixels").cast("double")), 2)
    return {
        "count_images": F.col("asset_type") == "IMAGE", "count_logos": of("LOGO"), "count_landscape": of("MARKETING_IMAGE"), "count_square": of("SQUARE_MARKETING_IMAGE"), "count_portrait": of("PORTRAIT_MARKETING_IMAGE"),
        "count_square_logos": of("LOGO") & (F.col("image_width_pixels") == F.col("image_height_pixels")), "count_landscape_logos": of("LOGO") & (shape == 4),
        "count_headlines": of("HEADLINE", "LONG_HEADLINE"), "count_short_headlines": of("HEADLINE"), "count_long_headlines": of("LONG_HEADLINE"),
        "count_descriptions": of("DESCRIPTION"), "count_short_descriptions": of("DESCRIPTION") & (F.length("text") <= 60), "count_videos": F.col("asset_type") == "YOUTUBE_VIDEO",
    }


def uploaded() -> Column:
    return (F.col("asset_type") == "YOUTUBE_VIDEO") & (F.col("video_id") != "")


def own_assets(assets: DataFrame) -> DataFrame:
    """Enabled assets of the advertiser's own that are still there."""
    return assets.where("status = 'ENABLED' AND source = 'ADVERTISER' AND NOT coalesce(inferred_removed, FALSE)")


def asset_counts(assets: DataFrame) -> DataFrame:
    """Thirteen counts for each asset group, and whether a video was uploaded."""
    return own_assets(assets).groupBy(*GROUP).agg(*[F.count_if(c).alias(n) for n, c in kind_counts().items()], (F.count_if(uploaded()) > 0).alias("has_uploaded_video"))


def share_met(wanted: dict[str, int]) -> Column:
    """The share of kinds of which there are enough."""
    met = [(F.col(c) >= n).cast("double") for c, n in wanted.items()]
    return sum(met[1:], met[0]) / float(len(met))


def asset_group_score(groups: DataFrame, campaigns: DataFrame, counts: DataFrame, signals: DataFrame, p: Params) -> DataFrame:
    """The score of each asset group: videos, texts, images; their mean."""
    there = "NOT coalesce(inferred_removed, FALSE)"
    heard = signals.where(f"audience IS NOT NULL AND {there}").select(*GROUP, F.lit("Yes").alias("audience_signals")).distinct()
    c = campaigns.where(there).select("account_id", "campaign_id", "campaign_name", F.col("status").alias("campaign_status"))
    out = groups.where(there).select("snapshot_date", *GROUP, "asset_group_name", F.col("status").alias("asset_group_status"), "ad_strength").join(c, ["account_id", "campaign_id"])
    out = out.join(counts, GROUP, "left").join(heard, GROUP, "left").fillna(0, list(kind_counts()))
    out = out.withColumns({"is_video_uploaded": F.when(F.col("has_uploaded_video"), "Yes").otherwise("X"), "audience_signals": F.coalesce("audience_signals", F.lit("X")), "video_score": share_met(VIDEOS), "text_score": share_met(TEXTS), "image_score": share_met(IMAGES)})
    mean = F.round((F.col("video_score") + F.col("text_score") + F.col("image_score")) / 3, 2)
    return out.drop("has_uploaded_video").withColumns({"asset_group_bp_score": mean, "run_id": F.lit(p.run_id)})


def extended_score(scored: DataFrame, groups: DataFrame, assets: DataFrame, p: Params) -> DataFrame:
    """What the published score leaves out: open action items, status reasons of assets, coverage of the feed, the three kinds of text."""
    items = F.coalesce(F.array_size("ad_strength_action_items"), F.lit(0))
    detail = own_assets(assets).groupBy(*GROUP).agg(
        F.sum(F.size(F.coalesce("primary_status_reasons", F.array().cast("array<string>")))).alias("asset_primary_status_reason_count"),
        F.count_distinct(F.when(F.col("field_type").isin(*FEED), F.col("field_type"))).alias("covered_feed_type_count"))
    out = scored.join(groups.select(*GROUP, items.cast("bigint").alias("ad_strength_action_item_count")), GROUP).join(detail, GROUP, "left")
    out = out.fillna(0, ["asset_primary_status_reason_count", "covered_feed_type_count"])
    texts = (F.col("count_short_headlines") > 0) & (F.col("count_long_headlines") > 0) & (F.col("count_descriptions") > 0)
    clear = lambda c: (F.col(c) == 0).cast("double")
    out = out.select(
        "snapshot_date", *GROUP, F.col("asset_group_bp_score").alias("google_parity_score"), "ad_strength_action_item_count", clear("ad_strength_action_item_count").alias("action_item_clear_score"),
        "asset_primary_status_reason_count", clear("asset_primary_status_reason_count").alias("primary_status_clear_score"), "covered_feed_type_count", (F.col("covered_feed_type_count") / float(len(FEED))).alias("feed_type_coverage_score"),
        texts.alias("text_guidelines_present"), texts.cast("double").alias("text_guidelines_present_score"))
    parts = [F.col(c) for c in ("action_item_clear_score", "primary_status_clear_score", "feed_type_coverage_score", "text_guidelines_present_score")]
    return out.withColumns({"extended_score": F.round(sum(parts[1:], parts[0]) / 4, 2), "run_id": F.lit(p.run_id)})


def action_items(groups: DataFrame) -> DataFrame:
    """What each asset group is asked to do: items, those that add assets, how many assets, and of which fields, from the nested list as it lies in the row."""
    items = F.col("ad_strength_action_items")
    adding = F.filter(items, lambda i: i["action_item_type"] == "ADD_ASSET")
    details = F.transform(adding, lambda i: i["add_asset_details"])
    fields = F.array_sort(F.array_distinct(F.transform(details, lambda x: x["asset_field_type"])))
    return groups.select(
        *GROUP, F.coalesce(F.array_size(items), F.lit(0)).cast("bigint").alias("items"), F.coalesce(F.array_size(adding), F.lit(0)).cast("bigint").alias("adding"),
        F.coalesce(F.aggregate(details, F.lit(0).cast("bigint"), lambda n, x: n + F.coalesce(x["asset_count"], F.lit(0))), F.lit(0)).alias("assets_wanted"), F.coalesce(F.array_join(fields, ","), F.lit("")).alias("fields"))
