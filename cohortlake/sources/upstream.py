"""Inputs of the second score chain, derived from the entity marts: the tables that the upstream reports deliver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUTOMATION = "FINAL_URL_EXPANSION_TEXT_ASSET_AUTOMATION"


def assets(mart: DataFrame) -> DataFrame:
    live = mart.where("status = 'ENABLED' AND source = 'ADVERTISER' AND NOT inferred_removed")
    return live.select("account_id", "campaign_id", "asset_group_id", "asset_id", "asset_type", "field_type", F.col("field_type").alias("asset_sub_type"), "image_width_pixels", "image_height_pixels", "text", "video_id")


def settings(campaigns: DataFrame) -> DataFrame:
    k = F.col("campaign_id")
    goal = lambda n, v: F.when(k % 4 == n, F.lit(v))
    listed = F.when(F.col("url_expansion_opt_out").isNotNull(), F.array(F.struct(F.lit(AUTOMATION).alias("asset_automation_type"), F.when(F.col("url_expansion_opt_out"), "OPTED_OUT").otherwise("OPTED_IN").alias("asset_automation_status"))))
    return campaigns.where("status = 'ENABLED' AND NOT inferred_removed").select(
        F.col("snapshot_date").alias("date"), "account_id", F.concat(F.lit("Account "), F.col("account_id").cast("string")).alias("account_name"), "campaign_id", "campaign_name", F.col("status").alias("campaign_status"),
        listed.alias("asset_automation_settings"), "negative_geo_target_type", "positive_geo_target_type", goal(0, 2.5).alias("campaign_mcv_troas"), goal(1, 3.5).alias("campaign_troas"), F.lit(4.5).alias("bidding_strategy_mcv_troas"),
        F.lit(None).cast("double").alias("bidding_strategy_troas"), goal(2, 5.0).alias("campaign_mc_tcpa"), F.lit(None).cast("double").alias("campaign_tcpa"), goal(3, 0.0).alias("bidding_strategy_mc_tcpa"), F.lit(None).cast("double").alias("bidding_strategy_tcpa"))


def summary(groups: DataFrame, campaigns: DataFrame) -> DataFrame:
    live = campaigns.where("status = 'ENABLED' AND NOT inferred_removed").select("account_id", "campaign_id", "campaign_name")
    return groups.where("status = 'ENABLED' AND NOT inferred_removed").join(live, ["account_id", "campaign_id"]).select(
        F.col("snapshot_date").alias("date"), "account_id", F.concat(F.lit("Account "), F.col("account_id").cast("string")).alias("account_name"), "campaign_id", "campaign_name", "asset_group_id", "asset_group_name", "ad_strength")


def signals(mart: DataFrame) -> DataFrame:
    return mart.where("audience IS NOT NULL AND NOT inferred_removed").select("account_id", "campaign_id", "asset_group_id", F.col("audience").alias("audience_signals"))


def links(df: DataFrame, key: list[str]) -> DataFrame:
    return df.where("status = 'ENABLED'").select(*key, F.col("field_type").alias("asset_type"))


def _kind():
    return F.when(F.col("campaign_id") % 3 < 2, "PERFORMANCE_MAX").otherwise("SEARCH").alias("campaign_type")


def category(conv: DataFrame) -> DataFrame:
    return conv.where("conversions >= 1").select("account_id", "campaign_id", _kind(), F.col("conversion_action_name").alias("conversion_name"))


def custom(campaigns: DataFrame) -> DataFrame:
    return campaigns.where("campaign_id % 7 = 0").select("account_id", "campaign_id", _kind(), (F.col("campaign_id") % 2).alias("custom_conversion_goal_id"))


def goal_names(customers: DataFrame) -> DataFrame:
    return customers.select("account_id", F.explode(F.array(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))).alias("custom_conversion_goal_id")).withColumn("custom_conversion_goal_name", F.concat(F.lit("Custom "), F.col("custom_conversion_goal_id").cast("string")))


def ocid(customers: DataFrame) -> DataFrame:
    return customers.where("account_id <> 4").select(F.col("account_id").alias("customer_id"), (F.col("account_id") + 9000).alias("ocid"))
