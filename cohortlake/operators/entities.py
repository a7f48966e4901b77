"""Entity history over complete days, with removals inferred from what is absent."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlake.functions.columns import currency, null_safe_join

ABSENT = "ENTITY_NOT_PRESENT_ON_COMPLETE_SNAPSHOT"
#: History -> what names an entity.
KEYS: dict[str, list[str]] = {
    "campaign": ["account_id", "campaign_id"],
    "asset_group": ["account_id", "campaign_id", "asset_group_id"],
    "asset": ["account_id", "campaign_id", "asset_group_id", "asset_id", "field_type"],
    "asset_group_signal": ["account_id", "campaign_id", "asset_group_id", "signal_resource_name"],
    "campaign_asset": ["account_id", "campaign_id", "asset_resource_name", "field_type"],
    "conversion_action": ["account_id", "conversion_action_id"],
    "customer": ["account_id"],
}
#: What a removal says besides its keys.
REMOVED = {"status": "REMOVED", "primary_status": "REMOVED", "approval_status": "REMOVED"}


def complete_days(customers: DataFrame) -> DataFrame:
    """(account, day) is complete if the account's customer row is there."""
    return customers.select("account_id", "snapshot_date").distinct()


def seen_bounds(staged: DataFrame, days: DataFrame, keys: list[str], as_of: dt.date) -> DataFrame:
    """First and last complete day on which each entity was seen, up to as_of."""
    on = staged.where(F.col("snapshot_date") <= F.lit(as_of)).join(days, ["account_id", "snapshot_date"], "left_semi")
    return on.groupBy(*keys).agg(F.min("snapshot_date").alias("first_seen_date"), F.max("snapshot_date").alias("last_seen_date"))


def following_days(days: DataFrame) -> DataFrame:
    """Each complete day with the account's next one."""
    return days.withColumn("next_complete_date", F.lead("snapshot_date").over(Window.partitionBy("account_id").orderBy("snapshot_date")))


def next_complete(bounds: DataFrame, days: DataFrame) -> DataFrame:
    """The first complete day after each entity's last one. A last seen day is complete, so its follower is the answer."""
    after = following_days(days).withColumnRenamed("snapshot_date", "last_seen_date")
    return bounds.join(after, ["account_id", "last_seen_date"], "left")


def link_attributes(links: DataFrame, assets: DataFrame) -> DataFrame:
    """Asset links with the attributes of their asset on the same day."""
    keys = ["account_id", "campaign_id", "asset_group_id", "asset_id", "snapshot_date"]
    return links.join(assets.drop("source_run_id"), keys, "left")


def history(staged: DataFrame, days: DataFrame, entity: str, as_of: dt.date | None = None, tombstones: bool = True) -> DataFrame:
    """Rows seen on complete days, and a removal on the first complete day on which an entity is absent.

    `staged` has every day. With `as_of`, only what a run on that day would write. An incomplete day
    shows nothing and removes nothing: the removal waits for the next complete one.
    """
    keys = KEYS[entity]
    seen = staged.join(days, ["account_id", "snapshot_date"], "left_semi")
    observed = seen.withColumns({"inferred_removed": F.lit(False), "attribute_provenance": F.lit("observed")})
    if as_of is not None:
        observed = observed.where(F.col("snapshot_date") == F.lit(as_of))
    if not tombstones:
        return observed
    due = seen.select(*keys, "snapshot_date").join(following_days(days), ["account_id", "snapshot_date"])
    due = due.where("next_complete_date IS NOT NULL").select(*keys, F.col("next_complete_date").alias("snapshot_date"))
    if as_of is not None:
        due = due.where(F.col("snapshot_date") == F.lit(as_of))
    gone = null_safe_join(due, seen.select(*keys, "snapshot_date"), [*keys, "snapshot_date"], "left_anti")
    said = REMOVED | {"attribute_provenance": "inferred-removed"}

    def value(f):
        if f.name in keys or f.name == "snapshot_date":
            return F.col(f.name)
        if f.name == "inferred_removed":
            return F.lit(True)
        if f.name == "primary_status_reasons":
            return F.array(F.lit(ABSENT))
        return F.lit(said.get(f.name)).cast(f.dataType)

    return observed.unionByName(gone.select([value(f).alias(f.name) for f in observed.schema.fields]))


def seen_view(full: DataFrame, days: DataFrame, entity: str) -> DataFrame:
    """History with the bounds over all rows on complete days that are no removals; entities never seen drop out."""
    keys = KEYS[entity]
    rows = full.join(days, ["account_id", "snapshot_date"], "left_semi").where("NOT inferred_removed")
    bounds = rows.groupBy(*keys).agg(F.min("snapshot_date").alias("first_seen_date"), F.max("snapshot_date").alias("last_seen_date"))
    return null_safe_join(full, bounds, keys, "inner")


def mart(view: DataFrame, as_of: dt.date) -> DataFrame:
    """The view on one day; budgets in currency units."""
    out = view.where(F.col("snapshot_date") == F.lit(as_of))
    if "budget_amount_micros" in out.columns:
        out = out.withColumn("budget_amount", currency(F.col("budget_amount_micros"))).drop("budget_amount_micros")
    return out
