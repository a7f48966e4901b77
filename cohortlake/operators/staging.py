"""Staging: the latest row of each grain, and the rules by which landed values are read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlake.plans.params import Params
from cohortlake.sources.generations import Generations

_GROUP, _ASSET = ["account_id", "campaign_id", "asset_group_id"], ["account_id", "campaign_id", "asset_group_id", "asset_id", "field_type"]
_ACTION = ["conversion_action"]
#: Table -> columns that name a row, besides the day.
GRAINS: dict[str, list[str]] = {
    "volume_campaign": ["account_id", "campaign_id", "ad_network_type"],
    "volume_asset_group": [*_GROUP, "ad_network_type"],
    "volume_asset": [*_ASSET, "ad_network_type"],
    "conv_campaign": ["account_id", "campaign_id", "ad_network_type", *_ACTION],
    "conv_asset_group": [*_GROUP, "ad_network_type", *_ACTION],
    "conv_asset": [*_ASSET, "ad_network_type", *_ACTION],
    "lag_campaign": ["account_id", "campaign_id", "ad_network_type", *_ACTION, "conversion_lag_bucket"],
    "lag_asset_group": [*_GROUP, "ad_network_type", *_ACTION, "conversion_lag_bucket"],
    "entities_campaign": ["account_id", "campaign_id"],
    "entities_asset_group": _GROUP,
    "entities_asset_group_asset": _ASSET,
    "entities_asset": [*_GROUP, "asset_id"],
    "entities_asset_group_signal": [*_GROUP, "signal_resource_name"],
    "entities_campaign_asset": ["account_id", "campaign_id", "asset_resource_name", "field_type"],
    "entities_customer_asset": ["account_id", "asset_resource_name", "field_type"],
    "entities_conversion_action": ["account_id", "conversion_action_id"],
    "entities_customer": ["account_id"],
}


def day_column(table: str) -> str:
    return "snapshot_date" if table.startswith("entities_") else "date"


def latest_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key: the last by load time, then run; a hash of the row breaks what ties are left."""
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("loaded_at"), F.desc_nulls_last("run_id"), F.xxhash64(*df.columns))
    # The row that none comes before: asked for by number, rows would be sorted and cut before they are dealt too, and few rows have a second load.
    return df.withColumn("_later", F.lag(F.lit(1)).over(order)).where("_later IS NULL").drop("_later")


def safe_datetime(text: Column) -> Column:
    """A zone-less date and time, null where the text is none."""
    return F.try_to_timestamp(F.nullif(text, F.lit(""))).cast("timestamp_ntz")


def finished(rows: DataFrame, table: str) -> DataFrame:
    """Latest landed rows in their staged form."""
    if table == "entities_campaign":
        rows = rows.withColumns({c: safe_datetime(F.col(c)) for c in ("start_date_time", "end_date_time")})
    return rows.withColumnRenamed("run_id", "source_run_id").drop("query_hash")


def stage(raw: DataFrame, table: str, p: Params, every_day: bool = False) -> DataFrame:
    """The staged form of a landed table: its window (facts) or the run's day (snapshots), latest rows, `source_run_id`."""
    day = day_column(table)
    if every_day:
        kept = raw
    elif day == "date":
        kept = raw.where(F.col(day).between(p.window_start, p.as_of))
    else:
        kept = raw.where(F.col(day) == F.lit(p.as_of))
    return finished(latest_rows(kept, [day, *GRAINS[table]]), table)


def merge_load(store: Generations, table: str, load: DataFrame, start: dt.date, end: dt.date, generation: str) -> list[str]:
    """Bring one load's days from start to end into the stored latest rows of a table; the days that were written.

    Only those days are read, ranked and replaced; others are neither scanned nor written. The latest of
    the stored latest rows and the load's is the latest of all loads, so after any sequence of loads, in
    any order and repeated or not, the table holds what ranking all landed rows at once would give.
    """
    day = day_column(table)
    inside = F.col(day).between(F.lit(start), F.lit(end))
    have = store.read(table)
    both = have.where(inside).unionByName(load.where(inside).select(have.columns))
    return store.replace_range(table, latest_rows(both, [day, *GRAINS[table]]), start, end, generation)


# Reading landed values ----------------------------------------------------------------------------


#: Columns whose type their name's ending doesn't tell.
WHOLE = ("impressions", "clicks", "asset_count")
REAL = ("conversions", "conversions_value", "all_conversions", "all_conversions_value")
DAYS = ("date", "snapshot_date")


def type_of(column: str) -> str:
    """The type of a landed column by its name: counts and ids are whole numbers, conversions are not, the rest is text."""
    if column in REAL:
        return "double"
    if column in DAYS:
        return "date"
    if column == "loaded_at":
        return "timestamp"
    if column not in ("video_id", "run_id") and (column in WHOLE or column.endswith(("_id", "_micros", "_pixels", "_days"))):
        return "bigint"
    return "string"


def coerce(df: DataFrame) -> DataFrame:
    """Give text columns the type that their name calls for; blank text is null. Ids and counts that are no numbers raise."""

    def typed(c: str) -> Column:
        x, kind = F.nullif(F.col(c), F.lit("")), type_of(c)
        return F.substring(x, 1, 10).cast("date") if kind == "date" else x.cast(kind) if kind in ("double", "bigint") else x

    return df.select([typed(c).alias(c) if t == "string" else (F.coalesce(c, F.array().cast(t)).alias(c) if t.startswith("array") else F.col(c)) for c, t in df.dtypes])


def with_lineage(df: DataFrame, run_id: str, loaded_at: str, query: str) -> DataFrame:
    return df.select(F.lit(run_id).alias("run_id"), F.lit(loaded_at).cast("timestamp").alias("loaded_at"), F.sha2(F.lit(query), 256).alias("query_hash"), "*")


def date_bounds(df: DataFrame, day: str = "date") -> DataFrame:
    """First and last day, rows without a day, rows."""
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count_if(F.col(day).isNull()).alias("without_day"), F.count("*").alias("n"))


def clip(df: DataFrame, p: Params, day: str = "date") -> DataFrame:
    """Rows from the window's start on."""
    return df.where(F.col(day) >= F.lit(p.window_start))


def swap_bounds(fetched: DataFrame, staged: DataFrame, p: Params, day: str = "date") -> DataFrame:
    """The range that a load replaces: from the window's start to the last day fetched or staged."""
    last = fetched.agg(F.max(day).alias("a")).crossJoin(staged.agg(F.max(day).alias("b")))
    return last.select(F.lit(p.window_start).alias("start_day"), F.greatest("a", "b").alias("end_day"))


def in_channel(df: DataFrame, channel: str = "PERFORMANCE_MAX") -> DataFrame:
    return df.where(F.col("advertising_channel_type") == channel)


def stamp_day(df: DataFrame, p: Params) -> DataFrame:
    return df.withColumn("snapshot_date", F.lit(p.as_of))
