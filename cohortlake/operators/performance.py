"""Performance facts: two metric families in one table, enriched as of the click day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlake.functions.columns import action_id, currency, null_safe_join
from cohortlake.plans.params import Params

COUNTS = ["conversions", "conversions_value", "all_conversions", "all_conversions_value"]
NETWORK = ["network_impressions", "network_clicks", "network_cost", *(f"network_{c}" for c in COUNTS)]
BY_ACTION = [f"action_{c}" for c in COUNTS]
GRAIN_KEYS = {
    "campaign": ["account_id", "campaign_id"],
    "asset_group": ["account_id", "campaign_id", "asset_group_id"],
    "asset": ["account_id", "campaign_id", "asset_group_id", "asset_id", "field_type"],
}
#: Attributes that each grain takes from its entity view: column of the view -> column of the fact.
ENTITY_COLUMNS = {
    "campaign": {"campaign_name": "campaign_name", "status": "campaign_status", "primary_status": "campaign_primary_status", "primary_status_reasons": "campaign_primary_status_reasons"},
    "asset_group": {"asset_group_name": "asset_group_name", "status": "asset_group_status", "primary_status": "asset_group_primary_status", "primary_status_reasons": "asset_group_primary_status_reasons", "ad_strength": "ad_strength"},
    "asset": {"asset_name": "asset_name", "asset_type": "asset_type", "status": "asset_status", "primary_status": "asset_primary_status", "primary_status_reasons": "asset_primary_status_reasons", "text": "text", "source": "source"},
}
ACTION_COLUMNS = ["click_through_lookback_window_days", "view_through_lookback_window_days", "include_in_conversions_metric", "conversion_action_type"]


def metric_union(volume: DataFrame, conv: DataFrame, grain: str) -> DataFrame:
    """Network rows and conversion-action rows in one table; each fills its own columns, the others are null."""
    keys = ["date", *GRAIN_KEYS[grain], "ad_network_type"]
    network = volume.select(
        *keys, F.lit("NETWORK").alias("metric_basis"), F.lit(None).cast("bigint").alias("conversion_action_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("conversion_action_resource_name", "conversion_action_name")],
        F.col("impressions").alias("network_impressions"), F.col("clicks").alias("network_clicks"), currency(F.col("cost_micros")).alias("network_cost"),
        *[F.col(c).alias(f"network_{c}") for c in COUNTS], *[F.lit(None).cast("double").alias(c) for c in BY_ACTION], "source_run_id",
    )
    types = dict(network.dtypes)
    actions = conv.select(
        *keys, F.lit("CONVERSION_ACTION").alias("metric_basis"), action_id(F.col("conversion_action")).alias("conversion_action_id"),
        F.col("conversion_action").alias("conversion_action_resource_name"), "conversion_action_name",
        *[F.lit(None).cast(types[c]).alias(c) for c in NETWORK], *[F.col(c).alias(f"action_{c}") for c in COUNTS], "source_run_id",
    )
    return network.unionByName(actions)


def asof_else_earliest(facts: DataFrame, view: DataFrame, keys: list[str], columns: dict[str, str], day: str = "date") -> DataFrame:
    """Each fact with the last snapshot up to its day, else with the first one after it; without any, with nulls.

    Facts and snapshots are laid in one row by day, and a window looks back: one shuffle by the keys, and no
    fact ever meets more than one snapshot. Where nothing lies before a fact, the first one after it is the
    key's first of all; that is found once for a key, as looking ahead from every row would take the square of them.
    """
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    marks = view.where(known).select(*keys, F.col("snapshot_date").alias("_day"), F.lit(0).alias("_kind"), F.struct(*[F.col(c).alias(to) for c, to in columns.items()]).alias("_s"))
    rows = facts.withColumns({"_day": F.col(day), "_kind": F.lit(1)}).unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy(*keys).orderBy("_day", "_kind")
    back = F.last("_s", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    earliest = F.first("_s", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    met = rows.withColumn("_s", F.coalesce(back, earliest)).where("_kind = 1")
    return met.select(*facts.columns, *[F.col(f"_s.{to}").alias(to) for to in columns.values()])


def asof_in_place(facts: DataFrame, view: DataFrame, keys: list[str], columns: dict[str, str], day: str = "date") -> DataFrame:
    """The same for tables clustered by the keys: neither side moves. A key's snapshots, one a day at most, come as one ordered array."""
    one = F.struct(F.col("snapshot_date").alias("day"), *[F.col(c).alias(f"s{k}") for k, c in enumerate(columns)])
    marks = view.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("_marks"))
    met = facts.join(marks.hint("merge"), keys, "left")
    before = F.filter("_marks", lambda m: m["day"] <= F.col(day))
    chosen = F.when(F.size(before) > 0, F.element_at(before, -1)).when(F.size("_marks") > 0, F.element_at("_marks", 1))
    return met.withColumn("_s", chosen).select(*facts.columns, *[F.col(f"_s.s{k}").alias(to) for k, to in enumerate(columns.values())])


def asof_by_day(facts: DataFrame, view: DataFrame, keys: list[str], columns: dict[str, str], day: str = "date") -> DataFrame:
    """The same for keys that many facts share: resolved once for each distinct (keys, day), and sent to the facts, which stay where they are."""
    wanted = facts.select(*keys, day).dropna().distinct()
    return facts.join(F.broadcast(asof_else_earliest(wanted, view, keys, columns, day)), [*keys, day], "left")


def provenance(day: Column, first_seen: Column, own: Column) -> Column:
    return F.when(first_seen.isNull(), "unavailable").when(day < first_seen, "assumed-current").otherwise(own)


def with_entity(facts: DataFrame, view: DataFrame, grain: str) -> DataFrame:
    columns = ENTITY_COLUMNS[grain] | {"first_seen_date": "_first", "attribute_provenance": "_own"}
    out = asof_else_earliest(facts, view, GRAIN_KEYS[grain], columns)
    return out.withColumn("attribute_provenance", provenance(F.col("date"), F.col("_first"), F.col("_own"))).drop("_first", "_own")


def with_customer(facts: DataFrame, view: DataFrame) -> DataFrame:
    return asof_by_day(facts, view, ["account_id"], {c: c for c in ("currency_code", "time_zone")})


def with_action(facts: DataFrame, view: DataFrame) -> DataFrame:
    return asof_by_day(facts, view, ["account_id", "conversion_action_id"], {c: c for c in ACTION_COLUMNS})


def performance(volume: DataFrame, conv: DataFrame, entity: DataFrame, customer: DataFrame, action: DataFrame, grain: str, p: Params) -> DataFrame:
    """The fact table of a grain."""
    facts = metric_union(volume, conv, grain).where(F.col("date").between(p.window_start, p.as_of))
    columns = [*with_entity(facts, entity, grain).columns, "currency_code", "time_zone", *ACTION_COLUMNS]
    return with_entity(with_action(with_customer(facts, customer), action), entity, grain).select(*columns).withColumn("run_id", F.lit(p.run_id))


def campaign_truth(facts: DataFrame, p: Params) -> DataFrame:
    """Network rows of the campaign grain: the totals that everything else is held against."""
    return facts.where((F.col("metric_basis") == "NETWORK") & F.col("date").between(p.window_start, p.as_of)).select(
        "date", "account_id", "campaign_id", "campaign_name", "ad_network_type", "currency_code", "time_zone", *NETWORK, "run_id"
    )


def click_day_cost(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Cost of each click day, summed before it is joined with anything."""
    return facts.where("metric_basis = 'NETWORK'").groupBy(F.col("date").alias("click_date"), *keys).agg(F.sum("network_cost").alias("click_day_cost"))


def add_cost(cells: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    cost = click_day_cost(facts, [*keys, "ad_network_type"])
    return null_safe_join(cells, cost, ["click_date", *keys, "ad_network_type"], "left")
