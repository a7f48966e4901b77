"""The ads star on top of the order tables: landed click-day facts and daily entity snapshots.

The derivations are written once, in SQL that both Spark and other engines read; only what differs
between dialects goes through `Dialect`. Metrics are whole or multiples of a quarter, so that sums of
doubles are exact in any order. Loads come twice for part of the rows, so that staging has work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

AS_OF = "DATE '1998-06-30'"
#: The field types, in the order of asset numbers modulo nine.
FIELD_TYPES = ("HEADLINE", "HEADLINE", "LONG_HEADLINE", "DESCRIPTION", "MARKETING_IMAGE", "SQUARE_MARKETING_IMAGE", "PORTRAIT_MARKETING_IMAGE", "LOGO", "YOUTUBE_VIDEO")
#: Lag buckets by the upper day of each, ascending.
BUCKETS = {
    "LESS_THAN_ONE_DAY": 1, "ONE_TO_TWO_DAYS": 2, "TWO_TO_THREE_DAYS": 3, "THREE_TO_FOUR_DAYS": 4, "FOUR_TO_FIVE_DAYS": 5, "FIVE_TO_SIX_DAYS": 6,
    "SIX_TO_SEVEN_DAYS": 7, "SEVEN_TO_EIGHT_DAYS": 8, "EIGHT_TO_NINE_DAYS": 9, "NINE_TO_TEN_DAYS": 10, "TEN_TO_ELEVEN_DAYS": 11,
    "ELEVEN_TO_TWELVE_DAYS": 12, "TWELVE_TO_THIRTEEN_DAYS": 13, "THIRTEEN_TO_FOURTEEN_DAYS": 14, "FOURTEEN_TO_TWENTY_ONE_DAYS": 21,
    "TWENTY_ONE_TO_THIRTY_DAYS": 30, "THIRTY_TO_FORTY_FIVE_DAYS": 45, "FORTY_FIVE_TO_SIXTY_DAYS": 60, "SIXTY_TO_NINETY_DAYS": 90,
}


@dataclass(frozen=True)
class Dialect:
    spark: bool

    def days(self, end: str, start: str) -> str:
        """Whole days from start to end."""
        end, start = f"CAST({end} AS DATE)", f"CAST({start} AS DATE)"
        return f"datediff({end}, {start})" if self.spark else f"date_diff('day', {start}, {end})"

    def array(self, *items: str) -> str:
        return f"array({', '.join(items)})" if self.spark else f"[{', '.join(items)}]"

    def record(self, **fields: str) -> str:
        return f"named_struct({', '.join(f'{chr(39)}{k}{chr(39)}, {v}' for k, v in fields.items())})" if self.spark else "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"

    @property
    def action_items(self) -> str:
        """The type of a list of things to do about an asset group."""
        if self.spark:
            return "ARRAY<STRUCT<action_item_type: STRING, add_asset_details: STRUCT<asset_field_type: STRING, asset_count: BIGINT>>>"
        return "STRUCT(action_item_type VARCHAR, add_asset_details STRUCT(asset_field_type VARCHAR, asset_count BIGINT))[]"

    @property
    def strings(self) -> str:
        return "ARRAY<STRING>" if self.spark else "VARCHAR[]"


def _case(value: str, mapping: dict, default: str = "NULL") -> str:
    return f"CASE {value} " + " ".join(f"WHEN {k} THEN {v}" for k, v in mapping.items()) + f" ELSE {default} END"


def _field(asset: str) -> str:
    return _case(f"{asset} % 9", {k: f"'{t}'" for k, t in enumerate(FIELD_TYPES)})


VOLUME = """CAST(sum(l_quantity * 10) AS BIGINT) AS impressions, CAST(sum(l_quantity) AS BIGINT) AS clicks, CAST(sum(CAST(round(l_extendedprice * 1000) AS BIGINT)) AS BIGINT) AS cost_micros"""
CONVERSIONS = """0.25 * CAST(count(*) AS DOUBLE) AS conversions, sum(round(l_extendedprice)) AS conversions_value,
  0.25 * CAST(count(*) AS DOUBLE) + 0.25 * CAST(sum(l_linenumber % 2) AS DOUBLE) AS all_conversions, sum(round(l_extendedprice)) + CAST(sum(l_linenumber) AS DOUBLE) AS all_conversions_value"""
GRAINS = {
    "campaign": ["account_id", "campaign_id", "campaign_name"],
    "asset_group": ["account_id", "campaign_id", "asset_group_id", "asset_group_name"],
    "asset": ["account_id", "campaign_id", "asset_group_id", "asset_id", "field_type"],
}
ACTION = ["conversion_action", "conversion_action_name"]
BACK = (100, 60, 30, 7, 0)


def _loads(d: Dialect, select: str, columns: list[str], metric: str, key: str) -> str:
    """Every row in a first load, stale for even keys, and rows of even keys again, right, in a second load.

    In Spark both loads come from one pass over the rows, which are grouped once.
    """
    names = ", ".join(columns)
    if d.spark:
        stale = ", ".join(f"CASE WHEN n = 1 AND {key} % 2 = 0 THEN {c} + 1 ELSE {c} END AS {c}" if c == metric else c for c in columns)
        return f"""SELECT CASE n WHEN 1 THEN 'load-1' ELSE 'load-2' END AS run_id, CASE n WHEN 1 THEN TIMESTAMP '1998-07-01 01:00:00' ELSE TIMESTAMP '1998-07-01 02:00:00' END AS loaded_at, 'q' AS query_hash, {stale}
FROM (SELECT *, explode(CASE WHEN {key} % 2 = 0 THEN array(1, 2) ELSE array(1) END) AS n FROM ({select}) a) b"""
    stale = ", ".join(f"CASE WHEN {key} % 2 = 0 THEN {c} + 1 ELSE {c} END AS {c}" if c == metric else c for c in columns)
    return f"""SELECT 'load-1' AS run_id, TIMESTAMP '1998-07-01 01:00:00' AS loaded_at, 'q' AS query_hash, {stale} FROM ({select}) a
UNION ALL SELECT 'load-2', TIMESTAMP '1998-07-01 02:00:00', 'q', {names} FROM ({select}) b WHERE {key} % 2 = 0"""


def definitions(d: Dialect) -> dict[str, str]:
    """Name -> SELECT over the order tables and over earlier names of this dict."""
    out: dict[str, str] = {}
    lag = f"((({d.days('l_shipdate', 'o_orderdate')}) % 100) + 100) % 100"
    out["lines"] = f"""SELECT c_custkey % 5 AS account_id, c_custkey % 50 AS campaign_id, 'Campaign ' || CAST(c_custkey % 50 AS STRING) AS campaign_name,
  (c_custkey % 50) * 4 + l_suppkey % 4 AS asset_group_id, 'Group ' || CAST((c_custkey % 50) * 4 + l_suppkey % 4 AS STRING) AS asset_group_name,
  l_partkey % 200 AS asset_id, {_field('(l_partkey % 200)')} AS field_type, {AS_OF} - CAST(o_orderkey % 120 AS INT) AS date,
  CASE l_returnflag WHEN 'R' THEN 'SEARCH' WHEN 'A' THEN 'CONTENT' END AS ad_network_type,
  'customers/' || CAST(c_custkey % 5 AS STRING) || '/conversionActions/' || CASE substr(o_orderpriority, 1, 1) WHEN '5' THEN 'x5' ELSE substr(o_orderpriority, 1, 1) END AS conversion_action,
  'Action ' || substr(o_orderpriority, 1, 1) AS conversion_action_name, {lag} AS lag, l_quantity, l_extendedprice, l_linenumber
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
    metrics_v = ["impressions", "clicks", "cost_micros", "conversions", "conversions_value", "all_conversions", "all_conversions_value"]
    metrics_c = metrics_v[3:]
    for grain, keys in GRAINS.items():
        k = [*keys, "date", "ad_network_type"]
        out[f"raw_volume_{grain}"] = _loads(d, f"SELECT {', '.join(k)}, {VOLUME}, {CONVERSIONS} FROM lines GROUP BY {', '.join(k)}", [*k, *metrics_v], "clicks", "campaign_id")
        k = [*k, *ACTION]
        out[f"raw_conv_{grain}"] = _loads(d, f"SELECT {', '.join(k)}, {CONVERSIONS} FROM lines GROUP BY {', '.join(k)}", [*k, *metrics_c], "conversions", "campaign_id")
        if grain != "asset":
            bucket = "CASE " + " ".join(f"WHEN lag < {v} THEN '{n}'" for n, v in BUCKETS.items()) + " ELSE 'UNKNOWN' END"
            src = f"(SELECT *, {bucket} AS conversion_lag_bucket FROM lines) t"
            k = [*k, "conversion_lag_bucket"]
            out[f"raw_lag_{grain}"] = _loads(d, f"SELECT {', '.join(k)}, {CONVERSIONS} FROM {src} GROUP BY {', '.join(k)}", [*k, *metrics_c], "conversions", "campaign_id")
    # What the source reports: other channels too, which are not landed.
    channel = "CASE WHEN campaign_id % 7 = 3 THEN 'SEARCH' WHEN campaign_id % 7 = 5 THEN 'DISPLAY' ELSE 'PERFORMANCE_MAX' END AS advertising_channel_type"
    out["report_volume"] = f"SELECT *, {channel} FROM raw_volume_campaign r"
    days = ", ".join(f"({b})" for b in BACK)
    snap = f"(SELECT {AS_OF} - CAST(back AS INT) AS snapshot_date, back FROM (VALUES {days}) AS v(back)) s"

    def entity(name: str, keys: list[str], key: str, columns: dict[str, str], source: str, gone: str) -> None:
        """A snapshot table: rows of `source` on every day but those on which `gone` holds; two loads for even keys."""
        cols = ", ".join(f"{e} AS {c}" for c, e in columns.items())
        select = f"SELECT {', '.join(keys)}, snapshot_date, {cols} FROM {source} CROSS JOIN {snap} WHERE NOT ({gone})"
        names = ", ".join([*keys, "snapshot_date", *columns])
        stale = ", ".join([*keys, "snapshot_date", *(f"CASE WHEN {key} % 2 = 0 THEN 'STALE' ELSE {c} END AS {c}" if c in ("status", "asset_type", "approval_status") else c for c in columns)])
        out[f"raw_entities_{name}"] = f"""SELECT 'load-1' AS run_id, TIMESTAMP '1998-07-01 01:00:00' AS loaded_at, 'q' AS query_hash, {stale} FROM ({select}) a
UNION ALL SELECT 'load-2', TIMESTAMP '1998-07-01 02:00:00', 'q', {names} FROM ({select}) b WHERE {key} % 2 = 0"""

    campaigns = "(SELECT DISTINCT c_custkey % 5 AS account_id, c_custkey % 50 AS campaign_id FROM customer) c"
    groups = "(SELECT DISTINCT account_id, campaign_id, asset_group_id FROM lines) g"
    links = "(SELECT DISTINCT account_id, campaign_id, asset_group_id, asset_id FROM lines) l"
    actions = "(SELECT DISTINCT c_custkey % 5 AS account_id, k AS conversion_action_id FROM customer CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS v(k)) a"
    accounts = "(SELECT DISTINCT c_custkey % 5 AS account_id FROM customer) a"
    reasons = lambda test: f"CASE WHEN {test} THEN {d.array(chr(39) + 'LIMITED' + chr(39))} ELSE CAST({d.array()} AS {d.strings}) END"
    entity(
        "campaign", ["account_id", "campaign_id"], "campaign_id",
        {"campaign_name": "'Campaign ' || CAST(campaign_id AS STRING)", "status": "CASE WHEN campaign_id % 8 = 0 THEN 'PAUSED' ELSE 'ENABLED' END", "primary_status": "'ELIGIBLE'",
         "primary_status_reasons": reasons("campaign_id % 17 = 0"), "advertising_channel_type": "'PERFORMANCE_MAX'",
         "positive_geo_target_type": "CASE WHEN campaign_id % 2 = 0 THEN 'PRESENCE' ELSE 'PRESENCE_OR_INTEREST' END", "negative_geo_target_type": "CASE WHEN campaign_id % 4 < 2 THEN 'PRESENCE' ELSE 'PRESENCE_OR_INTEREST' END",
         "start_date_time": "CASE WHEN campaign_id % 3 = 0 THEN '' WHEN campaign_id % 3 = 1 THEN '1998-01-01 00:00:00' ELSE 'bad' END", "end_date_time": "CAST(NULL AS STRING)",
         "budget_id": "campaign_id + 1000", "budget_amount_micros": "campaign_id * 1000000", "budget_explicitly_shared": "campaign_id % 5 = 0", "budget_period": "'DAILY'",
         "url_expansion_opt_out": "CASE campaign_id % 3 WHEN 1 THEN TRUE WHEN 2 THEN FALSE END"},
        campaigns, "campaign_id % 10 = 7 AND back = 0",
    )
    out["report_campaigns"] = """SELECT * FROM raw_entities_campaign r
UNION ALL SELECT run_id, loaded_at, query_hash, account_id, campaign_id + 100, snapshot_date, campaign_name, status, primary_status, primary_status_reasons, CASE WHEN campaign_id % 2 = 0 THEN 'SEARCH' END, positive_geo_target_type,
  negative_geo_target_type, start_date_time, end_date_time, budget_id, budget_amount_micros, budget_explicitly_shared, budget_period, url_expansion_opt_out FROM raw_entities_campaign t WHERE campaign_id % 3 = 0"""
    item = lambda kind, field, n: d.record(action_item_type=f"'{kind}'", add_asset_details=d.record(asset_field_type=f"'{field}'", asset_count=f"CAST({n} AS BIGINT)"))
    todo = {1: d.array(item("ADD_ASSET", "HEADLINE", 3), item("ADD_ASSET", "YOUTUBE_VIDEO", 1)), 2: d.array(item("ADD_ASSET", "LOGO", "1 + asset_group_id % 4")), 3: d.array(item("IMPROVE_TEXT", "", 0), item("ADD_ASSET", "HEADLINE", 2))}
    entity(
        "asset_group", ["account_id", "campaign_id", "asset_group_id"], "asset_group_id",
        {"asset_group_name": "'Group ' || CAST(asset_group_id AS STRING)", "status": "CASE WHEN asset_group_id % 9 = 0 THEN 'PAUSED' ELSE 'ENABLED' END", "primary_status": "'ELIGIBLE'",
         "primary_status_reasons": reasons("asset_group_id % 17 = 0"), "ad_strength": "CASE asset_group_id % 3 WHEN 0 THEN 'EXCELLENT' WHEN 1 THEN 'GOOD' ELSE 'POOR' END", "final_urls": d.array("'https://example.com/'"),
         "ad_strength_action_items": "CASE " + " ".join(f"WHEN asset_group_id % 6 = {k} THEN CAST({v} AS {d.action_items})" for k, v in todo.items()) + f" WHEN asset_group_id % 6 = 4 THEN CAST({d.array()} AS {d.action_items}) END"},
        groups, "asset_group_id % 10 = 7 AND back <= 7",
    )
    entity(
        "asset_group_asset", ["account_id", "campaign_id", "asset_group_id", "asset_id"], "asset_id",
        {"field_type": _field("asset_id"), "status": "CASE WHEN (asset_id + asset_group_id) % 10 < asset_group_id % 4 THEN 'ENABLED' ELSE 'PAUSED' END", "primary_status": "'ELIGIBLE'",
         "primary_status_reasons": reasons("asset_id % 17 = 0"), "source": "CASE WHEN asset_id % 11 = 0 THEN 'AUTOMATICALLY_CREATED' ELSE 'ADVERTISER' END"},
        links, "asset_id % 10 = 7 AND back = 0",
    )
    kind = "CASE WHEN asset_id % 9 < 4 THEN 'TEXT' WHEN asset_id % 9 = 8 THEN 'YOUTUBE_VIDEO' ELSE 'IMAGE' END"
    entity(
        "asset", ["account_id", "campaign_id", "asset_group_id", "asset_id"], "asset_id",
        {"asset_name": "'Asset ' || CAST(asset_id AS STRING)", "asset_type": kind, "orientation": "CAST(NULL AS STRING)", "text": "lpad('t', CAST(20 + asset_id % 60 AS INT), 'x')",
         "image_url": "'https://example.com/i.png'", "image_height_pixels": "CAST(300 AS BIGINT)", "image_width_pixels": "CASE WHEN asset_id % 2 = 0 THEN CAST(300 AS BIGINT) ELSE CAST(1200 AS BIGINT) END",
         "video_id": "CASE WHEN asset_id % 27 = 8 THEN '' ELSE 'v' || CAST(asset_id AS STRING) END", "video_title": "'Video'"},
        links, "asset_id % 10 = 7 AND back = 0",
    )
    entity(
        "asset_group_signal", ["account_id", "campaign_id", "asset_group_id"], "asset_group_id",
        {"signal_resource_name": "'signal/' || CAST(asset_group_id AS STRING) || '/' || CAST(n AS STRING)", "approval_status": "'APPROVED'",
         "audience": "CASE WHEN n < asset_group_id % 3 THEN 'a' || CAST(n AS STRING) END", "search_theme": "CASE WHEN n >= asset_group_id % 3 THEN 'theme' END"},
        f"(SELECT * FROM {groups} CROSS JOIN (VALUES (0), (1), (2)) AS v(n)) g2", "asset_group_id % 10 = 3 AND back = 0",
    )
    entity(
        "campaign_asset", ["account_id", "campaign_id"], "campaign_id",
        {"asset_id": "CAST(n AS BIGINT)", "asset_resource_name": "'customers/' || CAST(account_id AS STRING) || '/assets/' || CAST(n AS STRING)", "advertising_channel_type": "'PERFORMANCE_MAX'", "field_type": "'SITELINK'",
         "status": "'ENABLED'", "primary_status": "'ELIGIBLE'", "primary_status_reasons": reasons("n = 1")},
        f"(SELECT * FROM {campaigns} CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(n) WHERE n < campaign_id % 5) c2", "campaign_id % 10 = 3 AND back = 0",
    )
    entity(
        "customer_asset", ["account_id"], "account_id",
        {"asset_id": "CAST(n AS BIGINT)", "asset_resource_name": "'customers/' || CAST(account_id AS STRING) || '/assets/' || CAST(n AS STRING)", "field_type": "'SITELINK'", "status": "'ENABLED'", "primary_status": "'ELIGIBLE'",
         "primary_status_reasons": reasons("n = 1")},
        f"(SELECT * FROM {accounts} CROSS JOIN (VALUES (0), (1)) AS v(n) WHERE n < account_id % 3) a2", "FALSE",
    )
    entity(
        "conversion_action", ["account_id", "conversion_action_id"], "conversion_action_id",
        {"conversion_action_name": "'Action ' || CAST(conversion_action_id AS STRING)", "category": "'PURCHASE'", "counting_type": "'ONE_PER_CLICK'", "status": "'ENABLED'",
         "click_through_lookback_window_days": "CAST(CASE conversion_action_id WHEN 1 THEN 7 WHEN 2 THEN 28 WHEN 3 THEN CASE WHEN back >= 60 THEN 14 ELSE 30 END WHEN 4 THEN CASE WHEN account_id = 2 THEN 60 ELSE 45 END ELSE 90 END AS BIGINT)",
         "view_through_lookback_window_days": "CAST(1 AS BIGINT)", "include_in_conversions_metric": "CASE WHEN conversion_action_id = 4 THEN CAST(NULL AS BOOLEAN) ELSE conversion_action_id <= 2 END", "conversion_action_type": "'WEBPAGE'"},
        actions, "conversion_action_id = 5 AND back = 0",
    )
    entity(
        "customer", ["account_id"], "account_id",
        {"descriptive_name": "'Account ' || CAST(account_id AS STRING)", "currency_code": "CASE account_id % 2 WHEN 0 THEN 'EUR' ELSE 'USD' END",
         "time_zone": "CASE account_id % 3 WHEN 0 THEN 'Europe/Paris' WHEN 1 THEN 'America/New_York' ELSE 'Asia/Tokyo' END", "status": "'ENABLED'", "manager": "FALSE"},
        accounts, "account_id = 3 AND back = 7",
    )
    return out


def with_clause(sql: dict[str, str], needed: list[str], materialized: bool = False) -> str:
    """A WITH list of the named definitions and all that they use, in the order of `sql`."""
    import re

    want, todo = set(), list(needed)
    while todo:
        name = todo.pop()
        if name in sql and name not in want:
            want.add(name)
            todo += [n for n in re.findall(r"\b\w+\b", sql[name]) if n in sql]
    as_ = "AS MATERIALIZED" if materialized else "AS"
    return "WITH " + ",\n".join(f"{n} {as_} ({s})" for n, s in sql.items() if n in want)


SPARK, OTHER = Dialect(True), Dialect(False)
_SPARK_SQL = definitions(SPARK)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines that all facts are sums of."""
    return landed(spark, sf_dir, "lines", None)


def landed(spark: SparkSession, sf_dir: str, name: str, made: DataFrame | None) -> DataFrame:
    """One landed table, derived lazily from the order tables; `made` are the lines, if there are any yet."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders", "customer")}
    sql = dict(_SPARK_SQL)
    if made is not None:
        sql["lines"], tables["made"] = "SELECT * FROM made ", made
    text = with_clause(sql, [name])
    for t in tables:
        text = text.replace(f"FROM {t} ", f"FROM {{{t}}} ").replace(f"JOIN {t} ", f"JOIN {{{t}}} ").replace(f"FROM {t})", f"FROM {{{t}}})")
    return spark.sql(f"{text} SELECT * FROM {name}", **{t: df for t, df in tables.items() if f"{{{t}}}" in text})
