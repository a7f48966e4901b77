"""The same results in SQL, for another engine: independent statements over the order tables."""

from __future__ import annotations

from cohortlake.sources.adapter import OTHER, definitions, with_clause

# Everything below is stated here anew, so that a wrong list there isn't wrong here too.
_G, _A = ["account_id", "campaign_id", "asset_group_id"], ["account_id", "campaign_id", "asset_group_id", "asset_id", "field_type"]
GRAINS = {
    "volume_campaign": ["account_id", "campaign_id", "ad_network_type"], "volume_asset_group": [*_G, "ad_network_type"], "volume_asset": [*_A, "ad_network_type"],
    "conv_campaign": ["account_id", "campaign_id", "ad_network_type", "conversion_action"], "conv_asset_group": [*_G, "ad_network_type", "conversion_action"], "conv_asset": [*_A, "ad_network_type", "conversion_action"],
    "lag_campaign": ["account_id", "campaign_id", "ad_network_type", "conversion_action", "conversion_lag_bucket"], "lag_asset_group": [*_G, "ad_network_type", "conversion_action", "conversion_lag_bucket"],
    "entities_campaign": ["account_id", "campaign_id"], "entities_asset_group": _G, "entities_asset_group_asset": _A, "entities_asset": [*_G, "asset_id"], "entities_asset_group_signal": [*_G, "signal_resource_name"],
    "entities_campaign_asset": ["account_id", "campaign_id", "asset_resource_name", "field_type"], "entities_customer_asset": ["account_id", "asset_resource_name", "field_type"],
    "entities_conversion_action": ["account_id", "conversion_action_id"], "entities_customer": ["account_id"],
}
KEYS = {
    "campaign": ["account_id", "campaign_id"], "asset_group": _G, "asset": _A, "asset_group_signal": [*_G, "signal_resource_name"], "campaign_asset": ["account_id", "campaign_id", "asset_resource_name", "field_type"],
    "conversion_action": ["account_id", "conversion_action_id"], "customer": ["account_id"],
}
GRAIN_KEYS = {"campaign": ["account_id", "campaign_id"], "asset_group": _G, "asset": _A}
COUNTS = ["conversions", "conversions_value", "all_conversions", "all_conversions_value"]
NETWORK = ["network_impressions", "network_clicks", "network_cost", "network_conversions", "network_conversions_value", "network_all_conversions", "network_all_conversions_value"]
BY_ACTION = ["action_conversions", "action_conversions_value", "action_all_conversions", "action_all_conversions_value"]
ENTITY_COLUMNS = {
    "campaign": {"campaign_name": "campaign_name", "status": "campaign_status", "primary_status": "campaign_primary_status", "primary_status_reasons": "campaign_primary_status_reasons"},
    "asset_group": {"asset_group_name": "asset_group_name", "status": "asset_group_status", "primary_status": "asset_group_primary_status", "primary_status_reasons": "asset_group_primary_status_reasons", "ad_strength": "ad_strength"},
    "asset": {"asset_name": "asset_name", "asset_type": "asset_type", "status": "asset_status", "primary_status": "asset_primary_status", "primary_status_reasons": "asset_primary_status_reasons", "text": "text", "source": "source"},
}
ACTION_COLUMNS = ["click_through_lookback_window_days", "view_through_lookback_window_days", "include_in_conversions_metric", "conversion_action_type"]
_SHARED = ["ad_network_type", "metric_basis", "conversion_action_id", "conversion_action_name", "currency_code", "attribute_provenance"]
DIMENSIONS = {
    "campaign": ["date", "account_id", "campaign_id", "campaign_name", "campaign_status", *_SHARED],
    "asset_group": ["date", *_G, "asset_group_name", "asset_group_status", "ad_strength", *_SHARED],
    "asset": ["date", *_A, "asset_name", "asset_type", "asset_status", *_SHARED],
}
ABSENT = "ENTITY_NOT_PRESENT_ON_COMPLETE_SNAPSHOT"
#: The upper day of each lag bucket.
UPPER = """CASE conversion_lag_bucket WHEN 'LESS_THAN_ONE_DAY' THEN 1 WHEN 'ONE_TO_TWO_DAYS' THEN 2 WHEN 'TWO_TO_THREE_DAYS' THEN 3 WHEN 'THREE_TO_FOUR_DAYS' THEN 4 WHEN 'FOUR_TO_FIVE_DAYS' THEN 5
WHEN 'FIVE_TO_SIX_DAYS' THEN 6 WHEN 'SIX_TO_SEVEN_DAYS' THEN 7 WHEN 'SEVEN_TO_EIGHT_DAYS' THEN 8 WHEN 'EIGHT_TO_NINE_DAYS' THEN 9 WHEN 'NINE_TO_TEN_DAYS' THEN 10 WHEN 'TEN_TO_ELEVEN_DAYS' THEN 11
WHEN 'ELEVEN_TO_TWELVE_DAYS' THEN 12 WHEN 'TWELVE_TO_THIRTEEN_DAYS' THEN 13 WHEN 'THIRTEEN_TO_FOURTEEN_DAYS' THEN 14 WHEN 'FOURTEEN_TO_TWENTY_ONE_DAYS' THEN 21 WHEN 'TWENTY_ONE_TO_THIRTY_DAYS' THEN 30
WHEN 'THIRTY_TO_FORTY_FIVE_DAYS' THEN 45 WHEN 'FORTY_FIVE_TO_SIXTY_DAYS' THEN 60 WHEN 'SIXTY_TO_NINETY_DAYS' THEN 90 END"""


def day_column(table: str) -> str:
    return "snapshot_date" if table.startswith("entities_") else "date"


AS_OF, START = "DATE '1998-06-30'", "DATE '1998-04-01'"
RUN = "'run-19980630'"
SQL: dict[str, str] = definitions(OTHER)
ORACLE: dict[str, str] = {}
#: Array columns by table; results show them as text.
ARRAYS = {"campaign": ["primary_status_reasons"], "asset_group": ["primary_status_reasons", "final_urls", "ad_strength_action_items"], "asset": ["primary_status_reasons"], "campaign_asset": ["primary_status_reasons"]}


def put(name: str, select: str, needs: list[str], arrays: list[str] = ()) -> None:
    if arrays:
        nested = lambda a: f"CASE WHEN {a} IS NOT NULL THEN CAST(to_json({a}) AS VARCHAR) END"
        shown = ", ".join(f"{nested(a) if a.endswith('_items') else f'array_to_string({a}, {chr(39)}, {chr(39)})'} AS {a}" for a in arrays)
        select = f"SELECT * REPLACE ({shown}) FROM ({select}) q"
    ORACLE[name] = f"{with_clause(SQL, needs, materialized=True)}\n{select}"


def tally(table: str, by: str, *sums: str) -> str:
    return f"SELECT {by}, count(*) AS n{''.join(f', sum({c}) AS {c}' for c in sums)} FROM {table} GROUP BY {by}"


def staged(table: str, where: str, dated: bool = False) -> str:
    keys = ", ".join([day_column(table), *GRAINS[table]])
    fix = ""
    if table == "entities_campaign":
        fix = "REPLACE (TRY_CAST(NULLIF(start_date_time, '') AS TIMESTAMP) AS start_date_time, TRY_CAST(NULLIF(end_date_time, '') AS TIMESTAMP) AS end_date_time)"
    return f"""SELECT * EXCLUDE (run_id, query_hash) {fix}, run_id AS source_run_id FROM raw_{table} WHERE {where}
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY loaded_at DESC, run_id DESC) = 1"""


def array_columns(table: str) -> list[str]:
    if not table.startswith("entities_") or table in ("entities_asset", "entities_asset_group_signal", "entities_conversion_action", "entities_customer"):
        return []
    return ["primary_status_reasons"] + (["final_urls", "ad_strength_action_items"] if table == "entities_asset_group" else [])


# Sources and staging
put("src_family_scan", "SELECT * EXCLUDE (loaded_at) FROM raw_volume_campaign", ["raw_volume_campaign"])
for _t in GRAINS:
    if _t != "volume_campaign":
        put(f"src_family_scan_{_t}", f"SELECT * EXCLUDE (loaded_at) FROM raw_{_t}", [f"raw_{_t}"], array_columns(_t))
put("src_coerce", "SELECT * EXCLUDE (loaded_at) REPLACE (NULLIF(video_id, '') AS video_id) FROM raw_entities_asset", ["raw_entities_asset"])
put("src_date_bounds", "SELECT min(date) AS first_day, max(date) AS last_day, count(*) FILTER (WHERE date IS NULL) AS without_day, count(*) AS n FROM raw_volume_campaign", ["raw_volume_campaign"])
put("src_window_clip", f"SELECT * EXCLUDE (loaded_at) FROM raw_volume_asset_group WHERE date >= {START}", ["raw_volume_asset_group"])
put("src_channel_filter", "SELECT account_id, campaign_id, snapshot_date, run_id, status FROM report_campaigns WHERE advertising_channel_type = 'PERFORMANCE_MAX'", ["report_campaigns"])
put("src_channel_window", f"SELECT * EXCLUDE (loaded_at) FROM report_volume WHERE advertising_channel_type = 'PERFORMANCE_MAX' AND date BETWEEN {START} AND {AS_OF}", ["report_volume"])
put("src_landed_json", "SELECT * EXCLUDE (loaded_at) FROM raw_volume_campaign", ["raw_volume_campaign"])
_PLANTED = "(SELECT * FROM raw_volume_campaign r WHERE day(date) = 1 AND campaign_id % 10 = 3) p"
_REASONS = "(VALUES ('no JSON object'), ('unknown field surprise'), ('bad value in clicks'), ('no date')) AS v(reason)"
put("src_landed_outcomes", f"SELECT 'taken' AS outcome, count(*) AS n FROM raw_volume_campaign UNION ALL SELECT reason, count(*) FROM {_PLANTED}, {_REASONS} GROUP BY reason", ["raw_volume_campaign"])
put("src_landed_broken", f"SELECT reason, CASE WHEN reason <> 'no JSON object' THEN campaign_id END AS campaign_id FROM {_PLANTED}, {_REASONS}", ["raw_volume_campaign"])
for _t in GRAINS:
    _fact = day_column(_t) == "date"
    SQL[f"ld_{_t}"] = staged(_t, f"date BETWEEN {START} AND {AS_OF}" if _fact else "TRUE")
    SQL[f"stg_{_t}"] = f"SELECT * EXCLUDE (loaded_at) FROM ld_{_t}"
    put(f"stg_{_t}", f"SELECT * FROM stg_{_t}" + ("" if _fact else f" WHERE snapshot_date = {AS_OF}"), [f"stg_{_t}"], array_columns(_t))
    if _t in ("volume_campaign", "conv_asset", "lag_campaign", "entities_asset_group"):
        put(f"stg_loads_{_t}", f"SELECT * FROM stg_{_t} WHERE {day_column(_t)} BETWEEN {START} AND {AS_OF}", [f"stg_{_t}"], array_columns(_t))
put("src_landed_json_staged", "SELECT * FROM stg_volume_campaign", ["stg_volume_campaign"])
put("src_swap_bounds", f"SELECT {START} AS start_day, greatest((SELECT max(date) FROM raw_volume_campaign), (SELECT max(date) FROM stg_volume_campaign)) AS end_day", ["raw_volume_campaign", "stg_volume_campaign"])
put("src_lineage", "SELECT 'run-x' AS run_id, sha256('SELECT 1') AS query_hash, * FROM stg_conv_campaign", ["stg_conv_campaign"])
put("src_snapshot_stamp", f"SELECT * FROM stg_entities_customer WHERE snapshot_date = {AS_OF}", ["stg_entities_customer"])

# Entities: a removal is dated by the first complete day after the entity's last one before it
SQL["days"] = "SELECT DISTINCT account_id, snapshot_date FROM stg_entities_customer"
SQL["next_days"] = "SELECT account_id, snapshot_date, lead(snapshot_date) OVER (PARTITION BY account_id ORDER BY snapshot_date) AS next_day FROM days"
put("src_snapshot_day_scan", "SELECT * EXCLUDE (loaded_at) FROM report_volume WHERE advertising_channel_type = 'SEARCH' AND date IN (SELECT snapshot_date FROM days WHERE account_id = 3)", ["report_volume", "days"])
put("ent_complete_days", "SELECT * FROM days", ["days"])
SQL["bounds"] = f"""SELECT account_id, campaign_id, min(snapshot_date) AS first_seen_date, max(snapshot_date) AS last_seen_date
FROM stg_entities_campaign JOIN days USING (account_id, snapshot_date) WHERE snapshot_date <= {AS_OF} GROUP BY ALL"""
put("ent_seen_bounds", "SELECT * FROM bounds", ["bounds"])
put("ent_next_complete", """SELECT b.account_id, b.campaign_id, first_seen_date, last_seen_date, min(d.snapshot_date) AS next_complete_date
FROM bounds b LEFT JOIN days d ON d.account_id = b.account_id AND d.snapshot_date > b.last_seen_date GROUP BY ALL""", ["bounds", "days"])
SQL["rows_asset"] = """SELECT l.*, a.* EXCLUDE (account_id, campaign_id, asset_group_id, asset_id, snapshot_date, source_run_id) FROM stg_entities_asset_group_asset l
LEFT JOIN stg_entities_asset a USING (account_id, campaign_id, asset_group_id, asset_id, snapshot_date)"""
SAID = {"status": "'REMOVED'", "primary_status": "'REMOVED'", "approval_status": "'REMOVED'", "primary_status_reasons": f"['{ABSENT}']", "inferred_removed": "TRUE", "attribute_provenance": "'inferred-removed'"}
#: Columns of staged entity tables besides keys and day that a removal leaves null or states.
COLUMNS = {
    "campaign": "campaign_name status primary_status primary_status_reasons advertising_channel_type positive_geo_target_type negative_geo_target_type start_date_time end_date_time budget_id budget_amount_micros budget_explicitly_shared budget_period url_expansion_opt_out source_run_id",
    "asset_group": "asset_group_name status primary_status primary_status_reasons ad_strength final_urls ad_strength_action_items source_run_id",
    "asset": "status primary_status primary_status_reasons source asset_name asset_type orientation text image_url image_height_pixels image_width_pixels video_id video_title source_run_id",
    "asset_group_signal": "approval_status audience search_theme source_run_id",
    "campaign_asset": "asset_id advertising_channel_type status primary_status primary_status_reasons source_run_id",
    "conversion_action": "conversion_action_name category counting_type status click_through_lookback_window_days view_through_lookback_window_days include_in_conversions_metric conversion_action_type source_run_id",
    "customer": "descriptive_name currency_code time_zone status manager source_run_id",
}
for _e, _keys in KEYS.items():
    src = "rows_asset" if _e == "asset" else f"stg_entities_{_e}"
    cols, k = COLUMNS[_e].split(), ", ".join(_keys)
    obs = f"SELECT {k}, snapshot_date, {', '.join(cols)}, FALSE AS inferred_removed, 'observed' AS attribute_provenance FROM {src} JOIN days USING (account_id, snapshot_date)"
    if _e != "customer":
        values = ", ".join(f"{SAID.get(c, 'NULL')} AS {c}" for c in [*cols, "inferred_removed", "attribute_provenance"])
        SQL[f"obs_{_e}"] = obs
        SQL[f"due_{_e}"] = f"SELECT {', '.join('o.' + c for c in _keys)}, d.next_day AS snapshot_date FROM obs_{_e} o JOIN next_days d USING (account_id, snapshot_date) WHERE d.next_day IS NOT NULL"
        k0 = _keys[0]
        same = " AND ".join(f"x.{c} IS NOT DISTINCT FROM d.{c}" for c in [*_keys[1:], "snapshot_date"])
        obs = f"""SELECT * FROM obs_{_e} UNION ALL BY NAME SELECT {k}, snapshot_date, {values} FROM (
  SELECT {', '.join('d.' + c for c in _keys)}, d.snapshot_date FROM due_{_e} d LEFT JOIN obs_{_e} x ON x.{k0} = d.{k0} AND {same} WHERE x.{k0} IS NULL) t"""
    SQL[f"hist_{_e}"] = obs
    eq = " AND ".join(f"h.{c} IS NOT DISTINCT FROM b.{c}" for c in _keys)
    SQL[f"view_{_e}"] = f"""SELECT h.*, b.first_seen_date, b.last_seen_date FROM hist_{_e} h JOIN (
  SELECT {k}, min(snapshot_date) AS first_seen_date, max(snapshot_date) AS last_seen_date FROM hist_{_e} JOIN days USING (account_id, snapshot_date) WHERE NOT inferred_removed GROUP BY {k}) b ON {eq}"""
    arrays = ARRAYS.get(_e, [])
    put(f"ent_{_e}", f"SELECT * FROM hist_{_e} WHERE snapshot_date = {AS_OF}", [f"hist_{_e}", "days"], arrays)
    put(f"ent_view_{_e}", f"SELECT * FROM view_{_e}", [f"view_{_e}", "days"], arrays)
    money = " EXCLUDE (budget_amount_micros), CAST(budget_amount_micros / 1000000.0 AS DECIMAL(38, 9)) AS budget_amount" if _e == "campaign" else ""
    put(f"mart_entities_{_e}", f"SELECT *{money} FROM view_{_e} WHERE snapshot_date = {AS_OF}", [f"view_{_e}", "days"], arrays)
put("ent_customer_asset", f"SELECT * FROM stg_entities_customer_asset JOIN days USING (account_id, snapshot_date) WHERE snapshot_date = {AS_OF}", ["stg_entities_customer_asset", "days"], ["primary_status_reasons"])

# Performance
ID = "TRY_CAST(NULLIF(regexp_extract(conversion_action, '/(\\d+)$', 1), '') AS BIGINT)"
COST = "CAST(cost_micros / 1000000.0 AS DECIMAL(38, 9))"


def union(grain: str) -> str:
    keys = ", ".join(["date", *GRAIN_KEYS[grain], "ad_network_type"])
    net = ", ".join(["impressions AS network_impressions", "clicks AS network_clicks", f"{COST} AS network_cost", *(f"{c} AS network_{c}" for c in COUNTS)])
    act = ", ".join(f"{c} AS action_{c}" for c in COUNTS)
    return f"""SELECT {keys}, 'NETWORK' AS metric_basis, NULL::BIGINT AS conversion_action_id, NULL::VARCHAR AS conversion_action_resource_name, NULL::VARCHAR AS conversion_action_name, {net}, {', '.join(f'NULL::DOUBLE AS {c}' for c in BY_ACTION)}, source_run_id FROM stg_volume_{grain}
UNION ALL BY NAME SELECT {keys}, 'CONVERSION_ACTION' AS metric_basis, {ID} AS conversion_action_id, conversion_action AS conversion_action_resource_name, conversion_action_name, {act}, source_run_id FROM stg_conv_{grain}"""


def asof(facts: str, view: str, keys: list[str], columns: str, grain: list[str], day: str = "date") -> str:
    on = " AND ".join(f"e.{c} = p.{c}" for c in keys)
    by = ", ".join(f"p.{c}" for c in grain)
    return f"""SELECT p.*, {columns} FROM {facts} p LEFT JOIN {view} e ON {on} QUALIFY row_number() OVER (PARTITION BY {by}
ORDER BY CASE WHEN e.snapshot_date <= p.{day} THEN 0 ELSE 1 END, CASE WHEN e.snapshot_date <= p.{day} THEN e.snapshot_date END DESC NULLS LAST, e.snapshot_date ASC NULLS FIRST) = 1"""


PROVENANCE = "CASE WHEN e.first_seen_date IS NULL THEN 'unavailable' WHEN p.date < e.first_seen_date THEN 'assumed-current' ELSE e.attribute_provenance END AS attribute_provenance"
for _g, _keys in GRAIN_KEYS.items():
    own = ["date", *_keys, "metric_basis", "ad_network_type", "conversion_action_id", "conversion_action_resource_name"]
    SQL[f"union_{_g}"] = union(_g)
    SQL[f"entity_{_g}"] = asof(f"union_{_g}", f"view_{_g}", _keys, ", ".join(f"e.{a} AS {b}" for a, b in ENTITY_COLUMNS[_g].items()) + ", " + PROVENANCE, own)
    SQL[f"customer_{_g}"] = asof(f"entity_{_g}", "view_customer", ["account_id"], "e.currency_code, e.time_zone", own)
    SQL[f"perf_{_g}"] = f"SELECT *, {RUN} AS run_id FROM (" + asof(f"customer_{_g}", "view_conversion_action", ["account_id", "conversion_action_id"], ", ".join(f"e.{c}" for c in ACTION_COLUMNS), own) + ") t"
    reasons = f"{'campaign' if _g == 'campaign' else _g}_primary_status_reasons"
    for name in (f"int_performance_{_g}", f"mart_performance_{_g}"):
        put(name, f"SELECT * FROM perf_{_g}", [f"perf_{_g}"], [reasons])
V = "stg_volume_campaign"
FACT = ["date", "account_id", "campaign_id", "ad_network_type"]
put("prf_metric_union", "SELECT * FROM union_campaign", ["union_campaign"])
put("prf_micros_to_currency", f"SELECT account_id, campaign_id, date, ad_network_type, {COST} AS cost FROM {V}", [V])
put("prf_action_id", f"SELECT DISTINCT conversion_action, {ID} AS conversion_action_id FROM stg_conv_campaign", ["stg_conv_campaign"])
put("prf_asof_join", "SELECT date, account_id, campaign_id, ad_network_type, status, snapshot_date FROM (" + asof(V, "view_campaign", KEYS["campaign"], "e.status, e.snapshot_date", FACT) + ") t", [V, "view_campaign"])
put("prf_provenance", "SELECT metric_basis, attribute_provenance, count(*) AS n FROM entity_campaign GROUP BY ALL", ["entity_campaign"])
put("prf_asof_customer", "SELECT date, account_id, campaign_id, ad_network_type, currency_code, time_zone FROM (" + asof(V, "view_customer", ["account_id"], "e.currency_code, e.time_zone", FACT) + ") t", [V, "view_customer"])
put("prf_asof_action", f"SELECT date, account_id, campaign_id, ad_network_type, metric_basis, conversion_action_resource_name, {', '.join(ACTION_COLUMNS)} FROM perf_campaign", ["perf_campaign"])
MEASURES = [*NETWORK, *BY_ACTION]
put("mart_asset_performance", "SELECT date, account_id, campaign_id, asset_group_id, asset_id, field_type, ad_network_type, metric_basis, conversion_action_resource_name, asset_primary_status, asset_primary_status_reasons, " + ", ".join(MEASURES) + " FROM perf_asset", ["perf_asset"], ["asset_primary_status_reasons"])
SQL["truth"] = "SELECT date, account_id, campaign_id, campaign_name, ad_network_type, currency_code, time_zone, " + ", ".join(NETWORK) + ", run_id FROM perf_campaign WHERE metric_basis = 'NETWORK'"
put("mart_campaign_truth", "SELECT * FROM truth", ["truth"])


def published(table: str, dimensions: list[str], measures: list[str]) -> str:
    by = ", ".join(f"array_to_string({c}, ', ') AS {c}" if c.endswith("_reasons") else c for c in dimensions)
    sums = ", ".join(f"sum({m})" + ("::BIGINT" if m in ("network_impressions", "network_clicks") else "") + f" AS {m}" for m in measures)
    return f"SELECT {by}, {sums}, {AS_OF} AS as_of, {RUN} AS run_id FROM {table} WHERE date BETWEEN {AS_OF} - 90 AND {AS_OF} - 1 GROUP BY ALL"


for _g, _dims in DIMENSIONS.items():
    put(f"pub_performance_{_g}", published(f"perf_{_g}", _dims, MEASURES), [f"perf_{_g}"])
put("pub_asset_performance", published("perf_asset", ["date", "account_id", "campaign_id", "asset_id", "field_type", "asset_primary_status", "asset_primary_status_reasons", "ad_network_type", "metric_basis"], MEASURES), ["perf_asset"])
put("pub_campaign_truth", published("truth", ["date", "account_id", "campaign_id", "campaign_name", "ad_network_type", "currency_code"], NETWORK), ["truth"])


def ratios(source: str, by: str) -> str:
    div = lambda a, b: f"sum({a})::DOUBLE / NULLIF(sum({b})::DOUBLE, 0)"
    return f"SELECT {by}, {div('network_clicks', 'network_impressions')} AS ctr, {div('network_cost', 'network_conversions')} AS cpa, {div('network_conversions_value', 'network_cost')} AS roas FROM ({source}) s GROUP BY {by}"


WINDOW = f"date BETWEEN {AS_OF} - 90 AND {AS_OF} - 1"
put("ratio_performance", ratios(f"SELECT * FROM perf_campaign WHERE {WINDOW}", "account_id, campaign_id"), ["perf_campaign"])
put("ratio_campaign_truth", ratios(f"SELECT * FROM truth WHERE {WINDOW}", "account_id"), ["truth"])

# Lookback windows
SQL["acted"] = f"""SELECT date AS click_date, account_id, conversion_action AS conversion_action_resource_name, {ID} AS conversion_action_id, conversions AS c FROM stg_conv_campaign
UNION ALL SELECT date, account_id, conversion_action, {ID}, conversions FROM stg_lag_campaign"""
SQL["evidence"] = "SELECT click_date, account_id, conversion_action_resource_name, conversion_action_id, bool_or(coalesce(c, 0) <> 0) AS has_primary_conversions FROM acted GROUP BY ALL"
SQL["defaults"] = "SELECT account_id, max(click_through_lookback_window_days) AS default_window_days FROM hist_conversion_action GROUP BY ALL"
SQL["kept_actions"] = "SELECT * FROM hist_conversion_action WHERE NOT inferred_removed"
SQL["chosen"] = "SELECT click_date, account_id, conversion_action_resource_name, conversion_action_id, coalesce(w, default_window_days) AS window_days, CASE WHEN s <= click_date THEN 'observed' ELSE 'assumed-current' END AS window_provenance, f OR has_primary_conversions AS is_primary FROM (" + asof(
    "evidence", "kept_actions", ["account_id", "conversion_action_id"], "e.click_through_lookback_window_days AS w, e.include_in_conversions_metric AS f, e.snapshot_date AS s", ["click_date", "account_id", "conversion_action_resource_name", "conversion_action_id"], "click_date"
) + ") t LEFT JOIN defaults USING (account_id)"
SQL["aggregated"] = """SELECT click_date, account_id, 'PRIMARY' AS metric_basis, max(window_days) AS window_days, CASE WHEN bool_or(window_provenance = 'assumed-current') THEN 'assumed-current' ELSE 'observed' END AS window_provenance FROM chosen WHERE is_primary GROUP BY ALL
UNION ALL SELECT click_date, account_id, 'ALL_CONVERSIONS', max(window_days), CASE WHEN bool_or(window_provenance = 'assumed-current') THEN 'assumed-current' ELSE 'observed' END FROM chosen GROUP BY click_date, account_id"""
put("lbk_action_keys", "SELECT click_date, account_id, conversion_action_resource_name, conversion_action_id FROM evidence", ["evidence"])
put("lbk_primary_evidence", "SELECT * FROM evidence", ["evidence"])
put("lbk_account_default", "SELECT * FROM defaults", ["defaults"])
put("lbk_chosen_action", "SELECT * FROM chosen", ["chosen"])
put("lbk_aggregate", "SELECT * FROM aggregated", ["aggregated"])
SQL["windows"] = "SELECT *, 'CONVERSION_ACTION' AS metric_basis FROM chosen UNION ALL BY NAME SELECT * FROM aggregated"
put("int_lookback_windows", "SELECT * FROM windows", ["windows"])

# Text
_HASH = lambda kind, x: f"sha256('7:{kind}:' || CAST({x} AS VARCHAR))"
_NUMBER = lambda kind, x, below=10**15: f"greatest(CAST(CAST('0x' || substr({_HASH(kind, x)}, 1, 16) AS UBIGINT) % {below} AS BIGINT), 1)"
put("txt_pseudonymise_ids", f"SELECT campaign_id, {_NUMBER('campaign_id', 'campaign_id')} AS pseudonym FROM stg_entities_campaign WHERE snapshot_date = {AS_OF}", ["stg_entities_campaign"])
put("txt_pseudonymise_text", f"SELECT campaign_id, 'Campaign ' || {_NUMBER('campaign_name', 'campaign_name')} AS name FROM stg_entities_campaign WHERE snapshot_date = {AS_OF}", ["stg_entities_campaign"])
_LAST = "split_part(conversion_action, '/', 4)"
put("txt_pseudonymise_resources", f"""SELECT {_NUMBER('account_id', 'account_id')} AS account_id, {_NUMBER('campaign_id', 'campaign_id')} AS campaign_id, date, ad_network_type, conversion_action AS old_action,
  'Action ' || {_NUMBER('conversion_action_name', 'conversion_action_name')} AS conversion_action_name,
  'customers/' || {_NUMBER('account_id', 'account_id')} || '/conversionActions/' || CASE WHEN {_LAST} = 'x5' THEN 'x5' ELSE CAST({_NUMBER('conversion_action_id', _LAST)} AS VARCHAR) END AS conversion_action FROM stg_conv_campaign""", ["stg_conv_campaign"])
_ALPHABET = "'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-'"
_OLD_URL = "CASE WHEN asset_id % 2 = 0 THEN 'https://example.com/i/' || asset_id || '.png?w=1' ELSE 'https://example.com/' END"
_CODE = f"printf('%x', {_NUMBER('url', 'u')})"
put("txt_pseudonymise_media", f"""SELECT account_id, campaign_id, asset_group_id, asset_id, 'https://fixtures.' || {_CODE} || '.example/' || CASE WHEN asset_id % 2 = 0 THEN {_CODE} || '.png' ELSE '' END AS image_url,
  {' || '.join(f"substr({_ALPHABET}, CAST(CAST('0x' || substr({_HASH('video_id', 'video_id')}, {2 * i + 1}, 2) AS UBIGINT) % 64 AS BIGINT) + 1, 1)" for i in range(11))} AS video_id,
  'Asset ' || {_NUMBER('asset_name', 'asset_name')} AS asset_name, 'Headline ' || {_NUMBER('text', 'text')} AS text, 'Video ' || {_NUMBER('video_title', 'video_title')} AS video_title
FROM (SELECT *, {_OLD_URL} AS u FROM stg_entities_asset WHERE snapshot_date = {AS_OF}) q""", ["stg_entities_asset"])
_TODAY = f"WHERE snapshot_date = {AS_OF}"
SQL["all_ids"] = " UNION ".join(f"SELECT '{c}' AS kind, CAST({x} AS VARCHAR) AS old FROM {t}" for t, columns in {
    f"stg_entities_asset_group_asset {_TODAY}": {c: c for c in ("account_id", "campaign_id", "asset_group_id", "asset_id")}, "stg_conv_campaign": {"account_id": "account_id", "campaign_id": "campaign_id"},
    f"stg_conv_campaign WHERE {_LAST} <> 'x5'": {"conversion_action_id": _LAST}, f"stg_entities_campaign_asset {_TODAY}": {c: c for c in ("account_id", "campaign_id", "asset_id")},
    f"stg_entities_campaign {_TODAY}": {c: c for c in ("account_id", "campaign_id", "budget_id")}}.items() for c, x in columns.items())
_ALL_NEW = lambda below: f"greatest(CAST(CAST('0x' || substr(sha256('7:' || kind || ':' || old), 1, 16) AS UBIGINT) % {below} AS BIGINT), 1)"
put("txt_id_mapping", f"SELECT kind, old, {_ALL_NEW(10**15)} AS new FROM all_ids", ["all_ids"])
put("txt_id_clashes", f"SELECT kind, {_ALL_NEW(1000)} AS new, count(DISTINCT old) AS ids, min(old) AS one, max(old) AS other FROM all_ids GROUP BY 1, 2 HAVING count(DISTINCT old) > 1", ["all_ids"])

# Lag cohorts
SQL["zones"] = "SELECT account_id, min(time_zone) AS time_zone FROM (SELECT account_id, time_zone FROM perf_campaign UNION ALL SELECT account_id, time_zone FROM perf_asset_group) t GROUP BY ALL"
put("lag_timezones", "SELECT * FROM zones", ["zones"])
# 01:00 and 02:00 UTC are the same day in Paris and Tokyo, the day before in New York.
LOCAL = "CAST({t} AS DATE) - CASE WHEN time_zone = 'America/New_York' THEN 1 ELSE 0 END"
SHOW = "strftime({t}, '%Y-%m-%d %H:%M:%S')"
_K = "account_id, campaign_id, {g} AS asset_group_id, ad_network_type, conversion_action, conversion_action_name, conversion_lag_bucket, " + ", ".join(COUNTS) + ", loaded_at AS refresh_ts, source_run_id, " + UPPER + " AS upper_day, " + LOCAL.format(t="loaded_at") + " AS refresh_date"
SQL["buckets"] = f"SELECT 'campaign' AS grain, date AS click_date, {_K.format(g='NULL::BIGINT')} FROM ld_lag_campaign LEFT JOIN zones USING (account_id) UNION ALL SELECT 'asset_group', date, {_K.format(g='asset_group_id')} FROM ld_lag_asset_group LEFT JOIN zones USING (account_id)"
put("lag_source_buckets", f"SELECT * EXCLUDE (upper_day) REPLACE ({SHOW.format(t='refresh_ts')} AS refresh_ts) FROM buckets", ["buckets"])
put("lag_bucket_upper_day", "SELECT grain, conversion_lag_bucket, upper_day, sum(conversions) AS conversions FROM buckets GROUP BY ALL", ["buckets"])
put("lag_refresh_date", f"SELECT DISTINCT account_id, run_id, {LOCAL.format(t='loaded_at')} AS refresh_date FROM raw_lag_campaign LEFT JOIN zones USING (account_id)", ["raw_lag_campaign", "zones"])
SQL["action_buckets"] = """SELECT b.*, CAST(coalesce(w.window_days, 90) AS BIGINT) AS action_window_days, coalesce(w.window_provenance, 'assumed-current') AS action_window_provenance,
  coalesce(w.is_primary, FALSE) OR coalesce(e.shown, FALSE) AS contributes_to_primary FROM buckets b
LEFT JOIN windows w ON w.metric_basis = 'CONVERSION_ACTION' AND w.click_date = b.click_date AND w.account_id = b.account_id AND w.conversion_action_resource_name = b.conversion_action
LEFT JOIN (SELECT click_date, account_id, conversion_action_resource_name AS r, bool_or(has_primary_conversions) AS shown FROM evidence GROUP BY ALL) e
  ON e.click_date = b.click_date AND e.account_id = b.account_id AND e.r IS NOT DISTINCT FROM b.conversion_action"""
put("lag_action_buckets", f"SELECT * REPLACE ({SHOW.format(t='refresh_ts')} AS refresh_ts) FROM action_buckets", ["action_buckets"])
_B = "grain, click_date, account_id, campaign_id, asset_group_id, ad_network_type, upper_day, refresh_date, refresh_ts, source_run_id, action_window_days, action_window_provenance"
SQL["basis"] = f"""SELECT {_B}, 'CONVERSION_ACTION' AS metric_basis, {ID} AS conversion_action_id, conversion_action AS conversion_action_resource_name, conversion_action_name, conversions, conversions_value FROM action_buckets
UNION ALL SELECT {_B}, 'PRIMARY', NULL, NULL, 'Primary conversions', conversions, conversions_value FROM action_buckets WHERE contributes_to_primary
UNION ALL SELECT {_B}, 'ALL_CONVERSIONS', NULL, NULL, 'All conversions', all_conversions, all_conversions_value FROM action_buckets"""
put("lag_basis_buckets", f"SELECT * REPLACE ({SHOW.format(t='refresh_ts')} AS refresh_ts) FROM basis", ["basis"])
_SERIES = ["grain", "click_date", "account_id", "campaign_id", "asset_group_id", "ad_network_type", "metric_basis", "conversion_action_resource_name"]
_S = ", ".join(_SERIES)


def on(a: str, b: str, keys: list[str]) -> str:
    """Null-safe, led by a key that is never null so that it can be hashed."""
    return " AND ".join(f"{a}.{c} = {b}.{c}" if c in ("grain", "click_date", "account_id", "campaign_id", "metric_basis", "date", "cohort_day") else f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in keys)


SQL["keyed"] = f"""SELECT {_S}, conversion_action_id, conversion_action_name, least(max(action_window_days), 90) AS window_days, CASE WHEN max(action_window_days) > 90 THEN 'capped by reporting window'
  WHEN count(*) FILTER (WHERE action_window_provenance = 'assumed-current') > 0 THEN 'assumed-current' ELSE 'observed' END AS window_provenance FROM basis GROUP BY ALL"""
SQL["steps"] = """SELECT k.*, CAST(d AS BIGINT) AS cohort_day, d = window_days AS is_window_rung FROM keyed k, (VALUES (1), (3), (5), (7), (14), (30)) v(d) WHERE d <= window_days
UNION SELECT k.*, window_days, TRUE FROM keyed k"""
put("lag_keys", "SELECT * FROM keyed", ["keyed"])
put("lag_ladder_days", "SELECT CAST(d AS BIGINT) AS cohort_day, coalesce(n, 0) AS rungs, coalesce(w, 0) AS window_rungs FROM (VALUES (1), (3), (5), (7), (14), (30)) v(d) LEFT JOIN (SELECT cohort_day, count(*) AS n, count(*) FILTER (WHERE is_window_rung) AS w FROM steps GROUP BY cohort_day) q ON d = cohort_day", ["steps"])
put("lag_ladder", tally("steps", "grain, metric_basis, window_days, window_provenance, cohort_day, is_window_rung"), ["steps"])
_IN = "b.upper_day <= least(l.cohort_day, b.action_window_days)"
SQL["prefixes"] = f"""SELECT l.*, sum(CASE WHEN {_IN} THEN b.conversions ELSE 0 END) AS prefix_conversions, sum(CASE WHEN {_IN} THEN b.conversions_value ELSE 0 END) AS prefix_value,
  sum(CASE WHEN b.upper_day IS NULL THEN b.conversions ELSE 0 END) AS unknown_lag_conversions, sum(CASE WHEN b.upper_day IS NULL THEN b.conversions_value ELSE 0 END) AS unknown_lag_value,
  max(b.refresh_date) AS bucket_refresh_date, max(b.refresh_ts) AS bucket_refresh_ts, min(b.source_run_id) AS bucket_run_id
FROM steps l JOIN basis b ON {on('l', 'b', _SERIES)} GROUP BY ALL"""
put("lag_prefix_sums", f"SELECT * REPLACE ({SHOW.format(t='bucket_refresh_ts')} AS bucket_refresh_ts) FROM prefixes", ["prefixes"])
_T = []
for _g in ("campaign", "asset_group"):
    _ag = "asset_group_id" if _g == "asset_group" else "NULL::BIGINT"
    for _b, _src, _r, _x in (("PRIMARY", "volume", "NULL::VARCHAR", ""), ("ALL_CONVERSIONS", "volume", "NULL::VARCHAR", "all_"), ("CONVERSION_ACTION", "conv", "conversion_action", "")):
        _T.append(f"SELECT '{_g}' AS grain, date AS click_date, account_id, campaign_id, {_ag} AS asset_group_id, ad_network_type, '{_b}' AS metric_basis, {_r} AS conversion_action_resource_name, {_x}conversions AS total_conversions, {_x}conversions_value AS total_value, loaded_at AS total_refresh_ts, source_run_id AS total_run_id, {LOCAL.format(t='loaded_at')} AS total_refresh_date FROM ld_{_src}_{_g} LEFT JOIN zones USING (account_id)")
SQL["totals"] = "\nUNION ALL ".join(_T)
put("lag_totals", f"SELECT * REPLACE ({SHOW.format(t='total_refresh_ts')} AS total_refresh_ts) FROM totals", ["totals"])
_OFF = "window_days NOT IN (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 21, 30, 45, 60, 90)"
SQL["resolved"] = f"""SELECT {', '.join('p.' + c for c in _SERIES)}, p.conversion_action_id, p.conversion_action_name, p.window_days, p.window_provenance, p.cohort_day, p.is_window_rung, p.unknown_lag_conversions, p.unknown_lag_value, p.no_answer,
  CASE WHEN r THEN total_conversions ELSE prefix_conversions END AS cohorted_conversions, CASE WHEN r THEN total_value ELSE prefix_value END AS cohorted_value, CASE WHEN r THEN total_refresh_date ELSE bucket_refresh_date END AS source_refresh_date,
  CASE WHEN r THEN total_refresh_ts ELSE bucket_refresh_ts END AS observed_through, CASE WHEN r THEN total_run_id ELSE bucket_run_id END AS source_run_id
FROM (SELECT *, is_window_rung AND window_provenance <> 'capped by reporting window' AND {_OFF} AS r, is_window_rung AND cohort_day = 90 AND {_OFF} AS no_answer FROM prefixes) p LEFT JOIN totals t ON {on('p', 't', _SERIES)}"""
_THROUGH = f"REPLACE ({SHOW.format(t='observed_through')} AS observed_through)"
put("lag_resolve_total", tally("resolved", "grain, click_date, metric_basis, cohort_day, is_window_rung, no_answer, source_run_id", "cohorted_conversions", "cohorted_value"), ["resolved"])
_LABEL = "'D' || CAST(cohort_day AS VARCHAR) || CASE WHEN is_window_rung THEN ' window' ELSE '' END AS cohort_label"
SQL["cells"] = f"""SELECT * EXCLUDE (no_answer) REPLACE (CASE WHEN no_answer THEN 'capped by reporting window' ELSE window_provenance END AS window_provenance, CASE WHEN NOT no_answer THEN cohorted_conversions END AS cohorted_conversions, CASE WHEN NOT no_answer THEN cohorted_value END AS cohorted_value),
  {_LABEL}, CASE WHEN no_answer THEN 'unavailable' ELSE 'measured' END AS provenance, CASE WHEN no_answer THEN 'reporting window is not a lag bucket boundary' END AS unavailable_reason,
  CASE WHEN no_answer THEN NULL WHEN source_refresh_date >= click_date + CAST(cohort_day AS INTEGER) THEN 'complete' ELSE 'immature' END AS maturity, {RUN} AS built_by_run_id, 'google_lag' AS cohort_counting FROM resolved"""
put("lag_label_maturity", tally("cells", "grain, click_date, cohort_label, window_provenance, provenance, unavailable_reason, maturity, cohort_counting", "cohorted_conversions"), ["cells"])
put("int_lag_prefix_campaign", f"SELECT * EXCLUDE (grain, asset_group_id) {_THROUGH} FROM cells WHERE grain = 'campaign'", ["cells"])
put("int_lag_prefix_asset_group", f"SELECT * EXCLUDE (grain) {_THROUGH} FROM cells WHERE grain = 'asset_group'", ["cells"])
COHORT_KEYS = {"campaign": ["account_id", "campaign_id"], "asset_group": _G, "asset": _A}
_CELL = ["ad_network_type", "metric_basis", "conversion_action_id", "conversion_action_resource_name", "conversion_action_name", "cohort_day", "is_window_rung", "cohort_label", "window_days", "window_provenance", "provenance", "unavailable_reason", "maturity", "observed_through"]
_SUMS = ["click_day_cost", "cohorted_conversions", "cohorted_value", "unknown_lag_conversions", "unknown_lag_value", "stale_cell_count", "missing_cost_cell_count"]

# Observation diary: the runs of the diary, and what they saw
SQL["obs_runs"] = f"SELECT run_id, CAST({AS_OF} - back AS DATE) AS observed_date, only_account, share FROM (VALUES ('o-30', 30, NULL, 1.0), ('o-07', 7, NULL, 1.0), ('o-07b', 7, 1, 0.5), ('o-07z', 7, 2, 0.25), ('o-01', 1, NULL, 1.0), ('o-00', 0, NULL, 1.0)) v(run_id, back, only_account, share)"
_O = []
for _g in ("campaign", "asset_group", "asset"):
    _own = ", ".join(f"{c if c in GRAIN_KEYS[_g] else f'NULL::{t}'} AS {c}" for c, t in (("campaign_id", "BIGINT"), ("asset_group_id", "BIGINT"), ("asset_id", "BIGINT"), ("field_type", "VARCHAR")))
    for _b, _src, _r, _n, _x in (("PRIMARY", "volume", "NULL::VARCHAR", "NULL::VARCHAR", ""), ("ALL_CONVERSIONS", "volume", "NULL::VARCHAR", "NULL::VARCHAR", "all_"), ("CONVERSION_ACTION", "conv", "conversion_action", "conversion_action_name", "")):
        _O.append((_g, _b, _src, f"account_id, date AS click_date, '{_g}' AS grain, {_own}, ad_network_type, '{_b}' AS metric_basis, {_r} AS conversion_action, {_n} AS conversion_action_name", _x))
_PART = "CAST(share AS DOUBLE) * CASE WHEN date_diff('day', date, observed_date) < 5 THEN 0.5 ELSE 1.0 END"
SQL["diary"] = "\nUNION ALL ".join(f"SELECT r.run_id, observed_date, date_diff('day', date, observed_date) AS lag, {sel}, {x}conversions * {_PART} AS conversions, {x}conversions_value * {_PART} AS conversions_value FROM stg_{src}_{g} f JOIN obs_runs r ON date < observed_date AND date >= observed_date - 60 AND (only_account IS NULL OR only_account = account_id)" for g, b, src, sel, x in _O)
SQL["obs_ok"] = "SELECT run_id, only_account AS account_id FROM obs_runs WHERE run_id <> 'o-07z' UNION ALL SELECT DISTINCT 'o-30', c_custkey % 5 FROM customer WHERE c_custkey % 5 < 3"
SQL["winners"] = "SELECT d.account_id, observed_date, max(d.run_id) AS run_id FROM (SELECT DISTINCT account_id, observed_date, run_id FROM diary) d JOIN obs_ok s ON s.run_id = d.run_id AND (s.account_id IS NULL OR s.account_id = d.account_id) GROUP BY ALL"
SQL["selected"] = "SELECT d.* FROM diary d JOIN winners w ON w.account_id = d.account_id AND w.observed_date = d.observed_date AND w.run_id = d.run_id"
put("obs_winning_runs", "SELECT * FROM winners", ["winners"])
put("obs_selected", "SELECT * FROM selected", ["selected"])
put("obs_baseline", "SELECT count(*) AS n, count(DISTINCT observed_date) AS days, max(observed_date) AS last_day FROM diary", ["diary"])
SQL["landed_today"] = "\nUNION ALL ".join(f"SELECT 'load-2' AS run_id, {AS_OF} AS observed_date, date_diff('day', date, {AS_OF}) AS lag, {sel}, {x}conversions AS conversions, {x}conversions_value AS conversions_value FROM raw_{src}_{g} WHERE run_id = 'load-2' AND date BETWEEN {AS_OF} - 60 AND {AS_OF} - 1" for g, b, src, sel, x in _O)
put("obs_landed", "SELECT * FROM landed_today", ["landed_today"])
_ROW = ["account_id", "click_date", "grain", "campaign_id", "asset_group_id", "asset_id", "field_type", "ad_network_type", "metric_basis", "conversion_action"]
SQL["prior"] = f"SELECT {', '.join(_ROW)}, min(conversion_action_name) AS conversion_action_name FROM selected WHERE observed_date <= {AS_OF} AND click_date BETWEEN {AS_OF} - 60 AND {AS_OF} - 1 AND (coalesce(conversions, 0) <> 0 OR coalesce(conversions_value, 0) <> 0) GROUP BY ALL"
put("obs_prior_nonzero", "SELECT * FROM prior", ["prior"])
_NOW = f"run_id = 'load-2' AND snapshot_date = {AS_OF}"
_ENT = {"campaign": "raw_entities_campaign", "asset_group": "raw_entities_asset_group", "asset": "raw_entities_asset_group_asset"}
SQL["complete_grains"] = " UNION ALL ".join(f"SELECT DISTINCT '{g}' AS grain, account_id FROM {t} WHERE {_NOW} AND account_id IN (SELECT account_id FROM raw_entities_customer WHERE snapshot_date = {AS_OF})" for g, t in _ENT.items())
put("obs_grain_complete", "SELECT * FROM complete_grains", ["complete_grains"])
SQL["zeros"] = " UNION ALL ".join(f"""SELECT 'load-2' AS run_id, {AS_OF} AS observed_date, date_diff('day', p.click_date, {AS_OF}) AS lag, p.*, 0.0::DOUBLE AS conversions, 0.0::DOUBLE AS conversions_value FROM prior p JOIN complete_grains c ON c.grain = p.grain AND c.account_id = p.account_id
JOIN (SELECT DISTINCT {', '.join(COHORT_KEYS[g])} FROM {t} WHERE {_NOW}) e ON {' AND '.join(f'e.{c} = p.{c}' for c in COHORT_KEYS[g])}
LEFT JOIN landed_today l ON {on('l', 'p', _ROW)} WHERE p.grain = '{g}' AND l.run_id IS NULL""" for g, t in _ENT.items())
put("obs_synthetic_zeros", "SELECT * FROM zeros", ["zeros"])
put("obs_diary", "SELECT * FROM landed_today UNION ALL BY NAME SELECT * FROM zeros", ["zeros"])
SQL["observed_dates"] = f"SELECT account_id, DATE '1998-07-01' - CASE WHEN time_zone = 'America/New_York' THEN 1 ELSE 0 END AS observed_date FROM view_customer WHERE snapshot_date = {AS_OF}"
put("obs_observed_date", "SELECT * FROM observed_dates", ["observed_dates"])
SQL["latest_actions"] = "SELECT a.* FROM stg_entities_conversion_action a JOIN (SELECT account_id, max(snapshot_date) AS d FROM raw_entities_customer GROUP BY ALL) l ON l.account_id = a.account_id AND l.d = a.snapshot_date"
SQL["own_windows"] = f"""SELECT account_id, observed_date, depth_days, greatest(observed_date - depth_days, {START}) AS window_start, observed_date - 1 AS window_end FROM (
  SELECT d.account_id, d.observed_date, CAST(least(90, greatest(31, coalesce(max(a.click_through_lookback_window_days) + 1, 31)) + 7) AS INT) AS depth_days
  FROM observed_dates d LEFT JOIN latest_actions a USING (account_id) GROUP BY d.account_id, d.observed_date) q"""
put("obs_window_clamp", "SELECT * FROM own_windows", ["own_windows"])
put("obs_window_scan", "SELECT r.account_id, campaign_id, date, ad_network_type, run_id, observed_date, observed_date - date AS lag, conversions FROM report_volume r JOIN own_windows w ON r.account_id = w.account_id AND date BETWEEN window_start AND window_end", ["report_volume", "own_windows"])
put("obs_depth_contract", "SELECT max(click_through_lookback_window_days) AS longest_window_days, count(DISTINCT account_id) AS accounts, least(90, greatest(31, max(click_through_lookback_window_days) + 1) + 7) AS depth_days, 'action windows' AS depth_source FROM latest_actions", ["latest_actions"])
put("obs_forfeited_actions", "SELECT account_id, conversion_action_id, w AS window_days, CASE WHEN w >= 90 THEN 'D90..D' || w END AS unmeasurable_rungs, 'D83..D' || w AS margin_rungs FROM (SELECT *, click_through_lookback_window_days AS w FROM latest_actions) t WHERE w > 83", ["latest_actions"])
SQL["obs_bounds"] = f"SELECT account_id, max(observed_date) AS latest_observed_date FROM winners WHERE observed_date <= {AS_OF} GROUP BY ALL"
put("obs_account_bounds", "SELECT * FROM obs_bounds", ["obs_bounds"])
_P = []
for _g in ("asset", "asset_group"):
    _k = f"date AS click_date, account_id, '{_g}' AS grain, campaign_id, asset_group_id, " + ("asset_id, field_type" if _g == "asset" else "NULL::BIGINT AS asset_id, NULL::VARCHAR AS field_type") + ", ad_network_type"
    for _b, _t in (("PRIMARY", "Primary conversions"), ("ALL_CONVERSIONS", "All conversions")):
        _P.append(f"SELECT {_k}, '{_b}' AS metric_basis, NULL::BIGINT AS conversion_action_id, NULL::VARCHAR AS conversion_action_resource_name, '{_t}' AS conversion_action_name, time_zone FROM perf_{_g} WHERE metric_basis = 'NETWORK'")
    _P.append(f"SELECT {_k}, metric_basis, conversion_action_id, conversion_action_resource_name, conversion_action_name, time_zone FROM perf_{_g} WHERE metric_basis = 'CONVERSION_ACTION'")
SQL["obs_keyed"] = " UNION ".join(_P) + f""" UNION SELECT o.click_date, o.account_id, grain, campaign_id, asset_group_id, asset_id, field_type, ad_network_type, metric_basis, {ID}, conversion_action,
  CASE metric_basis WHEN 'PRIMARY' THEN 'Primary conversions' WHEN 'ALL_CONVERSIONS' THEN 'All conversions' ELSE conversion_action_name END, z.time_zone
FROM selected o LEFT JOIN (SELECT account_id, date AS click_date, min(time_zone) AS time_zone FROM perf_asset GROUP BY ALL) z ON z.account_id = o.account_id AND z.click_date = o.click_date WHERE grain <> 'campaign'"""
put("obs_keys", tally("obs_keyed", "grain, click_date, account_id, metric_basis, conversion_action_id, conversion_action_name, time_zone"), ["obs_keyed"])
SQL["obs_cut"] = "SELECT click_date, account_id, metric_basis, conversion_action_resource_name, least(window_days, 90) AS window_days, CASE WHEN window_days >= 90 THEN 'capped by reporting window' ELSE window_provenance END AS window_provenance FROM windows"
put("obs_windows", "SELECT * FROM obs_cut", ["obs_cut"])
_W = ["click_date", "account_id", "metric_basis", "conversion_action_resource_name"]
SQL["obs_met"] = f"SELECT k.*, w.window_days, w.window_provenance, b.latest_observed_date FROM obs_keyed k JOIN obs_cut w ON {on('k', 'w', _W)} JOIN obs_bounds b ON b.account_id = k.account_id"
SQL["obs_steps"] = """SELECT *, cohort_day = window_days AS is_window_rung, CAST(click_date + CAST(cohort_day + 1 AS INTEGER) AS DATE) AS target_date FROM (
  SELECT m.*, CAST(d AS BIGINT) AS cohort_day FROM obs_met m, (VALUES (0), (1), (3), (5), (7), (14), (30)) v(d) WHERE d <= window_days UNION SELECT m.*, window_days FROM obs_met m) t
WHERE click_date + CAST(least(cohort_day + 1, 90) AS INTEGER) <= latest_observed_date"""
put("obs_ladder", tally("obs_steps", "grain, click_date, account_id, metric_basis, cohort_day, is_window_rung, target_date, latest_observed_date"), ["obs_steps"])
SQL["obs_first"] = f"SELECT DISTINCT c_custkey % 5 AS account_id, CAST({AS_OF} - CASE WHEN c_custkey % 5 < 2 THEN 30 ELSE 60 END AS DATE) AS first_snapshot_date FROM customer WHERE c_custkey % 5 < 3"
put("obs_first_snapshot", "SELECT * FROM obs_first", ["obs_first"])
_OWN = [c for c in _ROW if c != "conversion_action"]
SQL["obs_read"] = f"""SELECT l.*, f.first_snapshot_date, o.observed_date, o.conversions, o.conversions_value, o.run_id AS source_run_id FROM obs_steps l LEFT JOIN obs_first f ON f.account_id = l.account_id
LEFT JOIN selected o ON {on('o', 'l', _OWN)} AND o.conversion_action IS NOT DISTINCT FROM l.conversion_action_resource_name AND o.observed_date <= l.target_date
QUALIFY row_number() OVER (PARTITION BY {', '.join('l.' + c for c in [*_OWN, 'conversion_action_resource_name', 'conversion_action_name', 'time_zone', 'cohort_day'])} ORDER BY o.observed_date DESC NULLS LAST, o.run_id DESC) = 1"""
put("obs_asof_reading", tally("obs_read", "grain, click_date, account_id, cohort_day, observed_date, source_run_id, first_snapshot_date", "conversions", "conversions_value"), ["obs_read"])
_CASES = [("target_date > click_date + 90", "unavailable", "capped by reporting window"), ("grain = 'asset' AND cohort_day = 0 AND first_snapshot_date IS NULL", "unavailable", "first snapshot unknown"), ("target_date < first_snapshot_date", "unavailable", "before first snapshot"),
          ("observed_date = target_date", "measured", None), ("observed_date = first_snapshot_date", "unavailable", "seed only"), ("target_date - observed_date BETWEEN 1 AND 5", "carried", None)]
SQL["obs_resolved"] = "SELECT *, CASE " + " ".join(f"WHEN {c} THEN '{p}'" for c, p, _ in _CASES) + " ELSE 'unavailable' END AS provenance, CASE " + " ".join(f"WHEN {c} THEN " + (f"'{r}'" if r else "NULL") for c, _, r in _CASES) + " ELSE 'gap exceeded' END AS reason FROM obs_read"
put("obs_resolve", "SELECT grain, cohort_day, provenance, reason, count(*) AS n FROM obs_resolved GROUP BY ALL", ["obs_resolved"])
# Midnight of late May and June in UTC
_MIDNIGHT = "CAST(observed_date AS TIMESTAMP) + CASE time_zone WHEN 'Europe/Paris' THEN INTERVAL (-2) HOUR WHEN 'America/New_York' THEN INTERVAL 4 HOUR WHEN 'Asia/Tokyo' THEN INTERVAL (-9) HOUR ELSE INTERVAL 0 HOUR END"
SQL["obs_cells"] = f"""SELECT click_date, account_id, grain, campaign_id, asset_group_id, asset_id, field_type, ad_network_type, metric_basis, conversion_action_id, conversion_action_resource_name, conversion_action_name, cohort_day, is_window_rung, {_LABEL}, window_days, window_provenance,
  CASE WHEN provenance <> 'unavailable' THEN conversions END AS cohorted_conversions, CASE WHEN provenance <> 'unavailable' THEN conversions_value END AS cohorted_value, NULL::DOUBLE AS unknown_lag_conversions, NULL::DOUBLE AS unknown_lag_value,
  provenance, reason AS unavailable_reason, CASE WHEN provenance <> 'unavailable' THEN CASE WHEN latest_observed_date >= target_date THEN 'complete' ELSE 'immature' END END AS maturity, {_MIDNIGHT} AS observed_through, observed_date AS source_refresh_date, source_run_id,
  {RUN} AS built_by_run_id, 'arp_calendar' AS cohort_counting FROM obs_resolved WHERE cohort_day <> 0 OR grain = 'asset_group' OR first_snapshot_date IS NULL OR target_date >= first_snapshot_date"""
put("int_observation_cells", f"SELECT * {_THROUGH} FROM obs_cells", ["obs_cells"])
for _g, _keys in COHORT_KEYS.items():
    _src = "obs_cells" if _g == "asset" else "cells"
    _by = ["click_date", *_keys, "ad_network_type"]
    SQL[f"cohort_{_g}"] = f"""SELECT c.click_date, {', '.join('c.' + x for x in [*_keys, *_CELL])}, k.click_day_cost, c.cohorted_conversions, c.cohorted_value, c.unknown_lag_conversions, c.unknown_lag_value, c.source_refresh_date,
  CASE WHEN k.click_day_cost IS NULL THEN 1 ELSE 0 END AS missing_cost_cell_count, CASE WHEN c.provenance IN ('measured', 'carried') AND c.maturity = 'immature' THEN 1 ELSE 0 END AS stale_cell_count, c.source_run_id, {RUN} AS run_id, c.cohort_counting
FROM {_src} c LEFT JOIN (SELECT date AS click_date, {', '.join(_keys)}, ad_network_type, sum(network_cost) AS click_day_cost FROM perf_{_g} WHERE metric_basis = 'NETWORK' GROUP BY ALL) k ON {on('k', 'c', _by)} WHERE c.grain = '{_g}'"""
    put(f"mart_cohort_{_g}", f"SELECT * {_THROUGH} FROM cohort_{_g}", [f"cohort_{_g}"])
    _sum = ", ".join(f"sum({m})" + ("::BIGINT" if m.endswith("_count") else "") + f" AS {m}" for m in _SUMS)
    _zero = "" if _g == "asset" else " AND cohort_day > 0"
    SQL[f"pub_cohort_{_g}"] = f"""SELECT click_date, {', '.join([*_keys, *_CELL])}, cohort_counting, {_sum}, {AS_OF} AS as_of, {RUN} AS run_id FROM cohort_{_g} WHERE click_date BETWEEN {AS_OF} - 90 AND {AS_OF} - 1 AND click_day_cost IS NOT NULL
  AND cohort_day <= least(window_days, 90) AND (cohort_day IN (0, 1, 3, 5, 7, 14, 30) OR (is_window_rung AND cohort_day = least(window_days, 90))){_zero} GROUP BY ALL"""
    put(f"pub_cohort_{_g}", f"SELECT * {_THROUGH} FROM pub_cohort_{_g}", [f"pub_cohort_{_g}"])
put("ratio_cohort", "SELECT account_id, metric_basis, cohort_day, sum(click_day_cost)::DOUBLE / NULLIF(sum(cohorted_conversions), 0) AS cpa, sum(cohorted_value) / NULLIF(sum(click_day_cost)::DOUBLE, 0) AS roas FROM pub_cohort_campaign GROUP BY ALL", ["pub_cohort_campaign"])

# Scores
put("bps_asset_group_count", f"""SELECT g.account_id, g.campaign_id, count(DISTINCT g.asset_group_id) AS asset_groups FROM hist_asset_group g JOIN hist_asset a USING (account_id, campaign_id, asset_group_id)
WHERE g.snapshot_date = {AS_OF} AND a.snapshot_date = {AS_OF} AND g.status = 'ENABLED' AND a.status = 'ENABLED' AND a.source = 'ADVERTISER' GROUP BY ALL""", ["hist_asset_group", "hist_asset"])
put("bps_audience_count", f"SELECT account_id, campaign_id, count(DISTINCT audience) AS audiences FROM hist_asset_group_signal WHERE snapshot_date = {AS_OF} AND audience <> '' GROUP BY ALL", ["hist_asset_group_signal"])
_LIVE = f"snapshot_date = {AS_OF} AND field_type = 'SITELINK' AND status = 'ENABLED'"
put("bps_sitelinks", f"""SELECT c.account_id, c.campaign_id, coalesce(a, 0) AS campaign_sitelinks, coalesce(b, 0) AS account_sitelinks, greatest(4 - coalesce(a, 0) - coalesce(b, 0), 0) AS missing_sitelinks FROM hist_campaign c
LEFT JOIN (SELECT account_id, campaign_id, count(*) AS a FROM hist_campaign_asset WHERE {_LIVE} GROUP BY ALL) x USING (account_id, campaign_id)
LEFT JOIN (SELECT account_id, count(*) AS b FROM stg_entities_customer_asset JOIN days USING (account_id, snapshot_date) WHERE {_LIVE} GROUP BY ALL) y USING (account_id) WHERE c.snapshot_date = {AS_OF}""", ["hist_campaign", "hist_campaign_asset", "stg_entities_customer_asset", "days"])

_MART = {e: f"view_{e}" for e in KEYS}
for _e in KEYS:
    SQL[f"ent_mart_{_e}"] = f"SELECT * FROM view_{_e} WHERE snapshot_date = {AS_OF}"
SQL["live_links"] = f"SELECT * FROM stg_entities_customer_asset JOIN days USING (account_id, snapshot_date) WHERE snapshot_date = {AS_OF} AND status = 'ENABLED'"
SQL["bp_a"] = """SELECT g.account_id, g.campaign_id, count(DISTINCT g.asset_group_id) AS n FROM ent_mart_asset_group g JOIN ent_mart_asset a USING (account_id, campaign_id, asset_group_id) WHERE g.status = 'ENABLED' AND a.status = 'ENABLED' AND a.source = 'ADVERTISER' GROUP BY ALL"""
SQL["bp_campaign"] = f"""SELECT *, CASE WHEN url_expansion_known THEN round((url_expansion_score + audience_signals_score + sitelink_score + geo_target_score) / 4, 2) ELSE round((audience_signals_score + sitelink_score + geo_target_score) / 3, 2) END AS campaign_bp_score,
  CASE WHEN url_expansion_known THEN 'KNOWN' ELSE 'PARITY_NEUTRAL_UNKNOWN' END AS url_expansion_parity_mode, {RUN} AS run_id FROM (
SELECT *, CASE WHEN missing_sitelinks = 0 THEN 1.0::DOUBLE ELSE missing_sitelinks / 4.0::DOUBLE END AS sitelink_score, (CASE WHEN positive_geo_target_type_configured_good = 'Yes' THEN 0.5::DOUBLE ELSE 0 END) + (CASE WHEN negative_geo_target_type_configured_good = 'Yes' THEN 0.5::DOUBLE ELSE 0 END) AS geo_target_score FROM (
SELECT c.snapshot_date, c.account_id, c.campaign_id, c.campaign_name, c.status AS campaign_status, c.url_expansion_opt_out, c.url_expansion_opt_out IS NOT NULL AS url_expansion_known, CAST(c.url_expansion_opt_out AS DOUBLE) AS url_expansion_score,
  coalesce(h.n, 0) AS audience_signals_count, coalesce(a.n, 0) AS asset_group_count, CASE WHEN h.n IS NULL THEN 0.0::DOUBLE ELSE h.n::DOUBLE / a.n END AS audience_signals_score, coalesce(x.n, 0) + coalesce(y.n, 0) AS sitelink_count,
  greatest(4 - coalesce(x.n, 0) - coalesce(y.n, 0), 0) AS missing_sitelinks, positive_geo_target_type, negative_geo_target_type,
  CASE WHEN positive_geo_target_type <> 'PRESENCE_OR_INTEREST' THEN 'X' ELSE 'Yes' END AS positive_geo_target_type_configured_good, CASE WHEN negative_geo_target_type <> 'PRESENCE_OR_INTEREST' THEN 'X' ELSE 'Yes' END AS negative_geo_target_type_configured_good
FROM ent_mart_campaign c LEFT JOIN bp_a a USING (account_id, campaign_id)
LEFT JOIN (SELECT account_id, campaign_id, count(DISTINCT audience) AS n FROM ent_mart_asset_group_signal WHERE audience <> '' GROUP BY ALL) h USING (account_id, campaign_id)
LEFT JOIN (SELECT account_id, campaign_id, count(*) AS n FROM ent_mart_campaign_asset WHERE field_type = 'SITELINK' AND status = 'ENABLED' GROUP BY ALL) x USING (account_id, campaign_id)
LEFT JOIN (SELECT account_id, count(*) AS n FROM live_links WHERE field_type = 'SITELINK' GROUP BY ALL) y USING (account_id) WHERE c.advertising_channel_type = 'PERFORMANCE_MAX' AND NOT c.inferred_removed) q) r"""
put("mart_bp_campaign", "SELECT * FROM bp_campaign", ["bp_campaign", "days"])
_KINDS = {
    "count_images": "asset_type = 'IMAGE'", "count_logos": "field_type = 'LOGO'", "count_landscape": "field_type = 'MARKETING_IMAGE'", "count_square": "field_type = 'SQUARE_MARKETING_IMAGE'", "count_portrait": "field_type = 'PORTRAIT_MARKETING_IMAGE'",
    "count_square_logos": "field_type = 'LOGO' AND image_width_pixels = image_height_pixels", "count_landscape_logos": "field_type = 'LOGO' AND round(image_width_pixels::DOUBLE / image_height_pixels, 2) = 4", "count_headlines": "field_type IN ('HEADLINE', 'LONG_HEADLINE')",
    "count_short_headlines": "field_type = 'HEADLINE'", "count_long_headlines": "field_type = 'LONG_HEADLINE'", "count_descriptions": "field_type = 'DESCRIPTION'", "count_short_descriptions": "field_type = 'DESCRIPTION' AND length(text) <= 60", "count_videos": "asset_type = 'YOUTUBE_VIDEO'",
}
_LIVE_ASSET = "FROM ent_mart_asset WHERE status = 'ENABLED' AND source = 'ADVERTISER' AND NOT inferred_removed"
_ag = "account_id, campaign_id, asset_group_id"
SQL["bp_counts"] = f"SELECT {_ag}, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in _KINDS.items()) + f", count(*) FILTER (WHERE asset_type = 'YOUTUBE_VIDEO' AND video_id <> '') > 0 AS has_uploaded_video {_LIVE_ASSET} GROUP BY ALL"
put("bps_asset_counts", "SELECT * FROM bp_counts", ["bp_counts", "days"])
_ok = lambda c, n: f"(CASE WHEN {c} >= {n} THEN 1.0::DOUBLE ELSE 0 END)"
_TEXT = f"({_ok('count_descriptions', 4)} + {_ok('count_headlines', 11)} + {_ok('count_long_headlines', 2)}) / 3"
_IMAGE = f"({_ok('count_landscape', 4)} + {_ok('count_square', 4)} + {_ok('count_portrait', 4)} + {_ok('count_landscape_logos', 1)} + {_ok('count_square_logos', 1)}) / 5"
SQL["bp_group"] = f"""SELECT *, round((video_score + text_score + image_score) / 3, 2) AS asset_group_bp_score, {RUN} AS run_id FROM (SELECT *, {_ok('count_videos', 3)} AS video_score, {_TEXT} AS text_score, {_IMAGE} AS image_score FROM (
SELECT g.snapshot_date, g.account_id, g.campaign_id, c.campaign_name, c.status AS campaign_status, g.asset_group_id, g.asset_group_name, g.status AS asset_group_status, g.ad_strength, {', '.join(f'coalesce({n}, 0) AS {n}' for n in _KINDS)},
  CASE WHEN has_uploaded_video THEN 'Yes' ELSE 'X' END AS is_video_uploaded, CASE WHEN s.n IS NOT NULL THEN 'Yes' ELSE 'X' END AS audience_signals
FROM ent_mart_asset_group g JOIN ent_mart_campaign c USING (account_id, campaign_id) LEFT JOIN bp_counts a USING (account_id, campaign_id, asset_group_id)
LEFT JOIN (SELECT {_ag}, count(*) AS n FROM ent_mart_asset_group_signal WHERE audience IS NOT NULL AND NOT inferred_removed GROUP BY ALL) s USING (account_id, campaign_id, asset_group_id) WHERE NOT g.inferred_removed AND NOT c.inferred_removed) q) r"""
put("mart_bp_asset_group", "SELECT * FROM bp_group", ["bp_group", "days"])
_FEED = "('HEADLINE', 'LONG_HEADLINE', 'DESCRIPTION', 'MARKETING_IMAGE', 'SQUARE_MARKETING_IMAGE', 'PORTRAIT_MARKETING_IMAGE', 'LOGO', 'YOUTUBE_VIDEO')"
SQL["bp_ext"] = f"""SELECT *, round((action_item_clear_score + primary_status_clear_score + feed_type_coverage_score + text_guidelines_present_score) / 4, 2) AS extended_score, {RUN} AS run_id FROM (
SELECT b.snapshot_date, b.account_id, b.campaign_id, b.asset_group_id, asset_group_bp_score AS google_parity_score, todo AS ad_strength_action_item_count, CASE WHEN todo = 0 THEN 1.0::DOUBLE ELSE 0 END AS action_item_clear_score, coalesce(r, 0)::BIGINT AS asset_primary_status_reason_count,
  CASE WHEN coalesce(r, 0) = 0 THEN 1.0::DOUBLE ELSE 0 END AS primary_status_clear_score, coalesce(f, 0) AS covered_feed_type_count, coalesce(f, 0) / 8.0::DOUBLE AS feed_type_coverage_score,
  count_short_headlines > 0 AND count_long_headlines > 0 AND count_descriptions > 0 AS text_guidelines_present, CASE WHEN count_short_headlines > 0 AND count_long_headlines > 0 AND count_descriptions > 0 THEN 1.0::DOUBLE ELSE 0 END AS text_guidelines_present_score
FROM bp_group b JOIN (SELECT {_ag}, CAST(coalesce(len(ad_strength_action_items), 0) AS BIGINT) AS todo FROM ent_mart_asset_group) w USING (account_id, campaign_id, asset_group_id)
LEFT JOIN (SELECT {_ag}, sum(len(coalesce(primary_status_reasons, []))) AS r, count(DISTINCT field_type) FILTER (WHERE field_type IN {_FEED}) AS f {_LIVE_ASSET} GROUP BY ALL) d USING (account_id, campaign_id, asset_group_id)) q"""
_ADDING = "list_filter(ad_strength_action_items, lambda i: i.action_item_type = 'ADD_ASSET')"
put("bps_action_items", f"""SELECT {_ag}, CAST(coalesce(len(ad_strength_action_items), 0) AS BIGINT) AS items, CAST(coalesce(len({_ADDING}), 0) AS BIGINT) AS adding,
  CAST(coalesce(list_sum(list_transform({_ADDING}, lambda i: i.add_asset_details.asset_count)), 0) AS BIGINT) AS assets_wanted,
  coalesce(array_to_string(list_sort(list_distinct(list_transform({_ADDING}, lambda i: i.add_asset_details.asset_field_type))), ','), '') AS fields FROM ent_mart_asset_group""", ["ent_mart_asset_group", "days"])
put("mart_bp_extended", "SELECT * FROM bp_ext", ["bp_ext", "days"])

# Parity
_ON = "status = 'ENABLED' AND NOT inferred_removed"
SQL["up_assets"] = f"SELECT * {_LIVE_ASSET}"
SQL["up_settings"] = f"""SELECT snapshot_date AS date, account_id, 'Account ' || account_id AS account_name, campaign_id, campaign_name, status AS campaign_status, url_expansion_opt_out, negative_geo_target_type, positive_geo_target_type,
  CASE campaign_id % 4 WHEN 0 THEN 2.5::DOUBLE WHEN 1 THEN 3.5 ELSE 4.5 END AS troas, CASE campaign_id % 4 WHEN 2 THEN 5.0::DOUBLE WHEN 3 THEN 0.0 END AS tcpa FROM ent_mart_campaign WHERE {_ON}"""
SQL["up_summary"] = f"SELECT g.snapshot_date AS date, g.account_id, 'Account ' || g.account_id AS account_name, g.campaign_id, c.campaign_name, g.asset_group_id, g.asset_group_name, g.ad_strength FROM ent_mart_asset_group g JOIN (SELECT * FROM ent_mart_campaign WHERE {_ON}) c USING (account_id, campaign_id) WHERE g.status = 'ENABLED' AND NOT g.inferred_removed"
SQL["up_signals"] = "SELECT account_id, campaign_id, asset_group_id, audience FROM ent_mart_asset_group_signal WHERE audience IS NOT NULL AND NOT inferred_removed"
_TYPE = "CASE WHEN campaign_id % 3 < 2 THEN 'PERFORMANCE_MAX' ELSE 'SEARCH' END AS campaign_type"
SQL["up_goals"] = f"""SELECT account_id, campaign_id, campaign_type, string_agg(n, ',' ORDER BY n) AS conversion_name FROM (
  SELECT account_id, campaign_id, campaign_type, string_agg(n, ',' ORDER BY n) AS n FROM (SELECT DISTINCT account_id, campaign_id, {_TYPE}, conversion_action_name AS n FROM stg_conv_campaign WHERE conversions >= 1) a GROUP BY ALL
  UNION ALL SELECT account_id, campaign_id, {_TYPE}, 'Custom ' || campaign_id % 2 FROM ent_mart_campaign WHERE campaign_id % 7 = 0 AND account_id IN (SELECT account_id FROM ent_mart_customer)) b GROUP BY ALL"""
SQL["up_pmax"] = "SELECT account_id, campaign_id, conversion_name FROM up_goals WHERE campaign_type = 'PERFORMANCE_MAX'"
SQL["up_search"] = "SELECT account_id, conversion_name FROM (SELECT account_id, conversion_name, rank() OVER (PARTITION BY account_id ORDER BY count(DISTINCT campaign_id) DESC) AS r FROM up_goals WHERE campaign_type = 'SEARCH' GROUP BY account_id, conversion_name) t WHERE r = 1"
put("par_primary_action_pmax", "SELECT * FROM up_pmax", ["up_pmax", "days"])
put("par_primary_action_search", "SELECT * FROM up_search", ["up_search", "days"])
put("par_url_opt_out", "SELECT account_id, campaign_id, url_expansion_opt_out FROM up_settings", ["up_settings", "days"])
_NAMES = "account_id, account_name, campaign_id, campaign_name, asset_group_id, asset_group_name"
_BY_GROUP = "FROM up_summary LEFT JOIN bp_counts USING (account_id, campaign_id, asset_group_id)"
_c = lambda names: ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)
put("par_image_assets", f"SELECT {_NAMES}, {_c(list(_KINDS)[:7])} {_BY_GROUP}", ["up_summary", "bp_counts", "days"])
put("par_text_assets", f"SELECT {_NAMES}, {_c(list(_KINDS)[7:12])} {_BY_GROUP}", ["up_summary", "bp_counts", "days"])
put("par_video_assets", f"SELECT {_NAMES}, ad_strength, coalesce(count_videos, 0) AS count_videos, CASE WHEN has_uploaded_video THEN 'Yes' ELSE 'X' END AS is_video_uploaded {_BY_GROUP}", ["up_summary", "bp_counts", "days"])
_ext = lambda kind, want: f"greatest({want} - coalesce((SELECT count(*) FROM ent_mart_campaign_asset a WHERE a.campaign_id = c.campaign_id AND a.field_type = '{kind}' AND a.status = 'ENABLED' AND NOT a.inferred_removed), 0) - coalesce((SELECT count(*) FROM live_links l WHERE l.account_id = c.account_id AND l.field_type = '{kind}'), 0), 0)"
SQL["up_data"] = f"""SELECT date, c.account_id, account_name, c.campaign_id, campaign_name, campaign_status, url_expansion_opt_out, troas, tcpa, p.conversion_name AS pmax_conversion, s.conversion_name AS primary_conversion_search, negative_geo_target_type, positive_geo_target_type,
  coalesce(h.n, 0) AS number_of_audience_signals, a.n AS number_of_asset_groups, CASE WHEN negative_geo_target_type <> 'PRESENCE_OR_INTEREST' THEN 'X' ELSE 'Yes' END AS negative_geo_target_type_configured_good, CASE WHEN positive_geo_target_type <> 'PRESENCE_OR_INTEREST' THEN 'X' ELSE 'Yes' END AS positive_geo_target_type_configured_good,
  {_ext('SITELINK', 4)} AS missing_sitelinks, {_ext('CALLOUT', 1)} AS missing_callouts, {_ext('STRUCTURED_SNIPPET', 1)} AS missing_structured_snippets, CASE WHEN tcpa > 0 THEN 'tCPA' WHEN troas > 0 THEN 'tROAS' ELSE 'null' END AS target_type, CASE WHEN tcpa > 0 THEN tcpa WHEN troas > 0 THEN troas END AS target_value,
  CASE WHEN h.n IS NULL THEN 0.0::DOUBLE ELSE h.n::DOUBLE / a.n END AS audience_signals_score, CASE WHEN c.account_id <> 4 AND o.account_id IS NOT NULL THEN c.account_id + 9000 END AS ocid
FROM up_settings c LEFT JOIN up_search s ON s.account_id = c.account_id LEFT JOIN up_pmax p ON p.campaign_id = c.campaign_id LEFT JOIN (SELECT campaign_id, count(DISTINCT asset_group_id) AS n FROM up_assets GROUP BY ALL) a ON a.campaign_id = c.campaign_id
LEFT JOIN (SELECT campaign_id, count(DISTINCT audience) AS n FROM up_signals GROUP BY ALL) h ON h.campaign_id = c.campaign_id LEFT JOIN ent_mart_customer o ON o.account_id = c.account_id"""
put("par_campaign_data", "SELECT * FROM up_data", ["up_data", "days"])
_LINK = "CASE WHEN missing_sitelinks = 0 THEN 1.0::DOUBLE ELSE missing_sitelinks / 4.0::DOUBLE END"
_GEO = "(CASE WHEN positive_geo_target_type_configured_good = 'Yes' THEN 0.5::DOUBLE ELSE 0 END) + (CASE WHEN negative_geo_target_type_configured_good = 'Yes' THEN 0.5::DOUBLE ELSE 0 END)"
SQL["up_score"] = f"SELECT DISTINCT date, account_id, account_name, campaign_id, campaign_name, round((CASE WHEN url_expansion_opt_out THEN 1.0::DOUBLE ELSE 0 END + audience_signals_score + {_LINK} + {_GEO}) / 4, 2) AS campaign_bp_score, round((audience_signals_score + {_LINK} + {_GEO}) / 3, 2) AS score_without_url FROM up_data"
put("par_campaign_score", "SELECT * FROM up_score", ["up_score", "days"])
_GAPS = {"Recommended": dict(descriptions=4, headlines=11, long_headlines=2, images=12, landscape=4, square=4, portrait=2, logos=2, square_logos=1, landscape_logos=1, videos=3), "Maximum": dict(descriptions=5, headlines=15, long_headlines=5, images=20, landscape=4, square=4, portrait=2, logos=2, square_logos=1, landscape_logos=1, videos=5)}
_have = lambda n: "(coalesce(count_landscape, 0) + coalesce(count_square, 0) + coalesce(count_portrait, 0) + coalesce(count_logos, 0))" if n == "images" else f"coalesce(count_{n}, 0)"
SQL["up_practices"] = " UNION ALL ".join(f"""SELECT date, {', '.join('g.' + c for c in _NAMES.split(', '))}, ad_strength, CASE WHEN has_uploaded_video THEN 'Yes' ELSE 'X' END AS is_video_uploaded, {_ok('coalesce(count_videos, 0)', 3)} AS video_score, {_TEXT} AS text_score, {_IMAGE} AS image_score,
  CASE WHEN EXISTS (SELECT 1 FROM up_signals s WHERE s.campaign_id = g.campaign_id AND s.asset_group_id = g.asset_group_id) THEN 'Yes' ELSE 'X' END AS audience_signals, CASE WHEN g.account_id <> 4 AND g.account_id IN (SELECT account_id FROM ent_mart_customer) THEN g.account_id + 9000 END AS ocid,
  '{kind}' AS recommendation_type, {', '.join(f'greatest({n} - {_have(c)}, 0)::BIGINT AS missing_{c}' for c, n in want.items())} FROM up_summary g LEFT JOIN bp_counts b ON b.account_id = g.account_id AND b.campaign_id = g.campaign_id AND b.asset_group_id = g.asset_group_id WHERE g.campaign_id IN (SELECT campaign_id FROM up_settings)""" for kind, want in _GAPS.items())
put("par_asset_group_practices", "SELECT * FROM up_practices", ["up_practices", "days"])
_FOUR = ("video_score", "text_score", "image_score", "asset_group_bp_score")
_long = lambda src: " UNION ALL ".join(f"SELECT 'asset_group' AS entity_type, account_id, campaign_id, asset_group_id, '{m}' AS metric, {m} AS score, NULL::DOUBLE AS score_without_url, NULL::BOOLEAN AS url_expansion_known FROM {src}" for m in _FOUR)
SQL["up_rec"] = "SELECT *, round((video_score + text_score + image_score) / 3, 2) AS asset_group_bp_score FROM up_practices WHERE recommendation_type = 'Recommended'"
SQL["their_rows"] = f"SELECT 'campaign' AS entity_type, account_id, campaign_id, NULL::BIGINT AS asset_group_id, 'campaign_bp_score' AS metric, campaign_bp_score AS score, score_without_url, NULL::BOOLEAN AS url_expansion_known FROM up_score UNION ALL {_long('up_rec')}"
SQL["our_groups"] = "SELECT * FROM bp_group WHERE campaign_status = 'ENABLED' AND asset_group_status = 'ENABLED'"
SQL["our_rows"] = f"SELECT 'campaign' AS entity_type, account_id, campaign_id, NULL::BIGINT AS asset_group_id, 'campaign_bp_score' AS metric, campaign_bp_score AS score, NULL::DOUBLE AS score_without_url, url_expansion_known FROM bp_campaign WHERE campaign_status = 'ENABLED' UNION ALL {_long('our_groups')}"
put("par_score_rows", "SELECT * FROM their_rows UNION ALL SELECT * FROM our_rows", ["their_rows", "our_rows", "days"])
_PK = ["entity_type", "account_id", "campaign_id", "asset_group_id", "metric"]
_pack = lambda t: f"(SELECT {', '.join(_PK)}, count(*) AS n, max(score) AS score, max(score_without_url) AS bare, bool_and(url_expansion_known) AS known FROM {t} GROUP BY ALL)"
put("par_compare", f"""SELECT {', '.join(_PK)}, s AS their_score, o AS our_score, blind AS without_url_rule, CASE WHEN n1 > 1 OR n2 > 1 THEN 'duplicate key' WHEN n2 IS NULL THEN 'missing in ours' WHEN n1 IS NULL THEN 'ours only' WHEN s IS NULL THEN 'no comparable score'
  WHEN abs(CAST(s AS DECIMAL(20, 6)) - CAST(o AS DECIMAL(20, 6))) <= 0.01 THEN 'matched' ELSE 'mismatch' END AS status FROM (
SELECT {', '.join(f'coalesce(t.{c}, u.{c}) AS {c}' for c in _PK)}, t.n AS n1, u.n AS n2, u.score AS o, coalesce(t.entity_type, u.entity_type) = 'campaign' AND u.known IS NOT DISTINCT FROM FALSE AS blind,
  CASE WHEN coalesce(t.entity_type, u.entity_type) = 'campaign' AND u.known IS NOT DISTINCT FROM FALSE THEN t.bare ELSE t.score END AS s FROM {_pack('their_rows')} t FULL JOIN {_pack('our_rows')} u ON t.entity_type = u.entity_type AND t.account_id = u.account_id AND t.campaign_id = u.campaign_id AND t.metric = u.metric AND coalesce(t.asset_group_id, -1) = coalesce(u.asset_group_id, -1)) q""", ["their_rows", "our_rows", "days"])
put("par_paused_excluded", "SELECT (SELECT count(*) FROM bp_campaign WHERE campaign_status <> 'ENABLED') + (SELECT count(*) FROM bp_group WHERE campaign_status <> 'ENABLED' OR asset_group_status <> 'ENABLED') AS paused_excluded", ["bp_campaign", "bp_group", "days"])

# Assertions
_SAYS = "SELECT n = 0 AS passed, CAST(n AS VARCHAR) AS observed, '0' AS expected, '{d}' AS detail FROM ({q}) t"
_BASIS = ["metric_basis", "ad_network_type", "conversion_action_id", "conversion_action_resource_name"]
MARTS = {
    "perf_campaign": ["date", "account_id", "campaign_id", *_BASIS], "perf_asset_group": ["date", *_G, *_BASIS], "perf_asset": ["date", *_A, *_BASIS], "truth": ["date", "account_id", "campaign_id", "ad_network_type"],
    **{f"ent_mart_{e}": ["snapshot_date", *k] for e, k in KEYS.items()}, "bp_campaign": ["snapshot_date", "account_id", "campaign_id"], "bp_group": ["snapshot_date", *_G], "bp_ext": ["snapshot_date", *_G],
}
_LOOSE = ("ad_network_type", "conversion_action_id", "conversion_action_resource_name")
# The detail mart of assets is the asset mart again, so it counts twice.
_twice = lambda parts: [*parts.values(), parts["perf_asset"]]
CHECK_SQL = {
    "unique_keys": ("duplicate keys", "SELECT " + " + ".join(_twice({t: f"(SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {', '.join(k)} HAVING count(*) > 1) a)" for t, k in MARTS.items()})) + " AS n", list(MARTS)),
    "not_null": ("null keys", "SELECT " + " + ".join(_twice({t: f"(SELECT count(*) FROM {t} WHERE {' OR '.join(f'{c} IS NULL' for c in k if c not in _LOOSE)})" for t, k in MARTS.items()})) + " AS n", list(MARTS)),
    "cohort_integrity": ("cohort cells twice or without a key", "SELECT " + " + ".join(
        f"(SELECT count(*) FROM (SELECT 1 FROM cohort_{g} GROUP BY click_date, {', '.join(k)}, ad_network_type, metric_basis, conversion_action_resource_name, cohort_day HAVING count(*) > 1) a) + (SELECT CAST(count(*) > 0 AS INT) FROM cohort_{g} WHERE {' OR '.join(f'{c} IS NULL' for c in [*k, 'metric_basis', 'cohort_day', 'provenance', 'cohort_counting'])} OR (maturity IS NULL AND provenance <> 'unavailable'))"
        for g, k in COHORT_KEYS.items()) + " AS n", [f"cohort_{g}" for g in COHORT_KEYS]),
    "row_count_floor": ("days whose rows differ", "SELECT count(*) AS n FROM (SELECT date, count(*) AS a FROM truth GROUP BY ALL) x FULL JOIN (SELECT date, count(*) AS b FROM stg_volume_campaign GROUP BY ALL) y USING (date) WHERE coalesce(a, 0) <> coalesce(b, 0)", ["truth", "stg_volume_campaign"]),
    "family_coherence": ("campaign days whose families differ", "SELECT (SELECT count(*) FROM (SELECT 1 FROM perf_campaign GROUP BY date, account_id, campaign_id HAVING " + " OR ".join(f"abs(coalesce(sum(network_{c}), 0) - coalesce(sum(action_{c}), 0)) > 1e-9" for c in COUNTS) + ") s) + " + " + ".join(
        f"(SELECT count(*) FROM (SELECT 1 FROM hist_{e} GROUP BY {', '.join(k)}, snapshot_date HAVING bool_or(inferred_removed) AND NOT bool_and(inferred_removed)) s)" for e, k in KEYS.items() if e != "customer") + " AS n", ["perf_campaign", *(f"hist_{e}" for e in KEYS if e != "customer"), "days"]),
    "serving_budget_has_cost": ("serving campaigns without cost", "SELECT count(*) AS n FROM idle", ["idle"]),
}
SQL["idle"] = f"""SELECT c.account_id, c.campaign_id, max(CAST(budget_amount_micros / 1000000.0 AS DECIMAL(38, 9))) AS budget_amount FROM ent_mart_campaign c LEFT JOIN (SELECT account_id, campaign_id, sum(network_cost) AS cost FROM truth WHERE date = {AS_OF} GROUP BY ALL) t USING (account_id, campaign_id)
WHERE NOT inferred_removed AND status = 'ENABLED' AND budget_amount_micros > 0 AND coalesce(cost, 0) = 0 GROUP BY ALL"""
_NET = ["date", "account_id", "campaign_id", "ad_network_type"]


def facing(a: str, b: str, keys: list[str], sums: list[str], fa: str = "sum", wa: str = "TRUE", wb: str = "TRUE") -> str:
    """Both sides' sums by key, a full join; coalesced."""
    s = lambda t, f, w: f"(SELECT {', '.join(keys)}, {', '.join(f'{f}({m}) AS {m}' for m in sums)} FROM {t} WHERE {w} GROUP BY {', '.join(keys)})"
    texts = {"ad_network_type": "'~'", "conversion_action_resource_name": "'~'"}
    match = " AND ".join(f"coalesce(x.{c}, {texts[c]}) = coalesce(y.{c}, {texts[c]})" if c in texts else f"x.{c} = y.{c}" for c in keys)
    return f"SELECT {', '.join(f'coalesce(x.{c}, y.{c}) AS {c}' for c in keys)}, {', '.join(f'coalesce(x.{m}, 0) AS a_{m}, coalesce(y.{m}, 0) AS b_{m}' for m in sums)} FROM {s(a, fa, wa)} x FULL JOIN {s(b, 'sum', wb)} y ON {match}"


_NC = [f"network_{c}" for c in COUNTS]
_DAY = f"date = {AS_OF}"
_near = lambda m, rel: f"abs(a_{m} - b_{m}) > greatest(abs(b_{m}) * {rel}, 1e-9)"
CHECK_SQL["asset_not_over_campaign"] = ("assets credited above their campaign", f"SELECT count(*) AS n FROM ({facing('perf_asset', 'truth', _NET, _NC, 'max', _DAY + ' AND metric_basis = ' + chr(39) + 'NETWORK' + chr(39), _DAY)}) z WHERE " + " OR ".join(f"a_{m} > b_{m} + greatest(abs(b_{m}) * 0.01, 1e-9)" for m in _NC), ["perf_asset", "truth"])
CHECK_SQL["campaign_reconciliation"] = ("campaign networks that differ", f"SELECT count(*) AS n FROM ({facing('perf_campaign', 'truth', _NET, NETWORK, 'sum', _DAY + ' AND metric_basis = ' + chr(39) + 'NETWORK' + chr(39), _DAY)}) z WHERE a_network_impressions <> b_network_impressions OR a_network_clicks <> b_network_clicks OR abs(a_network_cost - b_network_cost) > 0.000001 OR " + " OR ".join(_near(m, 0.01) for m in _NC), ["perf_campaign", "truth"])
_CK = ["click_date", "account_id", "campaign_id", "ad_network_type", "metric_basis", "conversion_action_resource_name", "cohort_day"]
_CM = ["cohorted_conversions", "cohorted_value", "unknown_lag_conversions", "unknown_lag_value"]
_SINCE = f"click_date BETWEEN {AS_OF} - 30 AND {AS_OF}"
CHECK_SQL["cross_grain_identity"] = ("cohort cells that differ between grains", f"SELECT count(*) AS n FROM ({facing('cohort_campaign', 'cohort_asset_group', _CK, _CM, 'sum', _SINCE, _SINCE)}) z WHERE " + " OR ".join(f"abs(a_{m} - b_{m}) > 0.01" for m in _CM), ["cohort_campaign", "cohort_asset_group"])
for _c, (_d, _q, _n) in CHECK_SQL.items():
    SQL[f"check_{_c}"] = _SAYS.format(d=_d, q=_q)
    put(f"assert_{_c}", f"SELECT * FROM check_{_c}", [f"check_{_c}", *_n, "days"])
# Observation against lag: pairs of rungs in the ladder 0, 1, 3, 5, 7, 14, 30
_OK = ["click_date", "account_id", "campaign_id", "asset_group_id", "ad_network_type", "metric_basis", "conversion_action_resource_name", "cohort_day"]
SQL["pair_seen"] = f"SELECT * FROM obs_cells WHERE click_date BETWEEN {AS_OF} - 31 AND {AS_OF} AND grain = 'asset_group' AND cohort_day = 0"
SQL["pair_lag"] = f"SELECT * REPLACE (cohort_day - 1 AS cohort_day) FROM cohort_asset_group WHERE click_date BETWEEN {AS_OF} - 31 AND {AS_OF} AND cohort_day = 1 AND provenance IN ('measured', 'carried')"
SQL["check_cohort_observation_reconciliation"] = f"""SELECT count(*) FILTER (WHERE cohort_day = 0 AND d) = 0 AS passed, CAST(count(*) FILTER (WHERE cohort_day > 0 AND d) AS VARCHAR) AS observed, '0' AS expected, 'first pair must agree' AS detail FROM (
  SELECT z.*, abs(a_cohorted_conversions - b_cohorted_conversions) > 0.01 OR abs(a_cohorted_value - b_cohorted_value) > 0.01 AS d FROM ({facing('pair_seen', 'pair_lag', _OK, _CM[:2], 'sum', "provenance IN ('measured', 'carried')")}) z
  LEFT JOIN (SELECT DISTINCT {', '.join(_OK)}, TRUE AS dark FROM pair_seen WHERE provenance = 'unavailable') u ON {on('u', 'z', _OK)} WHERE dark IS NULL) q"""
put("assert_cohort_observation_reconciliation", "SELECT * FROM check_cohort_observation_reconciliation", ["check_cohort_observation_reconciliation", "days"])
# Window rungs against performance, and capped ones against their buckets
_P = []
for _g in ("campaign", "asset_group"):
    _k = f"'{_g}' AS grain, date AS click_date, account_id, campaign_id, " + ("asset_group_id" if _g == "asset_group" else "NULL::BIGINT AS asset_group_id") + ", ad_network_type"
    for _b, _w, _r, _x in (("PRIMARY", "NETWORK", "NULL::VARCHAR", "network_"), ("ALL_CONVERSIONS", "NETWORK", "NULL::VARCHAR", "network_all_"), ("CONVERSION_ACTION", "CONVERSION_ACTION", "conversion_action_resource_name", "action_")):
        _P.append(f"SELECT {_k}, '{_b}' AS metric_basis, {_r} AS conversion_action_resource_name, sum({_x}conversions) AS p, sum({_x}conversions_value) AS pv FROM perf_{_g} WHERE date BETWEEN {AS_OF} - 30 AND {AS_OF} AND metric_basis = '{_w}' GROUP BY ALL")
SQL["rec_p"] = " UNION ALL ".join(_P)
_cap, _dark = "(window_provenance IS NOT DISTINCT FROM 'capped by reporting window')", "(provenance = 'unavailable')"
SQL["rec_c"] = " UNION ALL ".join(f"""SELECT '{g}' AS grain, click_date, account_id, campaign_id, {'asset_group_id' if g == 'asset_group' else 'NULL::BIGINT AS asset_group_id'}, ad_network_type, metric_basis, conversion_action_resource_name,
  sum(CASE WHEN NOT {_dark} AND NOT {_cap} THEN cohorted_conversions + unknown_lag_conversions END) AS c, sum(CASE WHEN NOT {_dark} AND NOT {_cap} THEN cohorted_value + unknown_lag_value END) AS cv, sum(CASE WHEN NOT {_dark} AND {_cap} THEN cohorted_conversions + unknown_lag_conversions END) AS k,
  sum(CASE WHEN NOT {_dark} AND {_cap} THEN cohorted_value + unknown_lag_value END) AS kv, count(*) FILTER (WHERE NOT {_dark} AND NOT {_cap}) AS own, count(*) FILTER (WHERE NOT {_dark} AND {_cap}) AS cut, count(*) FILTER (WHERE {_dark}) AS dark
FROM cohort_{g} WHERE {_SINCE} AND is_window_rung GROUP BY ALL""" for g in ("campaign", "asset_group"))
_U = "upper_day IS NULL OR upper_day <= least(90, action_window_days)"
SQL["rec_b"] = f"SELECT {_S}, sum(CASE WHEN {_U} THEN conversions ELSE 0 END) AS b, sum(CASE WHEN {_U} THEN conversions_value ELSE 0 END) AS bv FROM basis WHERE {_SINCE} GROUP BY ALL"
_z = lambda x: f"coalesce({x}, 0)"
_off = lambda x, y: f"abs({_z(x)} - {_z(y)}) > greatest(abs({_z(y)}) * 0.01, 1e-9)"
_flat = lambda a, b: " AND ".join(f"coalesce({a}.{c}, -1) = coalesce({b}.{c}, -1)" if c == "asset_group_id" else f"coalesce({a}.{c}, '~') = coalesce({b}.{c}, '~')" if c in ("ad_network_type", "conversion_action_resource_name") else f"{a}.{c} = {b}.{c}" for c in _SERIES)
SQL["check_cohort_reconciliation"] = f"""SELECT count(*) FILTER (WHERE bad) = 0 AS passed, CAST(count(*) FILTER (WHERE bad) AS VARCHAR) AS observed, '0' AS expected, 'window cells without an answer: ' || CAST(coalesce(sum(dark), 0) AS VARCHAR) AS detail FROM (
  SELECT dark, (({_z('own')} > 0 OR {_z('dark')} + {_z('cut')} = 0) AND ({_off('c', 'p')} OR {_off('cv', 'pv')})) OR ({_z('cut')} > 0 AND ({_off('k', 'b')} OR {_off('kv', 'bv')})) AS bad
  FROM rec_p FULL JOIN rec_c ON {_flat('rec_p', 'rec_c')} LEFT JOIN rec_b ON {_flat('rec_c', 'rec_b')}) q"""
put("assert_cohort_reconciliation", "SELECT * FROM check_cohort_reconciliation", ["check_cohort_reconciliation", "days"])
SQL["check_required_tables_nonempty"] = "SELECT count(*) = 0 AS passed, CAST(count(*) AS VARCHAR) AS observed, '0' AS expected, coalesce('empty: ' || string_agg(t, ', ' ORDER BY t), 'none is empty') AS detail FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS t, count(*) AS n FROM {q}" for t, q in (("mart_performance_campaign", "perf_campaign"), ("mart_performance_asset_group", "perf_asset_group"), ("int_lag_prefix_campaign", "cells WHERE grain = 'campaign'"), ("int_lag_prefix_asset_group", "cells WHERE grain = 'asset_group'"), ("mart_cohort_campaign", "cohort_campaign"), ("mart_cohort_asset_group", "cohort_asset_group"))) + ") q WHERE n = 0"
put("assert_required_tables_nonempty", "SELECT * FROM check_required_tables_nonempty", ["check_required_tables_nonempty"])
_SOFT = ("cohort_observation_reconciliation", "asset_not_over_campaign", "campaign_reconciliation", "cross_grain_identity", "cohort_reconciliation", "serving_budget_has_cost")
_ALL = [*CHECK_SQL, "cohort_observation_reconciliation", "cohort_reconciliation", "required_tables_nonempty"]
put("assert_run_decision", "SELECT *, checks > 0 AND hard_failed = 0 AS may_publish, CASE WHEN checks = 0 THEN 'SKIPPED' WHEN hard_failed > 0 THEN 'FAIL' ELSE 'PASS' END AS decision FROM (SELECT count(*) AS checks, count(*) FILTER (WHERE NOT soft AND NOT coalesce(passed, FALSE)) AS hard_failed, count(*) FILTER (WHERE soft AND NOT coalesce(passed, FALSE)) AS soft_failed FROM ("
    + " UNION ALL ".join(f"SELECT passed, {str(c in _SOFT).upper()} AS soft FROM check_{c}" for c in _ALL) + ") q) r", [*(f"check_{c}" for c in _ALL), "days"])
_SHOWN = "coalesce(passed, FALSE) AS passed, observed, expected, CASE WHEN passed IS NULL THEN coalesce(detail, 'no answer') ELSE detail END AS detail"
put("rpt_assertion_results", " UNION ALL ".join(f"SELECT '{c}' AS assertion, '{'SOFT' if c in _SOFT else 'HARD'}' AS severity, {_SHOWN}, {RUN} AS run_id FROM check_{c}" for c in _ALL), [*(f"check_{c}" for c in _ALL), "days"])


def under(name: str, days: int) -> str:
    """A statement with another reporting window than 90 days: what cuts windows, and the rung at the cut; ends of buckets stay."""
    sql = ORACLE[name]
    for part in ("least(max(action_window_days), {})", "max(action_window_days) > {}", "cohort_day = {} AND", "least({}, action_window_days)", "least(window_days, {})", "window_days >= {}"):
        sql = sql.replace(part.format(90), part.format(days))
    return sql


for _n, _days in (("capped", 25), ("even", 30)):
    ORACLE[f"int_lag_prefix_campaign_{_n}"], ORACLE[f"assert_cohort_reconciliation_{_n}"] = under("int_lag_prefix_campaign", _days), under("assert_cohort_reconciliation", _days)
for _q in ("lag_keys", "mart_cohort_campaign", "obs_windows"):
    ORACLE[f"{_q}_capped"] = under(_q, 25)

# Reports
_FRESH = [(t, f"stg_{t}", day_column(t), AS_OF, "" if day_column(t) == "date" else f" WHERE snapshot_date = {AS_OF}") for t in GRAINS]
_FRESH += [(f"mart_performance_{g}", f"perf_{g}", "date", AS_OF, "") for g in GRAIN_KEYS] + [("mart_asset_performance", "perf_asset", "date", AS_OF, ""), ("mart_campaign_truth", "truth", "date", AS_OF, "")]
_FRESH += [(f"mart_cohort_{g}", f"cohort_{g}", "click_date", AS_OF, "") for g in COHORT_KEYS] + [(f"mart_entities_{e}", f"ent_mart_{e}", "snapshot_date", AS_OF, "") for e in KEYS]
_FRESH += [(f"mart_{m}", t, "snapshot_date", AS_OF, "") for m, t in (("bp_campaign", "bp_campaign"), ("bp_asset_group", "bp_group"), ("bp_extended", "bp_ext"))]
for _g, _dims in DIMENSIONS.items():
    SQL[f"out_performance_{_g}"] = published(f"perf_{_g}", _dims, MEASURES)
SQL["out_asset_performance"] = published("perf_asset", ["date", "account_id", "campaign_id", "asset_id", "field_type", "asset_primary_status", "asset_primary_status_reasons", "ad_network_type", "metric_basis"], MEASURES)
SQL["out_campaign_truth"] = published("truth", ["date", "account_id", "campaign_id", "campaign_name", "ad_network_type", "currency_code"], NETWORK)
_OUT = {**{t: f"out_{t}" for t in ("performance_campaign", "performance_asset_group", "performance_asset", "asset_performance", "campaign_truth")}, **{f"cohort_{g}": f"pub_cohort_{g}" for g in COHORT_KEYS}}
_FRESH += [(f"pub_{t}", src, "click_date" if t.startswith("cohort") else "date", f"({AS_OF} - 1)", "") for t, src in _OUT.items()]
put("rpt_freshness", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n, CAST(max({d}) AS DATE) AS last_day, coalesce(max({d}) < {e}, TRUE) AS stale FROM {src}{w}" for t, src, d, e, w in _FRESH), [*(src for _, src, *_ in _FRESH), "days"])
put("snk_publish_generation", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n, min(as_of) AS as_of, min(run_id) AS run_id FROM {src}" for t, src in _OUT.items()), list(_OUT.values()))
_cells = lambda cols: " UNION ALL ".join(f"SELECT {cols} FROM cohort_{g}" for g in COHORT_KEYS)
_CN = [f"cohort_{g}" for g in COHORT_KEYS]
put("rpt_assumed_current", f"SELECT account_id, count(*) FILTER (WHERE window_provenance = 'assumed-current') AS assumed_cells, count(*) AS total_cells, count(*) FILTER (WHERE window_provenance = 'assumed-current') / count(*) AS share FROM ({_cells('account_id, window_provenance')}) q GROUP BY ALL", _CN)
SQL["faced"] = facing("perf_asset", "truth", ["account_id", "ad_network_type"], _NC, "sum", _DAY + " AND metric_basis = 'NETWORK'", _DAY)
put("rpt_participation", " UNION ALL ".join(f"SELECT account_id, ad_network_type, '{c}' AS metric, a_network_{c} AS asset_sum, b_network_{c} AS campaign_truth, a_network_{c} / NULLIF(b_network_{c}, 0) AS ratio FROM faced" for c in COUNTS), ["faced"])
put("rpt_unknown_lag", "SELECT account_id, metric_basis, sum(unknown_lag_conversions) / NULLIF(sum(unknown_lag_conversions + cohorted_conversions), 0) AS share FROM cohort_campaign GROUP BY ALL", ["cohort_campaign"])
put("rpt_coverage", f"SELECT provenance, maturity, count(*) AS cell_count, CAST(sum(count(*)) OVER () AS BIGINT) AS total_cells, count(*) / sum(count(*)) OVER () AS share FROM ({_cells('provenance, maturity')}) q GROUP BY provenance, maturity", _CN)
SQL["all_cells"] = " UNION ALL BY NAME ".join(f"SELECT '{g}' AS grain, * FROM cohort_{g}" for g in COHORT_KEYS)
_IC = "grain, click_date, account_id, campaign_id, asset_group_id, asset_id, metric_basis, cohort_day, maturity"
SQL["issues"] = f"""SELECT {_IC}, 'snapshot gap' AS category, unavailable_reason AS reason FROM all_cells WHERE unavailable_reason IS NOT NULL UNION ALL SELECT {_IC}, 'stale cell', 'stale observation' FROM all_cells WHERE stale_cell_count > 0 AND provenance IS DISTINCT FROM 'unavailable'
UNION ALL SELECT {_IC}, 'NULL-cost cell', 'missing cost' FROM all_cells WHERE missing_cost_cell_count > 0"""
put("rpt_gap_summary", "SELECT category, grain, reason, CAST(date_trunc('month', click_date) AS DATE) AS month, count(*) AS cells FROM issues GROUP BY ALL", ["issues"])
put("rpt_gap_examples", "SELECT * FROM issues WHERE category <> 'NULL-cost cell' ORDER BY click_date, account_id, campaign_id, grain, asset_group_id NULLS FIRST, asset_id NULLS FIRST, metric_basis, cohort_day, category, reason LIMIT 50", ["issues"])
put("rpt_zero_cost", "SELECT * FROM idle", ["idle", "days"])
_RM = ["network_cost", "network_conversions", "action_conversions"]
_SUMMED = lambda t: ["click_day_cost", "cohorted_conversions", "cohorted_value", "unknown_lag_conversions", "unknown_lag_value", "stale_cell_count", "missing_cost_cell_count"] if t.startswith("cohort") else NETWORK if t == "campaign_truth" else MEASURES
put("rpt_publish_reconcile_all", " UNION ALL ".join(f"SELECT '{t}' AS table_name, {d} AS day, '{m}' AS measure, sum({m})::DOUBLE AS mart_value, sum({m})::DOUBLE AS published_value, FALSE AS differs FROM {src} GROUP BY {d}"
    for t, src in _OUT.items() for d in ["click_date" if t.startswith("cohort") else "date"] for m in _SUMMED(t)), [*_OUT.values(), "days"])
put("rpt_publish_reconcile", f"SELECT date, {', '.join(f'sum({m})::DOUBLE AS {m}_mart, sum({m})::DOUBLE AS {m}_published' for m in _RM)}, FALSE AS differs FROM perf_campaign WHERE date BETWEEN {AS_OF} - 90 AND {AS_OF} - 1 GROUP BY date", ["perf_campaign"])
_CUT = f"({AS_OF} - 45)"
put("rpt_month_stability", f"""SELECT *, rows_after - rows_before AS rows_delta, cost_after - cost_before AS cost_delta, CASE WHEN month <= {_CUT} AND last_day(month) >= {_CUT} THEN 'review' WHEN rows_before = rows_after AND cost_before = cost_after THEN 'stable' ELSE 'changed' END AS verdict FROM (
SELECT month, coalesce(a.n, 0) AS rows_before, coalesce(a.c, 0)::BIGINT AS cost_before, coalesce(b.n, 0) AS rows_after, coalesce(b.c, 0)::BIGINT AS cost_after FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n, sum(cost_micros) AS c FROM raw_volume_campaign WHERE run_id = 'load-1' GROUP BY ALL) a
FULL JOIN (SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n, sum(cost_micros) AS c FROM stg_volume_campaign GROUP BY ALL) b USING (month)) q""", ["raw_volume_campaign", "stg_volume_campaign"])
put("rpt_table_reconcile", f"SELECT 'volume_campaign' AS table_name, 'none' AS counting, min(date) AS first_day, count(*) AS n, sum(cost_micros)::DOUBLE AS total FROM stg_volume_campaign WHERE date < {AS_OF} - 30 HAVING count(*) > 0 " + " ".join(f"UNION ALL SELECT 'cohort_{g}', cohort_counting, min(click_date), count(*), sum(cohorted_conversions) FROM cohort_{g} WHERE click_date < {AS_OF} - 30 GROUP BY cohort_counting" for g in COHORT_KEYS), ["stg_volume_campaign", *_CN])
ORACLE["rpt_latest_parity"] = f"SELECT {AS_OF} AS run_date, CASE WHEN count(*) FILTER (WHERE status NOT IN ('matched', 'no comparable score')) = 0 THEN 'PASS' ELSE 'FAIL' END AS result, sha256('score rows') AS query_hash FROM ({ORACLE['par_compare']}) c"

# Ledger
_RUNS = "(SELECT user_id AS run_id, CAST(ts AS DATE) AS event_ts, CASE event_type WHEN 'purchase' THEN 'EXITED' WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END AS event, event_id FROM events)"
_LAST = "QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY event_ts DESC, CASE WHEN event = 'EXITED' THEN 0 ELSE 1 END, event_id DESC) = 1"
ORACLE["ops_latest_run_state"] = f"SELECT * FROM {_RUNS} r {_LAST}"
ORACLE["ops_unfinished_runs"] = f"SELECT * FROM (SELECT * FROM {_RUNS} r WHERE event_ts >= DATE '2024-01-16' {_LAST}) q WHERE event = 'RUNNING'"
SQL["points"] = "SELECT user_id % 5 AS account_id, CAST(date_trunc('month', ts) - INTERVAL (event_id % 45) MONTH AS DATE) AS chunk, substr('ABCD', CAST(user_id % 4 AS INT) + 1, 1) AS family, 'h' || event_id % 2 AS query_hash, 'DONE' AS event, ts AS event_ts, event_id FROM events WHERE event_type IN ('purchase', 'signup')"
put("ops_latest_checkpoints", "SELECT * FROM points QUALIFY row_number() OVER (PARTITION BY account_id, chunk, family, query_hash ORDER BY event_ts DESC, event_id DESC) = 1", ["points"])
put("ops_frozen_chunks", "SELECT DISTINCT account_id, chunk FROM points WHERE chunk < DATE '2020-12-01'", ["points"])
put("ops_pending_chunks", """SELECT a.account_id, m.chunk, string_agg(f, ',' ORDER BY f) AS missing FROM (SELECT DISTINCT account_id FROM points) a CROSS JOIN (SELECT CAST(range AS DATE) AS chunk FROM range(DATE '2020-12-01', DATE '2024-02-01', INTERVAL 1 MONTH)) m
CROSS JOIN (VALUES ('A'), ('B'), ('C'), ('D')) v(f) WHERE NOT EXISTS (SELECT 1 FROM points p WHERE p.account_id = a.account_id AND p.chunk = m.chunk AND p.family = f AND p.query_hash = 'h0') GROUP BY ALL""", ["points"])
put("ops_chunk_bounds", "SELECT DISTINCT account_id, chunk, greatest(chunk, DATE '2023-11-10') AS from_day, least(last_day(chunk), DATE '2024-01-20') AS to_day FROM points", ["points"])
put("ops_checkpoint_reset", "SELECT account_id, chunk, count(*) AS n FROM points WHERE NOT (account_id = 2 AND chunk = DATE '2024-01-01') GROUP BY ALL UNION ALL SELECT 2, NULL, count(*) FROM points WHERE account_id = 2 AND chunk = DATE '2024-01-01'", ["points"])
ORACLE["ops_first_snapshot"] = """WITH marks AS (SELECT user_id % 20 AS account_id, 'r' || user_id % 7 AS run_id, CAST(ts AS DATE) AS first_snapshot_date, event_id AS set_at, event_type, user_id FROM events)
SELECT account_id, run_id, first_snapshot_date FROM marks WHERE event_type = 'signup' AND account_id NOT IN (SELECT account_id FROM marks WHERE event_type = 'purchase' AND user_id < 40 AND run_id IN (SELECT 'r' || user_id % 7 FROM events WHERE user_id % 7 < 2))
QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY set_at, run_id) = 1"""
_TREE = """WITH e AS (SELECT sha256(CAST(doc_id AS VARCHAR) || '=' || sha256(coalesce(text, ''))) AS entry, count(*) AS c FROM documents GROUP BY 1),
a AS (SELECT substr(entry, 1, 6) AS r, sha256(string_agg(entry || ':' || c, ';' ORDER BY entry)) AS d FROM e GROUP BY 1),
b AS (SELECT substr(r, 1, 4) AS q, sha256(string_agg(r || ':' || d, ';' ORDER BY r)) AS d FROM a GROUP BY 1),
c AS (SELECT substr(q, 1, 2) AS p, sha256(string_agg(q || ':' || d, ';' ORDER BY q)) AS d FROM b GROUP BY 1),
t AS (SELECT sha256(string_agg(p || ':' || d, ';' ORDER BY p)) AS d FROM c)
"""
ORACLE["ops_checkpoint_hash"] = _TREE + "SELECT sha256(d || '|v1') AS query_hash FROM t"
ORACLE["ops_hash_ranges"] = _TREE + "SELECT 2 AS level, p AS range, d AS digest FROM c UNION ALL SELECT 0, '', d FROM t"
ORACLE["ops_changed_texts"] = """SELECT CAST(doc_id AS VARCHAR) AS name, CASE WHEN doc_id % 101 = 1 THEN 'removed' ELSE 'changed' END AS change FROM documents WHERE doc_id % 101 = 1 OR doc_id % 97 = 0
UNION ALL SELECT CAST(doc_id + 1000000000 AS VARCHAR), 'added' FROM documents WHERE doc_id % 89 = 5"""

# Sinks
_WEEK = f"date BETWEEN {AS_OF} - 20 AND {AS_OF} - 14"
SQL["vol"] = "SELECT * EXCLUDE (loaded_at) FROM raw_volume_campaign"
put("snk_range_replace", f"SELECT * FROM vol WHERE run_id = 'load-1' AND NOT ({_WEEK}) UNION ALL SELECT * FROM vol WHERE run_id = 'load-2' AND {_WEEK}", ["vol"])
put("snk_restore_range", f"SELECT * FROM vol WHERE run_id = 'load-2' AND NOT ({_WEEK}) UNION ALL SELECT * FROM vol WHERE run_id = 'load-1' AND {_WEEK}", ["vol"])
put("snk_snapshot_replace", f"SELECT * EXCLUDE (loaded_at) FROM raw_entities_campaign WHERE (run_id = 'load-1') = (snapshot_date <> {AS_OF})", ["raw_entities_campaign"], ["primary_status_reasons"])
put("snk_inventory", f"SELECT 'volume' AS table_name, date AS day, bool_or({_WEEK}) AS is_new FROM vol WHERE (run_id = 'load-1' AND NOT ({_WEEK})) OR (run_id = 'load-2' AND {_WEEK}) GROUP BY date", ["vol"])
put("snk_observation_append", tally("diary", "observed_date, run_id, account_id, grain, metric_basis", "conversions", "conversions_value"), ["diary"])
put("snk_slice_export", f"SELECT * FROM selected WHERE observed_date = {AS_OF} - 1", ["selected"])
ORACLE["snk_clustered_asof"] = ORACLE["prf_asof_join"]
put("snk_slice_export_account", f"SELECT * FROM selected WHERE observed_date = {AS_OF} - 1 AND account_id = 2", ["selected"])
put("snk_table_layout", "SELECT * FROM stg_conv_campaign", ["stg_conv_campaign"])
put("snk_publish_guard", f"SELECT {AS_OF} AS published_as_of, DATE '1998-06-29' AS run_as_of, TRUE AS is_older, FALSE AS may_publish FROM truth LIMIT 1", ["truth"])
put("snk_retention_expire", f"SELECT * FROM vol WHERE date >= {AS_OF} - 91", ["vol"])
put("snk_retention_drift", """SELECT t AS table_name, e AS expected_days, k AS actual_days, CASE WHEN t = 'conv_campaign' THEN 'not listed' WHEN e IS NOT DISTINCT FROM k THEN 'as expected' WHEN e IS NULL THEN 'refused: must never expire' ELSE 'differs' END AS status FROM (
SELECT 'volume_campaign' AS t, 119 AS e, max(date) - min(date) AS k FROM raw_volume_campaign UNION ALL SELECT 'conv_campaign', NULL, max(date) - min(date) FROM raw_conv_campaign
UNION ALL SELECT 'entities_campaign', NULL, max(snapshot_date) - min(snapshot_date) FROM raw_entities_campaign UNION ALL SELECT 'entities_customer', NULL, max(snapshot_date) - min(snapshot_date) FROM raw_entities_customer) q""", ["raw_volume_campaign", "raw_conv_campaign", "raw_entities_campaign", "raw_entities_customer"])
put("snk_loss_preview", " UNION ALL ".join(f"SELECT '{t}' AS table_name, min(date) AS first_day, count(DISTINCT date) FILTER (WHERE date < {AS_OF} - 100) AS older_days, count(*) FILTER (WHERE date < {AS_OF} - 100) AS older_rows, count(*) FILTER (WHERE date = {AS_OF} - 100) AS boundary_rows FROM raw_{t}" for t in GRAINS if day_column(t) == "date"), [f"raw_{t}" for t in GRAINS if day_column(t) == "date"])
put("snk_quarantine", "SELECT *, ad_network_type IS NULL AND day(date) < 8 AS is_aside FROM stg_volume_campaign", ["stg_volume_campaign"])

# Text
_Q = "'7:' || coalesce(CAST(campaign_id AS VARCHAR), '') || ':' || coalesce(CAST(date AS VARCHAR), '') || ':' || coalesce(ad_network_type, '')"
put("txt_perturb_metrics", f"SELECT account_id, campaign_id, date, ad_network_type, conversions_value * (0.85::DOUBLE + CAST('0x' || substr(sha256({_Q}), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE * 0.3::DOUBLE) AS conversions_value FROM stg_volume_campaign", ["stg_volume_campaign"])
_LK = "account_id, campaign_id, date, ad_network_type, conversion_action"
put("txt_repair_identities", f"""WITH x AS (SELECT l.*, t.target, sum(l.conversions) OVER w AS total, row_number() OVER (PARTITION BY l.account_id, l.campaign_id, l.date, l.ad_network_type, l.conversion_action ORDER BY l.conversion_lag_bucket) AS n, count(*) OVER w AS last_n FROM stg_lag_campaign l
LEFT JOIN (SELECT account_id, campaign_id, date, coalesce(ad_network_type, '~') AS a, conversion_action AS r, conversions * 2 AS target FROM stg_conv_campaign) t ON t.account_id = l.account_id AND t.campaign_id = l.campaign_id AND t.date = l.date AND t.a = coalesce(l.ad_network_type, '~') AND t.r = l.conversion_action
WINDOW w AS (PARTITION BY l.account_id, l.campaign_id, l.date, l.ad_network_type, l.conversion_action)),
y AS (SELECT *, conversions * (target / total) AS scaled FROM x)
SELECT {_LK}, conversion_lag_bucket, CASE WHEN target IS NULL OR total <= 0 THEN conversions WHEN n = last_n THEN target - coalesce(sum(scaled) OVER (PARTITION BY {_LK} ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE scaled END AS conversions, greatest(all_conversions, conversions) AS all_conversions FROM y""".replace("WITH x AS", "WITH_X").replace("WITH_X", "SELECT * FROM (WITH x AS") + ") final", ["stg_lag_campaign", "stg_conv_campaign"])
# Another engine's expressions have no look-around, so values already redacted are told by their first character.
_KEY = "-----{}[A-Z\\s]*PRIVATE\\s+KEY-----"
_BEGIN, _END = _KEY.format("BEGIN"), _KEY.format("END")
_NAMES = "|".join(["password", "passwd", "secret", "token", "credential", *(f"{a}[_-]?{b}" for a, b in (("api", "key"), ("private", "key"), ("client", "secret"), ("refresh", "token"), ("developer", "token")))])
_VALUE = "(?:\"[^\"]*\"|''[^'']*''|[^\\s<\"'']\\S*)"
_PIECE = "[-_0-9A-Za-z]{20,}"
REDACT = [
    (f"{_BEGIN}.*?{_END}", "<redacted:private_key_block>", "gs"), (f"{_BEGIN}.*?(\\n?)$", r"<redacted:truncated_private_key_block>\1", "gs"),
    *((f"({a}[_-]{b}\\s*[=:]\\s*)\\S+", rf"\1<redacted:{a}_{b}>", "gi") for a, b in (("refresh", "token"), ("developer", "token"), ("client", "secret"))),
    (rf"\b((?:[0-9a-z]+[-._])*(?:{_NAMES})\b[\"'']?\s*(?::=|:|=)\s*){_VALUE}", r"\1<redacted:credential_assignment>", "gi"),
    (r"\b(bearer\s+)[-+/=~._0-9a-z]{16,}", r"\1<redacted:bearer_token>", "gi"), (r"\b([A-Za-z][-+.0-9A-Za-z]*://)[^:@/<\s]+:(?:[^@\s]+@)+", r"\1<redacted:url_credentials>@", "g"),
]
CONTENT = [
    ("private_key_block", _BEGIN, "g"), ("base64_pem_header", r"LS0tLS1CRUdJ[A-Za-z0-9+/]", "g"), ("google_api_key", r"AIza[0-9A-Za-z_\-]{30,}", "g"), ("gemini_api_key", r"AQ\.[A-Za-z0-9][0-9A-Za-z_\-]{25,}", "g"),
    ("github_token", r"gh[pousr]_[0-9A-Za-z]{30,}", "g"), ("slack_token", r"xox[baprs]-[0-9A-Za-z-]{20,}", "g"), ("aws_access_key_id", r"AKIA[0-9A-Z]{16}", "g"), ("google_oauth_access_token", r"ya29\.[0-9A-Za-z_\-]{20,}", "g"),
    ("refresh_token", r"(^|[^A-Za-z0-9+/])1//[0-9A-Za-z_\-]{30,}", "g"), ("client_secret", r"GOCSPX-[0-9A-Za-z_\-]{20,}", "g"), ("service_account_private_key", r"\"private_key\"\s*:\s*\"-----BEGIN", "g"), ("stripe_api_key", r"\b[spr]k_(?:live|test)_[0-9A-Za-z]{16,}", "g"),
    ("supabase_jwt_service_key", rf"\beyJ{_PIECE}\.eyJ{_PIECE}\.{_PIECE}", "g"), ("vercel_token", r"\bvercel[_-]?(?:(?:access|api)[_-]?)?token[\"'']?\s*[=:]\s*[\"'']?[0-9a-z]{20,}", "gi"), ("stripe_webhook_signing_secret", r"\bwhsec_[0-9A-Za-z]{16,}", "g"), ("openrouter_api_key", r"\bsk-or-v1-[0-9A-Za-z]{32,}", "g"),
]


def redacted(x: str) -> str:
    for p, r, f in [*REDACT, *((p, (r"\1" if label == "refresh_token" else "") + f"<redacted:{label}>", f) for label, p, f in CONTENT)]:
        x = f"regexp_replace({x}, '{p}', '{r}', '{f}')"
    return x


ORACLE["txt_redact"] = f"SELECT doc_id, {redacted('text')} AS text FROM documents"
ORACLE["txt_redact_line"] = "SELECT conv_id, turn, " + redacted("trim(regexp_replace(text, '\\s+', ' ', 'g'))") + " AS text FROM conversations"
_FINDS = [*((label, p, f) for (p, _, f), label in zip(REDACT[2:], ("refresh_token", "developer_token", "client_secret", "credential_assignment", "bearer_token", "url_credentials"))), *CONTENT]
ORACLE["txt_secret_scan"] = "WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), numbered AS (SELECT doc_id, unnest(ls) AS t, generate_subscripts(ls, 1) AS line FROM lines) " + " UNION ".join(
    f"SELECT doc_id, line, '{label}' AS class FROM numbered WHERE regexp_matches(t, '{p}'{', ' + chr(39) + 'i' + chr(39) if 'i' in f else ''})" for label, p, f in _FINDS) + " UNION SELECT doc_id, line, 'term' FROM numbered WHERE contains(lower(t), 'apache license')"
