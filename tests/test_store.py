"""Stored tables: generations of day folders, increments of staging, landed files and declared tables."""

import datetime as dt
import random
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cohortlake.operators import ledger, observation, performance, sinks, staging
from cohortlake.plans.params import Params
from cohortlake.sources import declared, landing
from cohortlake.sources.generations import Generations

D = dt.date
DAYS = [D(2024, 1, d) for d in range(1, 7)]


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.fixture
def store(spark, tmp_path):
    g = Generations(spark, f"file://{tmp_path}/set")
    rows = [(d, f"old{d.day}", k) for d in DAYS for k in range(3)]
    g.commit({"t": spark.createDataFrame(rows, "date date, v string, k int"), "whole": spark.range(4)}, "one", {"t": "date"})
    return g


def days(df):
    return {(r.date.day if r.date else None, r.v) for r in df.collect()}


def files(tmp_path):
    return {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet")}


def test_generations_swap_whole(spark, tmp_path):
    g = Generations(spark, f"file://{tmp_path}/set")
    assert g.current() is None
    g.commit({"a": spark.range(3), "b": spark.range(2)}, "one")
    old = g.read("a")
    g.commit({"a": spark.range(5), "b": spark.range(4)}, "two")
    assert (g.current(), g.read("a").count(), g.read("b").count(), old.count(), g.read("a", "one").count()) == ("two", 5, 4, 3, 3)
    g.point("one")
    assert g.read("a").count() == 3
    with pytest.raises(ValueError, match="no generation"):
        g.point("three")


def test_only_replaced_days_are_written(spark, store, tmp_path):
    before = files(tmp_path)
    new = spark.createDataFrame([(D(2024, 1, 2), "new", 1), (D(2024, 1, 4), "new", 1)], "date date, v string, k int")
    assert sorted(sinks.range_replace(store, "t", new, D(2024, 1, 2), D(2024, 1, 4), "two")) == ["2024-01-02", "2024-01-04"]
    after = files(tmp_path)
    assert all(after[f] == t for f, t in before.items())
    assert {f.split("/")[-2] for f in after.keys() - before.keys()} == {"date=2024-01-02", "date=2024-01-04"}
    # The interior day without rows is empty, the days around stay.
    assert days(store.read("t")) == {(1, "old1"), (2, "new"), (4, "new"), (5, "old5"), (6, "old6")}
    assert days(store.read("t", "one")) == {(d.day, f"old{d.day}") for d in DAYS}
    again = spark.createDataFrame([(D(2024, 1, 4), "newer", 1)], "date date, v string, k int")
    store.replace_range("t", again, D(2024, 1, 4), D(2024, 1, 5), "three")
    assert days(store.read("t")) == {(1, "old1"), (2, "new"), (4, "newer"), (6, "old6")}
    assert {r.generation for r in store.inventory().where("table_name = 't'").collect()} == {"one", "two", "three"}
    sinks.snapshot_replace(store, "t", again.limit(0), D(2024, 1, 1), "four")
    assert days(store.read("t")) == {(2, "new"), (4, "newer"), (6, "old6")} and store.read("whole").count() == 4


@pytest.mark.parametrize("day", [D(2024, 1, 5), None])
def test_stray_rows_change_nothing(spark, store, tmp_path, day):
    before = files(tmp_path)
    new = spark.createDataFrame([(D(2024, 1, 2), "new", 1), (day, "stray", 1)], "date date, v string, k int")
    with pytest.raises(ValueError, match="outside the range"):
        store.replace_range("t", new, D(2024, 1, 2), D(2024, 1, 4), "two")
    assert store.current() == "one" and files(tmp_path) == before


def test_a_run_that_dies_changes_nothing_and_can_run_again(spark, store, monkeypatch):
    new = spark.createDataFrame([(D(2024, 1, 2), "new", k) for k in range(5)], "date date, v string, k int")
    with monkeypatch.context() as m:
        m.setattr(store, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.replace_range("t", new, D(2024, 1, 2), D(2024, 1, 2), "two")
    assert store.current() == "one" and store.read("t").count() == 18
    store.replace_range("t", new, D(2024, 1, 2), D(2024, 1, 2), "two")
    assert store.read("t").count() == 20


def test_a_change_between_is_noticed(spark, store, monkeypatch):
    other, put = Generations(spark, store.root), store._put

    def late(*a):
        other.expire("t", D(2024, 1, 2), "other")
        return put(*a)

    monkeypatch.setattr(store, "_put", late)
    with pytest.raises(RuntimeError, match="another generation"):
        store.replace_range("t", spark.createDataFrame([], "date date, v string, k int"), D(2024, 1, 3), D(2024, 1, 3), "two")
    assert store.current() == "other" and store.read("t").count() == 15


def test_days_expire_and_come_back_without_writing(spark, store, tmp_path):
    before = files(tmp_path)
    assert sinks.expire(store, "t", D(2024, 1, 6), 1, "two") == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert sinks.expire(store, "t", D(2024, 1, 6), 1, "no", mode="incremental") == []
    assert days(store.read("t")) == {(d.day, f"old{d.day}") for d in DAYS[3:]}
    assert store.restore_range("t", "one", D(2024, 1, 2), D(2024, 1, 5), "three") == ["2024-01-02", "2024-01-03"]
    assert days(store.read("t")) == {(d.day, f"old{d.day}") for d in DAYS[1:]} and files(tmp_path) == before
    assert store.restore_range("t", "two", D(2024, 1, 1), D(2024, 1, 31), "four") == ["2024-01-02", "2024-01-03"]
    assert store.vacuum(keep=["four"]) == 3
    assert days(store.read("t")) == {(d.day, f"old{d.day}") for d in DAYS[3:]} and len(files(tmp_path)) < len(before)


def test_quarantine_rewrites_days_with_wrong_rows_only(spark, store, tmp_path):
    before = files(tmp_path)
    said = store.quarantine("t", (F.col("k") == 1) & F.col("date").isin(DAYS[1], DAYS[4]), "two")
    assert said == {"days": 2, "set_aside": 2, "left": 4}
    fresh = files(tmp_path).keys() - before.keys()
    assert {f.split("/")[-2] for f in fresh} == {"date=2024-01-02", "date=2024-01-05"} and {f.split("/")[1] for f in fresh} == {"t", "t_quarantine"}
    assert store.read("t").count() == 16 and store.read("t_quarantine").count() == 2
    assert store.quarantine("t", F.col("k") > 9, "three")["days"] == 0
    store.restore_range("t", "one", DAYS[0], DAYS[5], "four")
    assert store.read("t").count() == 18


def test_rows_without_a_day_stay_apart(spark, tmp_path):
    g = Generations(spark, f"file://{tmp_path}/set")
    g.commit({"t": spark.createDataFrame([(None, "none"), (D(2024, 1, 1), "a")], "date date, v string")}, "one", {"t": "date"})
    g.replace_range("t", spark.createDataFrame([(D(2024, 1, 1), "b")], "date date, v string"), D(2020, 1, 1), D(2030, 1, 1), "two")
    assert days(g.read("t")) == {(None, "none"), (1, "b")}
    assert g.quarantine("t", F.col("date").isNull(), "three")["set_aside"] == 1 and days(g.read("t")) == {(1, "b")}
    g.expire("t", D(2030, 1, 1), "four")
    assert g.read("t").columns == ["date", "v"] and g.read("t").count() == 0


def test_filters_on_the_day_open_few_folders(store):
    text = plan(store.read("t").where((F.col("date") == D(2024, 1, 3)) & (F.col("k") > 1)))
    assert "PartitionFilters: [isnotnull(date#" in text and "PushedFilters: [IsNotNull(k), GreaterThan(k,1)]" in text


# Landed reports


def report(spark, tmp_path):
    rows = [(d, k, ch, k * d.day) for d in DAYS for k, ch in enumerate(["PERFORMANCE_MAX", "SEARCH", None])]
    spark.createDataFrame(rows, "date date, campaign_id long, advertising_channel_type string, clicks long").write.partitionBy("date").parquet(f"{tmp_path}/report")
    return spark.read.parquet(f"{tmp_path}/report")


def test_days_and_channel_reach_the_files(spark, tmp_path):
    df = landing.in_window(report(spark, tmp_path), "date", DAYS[1], DAYS[2], "PERFORMANCE_MAX")
    text = plan(df.select("campaign_id"))
    assert "PartitionFilters: [isnotnull(date#" in text and "EqualTo(advertising_channel_type,PERFORMANCE_MAX)" in text
    assert "ReadSchema: struct<campaign_id:bigint,advertising_channel_type:string>" in text
    assert {(r.date, r.campaign_id) for r in df.collect()} == {(DAYS[1], 0), (DAYS[2], 0)}


def test_days_of_another_table_choose_folders_at_run_time(spark, tmp_path):
    days = spark.createDataFrame([(DAYS[3], 1), (DAYS[5], 2), (DAYS[5], 1), (None, 1)], "snapshot_date date, account_id long")
    days.write.parquet(f"{tmp_path}/days")
    named = spark.read.parquet(f"{tmp_path}/days").where("account_id = 1").select("snapshot_date")
    df = landing.on_days(report(spark, tmp_path), named, "date")
    assert "dynamicpruning" in plan(df)
    rows = df.collect()
    assert {r.date for r in rows} == {DAYS[3], DAYS[5]} and len(rows) == 6
    scanned = df._jdf.queryExecution().executedPlan()
    assert "dynamicpruningexpression" in scanned.toString()


def test_lines_are_taken_or_refused_with_their_text(spark, tmp_path):
    good = '{"run_id":"r","loaded_at":"2024-01-01 00:00:00","account_id":"5","campaign_id":7,"date":"2024-01-02T00:00:00","clicks":"","conversions":"0.5"}'
    lines = [good, good.replace("7", "7.5"), good[:-3], good.replace('"run_id"', '"run"'), good.replace('"clicks":""', '"clicks":"12x"'), good.replace("2024-01-02T00:00:00", "soon"), good.replace('"date":"2024-01-02T00:00:00",', ""), "[1]", "null", "", "   ", '"x"', good]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    taken, refused = landing.read_landed(spark, f"{tmp_path}/in", "volume_campaign")
    rows = taken.collect()
    assert [(r.account_id, r.campaign_id, r.date, r.clicks, r.conversions, r.campaign_name) for r in rows] == [(5, 7, D(2024, 1, 2), None, 0.5, None)] * 2
    assert list(taken.columns) == list(landing.family_columns("volume_campaign"))
    said = sorted((r.reason, r.value) for r in refused.collect())
    assert [x for x, _ in said] == ["bad value in campaign_id", "bad value in clicks", "bad value in date", *["no JSON object"] * 4, "no date", "unknown field run"]
    assert {v for _, v in said} == set(lines) - {good, "", "   "} and len(said) == 9
    counted = {r.outcome: r.n for r in landing.reconciled(spark, f"{tmp_path}/in", "volume_campaign").collect()}
    assert sum(counted.values()) == 11 and counted["taken"] == 2 and counted["no JSON object"] == 4


# Increments of staging


def test_loads_in_any_order_give_the_full_ranking(spark, tmp_path):
    rnd = random.Random(7)
    at = lambda h: dt.datetime(2024, 2, 1, h)
    rows = [(f"r{load}", at(load), "q", a, 1, None, rnd.choice(DAYS), rnd.randint(0, 9)) for load in range(4) for a in range(6) for _ in range(4)]
    raw = spark.createDataFrame(rows, "run_id string, loaded_at timestamp, query_hash string, account_id long, campaign_id long, ad_network_type string, date date, clicks long")
    full = staging.latest_rows(raw, ["date", *staging.GRAINS["volume_campaign"]])
    g = Generations(spark, f"file://{tmp_path}/set")
    g.commit({"volume_campaign": raw.limit(0)}, "none", {"volume_campaign": "date"})
    for k, (load, a, b) in enumerate([(2, 0, 5), (0, 0, 5), (3, 3, 5), (1, 0, 5), (3, 0, 2), (2, 1, 4)]):
        staging.merge_load(g, "volume_campaign", raw.where(F.col("run_id") == f"r{load}"), DAYS[a], DAYS[b], f"g{k}")
    assert sorted(map(repr, g.read("volume_campaign").select(full.columns).collect())) == sorted(map(repr, full.collect()))


def test_a_load_touches_its_window_only(spark, tmp_path):
    raw = spark.createDataFrame([(f"r{load}", dt.datetime(2024, 2, load), "q", 1, 1, None, d, load) for load in (1, 2) for d in DAYS], "run_id string, loaded_at timestamp, query_hash string, account_id long, campaign_id long, ad_network_type string, date date, clicks long")
    g = Generations(spark, f"file://{tmp_path}/set")
    g.commit({"volume_campaign": raw.where("run_id = 'r1'")}, "one", {"volume_campaign": "date"})
    before = files(tmp_path)
    written = staging.merge_load(g, "volume_campaign", raw.where("run_id = 'r2'"), DAYS[2], DAYS[3], "two")
    assert sorted(written) == [str(DAYS[2]), str(DAYS[3])] and len(files(tmp_path).keys() - before.keys()) == 2
    assert {(r.date, r.clicks) for r in g.read("volume_campaign").collect()} == {(d, 2 if d in DAYS[2:4] else 1) for d in DAYS}


# Declared tables


@pytest.fixture
def clustered(spark, tmp_path):
    made = []

    def make(columns, rows, order=()):
        name = f"t{uuid.uuid4().hex}"
        layout = declared.Layout(columns, ("k",), 4, order)
        empty = declared.declare(spark, name, layout, f"file://{tmp_path}/{name}")
        assert dict(empty.dtypes) == columns and empty.count() == 0
        made.append(name)
        return declared.fill(spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in columns.items())), name, layout), name, layout

    yield make
    for name in made:
        spark.sql(f"DROP TABLE `{name}`")


def test_asof_of_clustered_tables_moves_nothing(spark, clustered):
    rnd = random.Random(8)
    facts, _, _ = clustered({"k": "bigint", "date": "date", "n": "int"}, [(rnd.choice([None, *range(9)]), rnd.choice(DAYS), n) for n in range(200)], ("k", "date"))
    view, _, _ = clustered({"k": "bigint", "snapshot_date": "date", "v": "string"}, [(k, d, f"{k}{d}") for k in [None, *range(7)] for d in rnd.sample(DAYS, 2)], ("k", "snapshot_date"))
    out = performance.asof_in_place(facts, view, ["k"], {"v": "value"})
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    want = performance.asof_else_earliest(facts, view, ["k"], {"v": "value"})
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect())) and out.where("value IS NULL").count() > 0


def test_a_table_of_another_layout_is_refused(spark, clustered):
    df, name, layout = clustered({"k": "bigint", "v": "string"}, [(1, "a"), (2, "b"), (None, "c")])
    assert df.count() == 3 and declared.fill(df.limit(1), name, layout).count() == 4
    for other in (declared.Layout(layout.columns, ("k",), 8), declared.Layout(layout.columns, ("v",), 4), declared.Layout(layout.columns | {"v": "int"}, ("k",), 4), declared.Layout(layout.columns, ("k",), 4, ("v",))):
        with pytest.raises(ValueError, match="laid out"):
            declared.fill(df, name, other)


# Trees of digests, windows of accounts


def test_changed_texts_are_found_by_going_down(spark):
    rows = [(f"n{k}", f"text {k}") for k in range(300)] + [("twice", "x"), ("twice", "x"), ("twice", "y"), ("none", None)]
    later = [(n, t + "!" if n in ("n7", "n90") else t) for n, t in rows if n != "n33"] + [("new", "z"), ("twice", "x")]
    old, new = (ledger.hash_entries(spark.createDataFrame(r, "name string, text string")) for r in (rows, later))
    trees = [ledger.hash_tree(e).cache() for e in (old, new)]
    got = {r.name: r.change for r in ledger.changed_texts(old, new, *trees).collect()}
    assert got == {"n7": "changed", "n90": "changed", "n33": "removed", "new": "added", "twice": "added"}
    assert ledger.changed_texts(old, old, trees[0], trees[0]).count() == 0
    key = lambda r: ledger.checkpoint_hash(spark.createDataFrame(r, "name string, text string"), "v1").first()[0]
    assert key(rows) == key(rows[::-1]) != key(later) and key(rows) != key(rows + rows[:1]) and key([]) is not None
    assert trees[0].groupBy("level").count().where("level = 0").first()["count"] == 1


def test_each_account_has_its_own_window(spark, tmp_path):
    p = Params(as_of=D(2024, 6, 30), run_id="r", window_days=90, cohort_days=(0, 1, 7))
    dates = spark.createDataFrame([(1, D(2024, 6, 30)), (2, D(2024, 7, 1)), (3, D(2024, 6, 30)), (4, D(2024, 6, 30))], "account_id long, observed_date date")
    actions = spark.createDataFrame([(1, 3), (1, 10), (2, 200), (4, None)], "account_id long, click_through_lookback_window_days long")
    windows = observation.window_clamp(observation.depth_by_account(dates, actions, p), D(2024, 6, 1))
    assert {r.account_id: (r.depth_days, r.window_start, r.window_end.day) for r in windows.collect()} == {1: (18, D(2024, 6, 12), 29), 2: (90, D(2024, 6, 1), 30), 3: (15, D(2024, 6, 15), 29), 4: (15, D(2024, 6, 15), 29)}
    spark.range(1, 6).selectExpr("id AS account_id", "explode(sequence(date'2024-05-20', date'2024-07-05')) AS date").write.partitionBy("date").parquet(f"{tmp_path}/facts")
    windows.write.parquet(f"{tmp_path}/windows")
    out = observation.window_scan(spark.read.parquet(f"{tmp_path}/facts"), spark.read.parquet(f"{tmp_path}/windows"), D(2024, 6, 1))
    assert "dynamicpruning" in plan(out)
    assert {r.account_id: (r.n, r.most) for r in out.groupBy("account_id").agg(F.count("*").alias("n"), F.max("lag").alias("most")).collect()} == {1: (18, 18), 2: (30, 30), 3: (15, 15), 4: (15, 15)}
