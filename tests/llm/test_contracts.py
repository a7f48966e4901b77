"""Odd pages, exact loads, clashing columns, and stages of the pipeline on awkward rows."""

import heapq
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from cohortlake.llm import html_extract, language, minhash, quality, sharding, storage, substring
from cohortlake.llm.decontaminate import decontaminate, find_leaks
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def read():
    field = html_extract.default_field()
    return lambda page: html_extract.main_text(page, field)


@pytest.mark.parametrize("page,want", [
    ("<p>Only a paragraph of plain text, which says something.</p>", "Only a paragraph of plain text, which says something."),
    ('<h1>A title of it</h1><div id="x7"><p>One paragraph is here.</p><p>Two is here as well.</p></div>', "A title of it\nOne paragraph is here.\nTwo is here as well."),
    ('<article><h1>T is it</h1><p title="x>broken quote para.</p><p class="y">More text goes on.</p></article>', "T is it\nbroken quote para.\nMore text goes on."),
    ("<article><p>Seen by all who read.</p><p hidden>Not seen by anybody.</p><div style='display:none'>Nor this one.</div><p>Last one, seen.</p></article>", "Seen by all who read.\nLast one, seen."),
    ("<article><p>Before <math><mi>x</mi></math> after it.</p><object data=x><p>Rest of it is here.</p></article>", "Before x after it.\nRest of it is here."),
    ("<article><p>Some words of it.</p><select><option>A</option><option>B</option></select><button>Go</button><p>And more words of it.</p></article>", "Some words of it.\nAnd more words of it."),
    ("<article><h1>Title here</h1><p>Some words of it.</p><svg><text>LABEL</text></svg><p>And more words of it.</p></article>", "Title here\nSome words of it.\nAnd more words of it."),
    ("<main><p>Some words of it.</p><label>Name</label><input><fieldset><legend>Choose</legend><label>One</label></fieldset><p>And more words of it.</p></main>", "Some words of it.\nAnd more words of it."),
    ("<div class='entry'><p>Short.</p><p>By Jane Doe, 3 May</p><p>And more words of it, which go on for a while.</p></div>", "Short.\nBy Jane Doe, 3 May\nAnd more words of it, which go on for a while."),
    ('<article><p data-x="<p>a</p>">Quoted markup goes.</p></article>', "Quoted markup goes."),
])
def test_odd_pages(read, page, want):
    assert read(page) == want


def test_depth_changes_nothing(read):
    def page(n):
        inner = "<div>" * n + "<p>Deep paragraph of the text.</p>" + "</div>" * n
        return "<div>" * 255 + "<article><h1>Heading here</h1><p>First paragraph.</p>" + inner + "<p>Last paragraph.</p></article>" + "</div>" * 255

    want = "Heading here\nFirst paragraph.\nDeep paragraph of the text.\nLast paragraph."
    assert [read(page(n)) for n in (0, 100, 400, 2000)] == [want] * 4


@pytest.mark.parametrize("unit", ["a<b ", '<b x="> ', "<b x='> <b x=\"> ", '<b x=">" ', "<b><i>x", "</p></b>", "<title>", "<p><div><b><hr>", "<div class=c>"])
def test_time_grows_with_length(read, unit):
    began = time.time()
    read(unit * (1_000_000 // len(unit)))
    assert time.time() - began < 10


def test_loads_are_those_of_plain_longest_first(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    group = Counter()
    for r in docs.collect():
        group[r.text] += len((r.text or "").encode()) + 1
    heap = [(0, k) for k in range(8)]
    for size in sorted(group.values(), reverse=True):
        load, k = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, k))
    got = {r.shard: r.n for r in sharding.assign_shards(docs).groupBy("shard").agg(F.sum("size").alias("n")).collect()}
    assert got == {k: load for load, k in heap}


CLASH = ["_from", "_to", "_rid", "_rhash", "_id", "_hash", "_lid", "_lhash", "_p", "_n", "first", "_group", "row", "id", "hash", "group", "gain", "languages", "shares", "kept_words", "others", "c0", "lang_pred", "score", "kept", "n_words", "n_removed", "shard_", "part", "place", "copies"]


def clashing(spark, extra=CLASH):
    d = spark.read.parquet(f"{DATA}/documents.parquet")
    return d.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in extra])


def test_columns_of_any_name_stay(spark):
    docs = clashing(spark).cache()
    new = {"n_words", "n_removed", "kept"}
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    for out, gone in ((sharding.assign_shards(docs), set()), (substring.dedup_substrings(docs), new), (decontaminate(docs, bench), set()), *((f(spark, docs, DATA), set()) for _, f in corpus_pipeline.STAGES[:-1])):
        row = out.first()
        assert all(row[c] == f"{c}{row.doc_id}" for c in CLASH if c not in gone)


def test_stages_on_awkward_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = docs.limit(1).selectExpr("explode(array(null, '', '   ', 'four', 'two words here')) AS text", "* except (text)").select(docs.columns)
    rows = docs.unionByName(odd.withColumn("doc_id", F.lit(10**9) + F.octet_length(F.coalesce("text", F.lit("xxxxxx"))))).unionByName(docs.limit(5)).unionByName(docs.limit(1).withColumn("text", F.repeat(F.lit("wort "), 300_000)).withColumn("doc_id", F.lit(2 * 10**9)))
    named = defaultdict(list)
    for r in rows.collect():
        named[r.doc_id].append(r.text)
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, rows, DATA).collect()
        ids = Counter(r.doc_id for r in out)
        assert all(n <= len(named[i]) for i, n in ids.items()), name
        if name != "language_id":
            assert 10**9 + 6 in ids and 10**9 in ids, name  # null and empty texts
        if name in ("language_id", "near_dedup", "decontamination"):
            assert all(r.text in named[r.doc_id] for r in out) and all(n == len(named[i]) for i, n in ids.items())
        assert f(spark, rows.limit(0), DATA).count() == 0, name


def test_a_text_of_many_words_goes_through_every_operator(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    long = docs.limit(1).withColumn("text", F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(200_000)), lambda k: F.concat(F.lit("wort"), F.conv(k.cast("string"), 10, 36))))).withColumn("doc_id", F.lit(10**9)).cache()
    rows = docs.limit(50).unionByName(long)
    bench, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("benchmark", "labels"))
    held = bench.limit(1).select(F.lit(1).alias("item_id"), F.lit(" ".join(long.first().text.split(" ")[5000:5060])).alias("text"))
    assert {r.id for r in find_leaks(rows.select("doc_id", "text"), held).collect()} == {10**9}
    assert quality.score_quality(rows, labels, F.col("source"), F.col("lang")).where("id = 1000000000").count() == 1
    assert language.identify(rows.select("doc_id", "text"), language.fit(docs)).where("doc_id = 1000000000").first().score > 0
    assert minhash.near_duplicates(rows.select("doc_id", "text")).where("doc_id = 1000000000").first().n_shingles == 200_000 - 4


def test_a_run_leaves_its_last_result_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{DATA}/{t}.parquet").limit(60).write.parquet(f"{tmp_path}/in/{t}.parquet")
    before = list(storage.MADE)
    out = corpus_pipeline.run(spark, f"{tmp_path}/in")
    left = storage.MADE[len(before):]
    assert out.count() > 0 and len(left) == 1 and "decontamination" in left[0] and storage.MADE[: len(before)] == before


def test_asked_windows_are_remembered_and_bounded(monkeypatch):
    a = substring.Asked()
    one, two = np.array([1, 5, 9], np.uint64), np.array([1, 1, 1], np.uint32)
    assert [a.often(one, two).tolist() for _ in range(3)] == [[False] * 3, [False] * 3, [True] * 3]
    assert a.often(np.array([5, 7], np.uint64), np.array([2, 1], np.uint32)).tolist() == [False, False]
    monkeypatch.setattr(substring.Asked, "MOST", 2)
    assert not a.often(np.array([3], np.uint64), np.array([1], np.uint32)).any() and len(a.one) <= 4
