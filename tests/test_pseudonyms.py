"""Pseudonyms: the same id everywhere, addresses, video ids, and a check that no two ids meet."""

import hashlib

from pyspark.sql import functions as F

from cohortlake.operators import pseudonyms


def number(kind, old, below=10**15):
    return int.from_bytes(hashlib.sha256(f"7:{kind}:{old}".encode()).digest()[:8], "big") % below or 1


def column(spark, make, *values):
    df = spark.createDataFrame(list(enumerate(values)), "k int, v string").select("k", make(F.col("v")).alias("v"))
    return [r.v for r in df.orderBy("k").collect()]


def test_ids_inside_names_are_those_of_columns(spark):
    a, c, x = number("account_id", 5), number("campaign_id", 5), number("conversion_action_id", "007")
    cases = {
        "customers/5/campaigns/5": f"customers/{a}/campaigns/{c}", "customers/5": f"customers/{a}", "see customers/5, campaigns/5 (campaigns/x)": f"see customers/{a}, campaigns/{c} (campaigns/x)",
        "customers/5/conversionActions/007/": f"customers/{a}/conversionActions/{x}/", "nothing": "nothing", "": "", "assets/": "assets/", "5": "5", None: None,
    }
    assert column(spark, lambda v: pseudonyms.resource(v, "7"), *cases) == list(cases.values())


def test_joins_keep_their_rows(spark):
    facts = spark.range(60).selectExpr("id % 7 AS account_id", "concat('customers/', id % 5, '/assets/', id % 3) AS resource_name", "id % 3 AS asset_id")
    links = spark.range(9).selectExpr("id % 5 AS account_id", "concat('customers/', id % 5, '/assets/', id % 3) AS resource_name")
    new = [pseudonyms.rewritten(df, "7", [c for c in ("account_id", "asset_id") if c in df.columns], ["resource_name"]) for df in (facts, links)]
    for keys in (["account_id"], ["resource_name"], ["account_id", "resource_name"]):
        assert facts.join(links, keys).count() == new[0].join(new[1], keys).count() > 0
    assert new[0].where(F.split_part("resource_name", F.lit("/"), F.lit(4)).cast("bigint") != F.col("asset_id")).count() == 0


def test_a_planted_clash_is_reported(spark):
    df = spark.createDataFrame([(k, f"customers/{k % 40}/assets/{k}") for k in range(200)] + [(None, None)], "campaign_id long, name string")
    tables = [(df, ["campaign_id"], ["name"]), (df.limit(50), ["campaign_id"], [])]
    m = pseudonyms.mapping(tables, "7")
    assert m.groupBy("kind").count().orderBy("kind").collect() == [("account_id", 40), ("asset_id", 200), ("campaign_id", 200)]
    assert pseudonyms.clashes(m).count() == 0
    small = {}
    for k in range(200):
        small.setdefault(("campaign_id", number("campaign_id", k, 500)), []).append(str(k))
    got = {(r.kind, r.new): (r.ids, r.one, r.other) for r in pseudonyms.clashes(pseudonyms.mapping(tables[1:] + [(df, ["campaign_id"], [])], "7", 500)).collect()}
    assert got == {k: (len(v), min(v), max(v)) for k, v in small.items() if len(v) > 1} and got


def test_addresses_texts_and_videos(spark):
    code = lambda u: f"{number('url', u):x}"
    urls = ["https://a.b/c/d?q=1#f", "http://a.b", "https://a.b/", "https://a.b/x/y.png", "https://a.b/x?f=z.png", "https://a.b/x.png?w=2", None]
    want = [f"https://fixtures.{code(u)}.example" + t for u, t in zip(urls, ["/c/d", "/path", "/", f"/{code(urls[3])}.png", f"/{code(urls[4])}.png", f"/{code(urls[5])}.png"])] + [None]
    assert column(spark, lambda v: pseudonyms.url(v, "7"), *urls) == want
    videos = column(spark, lambda v: pseudonyms.video(v, "7"), "abc", "abd", "", None)
    assert videos[3] is None and all(len(v) == 11 and set(v) <= set(pseudonyms.LETTERS) for v in videos[:3]) and len(set(videos[:3])) == 3
    df = spark.createDataFrame([("Our best offer", "https://a.b/", "Secret name")], "text string, headline string, other string")
    row = pseudonyms.rewritten(df, "7", texts=["text", "headline", "other"]).first()
    assert tuple(row) == (f"Headline {number('text', 'Our best offer')}", f"https://fixtures.{code('https://a.b/')}.example/", f"Field {number('other', 'Secret name')}")
