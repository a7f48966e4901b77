"""Pseudonyms for whole tables: the same id becomes the same number wherever it stands, in columns and inside strings.

A pseudonym is a function of seed, kind and old value alone, so tables rewritten apart still join. That no
two ids of a kind meet in one number is not taken for granted: the mapping of all tables tells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pseudonyms lie below this.
RANGE = 10**15
#: Collections of resource names, and the kind of their ids.
COLLECTIONS = {
    "customers": "account_id", "customerClients": "account_id", "campaigns": "campaign_id", "assetGroups": "asset_group_id", "assets": "asset_id", "conversionActions": "conversion_action_id",
    "campaignBudgets": "budget_id", "audiences": "audience_id", "assetGroupSignals": "asset_group_signal_id",
}
#: What stands before the number in place of a text.
LABELS = {
    "campaign_name": "Campaign", "asset_group_name": "AssetGroup", "asset_name": "Asset", "descriptive_name": "Account", "conversion_action_name": "Action", "text": "Headline",
    "video_title": "Video", "search_theme": "Theme", "audience": "Audience",
}
#: Fixed value: the letters of video ids.
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-"
_PAIR = f"({'|'.join(COLLECTIONS)})/([0-9]+)"


def number(value: Column, kind: Column | str, seed: str, below: int = RANGE) -> Column:
    """A number from 1 to `below` - 1 in place of a value: the first eight bytes of a digest, modulo `below`, one for zero. Null stays null."""
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.lit(kind) if isinstance(kind, str) else kind, value.cast("string")), 256)
    n = (F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)") % F.lit(below).cast("decimal(20,0)")).cast("bigint")
    return F.when(value.isNotNull(), F.when(n == 0, 1).otherwise(n))


def resource(text: Column, seed: str, below: int = RANGE) -> Column:
    """A string with the id of every `collection/id` pair in it replaced; all else stays as it is."""
    kinds = F.create_map(*[F.lit(x) for pair in COLLECTIONS.items() for x in pair])

    def new(pair: Column) -> Column:
        name, old = F.split_part(pair, F.lit("/"), F.lit(1)), F.split_part(pair, F.lit("/"), F.lit(2))
        return F.concat(name, F.lit("/"), number(old, F.element_at(kinds, name), seed, below).cast("string"))

    between, pairs = F.split(text, _PAIR, -1), F.regexp_extract_all(text, F.lit(_PAIR), F.lit(0))
    return F.array_join(F.zip_with(between, F.transform(pairs, new), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def label(text: Column, column: str, seed: str) -> Column:
    """`<Label> <number>` in place of a text, by the column that it stands in."""
    return F.concat(F.lit(LABELS.get(column, "Field") + " "), number(text, column, seed).cast("string"))


def url(text: Column, seed: str) -> Column:
    """An address of a made-up host, under the old path; an image keeps its ending and nothing else. Query and fragment go."""
    code = F.lower(F.hex(number(text, "url", seed)))
    path = F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    image = F.endswith(path, F.lit(".png")) | F.endswith(text, F.lit(".png"))
    return F.concat(F.lit("https://fixtures."), code, F.lit(".example"), F.when(image, F.concat(F.lit("/"), code, F.lit(".png"))).when(path == "", "/path").otherwise(path))


def video(text: Column, seed: str) -> Column:
    """Eleven letters in place of a video id, one for each of the first bytes of a digest."""
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.lit("video_id"), text), 256)
    at = lambda i: F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("int") % len(LETTERS)
    return F.when(text.isNotNull(), F.concat(*[F.substring(F.lit(LETTERS), at(i) + 1, F.lit(1)) for i in range(11)]))


def rewritten(df: DataFrame, seed: str, ids: list[str] = (), names: list[str] = (), texts: list[str] = (), urls: list[str] = (), videos: list[str] = ()) -> DataFrame:
    """The table with its ids, resource names, texts, addresses and video ids replaced. A text that is an address is treated as one."""
    address = lambda c: F.startswith(c, F.lit("http://")) | F.startswith(c, F.lit("https://"))
    new = {c: number(F.col(c), c, seed) for c in ids} | {c: resource(F.col(c), seed) for c in names} | {c: url(F.col(c), seed) for c in urls} | {c: video(F.col(c), seed) for c in videos}
    return df.withColumns(new | {c: F.when(address(F.col(c)), url(F.col(c), seed)).otherwise(label(F.col(c), c, seed)) for c in texts})


def mapping(tables: list[tuple[DataFrame, list[str], list[str]]], seed: str, below: int = RANGE) -> DataFrame:
    """(`kind`, `old`, `new`) of all ids of the tables, once each. A table comes with its id columns and its columns of resource names."""
    kinds = F.create_map(*[F.lit(x) for pair in COLLECTIONS.items() for x in pair])
    parts = []
    for df, ids, names in tables:
        found = [F.array(F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("old"))) for c in ids]
        for c in names:
            pairs = F.coalesce(F.regexp_extract_all(c, F.lit(_PAIR), F.lit(0)), F.array().cast("array<string>"))
            found.append(F.transform(pairs, lambda p: F.struct(F.element_at(kinds, F.split_part(p, F.lit("/"), F.lit(1))).alias("kind"), F.split_part(p, F.lit("/"), F.lit(2)).alias("old"))))
        parts.append(df.select(F.explode(F.concat(*found)).alias("p")).select("p.*"))
    known = reduce(DataFrame.unionByName, parts).where("old IS NOT NULL AND old <> ''").distinct()
    return known.select("kind", "old", number(F.col("old"), F.col("kind"), seed, below).alias("new"))


def clashes(mapped: DataFrame) -> DataFrame:
    """Pseudonyms that two ids of a kind share: (`kind`, `new`, `ids`, the smallest and the largest of them as text). None is what should come out."""
    return mapped.groupBy("kind", "new").agg(F.count_distinct("old").alias("ids"), F.min("old").alias("one"), F.max("old").alias("other")).where("ids > 1")
