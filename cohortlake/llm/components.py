"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written

#: Tasks that the rows of one key are spread over.
SALTS = 8


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def looked_up(rows: DataFrame, facts: DataFrame, key: str, value: str, spread: str) -> DataFrame:
    """`rows` with `value` of their `key`, null where `facts` lacks it.

    `facts` has one row for each key. Each is there once for every salt, rows take one by `spread`: so
    no key puts all its rows into one task, whatever its share.
    """
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt")
    met = rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS))).join(facts.select(key, value, salts), [key, "salt"], "left")
    return met.select(*rows.columns, value)


def _lowest(e: DataFrame) -> DataFrame:
    """`e` (u, v) with `m`, the smallest v of each u; minima are partial in each task first."""
    return looked_up(e, e.groupBy("u").agg(F.min("v").alias("m")), "u", "m", "v")


def components(links: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """(`u`, `v`): each vertex of a link other than its component's smallest, with that smallest.

    Links are pairs of longs in any order, repeats allowed; links of a vertex to itself are ignored.
    Each round is two groupings and two joins; rounds grow with the logarithm of the diameter. A hub's
    links are spread over tasks. The state is written to the shared folder after each round.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = written(e, "links")
    before = _mark(e)
    for _ in range(most):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _lowest(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        met = _lowest(large)
        small = met.select("u", F.col("m").alias("v")).unionByName(met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        e = written(small, "links")
        now = _mark(e)
        if now == before:
            return e
        before = now
    raise RuntimeError("components did not settle")
