"""Column helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,9)"


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys; it still plans as an equi-join."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join where a null key meets a null key; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(lambda a, b: a & b, (left[k].eqNullSafe(renamed[f"__{k}"]) for k in keys))
    out = left.join(renamed, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__{k}" for k in keys])


def currency(micros: Column) -> Column:
    """Millionths of a currency unit as an exact decimal."""
    return (micros.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast(MONEY)


def action_id(resource_name: Column) -> Column:
    """The number at the end of a resource name, null if there is none."""
    return F.regexp_extract(resource_name, r"/(\d+)$", 1).try_cast("bigint")


def ratio(top: Column, bottom: Column) -> Column:
    """Sum over sum; null where the bottom is zero or null."""
    return F.try_divide(top.cast("double"), F.nullif(bottom.cast("double"), F.lit(0.0)))


def flat(df: DataFrame) -> DataFrame:
    """Arrays and instants as text, for results that are compared or shown."""
    shown = {"array<string>": lambda c: F.array_join(c, ", "), "timestamp": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")}
    nested = lambda c, t: F.to_json(c).alias(c) if t.startswith("array<struct") else F.col(c)
    return df.select([shown[t](c).alias(c) if t in shown else nested(c, t) for c, t in df.dtypes])
