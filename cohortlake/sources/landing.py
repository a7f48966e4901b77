"""Landed reports: newline JSON read under a fixed schema, kept by day, and scanned with filters that reach the files.

A line is taken or refused as a whole. It is refused if it is no JSON object, has a field that the schema
doesn't know, lacks the day, or a value doesn't fit its column's type; refused lines keep their text and
the reason, so that lines in = rows + refused lines.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.operators.staging import GRAINS, day_column, type_of

LINEAGE = ["run_id", "loaded_at", "query_hash"]
#: Metrics of the fact families.
VOLUME = ["impressions", "clicks", "cost_micros"]
CONVERSIONS = ["conversions", "conversions_value", "all_conversions", "all_conversions_value"]
NAMES = {"campaign": ["campaign_name"], "asset_group": ["asset_group_name"], "asset": []}


def family_columns(table: str) -> dict[str, str]:
    """Column -> type of a fact family, by the rules for names."""
    kind, grain = table.split("_", 1)
    own = [*LINEAGE, *GRAINS[table], *NAMES[grain], *(["conversion_action_name"] if kind != "volume" else []), day_column(table), *(VOLUME if kind == "volume" else []), *CONVERSIONS]
    return {c: type_of(c) for c in own}


def parsed(lines: DataFrame, columns: dict[str, str], day: str) -> DataFrame:
    """`value` with `row` (typed) and `reason`, null where the line is taken. Blank text is null, as in any landed value."""
    text = F.from_json("value", ", ".join(f"`{c}` string" for c in columns) + ", _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    # Whether the text is an object at all, and of which fields; a broken one has none.
    fields = F.json_object_keys("value")
    read = lines.select("value", text.alias("t"), fields.alias("fields"))
    given = {c: F.nullif(F.trim(F.col(f"t.`{c}`")), F.lit("")) for c in columns}

    def typed(c: str, kind: str) -> Column:
        return (F.substring(given[c], 1, 10) if kind == "date" else given[c]).try_cast(kind)

    unknown = F.array_except("fields", F.array(*map(F.lit, columns)))
    misfits = F.array_compact(F.array(*[F.when(given[c].isNotNull() & typed(c, kind).isNull(), F.lit(c)) for c, kind in columns.items()]))
    reason = (
        F.when(F.col("fields").isNull() | F.col("t._broken").isNotNull(), F.lit("no JSON object"))
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown field "), F.array_min(unknown)))
        .when(F.size(misfits) > 0, F.concat(F.lit("bad value in "), F.array_min(misfits)))
        .when(typed(day, columns[day]).isNull(), F.lit(f"no {day}")))
    return read.select("value", F.struct(*[typed(c, kind).alias(c) for c, kind in columns.items()]).alias("row"), reason.alias("reason"))


def read_landed(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a family's landed JSON files, and the lines that were refused with their reasons. Empty lines are no lines."""
    found = parsed(spark.read.text(path).where(F.trim("value") != ""), family_columns(table), day_column(table))
    return found.where("reason IS NULL").select("row.*"), found.where("reason IS NOT NULL").select("value", "reason")


def reconciled(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Lines by what became of them."""
    found = parsed(spark.read.text(path).where(F.trim("value") != ""), family_columns(table), day_column(table))
    return found.groupBy(F.coalesce("reason", F.lit("taken")).alias("outcome")).agg(F.count("*").alias("n"))


def in_window(df: DataFrame, day: str, start: dt.date, end: dt.date, channel: str | None = None) -> DataFrame:
    """Days from start to end, of one channel: on a table kept by day the days choose folders and the channel goes to the file reader."""
    out = df.where(F.col(day).between(F.lit(start), F.lit(end)))
    return out if channel is None else out.where(F.col("advertising_channel_type") == channel)


def on_days(df: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """Rows of the days that another table names. Which they are is known at run time only, and still only their folders are opened."""
    return df.join(days.select(F.col(days.columns[0]).alias(day)).distinct(), day, "left_semi")
