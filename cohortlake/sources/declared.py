"""Tables declared before they have rows: typed columns, days as folders, rows of a key in one bucket and in order.

Tables that are clustered alike join, group and rank by their keys where they lie, without an exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Layout:
    columns: dict[str, str]
    keys: tuple[str, ...]
    buckets: int
    order: tuple[str, ...] = ()
    partition: str | None = None


def declare(spark: SparkSession, name: str, layout: Layout, location: str) -> DataFrame:
    """An empty table of this layout; it answers with its schema at once."""
    columns = ", ".join(f"`{c}` {t}" for c, t in layout.columns.items())
    by = f"PARTITIONED BY (`{layout.partition}`)" if layout.partition else ""
    listed = lambda names: ", ".join(f"`{c}`" for c in names)
    order = f"SORTED BY ({listed(layout.order)})" if layout.order else ""
    spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet {by} CLUSTERED BY ({listed(layout.keys)}) {order} INTO {layout.buckets} BUCKETS LOCATION '{location}'")
    return spark.table(name)


def fill(df: DataFrame, name: str, layout: Layout) -> DataFrame:
    """Append rows. They are dealt as the buckets are, so that a task writes one bucket and a bucket's day is one file."""
    spark = df.sparkSession
    check(spark, name, layout)
    df.repartition(layout.buckets, *layout.keys).select(spark.table(name).columns).write.insertInto(name)
    return spark.table(name)


def check(spark: SparkSession, name: str, layout: Layout) -> None:
    """Refuse a table that isn't laid out as it should be: appended to, it would be neither one layout nor the other."""
    said = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED `{name}`").collect()}
    named = lambda text: tuple(x.strip(" `[]") for x in (text or "").split(",") if x.strip(" `[]"))
    found = (dict(spark.table(name).dtypes), named(said.get("Bucket Columns")), int(said.get("Num Buckets", 0)), named(said.get("Sort Columns")))
    wanted = (layout.columns, layout.keys, layout.buckets, layout.order)
    if found != wanted:
        raise ValueError(f"{name} is laid out as {found[1:]}, not as {wanted[1:]}, or has other columns")
