"""Sharding by longest processing time: groups of equal texts, largest first, to the least-loaded shard.

Groups of exactly equal size are interchangeable, so the rule needs only how many there are of each
size. The driver gets that histogram, runs the heap over it from the largest size down, a class of n
groups moving through it in runs, and knows how many groups of each size every shard takes: the same
loads as if each group had gone through the heap by itself. Within a size, groups are then numbered
in parallel, by slices of their hash, and take their shard by number.

The histogram has one row per distinct size. As sizes are distinct whole numbers that sum to no more
than all bytes, there are at most sqrt(2 * bytes) of them, and no more than the longest group has bytes.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import written

#: Groups of one size, and rows of one shard, are numbered in this many parts by hash, at least.
PARTS = 512
#: Groups that hold at least this part of all rows, so no more than HOT of them, meet their rows by broadcast.
HOT = 1024


def longest_first(items: list[tuple[int, int, object]], shards: int) -> dict[object, list[tuple[int, int]]]:
    """Place items (size, count, key): for each key the runs (shard, how many), in the order they are dealt."""
    heap = [(0, s) for s in range(shards)]
    out: dict[object, list[tuple[int, int]]] = {}
    for size, count, key in sorted(items, key=lambda x: (-x[0], str(x[2]))):
        runs = out.setdefault(key, [])
        # Whole rounds over all shards first, once the loads are within one item of each other.
        while count:
            load, shard = heapq.heappop(heap)
            ahead = heap[0][0] if heap else load
            level = max(x for x, _ in heap) if heap else load
            if count > 4 * shards and level - load <= size:
                each = count // shards - 1
                heapq.heappush(heap, (load, shard))
                heap = [(x + each * size, s) for x, s in heap]
                heapq.heapify(heap)
                runs += [(s, each) for _, s in sorted(heap, key=lambda x: x[1])]
                count -= each * shards
                continue
            take = min(count, max(1, int((ahead - load) // size) if size else count))
            runs.append((shard, take))
            heapq.heappush(heap, (load + take * size, shard))
            count -= take
    return out


def _deals(histogram: DataFrame, shards: int) -> pa.Table:
    """For each size the shards that take groups of it, and up to which number each does."""
    placed = longest_first([(r["bytes"], r["n"], r["bytes"]) for r in histogram.toLocalIterator()], shards)
    sizes, takers, upto = [], [], []
    for size, runs in placed.items():
        total: dict[int, int] = {}
        for shard, n in runs:
            total[shard] = total.get(shard, 0) + n
        at, ends = 0, []
        for n in total.values():
            at += n
            ends.append(at)
        sizes.append(size)
        takers.append(list(total))
        upto.append(ends)
    return pa.table({"bytes": pa.array(sizes, pa.int64()), "takers": pa.array(takers, pa.list_(pa.int32())), "upto": pa.array(upto, pa.list_(pa.int64()))})


def assign_shards(docs: DataFrame, shards: int = 8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add size, text_crc32, law, shard, slot and grown_shard to every row, without its text.

    Size is the text's UTF-8 bytes plus one; a null text has size one and no checksum, and null texts
    are one group. The law is `bytes`: loads are as near to equal as longest-first makes them, so a
    group of more than a shard's share has a shard of its own. Slots count a shard's rows from 0
    without gaps, repeated rows included. `grown_shard` is null under this law. Input columns of the
    new names go, all others stay, whatever their names. An empty table gives an empty result.
    """
    new = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    keep = [c for c in docs.columns if c not in new and c != text]
    spark = docs.sparkSession
    parts = max(PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    t = F.col(f"`{text}`")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{id}`").alias("id"),
        (F.coalesce(F.octet_length(t), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(t).alias("crc"), F.unhex(F.coalesce(F.sha2(t, 256), F.lit(""))).alias("group"),
    )
    groups = written(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count("*").alias("copies")), "groups")
    deals = spark.createDataFrame(_deals(groups.groupBy("bytes").agg(F.count("*").alias("n")), shards))
    sliced = groups.withColumn("slice", F.pmod(F.xxhash64("group"), F.lit(parts)))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("bytes").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = sliced.groupBy("bytes", "slice").agg(F.count("*").alias("n")).withColumn("before", before).join(deals, "bytes").drop("n")
    number = F.row_number().over(Window.partitionBy("bytes", "slice").orderBy("group")) - 1
    ranked = sliced.withColumn("number", number).join(begins, ["bytes", "slice"]).withColumn("at", F.col("number") + F.col("before"))
    placed = written(ranked.select("group", "copies", F.expr("element_at(takers, size(filter(upto, x -> x <= at)) + 1)").alias("shard")), "placed")
    total = placed.agg(F.sum("copies")).first()[0] or 0
    hot = placed.where(F.col("copies") * HOT >= total).select("group", "shard")
    rest = placed.where(F.col("copies") * HOT < total).select("group", F.col("shard").alias("other"))
    # A hot group's rows never meet in one task: they get their shard where they are, and take no part in the join by group.
    marked = rows.join(F.broadcast(hot), "group", "left")
    joined = marked.where("shard IS NULL").drop("shard").join(rest.withColumnRenamed("other", "shard"), "group")
    out = written(marked.where("shard IS NOT NULL").unionByName(joined).drop("group"), "sharded")
    out = out.withColumn("part", F.pmod(F.xxhash64(F.lit(3), "id", "crc"), F.lit(parts)))
    counts = out.groupBy("shard", "part").agg(F.count("*").alias("n"))
    first = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "crc")) - 1
    # `starts` has at most shards * parts rows.
    starts = counts.select("shard", "part", first.alias("first"))
    return (
        out.withColumn("place", place).join(F.broadcast(starts), ["shard", "part"])
        .select(*[F.col(f"row.`{c}`").alias(c) for c in keep], "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("place") + F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
