"""Approximate nearest neighbours by inner product: a k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every vector is filed under the leaf that a greedy descent
reaches. Vectors get one more coordinate that makes their lengths equal, so the nearest centre is
also the one of the largest inner product. A query walks the tree through a priority queue and opens
leaves in the order of their centres' nearness; how many it opens is calibrated on the sample: leaf
visits are widened until the wanted recall against brute force is reached.

Equal vectors are one entry with their smallest ids, equal queries are one query: no number of copies
makes a leaf or a query heavier, and nothing is lost, as more copies than `k` + 1 can't all be asked for.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import written
from .textcore import ragged

#: Vectors to fit on: one in FIT_SHARE, within these bounds; sample rows in a leaf at most, children of a node.
#: So leaves grow in number with the table up to the upper bound, and in size only beyond it.
FIT_SHARE, FIT_ROWS, MOST_FIT_ROWS, LEAF_ROWS, BRANCHES = 50, 20_000, 400_000, 400, 8
#: Vectors of the sample that queries take their floor from.
FLOOR_ROWS = 20_000
#: Recall wanted on the sample, queries of the calibration, rows and queries that meet in one task group.
RECALL, PROBES, CHUNK = 0.98, 256, 4096
#: Queries with at least this part of all queries as copies are hot.
COPIES = 256


@dataclass
class Tree:
    centres: np.ndarray  # one per node, with the extra coordinate
    children: list[list[int]]
    leaf: np.ndarray  # node -> leaf number or -1
    longest: float
    sample: np.ndarray
    visits: int = 1

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        rest = np.maximum(self.longest**2 - (x * x).sum(1), 0)
        return np.concatenate([x, np.sqrt(rest)[:, None]], 1)

    def file(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        y, at = self.lifted(x), np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                at[rows] = self.leaf[node]
                continue
            c = self.centres[kids]
            pick = ((c * c).sum(1)[None] - 2 * y[rows] @ c.T).argmin(1)
            todo += [(k, rows[pick == i]) for i, k in enumerate(kids) if (pick == i).any()]
        return at

    def floor(self, q: np.ndarray, k: int, opened: list[list[int]]) -> np.ndarray:
        """For each query a nearness that at least k vectors in its opened leaves reach: of the sample's vectors there, the k-th."""
        out = np.full(len(q), -np.inf)
        if len(self.sample) >= k:
            at = self.file(self.sample)
            for i in range(0, len(q), 256):
                s = q[i : i + 256] @ self.sample.T
                seen = np.zeros((len(s), self.leaves), bool)
                for row, o in zip(seen, opened[i : i + 256]):
                    row[o] = True
                s[~seen[:, at]] = -np.inf
                out[i : i + 256] = np.partition(s, -k, axis=1)[:, -k]
        return np.where(np.isfinite(out), out - 1e-9 * np.maximum(1.0, np.abs(out)), -np.inf)

    def bins(self, q: np.ndarray, sizes: np.ndarray, least: int, visits: int) -> list[list[int]]:
        """For each query the leaves to open, best first: `visits` of them, more while they hold fewer than `least` vectors."""
        q = np.concatenate([q.astype(np.float64), np.zeros((len(q), 1))], 1)
        cost = (self.centres * self.centres).sum(1)[None] - 2 * q @ self.centres.T
        out = []
        for row in cost.tolist():
            queue, opened, held = [(row[0], 0)], [], 0
            while queue and (len(opened) < visits or held < least):
                _, node = heapq.heappop(queue)
                if self.children[node]:
                    for k in self.children[node]:
                        heapq.heappush(queue, (row[k], k))
                elif sizes[self.leaf[node]]:
                    opened.append(int(self.leaf[node]))
                    held += int(sizes[self.leaf[node]])
            out.append(opened)
        return out


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = ((c * c).sum(1)[None] - 2 * x @ c.T).argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        sums[n > 0] = np.add.reduceat(x[np.argsort(near, kind="stable")], (np.cumsum(n) - n)[n > 0], axis=0)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c, ((c * c).sum(1)[None] - 2 * x @ c.T).argmin(1)


def fit_tree(sample: np.ndarray, k: int, seed: int = 5, recall: float = RECALL) -> Tree:
    """Grow the tree on the sample's distinct vectors and calibrate the number of leaf visits."""
    rng = np.random.default_rng(seed)
    sample = np.unique(sample.astype(np.float64), axis=0)
    longest = float(np.sqrt((sample * sample).sum(1).max())) if len(sample) else 1.0
    tree = Tree(np.zeros((1, (sample.shape[1] if sample.ndim == 2 else 0) + 1)), [[]], np.zeros(1, np.int64), longest, sample)
    y = tree.lifted(sample) if len(sample) else np.zeros((0, 1))
    centres, children, leaf, leaves = [y.mean(0) if len(y) else np.zeros(1)], [[]], [-1], 0
    todo = [(0, np.arange(len(y)))]
    while todo:
        node, rows = todo.pop(0)
        if len(rows) <= LEAF_ROWS:
            leaf[node], leaves = leaves, leaves + 1
            continue
        c, near = _kmeans(y[rows], min(BRANCHES, len(rows)), rng)
        if len(np.unique(near)) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        for i in np.unique(near):
            centres.append(c[i]), children.append([]), leaf.append(-1)
            children[node].append(len(centres) - 1)
            todo.append((len(centres) - 1, rows[near == i]))
    tree = Tree(np.array(centres), children, np.array(leaf), longest, sample[rng.permutation(len(sample))[:FLOOR_ROWS]])
    if len(sample) > k + 1:
        filed = tree.file(sample)
        sizes = np.bincount(filed, minlength=tree.leaves)
        chosen = rng.choice(len(sample), min(PROBES, len(sample)), replace=False)
        probes = sample[chosen]
        near = probes @ sample.T
        near[np.arange(len(chosen)), chosen] = -np.inf  # a probe isn't its own neighbour
        truth = np.argsort(-near, 1)[:, :k]
        order = tree.bins(probes, sizes, len(sample), tree.leaves)
        place = np.full((len(probes), tree.leaves), tree.leaves)
        for i, o in enumerate(order):
            place[i, o] = np.arange(len(o))
        found = np.take_along_axis(place, filed[truth], 1)
        visits = 1
        while visits < tree.leaves and (found < visits).mean() < recall:
            visits += max(1, visits // 8)
        tree.visits = min(visits, tree.leaves)
    return tree


def nearest(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20, fit_rows: int | None = None, recall: float = RECALL) -> DataFrame:
    """The `k` nearest found of each query: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by `every`, candidates all rows but the query's own.
    Nearness is the largest inner product in double precision, ties go to the smaller id. Vectors that
    are null, zero, or hold null or non-finite components take no part, nor do those of another
    dimension than the largest number of vectors has; a row without an id neither. Rows equal in id and vector count once.
    `fit_rows` vectors, by default one in FIT_SHARE within bounds, fit the tree; all are filed and searched.
    """
    spark = vectors.sparkSession
    v, a = F.col(f"`{vector}`"), F.col(f"`{id}`")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    clean = vectors.select(a.cast("long").alias("id"), v.cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL").where(fine)
    sizes = clean.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    shape = "query_id bigint, rank int, vec_id bigint, score double"
    if sizes is None:
        return spark.createDataFrame([], shape)
    clean = clean.where(F.size("v") == sizes["d"])
    # Entries: distinct vectors with their k + 1 smallest ids; a task sends no more than that of each vector.
    copies = Window.partitionBy("v").orderBy("id")
    few = clean.distinct().withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k + 1)
    entries = written(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    fit_rows = fit_rows or min(MOST_FIT_ROWS, max(FIT_ROWS, sizes["count"] // FIT_SHARE))
    share = min(1.0, fit_rows / max(1, sizes["count"]))
    sample = entries.where(F.pmod(F.xxhash64(F.lit(3), F.col("ids")[0]), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("v")
    rows = [r.v for r in sample.toLocalIterator()]  # about fit_rows vectors
    tree = spark.sparkContext.broadcast(fit_tree(np.array(rows, np.float64).reshape(len(rows), sizes["d"]), k, recall=recall))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.value.file(x))], names=["v", "ids", "leaf"])

    filed = written(entries.mapInArrow(file, "v array<double>, ids array<bigint>, leaf bigint"), "filed")
    # At most about fit_rows / LEAF_ROWS * BRANCHES leaves.
    held = np.zeros(tree.value.leaves, np.int64)
    for r in filed.groupBy("leaf").count().toLocalIterator():
        held[r["leaf"]] = r["count"]

    asked = clean.where(F.col("id") % every == 0)
    grouped = asked.groupBy("v").agg(F.min("id").alias("q"), F.count_distinct("id").alias("copies"))
    queries = grouped.select("v", "q")
    parts = np.maximum(1, -(-held // CHUNK))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query once for each chunk of each leaf it opens."""
        for b in batches:
            x = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1)
            opened = tree.value.bins(x, held, 4 * (k + 1), tree.value.visits)
            floor = tree.value.floor(x, k + 1, opened)
            at = [(i, leaf, c) for i, o in enumerate(opened) for leaf in o for c in range(parts[leaf])]
            if at:
                i, leaf, c = (np.array(z, np.int64) for z in zip(*at))
                for s in range(0, len(i), 20_000):
                    t = slice(s, s + 20_000)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(i[t])), b.column(1).take(pa.array(i[t])), pa.array(leaf[t]), pa.array(c[t]), pa.array(floor[i[t]])], names=["v", "q", "leaf", "chunk", "floor"])

    # Leaves with many queries are met in several groups: queries by slice, each with the leaf's chunks.
    n_queries = max(1, asked.count())
    slices = max(1, math.ceil(n_queries * tree.value.visits / max(1, tree.value.leaves) / CHUNK))
    sent = queries.mapInArrow(spread, "v array<double>, q bigint, leaf bigint, chunk bigint, floor double").withColumn("slice", F.pmod(F.xxhash64("q"), F.lit(slices)))
    chunked = filed.withColumn("chunk", F.pmod(F.xxhash64(F.lit(9), F.col("ids")[0]), F.element_at(F.array(*[F.lit(int(p)) for p in parts]), (F.col("leaf") + 1).cast("int"))) if parts.max() > 1 else F.lit(0).cast("long"))
    chunked = chunked.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).withColumn("slice", F.col("slice").cast("long"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            x = right.column("v").combine_chunks().flatten().to_numpy().reshape(right.num_rows, -1)
            lists = right.column("ids").combine_chunks()
            ids, counts = lists.flatten().to_numpy(), np.asarray(lists.value_lengths())
            first = np.cumsum(counts) - counts
            y = left.column("v").combine_chunks().flatten().to_numpy().reshape(left.num_rows, -1)
            names, floor = left.column("q").to_numpy(), left.column("floor").to_numpy()
            for s in range(0, len(y), 256):
                score = y[s : s + 256] @ x.T
                hit = score >= floor[s : s + 256, None]
                # Of a leaf's chunk no more than k + 1 entries, and those that tie with the last, can matter.
                many = np.flatnonzero(hit.sum(1) > k + 1)
                if len(many):
                    hit[many] = score[many] >= np.partition(score[many], -(k + 1), axis=1)[:, -(k + 1)][:, None]
                r, c = np.nonzero(hit)
                out.append((np.repeat(names[s + r], counts[c]), ids[ragged(first[c], counts[c])], np.repeat(score[r, c], counts[c])))
        q, i, z = (np.concatenate([o[n] for o in out]) for n in range(3)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"q": pa.array(q), "id": pa.array(i), "score": pa.array(z)})

    key = ["leaf", "chunk", "slice"]
    met = sent.groupBy(*key).cogroup(chunked.groupBy(*key)).applyInArrow(meet, "q bigint, id bigint, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    met = met.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    # Copies of a query share its answer. No more than COPIES queries have that share of them: their copies and answers meet by broadcast.
    same = asked.select("id", "v").distinct()
    hot = grouped.where(F.col("copies") * COPIES >= n_queries).select("v", F.col("q").alias("h"))
    named = same.join(F.broadcast(hot), "v", "left")
    few = named.where("h IS NULL").join(grouped.where(F.col("copies") * COPIES < n_queries).select("v", "q"), "v").select(F.col("id").alias("query_id"), "q")
    many = named.where("h IS NOT NULL").select(F.col("id").alias("query_id"), F.col("h").alias("q"))
    met = met.withColumnRenamed("id", "vec")
    answers = met.join(F.broadcast(hot.select(F.col("h").alias("q"))), "q", "left_semi")
    full = few.join(met, "q").unionByName(many.join(F.broadcast(answers), "q")).withColumnRenamed("vec", "id").where("id <> query_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return full.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
