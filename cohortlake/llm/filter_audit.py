"""How filters interact: what each step of every order of filters removes, and which filter would have done it anyway.

A document is known by the set of filters that it fails, so all that counts is a table of documents per
part and failure mask: at most 32 cells for five filters. One walk over the 32 subsets of filters in Gray
code order toggles a single filter at a time. Each cell keeps how many active filters it fails; it leaves
the running survivors when that goes from none to one and comes back when it goes from one to none. The
survivors of the 32 states are stored, and every step of every order is the difference of two of them.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import small_batches
from .textcore import buffers, groups

#: Filters by their letter; the last one looks at other documents, the others at a text alone.
LETTERS = "ABCDE"
COPY = 1 << 4
_UPPER, _MARKS, _TAIL = bytes(range(65, 91)), b"#$%&*|", bytes(range(128, 192))


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text in UTF-8 fails."""
    words = text.split()  # bytes split at exactly 0x20 and 0x09-0x0D
    n, size = len(words), len(text)
    short = n < 200
    few = 100 * len(set(words)) < 50 * n
    loud = 100 * (size - len(text.translate(None, _UPPER))) > 3 * len(text.translate(None, _TAIL))
    marked = len(text.translate(None, _MARKS)) < size
    return short | few << 1 | loud << 2 | marked << 3


def masks(docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per row: `id`, `part` (null: empty), `digest` of the text (null: that of an empty one), `mask` of filters A to D."""
    small_batches(docs.sparkSession)
    base = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.col(f"`{text}`").cast("binary").alias("text"))
    id_type = base.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in groups(buffers(b.column(2))[1]):
                texts = [t.as_py() or b"" for t in b.column(2).slice(i, j - i)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array(map(text_mask, texts), pa.int32())],
                    names=["id", "part", "digest", "mask"])

    return base.mapInArrow(run, f"id {id_type}, part string, digest binary, mask int")


def cells(rows: DataFrame, labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """Documents, good and toxic ones by part and full mask. `rows` are those of `masks`.

    A row is a copy if a smaller id has its text; no row meets another. Rows are counted by id first,
    then by text, where the smallest id of a group travels along; so a text that a third of all rows
    share is a few partial sums by the time it meets in one task.
    """
    flags = labels.groupBy(F.col(f"`{id}`").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    own = rows.groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("c")).join(flags, "id", "left")
    by = ["digest", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")]
    named = F.col("id").isNotNull()
    low = F.min(F.when(named, F.struct("id", "c")))
    near = own.groupBy(*by).agg(F.sum("c").alias("n"), low.alias("low"), F.sum(F.when(named, 0).otherwise(F.col("c"))).alias("nameless"))
    lowest = F.min("low.id").over(Window.partitionBy("digest"))  # one row for each part, mask and label of a text
    first = F.when(F.col("low.id") == F.col("lowest"), F.col("low.c")).otherwise(0) + F.col("nameless")
    split = F.explode(F.array(F.struct(F.col("mask").alias("m"), F.col("first").alias("n")), F.struct((F.col("mask") + COPY).alias("m"), (F.col("n") - F.col("first")).alias("n")))).alias("x")
    out = near.withColumn("lowest", lowest).withColumn("first", first).select("part", "good", "toxic", split)
    count = F.sum("x.n")
    return out.groupBy("part", F.col("x.m").alias("mask")).agg(count.alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic")).where("n > 0")


def walk(mask: np.ndarray, counts: np.ndarray, filters: int = len(LETTERS)) -> np.ndarray:
    """Survivors under each subset of active filters. `counts` has a row for each cell, and any number of columns."""
    states = np.zeros((1 << filters, counts.shape[1]), np.int64)
    failing = np.zeros(len(mask), np.int64)
    left = counts.sum(0)
    states[0], active = left, 0
    for step in range(1, 1 << filters):
        f = (step & -step).bit_length() - 1  # in Gray code the lowest set bit of the step's number is what toggles
        active ^= 1 << f
        hit = (mask >> f & 1).astype(bool)
        if active >> f & 1:
            left = left - counts[hit & (failing == 0)].sum(0)
            failing += hit
        else:
            failing -= hit
            left = left + counts[hit & (failing == 0)].sum(0)
        states[active] = left
    return states


#: Every order, and for each of its steps the filter, the subset before it and the one after.
ORDERS = ["".join(p) for p in itertools.permutations(LETTERS)]
_FILTER = np.array([[LETTERS.index(x) for x in o] for o in ORDERS])
_AFTER = np.cumsum(1 << _FILTER, axis=1)
_BEFORE = _AFTER - (1 << _FILTER)


def steps(mask: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Numbers of all steps of all orders (orders x steps), from a part's cells; columns of `counts` are all, good, toxic."""
    states = walk(mask, counts)
    removed = states[_BEFORE] - states[_AFTER]
    failing = np.array([counts[(mask >> f & 1) > 0, 0].sum() for f in range(len(LETTERS))])
    alone = np.array([counts[mask == 1 << f, 0].sum() for f in range(len(LETTERS))])
    shapley = np.zeros(len(LETTERS), np.int64)
    np.add.at(shapley, _FILTER.reshape(-1), removed[:, :, 0].reshape(-1))
    return {
        "kept": states[_AFTER][:, :, 0], "removed": removed[:, :, 0], "redundant": failing[_FILTER] - removed[:, :, 0], "unique_fails": alone[_FILTER],
        "good_lost": removed[:, :, 1], "toxic_lost": removed[:, :, 2], "shapley": shapley[_FILTER],
    }


def audit(table: DataFrame) -> DataFrame:
    """600 rows for each part of the table that `cells` gives: every step of every order of the five filters."""
    packed = table.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # at most 32
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    size = _FILTER.size
    order = pa.array(np.repeat(ORDERS, len(LETTERS)).tolist(), pa.string())
    step = pa.array(np.tile(np.arange(1, len(LETTERS) + 1, dtype=np.int32), len(ORDERS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, found in zip(b.column(0), b.column(1)):
                own = found.values
                got = steps(own.field("mask").to_numpy(), np.stack([own.field(c).to_numpy() for c in ("n", "good", "toxic")], 1))
                yield pa.RecordBatch.from_arrays([pa.array([part.as_py()] * size, pa.string()), order, step, *(pa.array(got[c].reshape(-1).astype(np.int64)) for c in names)], names=["part", "filter_order", "step", *names])

    return packed.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in names))


def filter_interactions(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per part, order of the filters A to E and step: `kept`, `removed`, `redundant`, `unique_fails`, `good_lost`, `toxic_lost`, `shapley`.

    A: fewer than 200 words; B: less than half of the words distinct; C: more than 3 capitals in 100
    characters; D: one of `#$%&*|`; E: a smaller id has the same text, in whatever part. Null texts
    are empty; an empty text fails A, and E like any other. A null part is the empty one. Repeated rows of
    an id count each, and none is another's copy. A row without an id is nobody's copy and nobody's
    original. Of several labels of an id any 1 counts; unlabelled documents are neither good nor
    toxic. Other columns are not looked at. An empty table has no parts, so no rows.
    """
    return audit(cells(masks(docs, id, text, part), labels, id))
