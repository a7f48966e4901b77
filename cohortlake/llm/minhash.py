"""Near-duplicate groups by min-max hashing.

Every permutation of the shingle hashes gives two signature values, its minimum and its maximum, so
`PERMUTATIONS` evaluations make twice as many values. Values are banded; texts that agree in a whole
band are candidates, and candidates become links only by comparing their full shingle sets.

Equal word sequences are one node from the start. In the first phase each node is compared with one
pivot, of its buckets' most connected members the most connected. That already unites groups of copies, so
the second phase only looks at nodes that share a bucket with another component. All nodes that such
buckets connect are compared in blocks, exactly, and only links that unite components become rows.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, looked_up
from .storage import small_batches, written
from .textcore import buffers, groups, lowered, mix, normal, powers, ragged, rolled, spans, word_hashes

SHINGLE, NUMERATOR, DENOMINATOR = 5, 75, 100
PERMUTATIONS, ROWS = 64, 4
#: Nodes in a block of the second phase, shingles in one of its products.
BLOCK, WIDE = 1024, 4096
_A, _B = 0x9E6C63D0876A9A47 | 1, 0xC2B2AE3D27D4EB4F
_FACTORS = mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _whole(h: np.ndarray, first: np.ndarray, base: int) -> np.ndarray:
    """A hash of each text's whole word sequence."""
    c = np.empty(len(h) + 1, np.uint64)
    c[0] = 0
    np.cumsum(h * powers(base, len(h) + 1)[:-1], out=c[1:])
    n = np.diff(first)
    return mix((c[first[1:]] - c[first[:-1]]) * powers(pow(base, -1, 1 << 64), len(h) + 1)[first[:-1]] + n.astype(np.uint64))


def digests(buf: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """A cryptographic digest of each text's word sequence in lower case."""
    buf = lowered(buf)
    starts, ends, first = spans(buf, offsets)
    text, a, e = normal(buf, starts, ends)
    view = memoryview(text)
    return [hashlib.blake2b(view[a[i] : e[j - 1]] if j > i else b"", digest_size=16).digest() for i, j in zip(first[:-1], first[1:])]


def shingles(buf: np.ndarray, offsets: np.ndarray, size: int = SHINGLE, key: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes text by text, and n+1 offsets into them.

    A text with fewer than `size` words has its whole sequence as its only shingle; without words none.
    """
    buf = lowered(buf)
    starts, ends, first = spans(buf, offsets)
    h = word_hashes(buf, starts, ends, key)
    words = np.diff(first)
    counts = np.where(words >= size, words - size + 1, (words > 0).astype(np.int64))
    edge = np.concatenate([[0], np.cumsum(counts)])
    one = _whole(h, first, _A)
    out = np.empty(int(edge[-1]), np.uint64)
    long = words >= size
    rolling = rolled(h, size, _A)
    out[ragged(edge[:-1][long], counts[long])] = rolling[ragged(first[:-1][long], counts[long])]
    short = (words > 0) & ~long
    out[edge[:-1][short]] = mix(one[short] + np.uint64(size))
    return out, edge


def _keyed(h: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, int]:
    """Sorted distinct (text, hash) keys: the text's number in the high bits."""
    n = len(edge) - 1
    bits = max(1, int(n).bit_length())
    keys = (h >> np.uint64(bits)) | (np.repeat(np.arange(n, dtype=np.uint64), np.diff(edge)) << np.uint64(64 - bits))
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys, 64 - bits


def distinct_counts(h: np.ndarray, edge: np.ndarray) -> np.ndarray:
    keys, shift = _keyed(h, edge)
    return np.bincount((keys >> np.uint64(shift)).astype(np.int64), minlength=len(edge) - 1)


def signatures(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Per row: id, digest of its word sequence, number of distinct shingles, band hashes."""
    id_type = dict(docs.dtypes)[id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = buffers(b.column(1))
            for i, j in groups(offsets):
                part, own = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                h, edge = shingles(part, own)
                n, full = j - i, np.flatnonzero(np.diff(edge) > 0)
                values = np.zeros((n, 2 * PERMUTATIONS), np.uint64)
                if len(full):
                    at = edge[:-1][full]
                    for k, f in enumerate(_FACTORS):
                        x = h * f
                        values[full, k] = np.minimum.reduceat(x, at)
                        values[full, PERMUTATIONS + k] = np.maximum.reduceat(x, at)
                mixed = mix(values)
                bands = np.zeros((n, 2 * PERMUTATIONS // ROWS), np.uint64)
                for k in range(ROWS):
                    bands = mix(bands * np.uint64(_B) + mixed[:, k::ROWS])
                bands = mix(bands + np.arange(bands.shape[1], dtype=np.uint64) * np.uint64(_A)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), pa.array(digests(part, own), pa.binary()), pa.array(distinct_counts(h, edge)),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands.shape[1]), pa.array(bands.reshape(-1))),
                    ],
                    names=["id", "digest", "n", "bands"],
                )

    return docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, f"id {id_type}, digest binary, n bigint, bands array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough. `texts` has id and text.

    Shingles are hashed with a key drawn for this call, so no text can be made up whose shingles collide.
    """
    key = secrets.randbits(63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, ox), (y, oy) = buffers(batch.column(2)), buffers(batch.column(3))
            for i, j in groups(ox + oy):
                kx, shift = _keyed(*shingles(x[ox[i] : ox[j]], ox[i : j + 1] - ox[i], key=key))
                ky, _ = _keyed(*shingles(y[oy[i] : oy[j]], oy[i : j + 1] - oy[i], key=key))
                both = np.concatenate([kx, ky])
                both.sort()
                common = both[1:][both[1:] == both[:-1]]
                count = lambda k: np.bincount((k >> np.uint64(shift)).astype(np.int64), minlength=j - i)
                met = count(common)
                ok = DENOMINATOR * met >= NUMERATOR * (count(kx) + count(ky) - met)
                ok &= met > 0
                yield pa.RecordBatch.from_arrays([c.slice(i, j - i).filter(pa.array(ok)) for c in batch.columns[:2]], names=["a", "b"])

    full = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def token_sets(nodes: DataFrame) -> DataFrame:
    """The distinct shingles of each node, packed. `nodes` has node, comp, cluster, block, blocks, text. Hashes are keyed as in `verified`."""
    key = secrets.randbits(63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = buffers(b.column(5))
            for i, j in groups(offsets):
                h, edge = shingles(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], key=key)
                sets = [np.unique(h[edge[k] : edge[k + 1]]).tobytes() for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns[:5]), pa.array(sets, pa.binary())], names=["node", "comp", "cluster", "block", "blocks", "tokens"])

    return nodes.select("node", "comp", "cluster", "block", "blocks", "text").mapInArrow(run, "node bigint, comp bigint, cluster bigint, block bigint, blocks bigint, tokens binary")


def _compare(table: pa.Table) -> pa.Table:
    """Links between nodes of different components, as many as it takes to unite those that are linked.

    Intersections of all nodes of the group at once are products of their 0/1 shingle rows, some
    thousand shingles at a time; shingles that only one node has don't take part.
    """
    node, comp, block = (table.column(c).to_numpy() for c in ("node", "comp", "block"))
    tokens = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
    n = np.array([len(t) for t in tokens])
    flat, owner = np.concatenate(tokens), np.repeat(np.arange(len(tokens)), n)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    often = np.diff(np.append(np.flatnonzero(new), len(flat)))
    rank = np.cumsum(new) - 1
    shared = often[rank] > 1
    column, owner = (np.cumsum(often > 1) - 1)[rank[shared]], owner[shared]
    met = np.zeros((len(node), len(node)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, WIDE):
        a, b = np.searchsorted(column, [lo, lo + WIDE])
        m = np.zeros((len(node), min(WIDE, int(column[-1]) + 1 - lo)), np.float32)
        m[owner[a:b], column[a:b] - lo] = 1
        met += m @ m.T
    link = DENOMINATOR * met >= NUMERATOR * (n[:, None] + n[None, :] - met)
    link &= (met > 0) & (comp[:, None] != comp[None, :])
    if block.min() != block.max():
        link &= block[:, None] != block[None, :]
    root = {int(c): int(c) for c in comp}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for x, y in zip(*np.nonzero(np.triu(link))):
        a, b = find(int(comp[x])), find(int(comp[y]))
        if a != b:
            root[max(a, b)] = min(a, b)
            found.append((int(node[x]), int(node[y])))
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def crossing(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that unite components inside a cluster: every node is compared with all others of its cluster.

    Clusters are cut into blocks of about BLOCK nodes; a task gets two of them, so none holds more than
    2 * BLOCK nodes, whatever a cluster's size. No pair is made into a row but those that unite.
    `nodes` has node, comp, cluster, `texts` node and text; blocks are dealt before texts are fetched.
    """
    nodes = written(nodes, "unsettled")
    sizes = nodes.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    placed = looked_up(nodes, sizes, "cluster", "blocks", "node").where("blocks IS NOT NULL").withColumn("block", F.pmod(F.xxhash64(F.lit(4), "node"), "blocks"))
    sets = token_sets(placed.join(texts, "node"))
    pair = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda x: F.struct(F.least("block", x).alias("i"), F.greatest("block", x).alias("j")))
    dealt = sets.withColumn("p", F.explode(pair)).select("cluster", "p.i", "p.j", "block", "node", "comp", "tokens")
    return dealt.groupBy("cluster", "i", "j").applyInArrow(_compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: its id, `n_shingles`, `component_id` (smallest id reachable over links) and `kept`.

    Words are lower-cased in A-Z. Null and empty texts have no shingles and no links. Rows with the
    same id count as one document. A row without an id is linked with nothing: its component is null
    and it is kept. Other columns are not looked at; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    base = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    sigs = written(signatures(base, "id", "text"), "signatures")
    full = sigs.where("n > 0 AND id IS NOT NULL")
    # Equal word sequences are one node, named by their smallest id; ids that share a node are linked through it.
    named = written(full.groupBy("digest").agg(F.min("id").alias("node"), F.count("*").alias("copies")), "nodes")
    copies = full.join(named.where("copies > 1").select("digest", "node"), "digest").select(F.col("id").alias("a"), F.col("node").alias("b")).where("a <> b")
    nodes = full.join(named.select("digest", F.col("node").alias("id")), ["digest", "id"], "left_semi").dropDuplicates(["digest"])
    nodes = written(nodes.select(F.col("id").alias("node"), "bands"), "representatives")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = written(keyed.join(sizes, "key"), "buckets")
    # The pivot of a bucket is the member that meets most others in all its buckets: of copies, the one changed least.
    scores = members.groupBy("node").agg(F.sum("size").alias("score"))
    best = F.max(F.struct("score", (-F.col("node")).alias("low")))
    pivots = members.join(scores, "node").groupBy("key").agg(best.alias("best"))

    involved = members.select(F.col("node").alias("id")).distinct()
    texts = base.join(involved, "id", "left_semi").groupBy("id", F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"))
    texts = written(texts.select("id", "text"), "texts")
    stars = members.join(pivots, "key").groupBy(F.col("node").alias("b")).agg((-F.max("best").getField("low")).alias("a")).where("a <> b")
    links = written(verified(stars, texts), "links")
    found = components(links)

    labelled = members.join(found.select(F.col("u").alias("node"), F.col("v").alias("comp")), "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    open_ = labelled.join(mixed, "key", "left_semi")
    # Nodes that buckets of several components join into one cluster, directly or through others.
    hubs = open_.groupBy("key").agg(F.min("node").alias("b"))
    joined = components(open_.join(hubs, "key").select(F.col("node").alias("a"), "b"))
    unsettled = open_.select("node", "comp").distinct().join(joined.select(F.col("u").alias("node"), F.col("v").alias("cluster")), "node", "left")
    unsettled = unsettled.select("node", "comp", F.coalesce("cluster", "node").alias("cluster"))
    pairs = written(crossing(unsettled, texts.withColumnRenamed("id", "node")), "pairs")
    more = verified(pairs, texts)
    every = links.unionByName(more).unionByName(copies)
    found = components(every)
    out = sigs.join(found.select(F.col("u").alias("id"), "v"), "id", "left")
    # Only ids other than their component's smallest are in `found`.
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.coalesce("v", "id").alias("component_id"), F.col("v").isNull().alias("kept"))
