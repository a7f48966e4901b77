"""Substring dedup: remove words covered by a long window that also starts elsewhere.

A window's representative is the 20-word gram in it with the smallest hash, the leftmost of equals.
Equal windows have equal representatives at the same offset, so a window occurs at most as often as
its representative is chosen at different places.

1. Sketch. Each task counts the chosen representatives in `depth` rows of saturating counters and
   sends the cells it has seen, once each, marked if seen twice; segments of the sketch are merged in
   parallel. A window's count is estimated by its representative's cells, never too low.
2. Exact pass. Windows estimated as repeated go on, once per block of texts and window, to be grouped
   by a cryptographic digest of all their words, 96 bits of it. They are dealt out by representative, so neighbouring windows
   travel together. Real repeats are told back to their documents as ranges.

Only a bitmap of the cells counted twice or more is broadcast; its size is the parameter `cells` and
doesn't depend on the data. With many more representatives than cells it lets more unique windows
through to the exact pass, no fewer repeated ones, so the result is the same at every size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import small_batches
from .textcore import buffers, groups, mix, normal, ragged, rolled, spans, word_hashes

WINDOW = 35
#: Words in a representative.
GRAM = 20
#: Counters of all rows of the sketch together; as bits they make 32 MB.
CELLS = 1 << 28
DEPTH = 2
SEGMENT = 1 << 22
#: Words handled at once; positions among them and a hash's leading bits share 64 bits.
PIECE, PLACE_BITS = 1 << 21, 22
_A, _G = 0x9E6C63D0876A9A47 | 1, np.uint64(0xA0761D6478BD642F)


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Positions (word indexes) at which a window lies within one text."""
    return ragged(first[:-1], np.maximum(np.diff(first) - width + 1, 0))


class Words:
    """A piece of texts, word by word, from which windows are named by a digest of their bytes."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.buf, self.starts, self.ends = buf, starts, ends

    def digests(self, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Two parts, of 64 and 32 bits, of a cryptographic digest of each window: equal digests are equal word sequences."""
        text, a, e = normal(self.buf, self.starts, self.ends)
        view = memoryview(text)
        raw = b"".join([hashlib.blake2b(view[x:y], digest_size=12).digest() for x, y in zip(a[at].tolist(), e[at + width - 1].tolist())])
        both = np.frombuffer(raw, "<u4").reshape(-1, 3)
        return both[:, 0].astype(np.uint64) | both[:, 1].astype(np.uint64) << np.uint64(32), both[:, 2].copy()


def representatives(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `width` words the hash and the place of its representative."""
    gram = min(GRAM, width)
    x = rolled(h, gram, _A)
    keep = np.uint64((1 << 64) - (1 << PLACE_BITS))
    y = (x & keep) | np.arange(len(x), dtype=np.uint64)
    span, n = 1, width - gram + 1
    while 2 * span <= n:
        y = np.minimum(y[:-span], y[span:]) if len(y) > span else y[:0]
        span *= 2
    if n > span:
        y = np.minimum(y[: len(y) - (n - span)], y[n - span :]) if len(y) > n - span else y[:0]
    place = (y & ~keep).astype(np.int64)
    return x[place], place


def _cells(x: np.ndarray, cells: int, depth: int) -> Iterator[np.ndarray]:
    """A cell number for each hash and row of the sketch; rows lie behind each other."""
    per = cells // depth
    for r in range(depth):
        yield ((mix(x + np.uint64((2 * r + 1) * int(_G) % (1 << 64))) & np.uint64(per - 1)) + np.uint64(r * per)).astype(np.int64)


def _texts(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, Words]]:
    """Pieces of work: first row, word hashes, first words of its texts, the place of the piece in its text, and its words.

    A text of more than PIECE words comes in pieces that overlap by a window less a word.
    """
    buf, offsets = buffers(batch.column(column))
    for i, j in groups(offsets):
        part, offs = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = spans(part, offs)
        h = word_hashes(part, starts, ends)
        if len(h) <= PIECE:
            yield i, h, first, 0, Words(part, starts, ends)
            continue
        for k in range(j - i):
            own = h[first[k] : first[k + 1]]
            for a in range(0, max(1, len(own) - width + 1), PIECE - width):
                piece = own[a : a + PIECE - 1]
                if not len(piece):
                    continue
                s, e = (x[first[k] + a : first[k] + a + len(piece)] for x in (starts, ends))
                yield i + k, piece, np.array([0, len(piece)]), a, Words(part[s[0] : e[-1]], s - s[0], e - s[0])


def sketch(docs: DataFrame, text: str, width: int, cells: int, depth: int) -> np.ndarray:
    """The merged sketch as a bitmap of cells that were counted at least twice."""
    segments = max(1, cells // SEGMENT)
    size = cells // segments
    pending_most = 1 << 20

    def send(cell: np.ndarray) -> pa.RecordBatch:
        """The cells of one row of the sketch: gaps between them, and a mark for those seen twice."""
        cell.sort()
        lead = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        many = np.diff(np.append(lead, len(cell))) > 1
        cell = cell[lead]
        seg = cell // size
        cut = np.flatnonzero(np.diff(seg, prepend=-1, append=-1))
        rows = []
        for a, b in zip(cut[:-1], cut[1:]):
            gap = np.diff(cell[a:b] - seg[a] * size, prepend=0)
            # gaps below 255 take a byte, others a byte and four more: ascending cells pack well
            wide = gap >= 255
            rows.append((int(seg[a]), np.where(wide, 255, gap).astype(np.uint8).tobytes(), gap[wide].astype("<u4").tobytes(), np.packbits(many[a:b]).tobytes()))
        s, x, y, z = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(x, pa.binary()), pa.array(y, pa.binary()), pa.array(z, pa.binary())], names=["segment", "near", "far", "twice"])

    def flush(pending: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        x = np.concatenate(pending) if pending else np.zeros(0, np.uint64)
        if len(x):
            for cell in _cells(x, cells, depth):
                yield send(cell)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, n = [], 0
        for b in batches:
            for _, h, first, _, _ in _texts(b, 0, width):
                at = window_starts(first, width)
                x, place = representatives(h, width)
                if len(at):
                    # A text's places ascend; one place serves neighbouring windows.
                    x, place = x[at], place[at]
                    new = np.concatenate([[True], place[1:] != place[:-1]])
                    pending.append(x[new])
                    n += int(new.sum())
                if n > pending_most:
                    yield from flush(pending)
                    pending, n = [], 0
        yield from flush(pending)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one task arrive ordered by segment, so one segment is open at a time."""
        now, ones, twos = None, None, None

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(twos).tobytes()], pa.binary())], names=["segment", "bits"])

        for b in batches:
            for seg, near, far, twice in zip(*(c.to_pylist() for c in b.columns)):
                if seg != now:
                    if now is not None:
                        yield close()
                    now, ones, twos = seg, np.zeros(size, bool), np.zeros(size, bool)
                gap = np.frombuffer(near, np.uint8).astype(np.int64)
                gap[gap == 255] = np.frombuffer(far, "<u4")
                at = np.cumsum(gap)
                twos[at] |= ones[at] | np.unpackbits(np.frombuffer(twice, np.uint8), count=len(at)).view(bool)
                ones[at] = True
        if now is not None:
            yield close()

    parts = docs.select(F.col(f"`{text}`")).mapInArrow(ask, "segment int, near binary, far binary, twice binary")
    merged = parts.repartition(min(segments, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, bits binary")
    bits = np.zeros((segments, (size + 7) // 8), np.uint8)
    for row in merged.toLocalIterator():  # at most `cells` bits, whatever the data
        bits[row.segment] = np.frombuffer(row.bits, np.uint8)
    return bits.reshape(-1)


def _packed(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array per row."""
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)).cast(kind))


class Asked:
    """Windows that a task has asked about, a bounded number; a forgotten one is asked about again."""

    MOST = 1 << 20

    def __init__(self):
        self.one, self.two, self.n = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int8)

    def often(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Which of these distinct windows, ordered by their hashes, were asked about twice; the others count as asked about now."""
        if len(self.one) > self.MOST:
            stay = self.n > 1
            if stay.mean() > 0.5:
                stay &= False
            self.one, self.two, self.n = self.one[stay], self.two[stay], self.n[stay]
        at = np.minimum(np.searchsorted(self.one, one), max(0, len(self.one) - 1))
        if len(self.one):
            met = (self.one[at] == one) & (self.two[at] == two)
            known = met & (self.n[at] > 1)
            self.n[at[met]] = 2
        else:
            met = known = np.zeros(len(one), bool)
        new = ~met
        if len(self.one):
            new &= self.one[at] != one
        place = np.searchsorted(self.one, one[new])
        self.one, self.two, self.n = np.insert(self.one, place, one[new]), np.insert(self.two, place, two[new]), np.insert(self.n, place, 1)
        return known


def repeated_ranges(docs: DataFrame, text: str = "text", width: int = WINDOW, cells: int = CELLS, depth: int = DEPTH) -> DataFrame:
    """Arrays of word ranges [start, end) to remove, by `id` and `hash`; a text may have several rows.

    `docs` has `_id` and `_hash`, which together name a row's content. Buckets grow with the number of
    input partitions and of shuffle partitions, so a bucket that a task answers at once stays small.
    """
    spark = docs.sparkSession
    marks = spark.sparkContext.broadcast(sketch(docs, text, width, cells, depth))
    buckets = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    id_type = docs.schema["_id"].dataType.simpleString()

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows that the sketch marks, for each block and bucket one row of packed arrays.

        A window that repeats inside the block is sent once, by its first place, and its other places
        are known repeats: they go out as ranges with a bucket of their own and need no answer. A window
        that two blocks of this task have asked about is a known repeat as well. So a window that is in
        every text gives its bucket two entries per task, not one per text.
        """
        bits = marks.value
        asked = Asked()
        for b in batches:
            for i, h, first, moved, words in _texts(b, 2, width):
                at = window_starts(first, width)
                if not len(at):
                    continue
                x = representatives(h, width)[0][at]
                keep = np.ones(len(at), bool)
                for cell in _cells(x, cells, depth):
                    keep &= (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & np.uint8(1) > 0
                at, x = at[keep], x[keep]
                if not len(at):
                    continue
                one, two = words.digests(at, width)
                order = np.lexsort((at, two, one))
                same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
                lead, many = np.ones(len(at), bool), np.zeros(len(at), bool)
                lead[order[1:]] = ~same
                many[order[1:]] |= same
                many[order[:-1]] |= same
                doc = np.searchsorted(first, at, "right") - 1
                again = np.zeros(len(at), bool)
                group = np.empty(len(at), np.int64)  # number of each window among the block's distinct ones
                group[order] = np.cumsum(np.concatenate([[True], ~same])) - 1
                leaders = np.empty(int(lead.sum()), np.int64)
                leaders[group[lead]] = np.flatnonzero(lead)
                again = asked.often(one[leaders], two[leaders])[group]
                many |= again
                lead &= ~again
                rows: dict[str, list] = {k: [] for k in ("bucket", "one", "two", "many", "at", "docs", "base", "known", "start", "end")}
                if many.any():
                    d, a, e = joined(doc[many], at[many], at[many] + width)
                    own, index = np.unique(d, return_inverse=True)
                    for k, v in (("bucket", int((one.sum() >> np.uint64(20)) % np.uint64(buckets))), ("one", b""), ("two", b""), ("many", b""), ("at", b""), ("docs", own), ("base", first[own] - moved), ("known", index), ("start", a), ("end", e)):
                        rows[k].append(v)
                at, one, two, many, doc = at[lead], one[lead], two[lead], many[lead], doc[lead]
                if not len(at) and not rows["docs"]:
                    continue
                bucket = (mix(x[lead]) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
                none = np.zeros(0, np.int64)
                for x, y in zip(cut[:-1], cut[1:]):
                    o = order[x:y]
                    own = np.unique(doc[o])
                    for k, v in (("bucket", int(bucket[o[0]])), ("one", one[o].tobytes()), ("two", two[o].astype("<u4").tobytes()), ("many", np.packbits(many[o]).tobytes()), ("at", np.diff(at[o], prepend=0).astype("<u4").tobytes()), ("docs", own), ("base", first[own] - moved), ("known", none), ("start", none), ("end", none)):
                        rows[k].append(v)
                n = [len(x) for x in rows["docs"]]
                pick = pa.array(np.concatenate(rows["docs"]) + i)
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["bucket"], pa.int32()), *(pa.array(rows[k], pa.binary()) for k in ("one", "two", "many", "at")),
                     pa.ListArray.from_arrays(offsets, b.column(0).take(pick)), pa.ListArray.from_arrays(offsets, b.column(1).take(pick)),
                     *(_packed(rows[k], pa.int32()) for k in ("base", "known", "start", "end"))],
                    names=["bucket", "one", "two", "many", "at", "ids", "hashes", "base", "known", "start", "end"],
                )

    def answer(pending: list[dict]) -> pa.RecordBatch | None:
        """The exact grouping of one bucket: a window is repeated if two blocks, or one block twice, have it."""
        ids, hashes, starts, ends = [], [], [], []

        def tell(r: dict, doc: np.ndarray, a: np.ndarray, e: np.ndarray) -> None:
            """Ranges of one row, by text; they are sorted by it."""
            cut = np.flatnonzero(np.diff(doc, prepend=-1, append=-1))
            own = doc[cut[:-1]]
            ids.append(r["ids"].take(pa.array(own)))
            hashes.append(r["hashes"].take(pa.array(own)))
            a, e = a - r["base"][doc], e - r["base"][doc]
            starts.extend(a[x:y] for x, y in zip(cut[:-1], cut[1:]))
            ends.extend(e[x:y] for x, y in zip(cut[:-1], cut[1:]))

        asked = [r for r in pending if len(r["one"])]
        for r in pending:
            if len(r["known"]):
                tell(r, r["known"], r["start"], r["end"])
        if asked:
            one, two, many = (np.concatenate([r[k] for r in asked]) for k in ("one", "two", "many"))
            order = np.lexsort((two, one))
            same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
            hit = np.zeros(len(one), bool)
            hit[order[1:]] |= same
            hit[order[:-1]] |= same
            hit &= ~many  # places of these are known
            edge = np.concatenate([[0], np.cumsum([len(r["one"]) for r in asked])])
            for k, r in enumerate(asked):
                at = r["at"][hit[edge[k] : edge[k + 1]]]
                if len(at):
                    tell(r, *joined(np.searchsorted(r["base"], at, "right") - 1, at, at + width))
        if not ids:
            return None
        return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(hashes), _packed(starts, pa.int32()), _packed(ends, pa.int32())], names=["id", "hash", "starts", "ends"])

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pending = None, []
        for b in batches:
            buckets_here = b.column(0).to_numpy()
            for k in range(b.num_rows):
                if buckets_here[k] != now and pending:
                    if (out := answer(pending)) is not None:
                        yield out
                    pending = []
                now = buckets_here[k]
                one, two, many, at = (b.column(c)[k].as_buffer() for c in (1, 2, 3, 4))
                n = two.size // 4
                base, known, start, end = (b.column(c)[k].values.to_numpy().astype(np.int64) for c in (7, 8, 9, 10))
                pending.append({
                    "one": np.frombuffer(one, np.uint64), "two": np.frombuffer(two, "<u4"), "many": np.unpackbits(np.frombuffer(many, np.uint8), count=n).view(bool),
                    "at": np.cumsum(np.frombuffer(at, "<u4").astype(np.int64)), "ids": b.column(5)[k].values, "hashes": b.column(6)[k].values, "base": base, "known": known, "start": start, "end": end,
                })
        if pending and (out := answer(pending)) is not None:
            yield out

    schema = f"id {id_type}, hash bigint, starts array<int>, ends array<int>"
    found = docs.select("_id", "_hash", F.col(f"`{text}`")).mapInArrow(
        candidates, f"bucket int, one binary, two binary, many binary, at binary, ids array<{id_type}>, hashes array<bigint>, base array<int>, known array<int>, start array<int>, end array<int>"
    )
    return found.repartition(buckets // 4, "bucket").sortWithinPartitions("bucket").mapInArrow(group, schema)


def joined(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite overlapping or touching ranges of the same text; input ordered by text and start."""
    if not len(doc):
        return doc, start, end
    base = np.maximum.accumulate(end + doc.astype(np.int64) * (1 << 40))
    new = np.ones(len(doc), bool)
    new[1:] = (start[1:] + doc[1:].astype(np.int64) * (1 << 40)) > base[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], base[last] - doc[at].astype(np.int64) * (1 << 40)


def dedup_substrings(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WINDOW, cells: int = CELLS, depth: int = DEPTH) -> DataFrame:
    """Add to every row `n_words`, `n_removed` and `kept` (the words that stay, joined by one space).

    A word goes if a window of `width` consecutive words that covers it has a word sequence that
    starts anywhere else in the input too. Null and empty texts have no words and keep an empty text;
    texts with fewer than `width` words lose nothing; equal rows are repeats of each other. Input
    columns of the new names go, others stay, whatever their names. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept")]
    base = docs.select([F.col(f"`{c}`") for c in keep])
    at = keep.index(text)
    # Inside, input columns go by their number.
    own = [f"c{k}" for k in range(len(keep))]
    named = base.toDF(*own).withColumns({"_id": F.col(own[keep.index(id)]), "_hash": F.xxhash64(F.lit(7), F.col(own[at]))})
    ranges = repeated_ranges(named, own[at], width, cells, depth)
    # Ranges of one text come together in one row; their number is bounded by the text's length.
    packed = ranges.groupBy(F.col("id").alias("_rid"), F.col("hash").alias("_rhash")).agg(
        F.collect_set(F.struct("starts", "ends")).alias("_r")
    )
    packed = packed.select("_rid", "_rhash", F.flatten("_r.starts").alias("_from"), F.flatten("_r.ends").alias("_to"))
    both = named.join(packed, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_hash") == F.col("_rhash")), "left")
    shape = base.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept")).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # Some MB at a time, so that a batch of long texts isn't held several times over.
            for i, j in groups(buffers(b.column(at))[1]):
                yield one(b.slice(i, j - i))

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, kept = [], [], []
        for t, lo, hi in zip(b.column(at).cast(pa.binary()), b.column(len(keep)), b.column(len(keep) + 1)):
            words = (t.as_py() or b"").split()  # bytes split at exactly these six white-space bytes
            n, gone = len(words), 0
            if lo.is_valid:
                a, e = lo.values.to_numpy(), hi.values.to_numpy()
                order = np.argsort(a, kind="stable")
                _, a, e = joined(np.zeros(len(a), np.int64), a[order].astype(np.int64), e[order].astype(np.int64))
                gone = int((e - a).sum())
                left, out = 0, []
                for x, y in zip(a.tolist(), e.tolist()):
                    out += words[left:x]
                    left = y
                words = out + words[left:]
            n_words.append(n)
            n_removed.append(gone)
            kept.append(b" ".join(words))
        return pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=[*keep, "n_words", "n_removed", "kept"])

    return both.select(*own, "_from", "_to").mapInArrow(cut, shape)
