"""Benchmark decontamination by latent semantic retrieval.

1. Words of the benchmark become the vocabulary; every document is written once as vocabulary numbers.
2. Document frequencies over all documents give TF-IDF weights. Features are the benchmark's rarer words.
3. A randomised SVD of all TF-IDF passages: one pass adds up A'(A Omega) from the tasks, which spans
   the leading right singular space; a second adds up A'(A Q), whose small Gram matrix gives the
   singular vectors. Only (features x rank) sums meet, whatever the number of passages.
4. Passages of a length that suits each item are compared with the items by cosine in that space.
   Beside that, every run of RUN words that a document shares with an item makes a candidate,
   whatever the cosine, so that no verbatim leak depends on the space.
5. Candidates are verified by the longest common subsequence of words, and by whether the item's
   answer is there: a leak has most of the item's words in order, or fewer of them with the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import small_batches, written
from .textcore import buffers, groups, lowered, ragged, spans, word_hashes

#: Items handled in one run; a larger benchmark takes several, so what is broadcast stays bounded.
PORTION = 512
RANK, OVERSAMPLE = 192, 16
#: Words in more than this share of documents are no features, but an item keeps its RAREST words in any case.
MOST_DOCS, RAREST = 0.02, 8
#: Words in a passage of the SVD; cosine of a candidate; features that a compared passage has at least.
PASSAGE, COSINE, LEAST_FEATURES = 64, 0.38, 3
#: Words in a run that a document shares with an item; shorter items are looked for as a whole. Pairs of run and item handled at once.
RUN, PAIRS = 5, 1 << 20
#: Share of the item's words that a leak has in order; with the answer this share is enough. Shorter items must be there in full.
LCS_SHARE, LCS_WITH_ANSWER, SHORT_ITEM = 0.75, 0.55, 6
#: Words at an item's end that count as its answer if none is given.
ANSWER_WORDS = 4
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words_of(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (lower-cased runs of letters and digits) and n+1 offsets into them."""
    clean = np.where(_WORD[buf], lowered(buf), np.uint8(32))
    starts, ends, first = spans(clean, offsets)
    return word_hashes(clean, starts, ends), first


class Items:
    """A portion of the benchmark over its own vocabulary; word 0 is any other word."""

    def __init__(self, ids: list, texts: list[str], answers: list[str | None]):
        h, first = words_of(*buffers(pa.array(texts, pa.string())))
        self.vocabulary = np.unique(h)
        self.ids = ids
        self.words = [np.searchsorted(self.vocabulary, h[first[k] : first[k + 1]]) + 1 for k in range(len(ids))]
        ah, af = words_of(*buffers(pa.array([a or "" for a in answers], pa.string())))
        self.answers = []
        for k, w in enumerate(self.words):
            own = np.searchsorted(self.vocabulary, ah[af[k] : af[k + 1]])
            own = np.where((own < len(self.vocabulary)) & (self.vocabulary[np.minimum(own, len(self.vocabulary) - 1)] == ah[af[k] : af[k + 1]]), own + 1, -1) if len(own) else own
            self.answers.append(own if len(own) else w[-ANSWER_WORDS:])
        self.kind = np.uint16 if len(self.vocabulary) < 65_535 else np.uint32
        self.feature = np.full(len(self.vocabulary) + 1, -1, np.int64)
        self.weight = np.zeros(0)

    def number(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of word hashes."""
        v = self.vocabulary
        maybe = np.zeros(1 << 20, bool)
        maybe[(v >> np.uint64(44)).astype(np.int64)] = True
        out = np.zeros(len(h), self.kind)
        hit = np.flatnonzero(maybe[(h >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(v, h[hit]), len(v) - 1)
        real = v[at] == h[hit]
        out[hit[real]] = at[real] + 1
        return out

    def choose(self, found: np.ndarray, docs: int) -> None:
        """Features and their weights from document frequencies (by vocabulary number)."""
        pick = found <= MOST_DOCS * docs
        pick[0] = False
        for w in self.words:
            own = np.unique(w)
            pick[own[np.argsort(found[own], kind="stable")[:RAREST]]] = True
        chosen = np.flatnonzero(pick)
        self.feature[chosen] = np.arange(len(chosen))
        self.weight = np.log((1 + docs) / (1 + found[chosen])) + 1


def passages(items: Items, batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of documents: bounds, all numbers, offsets; and of the features in them the place, the document and the number."""
    buf, offsets = buffers(batch.column(column))
    size = np.dtype(items.kind).itemsize
    for i, j in groups(offsets):
        numbers = np.frombuffer(buf[offsets[i] : offsets[j]].tobytes(), items.kind)
        first = (offsets[i : j + 1] - offsets[i]) // size
        f = items.feature[numbers]
        at = np.flatnonzero(f >= 0)
        yield i, j, numbers, first, at, np.searchsorted(first, at, "right") - 1, f[at]


def _rows(items: Items, at: np.ndarray, doc: np.ndarray, f: np.ndarray, first: np.ndarray, width: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of `width` words: key (document, stretch), first feature, feature count, and the summed weighted rows of `table`."""
    stretch = (at - first[doc]) // width
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (stretch[1:] != stretch[:-1])]))
    sums = np.add.reduceat(table[f], new, axis=0)
    return doc[new], stretch[new], np.diff(np.append(new, len(f))), sums


def _gather(coded: DataFrame, items: Items, table: np.ndarray, tasks: int) -> np.ndarray:
    """A'(A table) over unit-length passages A, added up from all tasks; features x columns."""
    spark = coded.sparkSession
    shared = spark.sparkContext.broadcast((items, table.astype(np.float32)))
    block = 64

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its, omega = shared.value
        scaled = omega * its.weight[:, None].astype(np.float32)
        total = np.zeros(omega.shape, np.float64)
        for b in batches:
            for _, _, _, first, at, doc, f in passages(its, b, 0, PASSAGE):
                if not len(at):
                    continue
                d, s, n, y = _rows(its, at, doc, f, first, PASSAGE, scaled)
                norm = np.add.reduceat(its.weight[f] ** 2, np.concatenate([[0], np.cumsum(n)[:-1]]))
                y /= norm[:, None].astype(np.float32)
                # Each feature of a passage receives the passage's row: sorted by feature, rows add up in stretches.
                row = np.repeat(np.arange(len(n)), n)
                order = np.argsort(f, kind="stable")
                for c in range(0, len(order), 1 << 17):  # bounded memory
                    o = order[c : c + (1 << 17)]
                    g = f[o]
                    cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
                    total[g[cut]] += np.add.reduceat(y[row[o]], cut, axis=0) * its.weight[g[cut]][:, None]
        blocks = range(0, len(total), block)
        yield pa.RecordBatch.from_arrays([pa.array([k // block for k in blocks], pa.int32()), pa.array([total[k : k + block].astype(np.float32).tobytes() for k in blocks], pa.binary())], names=["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(s, np.float32).astype(np.float64)
                held[k] = held[k] + x if k in held else x
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["block", "sums"])

    parts = coded.select("numbers").coalesce(tasks).mapInArrow(part, "block int, sums binary")
    out = np.zeros(table.shape)
    for r in parts.repartition(min(tasks, 1 + len(out) // block), "block").mapInArrow(add, "block int, sums binary").toLocalIterator():
        x = np.frombuffer(r["sums"]).reshape(-1, table.shape[1])
        out[r["block"] * block : r["block"] * block + len(x)] = x
    return out


def latent_space(coded: DataFrame, items: Items, rank: int = RANK, seed: int = 3) -> np.ndarray:
    """Right singular vectors (features x rank) of the TF-IDF passages of all documents."""
    n = len(items.weight)
    rank = min(rank, n)
    tasks = 4 * coded.sparkSession.sparkContext.defaultParallelism
    omega = np.random.default_rng(seed).standard_normal((n, min(n, rank + OVERSAMPLE)))
    q, _ = np.linalg.qr(_gather(coded, items, omega, tasks))
    gram = q.T @ _gather(coded, items, q, tasks)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    return q @ vectors[:, ::-1][:, :rank]


def lcs(item: dict[int, int], full: int, region: list[int]) -> int:
    """Length of the longest common subsequence; `item` maps a word to the bits of its places."""
    v = full
    for w in region:
        if (m := item.get(w)) is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return (full ^ v).bit_count()


def _run_hashes(numbers: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on."""
    last = len(numbers) - n + 1
    h = np.zeros(max(0, last), np.uint64)
    for k in range(n if last > 0 else 0):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + numbers[k : k + last].astype(np.uint64)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)


class Runs:
    """All runs of RUN words of the items, and the items and places that have each."""

    def __init__(self, items: Items):
        self.length = np.array([len(w) for w in items.words])
        self.tables = []
        for n in range(1, RUN + 1):
            own = [k for k, w in enumerate(items.words) if min(len(w), RUN) == n]
            if not own:
                continue
            hashes = [_run_hashes(items.words[k], n) for k in own]
            h = np.concatenate(hashes)
            item = np.repeat(own, [len(x) for x in hashes])
            place = np.concatenate([np.arange(len(x)) for x in hashes])
            order = np.argsort(h, kind="stable")
            keys, first = np.unique(h[order], return_index=True)
            maybe = np.zeros(1 << 20, bool)
            maybe[(keys >> np.uint64(44)).astype(np.int64)] = True
            self.tables.append((n, keys, np.append(first, len(h)), item[order], place[order], maybe))

    def found(self, numbers: np.ndarray, first: np.ndarray, scale: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Document, item, and the bounds of a region that holds the item whole if it begins where a shared run says."""
        for n, keys, of, item, place, maybe in self.tables:
            known = numbers != 0
            last = len(numbers) - n + 1
            if last <= 0:
                continue
            full = known[:last].copy()
            for k in range(1, n):
                full &= known[k : k + last]
            at = np.flatnonzero(full)
            h = _run_hashes(numbers, n)[at]
            hit = np.flatnonzero(maybe[(h >> np.uint64(44)).astype(np.int64)])
            at, h = at[hit], h[hit]
            key = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            doc = np.searchsorted(first, at, "right") - 1
            real = (keys[key] == h) & (at + n <= first[doc + 1])  # a run lies in one document
            at, key, doc = at[real], key[real], doc[real]
            many = of[key + 1] - of[key]
            ends = np.cumsum(many)
            i = 0
            while i < len(at):  # bounded memory
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS, "right")))
                m = many[i:j]
                pair = np.repeat(of[key[i:j]], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                e, d = item[pair], np.repeat(doc[i:j], m)
                # Starts in the same stretch of an item's length share a region.
                begin = np.repeat(at[i:j], m) - place[pair] - first[d]
                for d1, e1, s in np.unique(np.stack([d, e, begin // scale[e]], 1), axis=0).tolist():
                    lo, w, half = int(first[d1]) + s * int(scale[e1]), int(scale[e1]), int(self.length[e1]) // 2
                    yield d1, e1, max(int(first[d1]), lo - half), min(int(first[d1 + 1]), lo + w + int(self.length[e1]) + half)
                i = j


def retrieve(coded: DataFrame, items: Items, space: np.ndarray) -> DataFrame:
    """Verified leaks: id, hash, item (its index), start, words, lcs, ratio, cosine, answered."""
    spark = coded.sparkSession
    shared = spark.sparkContext.broadcast((items, space.astype(np.float32)))
    id_type = dict(coded.dtypes)["_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its, v = shared.value
        table = v * its.weight[:, None].astype(np.float32)
        # An item's stretch is its length rounded up to a power of two: two neighbours hold it whole.
        scale = np.array([1 << max(3, int(len(w) - 1).bit_length()) for w in its.words])
        vectors = []
        for w in its.words:
            f = its.feature[w]
            x = table[f[f >= 0]].sum(0)
            vectors.append(x / max(1e-12, float(np.linalg.norm(x))))
        vectors = np.array(vectors)
        places = [{int(x): sum(1 << k for k in np.flatnonzero(w == x).tolist()) for x in np.unique(w)} for w in its.words]
        runs = Runs(its)

        def check(numbers: np.ndarray, first: np.ndarray, best: dict, d: int, e: int, a: int, z1: int, cosine: float | None) -> None:
            """Keep the region for its document and item if it is a leak and no earlier one is as close."""
            region = numbers[a:z1].tolist()
            need = len(its.words[e])
            got = lcs(places[e], (1 << need) - 1, region)
            ratio = got / need
            if ((d, e) in best and best[d, e][3] >= ratio) or ratio < LCS_WITH_ANSWER:
                return
            answered = _holds(region, its.answers[e])
            if (got == need) if need < SHORT_ITEM else (ratio >= LCS_SHARE or answered):
                if cosine is None:
                    g = its.feature[numbers[a:z1]]
                    x = table[g[g >= 0]].sum(0)
                    cosine = float(x @ vectors[e] / max(1e-12, float(np.linalg.norm(x))))
                best[d, e] = (a - int(first[d]), z1 - a, got, ratio, cosine, answered)

        for b in batches:
            for i, j, numbers, first, at, doc, f in passages(its, b, 2, PASSAGE):
                out: dict[str, list] = {k: [] for k in ("row", "item", "start", "words", "lcs", "ratio", "cosine", "answered")}
                best: dict[tuple[int, int], tuple] = {}
                for width in np.unique(scale) if len(at) else ():
                    own = np.flatnonzero(scale == width)
                    d, s, n, y = _rows(its, at, doc, f, first, int(width), table)
                    # A passage is a stretch with the next one of the same document, or alone if that has no features.
                    follows = np.zeros(len(d), bool)
                    follows[:-1] = (d[1:] == d[:-1]) & (s[1:] == s[:-1] + 1)
                    follows = np.flatnonzero(follows)
                    z, m = y.copy(), n.copy()
                    z[follows] += y[follows + 1]
                    m[follows] += n[follows + 1]
                    # Short items may not have LEAST_FEATURES of them.
                    few = min(LEAST_FEATURES, min(int((its.feature[its.words[k]] >= 0).sum()) for k in own))
                    pick = np.flatnonzero(m >= few)
                    for c in range(0, len(pick), 1 << 14):
                        p = pick[c : c + (1 << 14)]
                        zz = z[p] / np.maximum(np.linalg.norm(z[p], axis=1), 1e-12)[:, None]
                        cosine = zz @ vectors[own].T
                        for r, k in zip(*np.nonzero(cosine >= COSINE)):
                            e = int(own[k])
                            lo = int(first[d[p[r]]] + s[p[r]] * width)
                            a, z1 = max(int(first[d[p[r]]]), lo - int(width) // 2), min(int(first[d[p[r]] + 1]), lo + 2 * int(width) + int(width) // 2)
                            check(numbers, first, best, int(d[p[r]]), e, a, z1, float(cosine[r, k]))
                for d1, e, a, z1 in runs.found(numbers, first, scale):
                    if (d1, e) not in best or best[d1, e][3] < 1:
                        check(numbers, first, best, d1, e, a, z1, None)
                for (row, e), (start, words, got, ratio, cos, answered) in best.items():
                    for k, x in zip(out, (row + i, e, start, words, got, ratio, cos, answered)):
                        out[k].append(x)
                if out["row"]:
                    rows = pa.array(out["row"])
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(rows), b.column(1).take(rows), pa.array(out["item"], pa.int32()), pa.array(out["start"], pa.int64()), pa.array(out["words"], pa.int32()), pa.array(out["lcs"], pa.int32()),
                         pa.array(out["ratio"], pa.float64()), pa.array(out["cosine"], pa.float64()), pa.array(out["answered"], pa.bool_())],
                        names=["id", "hash", "item", "start", "words", "lcs", "ratio", "cosine", "answered"],
                    )

    return coded.select("_id", "_hash", "numbers").mapInArrow(run, f"id {id_type}, hash bigint, item int, start bigint, words int, lcs int, ratio double, cosine double, answered boolean")


def _holds(region: list[int], answer: np.ndarray) -> bool:
    """Is the answer in the region, word by word?"""
    a = answer.tolist()
    if not a:
        return False
    return any(region[k : k + len(a)] == a for k, w in enumerate(region) if w == a[0])


def find_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", answer: str | None = None) -> DataFrame:
    """Documents that hold benchmark items: id, `hash` of the text, item id, place, words in common and how close.

    One row per document and item, its best place; of places equally close the first looked at, which
    doesn't depend on the order of rows. Null and empty texts leak nothing, items without
    words neither; repeated rows are all found. An empty benchmark or no documents give no rows. Texts are
    read whole; memory follows the length of the longest. Other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(docs.sparkSession)
    id_type, item_type = dict(docs.dtypes)[id], dict(benchmark.dtypes)[item_id]
    shape = f"id {id_type}, hash bigint, item_id {item_type}, start bigint, words int, lcs int, ratio double, cosine double, answered boolean"
    wanted = benchmark.select(F.col(f"`{item_id}`").alias("i"), F.col(f"`{item_text}`").alias("t"), (F.col(f"`{answer}`") if answer else F.lit(None)).cast("string").alias("a")).where("i IS NOT NULL AND t IS NOT NULL").dropDuplicates(["i", "t"])
    portions = -(-wanted.count() // PORTION)
    out = spark.createDataFrame([], shape)
    named = docs.select(F.col(f"`{id}`").alias("_id"), F.xxhash64(F.lit(7), F.col(f"`{text}`")).alias("_hash"), F.col(f"`{text}`").alias("text"))
    for k in range(portions):
        # About PORTION items each.
        rows = wanted.where(F.pmod(F.xxhash64(F.lit(1), "t"), F.lit(portions)) == k).orderBy("i", "t").collect()
        rows = [r for r in rows if len(words_of(*buffers(pa.array([r["t"]])))[0])]
        if not rows:
            continue
        items = Items([r["i"] for r in rows], [r["t"] for r in rows], [r["a"] for r in rows])
        out = out.unionByName(_portion(named, items, item_type))
    return out


def _portion(named: DataFrame, items: Items, item_type: str) -> DataFrame:
    spark = named.sparkSession
    shared = spark.sparkContext.broadcast(items)
    id_type = dict(named.dtypes)["_id"]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its = shared.value
        for b in batches:
            buf, offsets = buffers(b.column(2))
            for i, j in groups(offsets):
                h, first = words_of(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                numbers = its.number(h)
                size = numbers.dtype.itemsize
                packed = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((first * size).astype(np.int32)), pa.py_buffer(numbers)])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), packed], names=["_id", "_hash", "numbers"])

    coded = written(named.mapInArrow(code, f"_id {id_type}, _hash bigint, numbers binary"), "coded")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its = shared.value
        total, docs = np.zeros(len(its.vocabulary) + 1, np.int64), 0
        for b in batches:
            for _, _, numbers, first, *_ in passages(its, b, 0, PASSAGE):
                n = len(its.vocabulary) + 1
                doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
                seen = np.unique(doc * n + numbers)
                total += np.bincount(seen % n, minlength=n)
                docs += len(first) - 1
        total[0] = docs
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["word", "n"])

    # One row for each word of the portion's vocabulary.
    found = np.zeros(len(items.vocabulary) + 1, np.int64)
    counted = coded.select("numbers").mapInArrow(frequencies, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    for r in counted.toLocalIterator():
        found[r["word"]] = r["n"]
    items.choose(found, int(found[0]))
    space = latent_space(coded, items)
    leaks = retrieve(coded, items, space)
    names = spark.createDataFrame([(k, v) for k, v in enumerate(items.ids)], f"item int, item_id {item_type}")
    return leaks.join(F.broadcast(names), "item").select("id", "hash", "item_id", "start", "words", "lcs", "ratio", "cosine", "answered")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, with all their columns, whatever those are called.

    Null and empty texts stay; repeated rows stay or go together; an empty benchmark or table takes nothing.
    """
    bad = find_leaks(docs, benchmark, id, text, **more).select(F.col("id").alias("bad_id"), F.col("hash").alias("bad_hash")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{id}`").alias("id"), F.xxhash64(F.lit(7), F.col(f"`{text}`")).alias("hash"))
    kept = rows.join(bad, F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("hash") == F.col("bad_hash")), "left_anti")
    return kept.select([F.col(f"row.`{c}`").alias(c) for c in docs.columns])
