"""Centroids, filter audits and token counts against plain loops and the library, with awkward rows."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import centroids, filter_audit, token_counts
from cohortlake.llm.queries import vocabulary

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def pieces():
    return token_counts.pieces(vocabulary(MODEL))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(MODEL))


# token counts


def test_every_proved_string_is_one_token(pieces, library):
    assert len(pieces.whole) > 30_000
    for p in random.Random(1).sample(sorted(pieces.whole), 2000):
        if p.startswith("▁"):
            assert len(library.encode(p[1:])) == 1


@pytest.mark.parametrize("segment,kept", [(1 << 20, 400_000), (40, 5)])
def test_counts_are_the_librarys(pieces, library, monkeypatch, segment, kept):
    monkeypatch.setattr(token_counts, "SEGMENT", segment)
    rnd, names = random.Random(2), sorted(pieces.rank)
    bits = ["a", " ", "  ", "\n", "\t", "▁", "é", "🙂", "中", "123", "Ⅷ", "the", "ing", "\x00", "<s>", "<0x41>", "​", "A.", "\r", "=", "¤"]
    texts = ["", " ", "   ", "x" * 3000, "ab" * 2500, "a" * 199 + "." * 300, " " * 500, "\n" * 300, "word " * 3000]
    texts += ["".join(rnd.choice(bits) if rnd.random() < 0.6 else rnd.choice(names) for _ in range(rnd.randint(1, 30))) for _ in range(3000)]
    texts += ["".join(rnd.choice(["a", "e", "ea", "th", ".", "1"]) for _ in range(700)) for _ in range(20)]
    counter = token_counts.Counter(pieces, kept)
    assert [counter.count(t) for t in texts] == [len(x) for x in library.encode(texts)]


def test_long_texts_of_many_words_in_either_order(pieces, library, monkeypatch):
    monkeypatch.setattr(token_counts, "SEGMENT", 10_000)
    a, b = (" ".join(f"{kind}{n} common" for n in range(8000)) for kind in ("q", "zz"))
    for texts in ([a, b, a], [b, a, b]):
        counter = token_counts.Counter(pieces, 3000)
        assert [counter.count(t) for t in texts] == [len(x) for x in library.encode(texts)]
        assert len(counter.known) < 3000 + len(pieces.whole) + 20_000


def test_token_count_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "some words", "x"), (3, "some words", "x"), (None, "é" * 5000, "x"), (5, "word " * 4096, "x"), (6, "word " * 4095, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = Counter(tuple(r) for r in token_counts.count_tokens(docs, vocabulary(MODEL)).select("doc_id", "text", "n_bytes", "n_tokens", "over_limit").collect())
    count = lambda t: len(library.encode(t or ""))
    assert got == Counter((i, t, len((t or "").encode()), count(t), count(t) > 4096) for i, t, _ in rows)
    assert token_counts.count_tokens(docs.limit(0), vocabulary(MODEL)).count() == 0


# filter audit


def audited(rows, labels):
    """Every order one filter after the other, document by document."""
    good, toxic = {i for i, q, _ in labels if i and q == 1}, {i for i, _, t in labels if i and t == 1}
    lowest = {}
    for i, t, _ in rows:
        if i is not None:
            lowest[t or ""] = min(i, lowest.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        t = t or ""
        words = t.encode().split()
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > lowest[t]}
        docs.append((lang or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for k, f in enumerate(order, 1):
                hit = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(hit)
                out[part, order, k] = [len(left), len(hit), sum(f in d[1] for d in own) - len(hit), sum(d[1] == {f} for d in own), sum(d[2] for d in hit), sum(d[3] for d in hit)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(shapley[order[k - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_is_that_of_every_order(spark):
    rnd = random.Random(3)
    rows = [(1, None, None), (2, "", "en"), (3, "", "en"), (None, "", "en"), (None, "same", "de"), (5, "same", "de"), (6, "same", None), (6, "same", None), (7, "same", ""), (8, "A B # C", "en"), (8, "other", "en")]
    for k in range(120):
        words = [rnd.choice(["a", "b", "C", "x#", "é", "word"]) + (str(rnd.randint(0, 400)) if rnd.random() < 0.6 else "") for _ in range(rnd.choice([3, 150, 199, 200, 260]))]
        rows.append((rnd.randint(10, 200), "\t".join(words) if k % 9 else "a copy of many", rnd.choice(["en", "de", None])))
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in [*range(0, 200, 2), 8, 8, None]]
    docs = spark.createDataFrame([(*r, 1, 1) for r in rows], "doc_id long, text string, lang string, n int, mask int").repartition(5)
    flags = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = filter_audit.filter_interactions(docs, flags)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in out.collect()} == audited(rows, labels)
    assert filter_audit.filter_interactions(docs.limit(0), flags).count() == 0
    assert filter_audit.filter_interactions(docs, flags.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_walk_stores_every_subset():
    mask = np.arange(32)
    counts = np.stack([mask * 7 + 1, mask % 3], 1)
    states = filter_audit.walk(mask, counts)
    for s in range(32):
        assert (states[s] == counts[mask & s == 0].sum(0)).all()


# centroids


def clustered(rows, clusters=8, rounds=10, dimensions=64):
    kept = [(i, [int(np.floor(1024 * np.float64(x))) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cs = [list(v) for _, v in order[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cs))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for k in range(len(cs)):
            members = [v for (_, v), o in zip(kept, own) if o == k]
            if members:
                cs[k] = [sum(x) // len(members) for x in zip(*members)]
    last = [(i, *near(v)[::-1]) for i, v in kept]
    total, by = sum(d for *_, d in last), Counter()
    for _, k, d in last:
        by[k] += d
    return Counter((i, k, d, by[k], total, hashlib.sha256(",".join(map(str, cs[k])).encode()).hexdigest()) for i, k, d in last)


def test_clusters_are_those_of_plain_rounds(spark):
    rnd = np.random.default_rng(4)
    rows = [(int(i), (rnd.normal(size=64) + 3 * rnd.integers(0, 3, 1)).astype(np.float32).tolist()) for i in rnd.permutation(300)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (900, [0.0] * 64), (901, [-0.0001] * 64), (902, [100000.0] * 64), (None, [1.0] * 64)]
    rows += [(910, None), (911, []), (912, [1.0] * 63), (913, [1.0] * 65), (914, [None] * 64), (915, [float("nan")] * 64), (916, [1.0] * 63 + [float("-inf")])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cluster int, v int").repartition(5)
    for take in (rows, rows[:3] + rows[-8:], rows[-3:]):
        own = df if take is rows else spark.createDataFrame(take, "vec_id long, embedding array<float>")
        found, cs = centroids.cluster_vectors(own)
        assert Counter(map(tuple, centroids.with_inertia(found, cs).collect())) == clustered(take)
    assert centroids.with_inertia(*centroids.cluster_vectors(df.limit(0))).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_dot_products_are_corrected_exactly():
    rnd = np.random.default_rng(5)
    v, old = rnd.integers(-(1 << 27), 1 << 27, (50, 64)), rnd.integers(-(1 << 27), 1 << 27, (8, 64))
    new = np.where(rnd.random((8, 64)) < 0.2, rnd.integers(-(1 << 27), 1 << 27, (8, 64)), old)
    new[3] = old[3]
    assert (centroids.corrected(v @ old.T, v, new - old) == v @ new.T).all()


def test_components_without_exact_distances_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exact distances"):
        centroids.cluster_vectors(df)
