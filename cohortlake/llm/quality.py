"""Quality classifier by hierarchical empirical Bayes: document evidence, path and host posteriors, global prior.

1. A document classifier is fitted on a bounded sample of labelled rows: words whose presence differs
   significantly between the classes, and figures of style, weighted by a logistic regression.
2. Its probabilities over all documents are added up by path and by host. A host's rate is shrunk
   toward the global rate, a path's toward its host's; how strongly is estimated from the spread of
   the rates themselves, so sparse sites stay near the prior and large ones speak for themselves.
3. A document's posterior odds are its own evidence times the odds of its path.

This is done for two targets, good quality and toxicity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import small_batches, written
from .textcore import buffers, groups, lowered, spans, word_hashes

#: Labelled rows to fit on (about), and what makes a word a sign (deviations from an even spread, documents, share of its class).
TRAIN_ROWS, SIGNIFICANT, LEAST_DOCS, LEAST_SHARE = 20_000, 6.0, 8, 0.05
#: A site's prior counts as at least and at most this many documents.
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 10_000.0
TARGETS = ("quality", "toxic")
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def document_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of every word, and the number of words of each text; words are runs of letters and digits."""
    clean = np.where(_LETTER[buf], lowered(buf), np.uint8(32))
    starts, ends, first = spans(clean, offsets)
    n = np.diff(first)
    return word_hashes(clean, starts, ends), np.repeat(np.arange(len(n)), n), n


def distinct_words(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct words of each text."""
    keys = (h >> np.uint64(24)) | (doc.astype(np.uint64) << np.uint64(40))
    keys.sort()
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    return np.bincount((keys >> np.uint64(40)).astype(np.int64), minlength=n)


def style(buf: np.ndarray, offsets: np.ndarray, distinct: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Figures of each text's form, each between 0 and about 1."""
    n = np.maximum(np.diff(offsets), 1).astype(float)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets]) / n

    upper = share((buf - np.uint8(65)) < 26)
    marks = share(~_LETTER[buf] & (buf > 32))
    return np.stack(
        [upper, np.minimum(1, 3 * upper), marks, np.minimum(1, 5 * marks), share(buf == 10) * 10, share(buf == 124) * 10,
         share((buf - np.uint8(48)) < 10), distinct / np.maximum(words, 1), np.minimum(1, np.log1p(words) / 10), (n / np.maximum(words, 1) / 12).clip(0, 3)],
        1,
    )


@dataclass
class Classifier:
    """For each target: word signs (ascending hashes and their scores), and weights of signs for, signs against, style and bias."""

    signs: dict[str, tuple[np.ndarray, np.ndarray]]
    weights: dict[str, np.ndarray]
    prior: dict[str, float]

    def features(self, target: str, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        h, doc, words = document_words(buf, offsets)
        n = len(words)
        known, score = self.signs[target]
        up, down = np.zeros(n), np.zeros(n)
        if len(known):
            # Most words are ruled out by a few of their bits.
            maybe = np.zeros(1 << 16, bool)
            maybe[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
            hit = np.flatnonzero(maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(known, h[hit]), len(known) - 1)
            real = known[at] == h[hit]
            pair = np.unique(doc[hit[real]] * len(known) + at[real])
            owner, s = pair // len(known), score[pair % len(known)]
            up, down = np.bincount(owner, np.maximum(s, 0), minlength=n), np.bincount(owner, np.maximum(-s, 0), minlength=n)
        shape = style(buf, offsets, distinct_words(h, doc, n), words)
        return np.concatenate([np.minimum(up, 3)[:, None], np.minimum(down, 3)[:, None], shape, np.ones((n, 1))], 1)

    def probability(self, target: str, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        w = self.weights.get(target)
        if w is None:
            return np.full(len(offsets) - 1, self.prior[target])
        return 1 / (1 + np.exp(-np.clip(self.features(target, buf, offsets) @ w, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 25, penalty: float = 1.0) -> np.ndarray:
    """Newton's method with a squared penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - penalty * w
        h = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w = w + np.linalg.solve(h, g)
    return w


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS) -> Classifier:
    """Fit both targets on labelled documents; beyond about `rows` labels an even share of them by hash."""
    spark = docs.sparkSession
    marks = labels.select(F.col(f"`{id}`").alias("id"), *[F.col(t).cast("int").alias(t) for t in TARGETS]).where("id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
    n = marks.count()
    if n > rows:
        marks = marks.where(F.pmod(F.xxhash64(F.lit(17), "id"), F.lit(1 << 20)) < int((1 << 20) * rows / n))
    marks = marks.groupBy("id").agg(*[F.max(t).alias(t) for t in TARGETS])
    # `marks` has about `rows` rows at most.
    sample = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL").join(F.broadcast(marks), "id")
    sample = written(sample.select("text", *TARGETS).dropDuplicates(["text"]), "labelled")
    out = Classifier({}, {}, {})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents of each class with each word, for every target; class sizes come under a null word."""
        for b in batches:
            buf, offsets = buffers(b.column(0))
            for i, j in groups(offsets):
                h, doc, _ = document_words(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                word, index = np.unique(h, return_inverse=True)
                pair = np.unique(doc * max(1, len(word)) + index)
                doc, index = pair // max(1, len(word)), pair % max(1, len(word))
                for k, t in enumerate(TARGETS):
                    y = b.column(1 + k).slice(i, j - i).to_pandas().to_numpy()
                    n = [np.bincount(index[(y == c)[doc]], minlength=len(word)) for c in (0, 1)]
                    yield pa.RecordBatch.from_arrays([pa.array([t] * (len(word) + 1)), pa.array([*word.view(np.int64), None], pa.int64()), *(pa.array(np.append(n[c], (y == c).sum()).astype(np.int64)) for c in (0, 1))], names=["target", "word", "n0", "n1"])

    counts = sample.mapInArrow(count, "target string, word bigint, n0 bigint, n1 bigint").groupBy("target", "word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = written(counts, "words")
    for t in TARGETS:
        own = counts.where(F.col("target") == t)
        sizes = own.where("word IS NULL").first()
        n0, n1 = (sizes["n0"], sizes["n1"]) if sizes else (0, 0)
        out.prior[t] = (n1 + 1) / (n0 + n1 + 2)
        # A sign is in a twentieth of a class, so there are few: at most 20 times the words of a text.
        odds = F.log((F.col("n1") + 0.5) / (n1 - F.col("n1") + 0.5)) - F.log((F.col("n0") + 0.5) / (n0 - F.col("n0") + 0.5))
        floor = F.when(odds > 0, F.col("n1") / (n1 + 1)).otherwise(F.col("n0") / (n0 + 1))
        # Copies of one text must not make its words signs: a sign is found in a fair share of its class.
        expected = (F.col("n0") + F.col("n1")) * F.lit(out.prior[t])
        chance = (F.col("n1") - expected) / F.sqrt(expected * (1 - out.prior[t]) + 0.5)
        found = own.where(f"word IS NOT NULL AND n0 + n1 >= {LEAST_DOCS}").select("word", odds.alias("odds"), chance.alias("chance"), floor.alias("floor"))
        got = [(r["word"], r["odds"]) for r in found.where((F.abs("chance") >= SIGNIFICANT) & (F.col("floor") >= LEAST_SHARE)).toLocalIterator()]
        known = np.array([w for w, _ in got], np.int64).view(np.uint64)
        order = np.argsort(known)
        out.signs[t] = known[order], np.clip(np.array([o for _, o in got], float)[order] / 3, -1.5, 1.5)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = buffers(b.column(0))
            for i, j in groups(offsets):
                part, offs = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                x = [out.features(t, part, offs) for t in TARGETS]
                yield pa.RecordBatch.from_arrays([*(b.column(1 + k).slice(i, j - i) for k in range(len(TARGETS))), *(pa.array(list(v), pa.list_(pa.float64())) for v in x)], names=[*TARGETS, *(f"x_{t}" for t in TARGETS)])

    table = sample.mapInArrow(describe, ", ".join([*(f"{t} int" for t in TARGETS), *(f"x_{t} array<double>" for t in TARGETS)]))
    got = list(table.toLocalIterator())  # about `rows` rows of a dozen figures
    for t in TARGETS:
        y = np.array([r[t] for r in got if r[t] is not None], float)
        x = np.array([r[f"x_{t}"] for r in got if r[t] is not None], float)
        if len(y) and 0 < y.sum() < len(y):
            out.weights[t] = _logistic(x, y)
    return out


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(p / (1 - p))


def _strength(rates: DataFrame, parent: Column) -> float:
    """How many documents a prior is worth, by moments: the spread of site rates beyond what their sizes explain."""
    r = rates.agg(
        F.sum(F.col("n") * (F.col("s") / F.col("n") - parent) ** 2).alias("spread"), F.sum(parent * (1 - parent)).alias("noise"),
        F.sum(F.col("n") * parent * (1 - parent)).alias("whole"), F.count("*").alias("sites"),
    ).first()
    if not r["sites"] or not r["whole"] or r["spread"] is None:
        return MOST_STRENGTH
    between = max(0.0, (r["spread"] - r["noise"]) / r["whole"])  # share of the variance that lies between sites
    return float(min(MOST_STRENGTH, max(LEAST_STRENGTH, (1 - between) / between if between > 0 else MOST_STRENGTH)))


def score_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id: str = "doc_id", text: str = "text", model: Classifier | None = None) -> DataFrame:
    """Per row of `docs`: id, host, path, and for each target its document evidence, site rates and posterior, and `keep`.

    `labels` has the id, quality and toxic (0, 1 or null). Null texts are scored as empty ones; null
    hosts and paths are sites of their own. A row is kept if good quality is at least as likely as not
    and toxicity less likely than not. An empty `docs` gives an empty result, empty `labels` rate every
    document at even odds, so all of them fail neither test: quality 0.5 keeps. `host_*` and `path_*`
    are the rates of the whole site; a document's posterior takes them without its own evidence, which
    counts once, so a site of one document leans on its host, and a host of one on the global rate.
    Repeated rows are scored alike, stay, and count as often for their site. Texts are read whole, whatever
    their length. Other columns of `docs` are not looked at, unless `host` or `path` name them.
    """
    small_batches(docs.sparkSession)
    model = model or fit(docs, labels, id, text)
    spark = docs.sparkSession
    bound = spark.sparkContext.broadcast(model)
    base = docs.select(F.col(f"`{id}`").alias("id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = bound.value
        for b in batches:
            buf, offsets = buffers(b.column(3))
            for i, j in groups(offsets):
                part, offs = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                p = [m.probability(t, part, offs) for t in TARGETS]
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in range(3)), *map(pa.array, p)], names=["id", "host", "path", *(f"e_{t}" for t in TARGETS)])

    id_type = dict(base.dtypes)["id"]
    scored = written(base.mapInArrow(run, f"id {id_type}, host string, path string, e_quality double, e_toxic double"), "evidence")
    paths = written(scored.groupBy("host", "path").agg(F.count("*").alias("n"), *[F.sum(f"e_{t}").alias(f"s_{t}") for t in TARGETS]), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(f"s_{t}").alias(f"s_{t}") for t in TARGETS])
    whole = hosts.agg(F.sum("n").alias("n"), *[F.sum(f"s_{t}").alias(f"s_{t}") for t in TARGETS]).first()
    mean = {t: (whole[f"s_{t}"] / whole["n"] if whole["n"] else 0.5) for t in TARGETS}
    worth = {}
    for t in TARGETS:
        k = worth["host", t] = _strength(hosts.select("n", F.col(f"s_{t}").alias("s")), F.lit(mean[t]))
        hosts = hosts.withColumn(f"host_{t}", (F.col(f"s_{t}") + k * mean[t]) / (F.col("n") + k))
    hosts = hosts.select(F.col("host").alias("h"), F.col("n").alias("hn"), *[F.col(f"s_{t}").alias(f"hs_{t}") for t in TARGETS], *[f"host_{t}" for t in TARGETS])
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    for t in TARGETS:
        k = worth["path", t] = _strength(sites.select("n", F.col(f"s_{t}").alias("s"), F.col(f"host_{t}").alias("m")), F.col("m"))
        sites = sites.withColumn(f"path_{t}", (F.col(f"s_{t}") + k * F.col(f"host_{t}")) / (F.col("n") + k))
    figures = ["n", "hn", *[f"{x}_{t}" for x in ("s", "hs") for t in TARGETS]]
    sites = sites.select(F.col("host").alias("h"), F.col("path").alias("p"), *figures, *[f"{x}_{t}" for x in ("host", "path") for t in TARGETS])
    full = scored.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p"))).drop("h", "p")
    for t in TARGETS:
        own, kh, kp = F.col(f"e_{t}"), worth["host", t], worth["path", t]
        others = (F.col(f"hs_{t}") - own + kh * mean[t]) / (F.col("hn") - 1 + kh)
        others = (F.col(f"s_{t}") - own + kp * others) / (F.col("n") - 1 + kp)
        full = full.withColumn(f"p_{t}", 1 / (1 + F.exp(_logit(F.lit(mean[t])) - _logit(own) - _logit(others))))
    return full.drop(*figures).withColumn("keep", (F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5)).withColumnRenamed("id", id)
