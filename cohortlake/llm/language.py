"""Language identification as a mixture: which languages a text holds, and in which shares.

Training counts byte trigrams per language over a bounded sample of labelled rows. A text is taken as
a draw of trigrams from a mixture of languages; expectation-maximisation finds the shares, and the
set of languages is the one with the best likelihood after a penalty per language. A block of texts
is solved together: its distinct (text, trigram) pairs are one sorted array, and every step is a few
numpy operations over it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import small_batches
from .textcore import buffers, groups, lowered, mix

#: Trigrams are hashed to this many values.
GRAMS = 1 << 15
#: Training takes all labelled rows of a language up to about an equal part of this number, LEAST_ROWS at least; beyond it an even share by hash.
TRAIN_ROWS, LEAST_ROWS = 20_000, 200
SMOOTHING, ROUNDS, LEAST_SHARE = 0.5, 8, 0.02
#: Neighbouring trigrams overlap in two letters of three: a text has about a third as many independent ones.
OVERLAP = 3.0
_TABLES = [(mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(k)) & np.uint64(GRAMS - 1)).astype(np.uint16) for k in (3, 5, 7)]


@dataclass
class LanguageModel:
    languages: list[str]
    logp: np.ndarray  # (GRAMS, languages), natural logarithms
    prior: np.ndarray


def gram_keys(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted text * GRAMS + trigram, for each letter with its neighbours; non-letters all count as one separator."""
    if not len(buf):
        return np.zeros(0, np.int64)
    b = lowered(buf)
    # Accented capitals of Latin-1 in UTF-8: C3 80..9E becomes C3 A0..BE.
    b[1:] += ((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)).astype(np.uint8) * np.uint8(32)
    letter = ((b >= 97) & (b <= 122)) | (b >= 128)
    b = np.where(letter, b, np.uint8(0))
    full = offsets[:-1] < offsets[1:]
    before, after = np.empty_like(b), np.empty_like(b)
    before[0], after[-1] = 0, 0
    before[1:], after[:-1] = b[:-1], b[1:]
    before[offsets[:-1][full]] = 0
    after[offsets[1:][full] - 1] = 0
    at = np.flatnonzero(letter)
    gram = (_TABLES[0][before[at]] ^ _TABLES[1][b[at]] ^ _TABLES[2][after[at]]).astype(np.int64)
    keys = gram + (np.searchsorted(offsets[1:], at, "right") * GRAMS)
    keys.sort()
    return keys


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = TRAIN_ROWS) -> LanguageModel:
    """Learn trigram likelihoods from rows with text and language; about `rows` of them at most.

    The bound is shared out by language, LEAST_ROWS or more to each, so a rare language is learned at
    every size of the input. Priors come from the counts of all labelled rows.
    """
    labelled = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    # One row for each language.
    have = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().toLocalIterator()}
    each = max(LEAST_ROWS, rows // max(1, len(have)))
    many = {k: each / n for k, n in have.items() if n > each}
    if many:
        share = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
        place = F.pmod(F.xxhash64(F.lit(11), "key"), F.lit(1 << 20)) / F.lit(1 << 20)
        labelled = labelled.where(place < F.coalesce(share[F.col("lang")], F.lit(1.0)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column(1).to_pylist(), object)
            buf, offsets = buffers(b.column(0))
            for i, j in groups(offsets):
                keys = gram_keys(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                doc, gram = keys // GRAMS, keys % GRAMS
                for name in set(langs[i:j]):
                    total[name] = total.get(name, 0) + np.bincount(gram[(langs[i:j] == name)[doc]], minlength=GRAMS)
        for name, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(c[at])], names=["lang", "gram", "n"])

    # At most GRAMS rows for each language come back, however large the sample is.
    got = labelled.select("text", "lang").mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(got["lang"].unique().tolist())
    logp, prior = np.zeros((GRAMS, len(languages))), np.zeros(len(languages))
    for k, name in enumerate(languages):
        grams = got[got["lang"] == name]
        c = np.full(GRAMS, SMOOTHING)
        c[grams["gram"].to_numpy()] += grams["n"].to_numpy()
        logp[:, k] = np.log(c / c.sum())
        prior[k] = have[name] + 1
    return LanguageModel(languages, logp, prior / max(1.0, prior.sum()))


def solve(model: LanguageModel, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares (n x languages; zero outside the selected set) and the mean gain per trigram over chance, in bits."""
    langs = len(model.languages)
    shares, gain = np.zeros((n, langs)), np.zeros(n)
    if not len(keys) or not langs:
        return shares, gain
    lead = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count = np.diff(np.append(lead, len(keys))).astype(float)
    doc, gram = keys[lead] // GRAMS, keys[lead] % GRAMS
    logp = model.logp[gram]
    top = logp.max(1)
    p = np.exp(logp - top[:, None])

    def em(pick: np.ndarray, pi: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """EM on the entries `pick` (whole texts, in order) from shares pi; the shares and the log-likelihood."""
        own, c, q = doc[pick], count[pick], p[pick]
        edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ids = own[edge]
        slot = np.repeat(np.arange(len(ids)), np.diff(np.append(edge, len(own))))
        total = np.add.reduceat(c, edge)
        for _ in range(rounds):
            r = q * pi[ids][slot]
            r *= (c / np.maximum(r.sum(1), 1e-300))[:, None]
            pi[ids] = np.add.reduceat(r, edge) / total[:, None]
        s = np.maximum((q * pi[ids][slot]).sum(1), 1e-300)
        ll = np.full(n, -np.inf)
        ll[ids] = np.add.reduceat(c * (np.log(s) + top[pick]), edge)
        return pi, ll

    every = np.arange(len(doc))
    size = np.bincount(doc, count, minlength=n)
    pi, _ = em(every, np.tile(model.prior, (n, 1)), ROUNDS)
    rank = np.argsort(-pi, 1, kind="stable")
    best, chosen = np.full(n, -np.inf), np.zeros((n, langs))
    for k in range(1, langs + 1):
        need = (size > 0) & (np.take_along_axis(pi, rank[:, k - 1 : k], 1)[:, 0] >= (LEAST_SHARE if k > 1 else 0))
        pick = every[need[doc]]
        if not len(pick):
            break
        start = np.zeros((n, langs))
        np.put_along_axis(start, rank[:, :k], np.maximum(np.take_along_axis(pi, rank[:, :k], 1), 1e-9), 1)
        start /= start.sum(1, keepdims=True)
        start, ll = em(pick, start, 0 if k == 1 else ROUNDS // 2)
        value = ll / OVERLAP - (k - 1) / 2 * np.log(np.maximum(size / OVERLAP, 2))
        better = need & (value > best)
        best[better], chosen[better] = value[better], start[better]
        gain[better] = (ll[better] / size[better] + np.log(GRAMS)) / np.log(2)
    return chosen, gain


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add lang_pred, score, languages, shares and gain to every row.

    `lang_pred` is the language of the largest share and `score` that share; `languages` and `shares`
    are the selected set, largest first. A null or empty text and one without a letter get `und`, 0 and
    empty lists, as does every text if the model knows no language. `gain` tells how many bits per
    trigram the text is more likely than chance. Whole texts are read, whatever their length; input columns
    of these names go. Languages of equal shares are taken in the order of their names. Repeated rows are
    judged alike and stay; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    new = ("lang_pred", "score", "languages", "shares", "gain")
    keep = [c for c in docs.columns if c not in new]
    base = docs.select([F.col(f"`{c}`") for c in keep])
    shape = base.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.array(F.lit("")).alias("languages"), F.array(F.lit(0.0)).alias("shares"), F.lit(0.0).alias("gain")).schema
    at = keep.index(text)
    names = np.array([*model.languages, "und"], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = buffers(b.column(at))
            for i, j in groups(offsets):
                part, offs, n = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], j - i
                shares, gain = solve(model, gram_keys(part, offs), n)
                ascii_letter = ((part | np.uint8(32)) - np.uint8(97)) < 26
                letters = np.diff(np.concatenate([[0], np.cumsum(ascii_letter)])[offs]) > 0
                for k in np.flatnonzero(~letters & (np.diff(offs) > 0)):
                    letters[k] = any(map(str.isalpha, bytes(part[offs[k] : offs[k + 1]]).decode("utf-8", "replace")))
                known = letters & bool(model.languages)
                shares[~known] = 0
                gain[~known] = 0
                first = np.where(known, shares.argmax(1) if shares.shape[1] else 0, len(model.languages))
                score = shares.max(1) if shares.shape[1] else np.zeros(n)
                order = np.argsort(-shares, 1, kind="stable")
                sets = [[(names[x], float(s[x])) for x in o if s[x] > 0] for o, s in zip(order, shares)]
                yield pa.RecordBatch.from_arrays(
                    [*b.slice(i, n).columns, pa.array(names[first], pa.string()), pa.array(np.minimum(score, 1.0)),
                     pa.array([[x for x, _ in s] for s in sets], pa.list_(pa.string())), pa.array([[y for _, y in s] for s in sets], pa.list_(pa.float64())), pa.array(gain)],
                    names=[*keep, *new],
                )

    return base.mapInArrow(run, shape)
