"""BPE encoding and decoding by speculation: guess greedily, verify pairs, merge exactly only where the guess fails.

A segmentation of a word into vocabulary tokens is the one that BPE merging gives if each of its
tokens encodes to itself and each adjacent pair of tokens encodes to itself: before the first merge
across a border, both neighbours evolve as they do alone, so the first such merge would also happen
in the pair. The greedy longest-match guess is therefore checked pair by pair, for all new words of a
block at once, against a growing sorted table of judged pairs.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import small_batches
from .textcore import buffers, groups

#: Words remembered per Python worker; the memory is emptied when it is full, results don't depend on it.
WORDS_KEPT = 300_000
#: Judged pairs remembered per Python worker, besides those of the present block.
PAIRS_KEPT = 2_000_000
#: Longer words are merged with a heap.
LONG_WORD = 200
NEVER = 1 << 60
#: What counts as white space to the tokenizer's patterns.
SPACE = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next free one from U+0100 for the others."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder for a vocabulary file with byte-level letters and a word-end suffix."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.end: str = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.names = {i: t for t, i in {**self.vocab, **self.special}.items()}
        self.letters = byte_letters()
        bare = {t.removesuffix(self.end) for t in self.vocab} | set(self.vocab)
        #: All beginnings of tokens: where a text stops being one, no longer token fits.
        self.beginnings = {t[:k] for t in bare for k in range(1, len(t) + 1)}
        rule = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # The same alternatives; \s is spelled out, as the libraries differ in what it covers.
        self.split = regex.compile(rule.replace(r"[^\s", f"[^{SPACE}"), regex.V0)
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.single: dict[int, bool] = {}
        self.judged = np.zeros(0, np.int64)  # pairs a * size + b, sorted
        self.good = np.zeros(0, bool)
        self.size = 1 + max(self.names)
        self.ids: dict[str, bytes] = {}
        self.shown: dict[str, bytes] = {}
        self.stats = {"words": 0, "merged": 0}

    # exact merging -------------------------------------------------------------------------------

    def merge(self, symbols: list[str]) -> list[int]:
        """The lowest-ranked adjacent pair merges first, the leftmost of equals."""
        if len(symbols) > LONG_WORD:
            return self._merge_long(symbols)
        rank = self.rank
        ranks = [rank.get(p, NEVER) for p in zip(symbols, symbols[1:])]
        while ranks and (lowest := min(ranks)) != NEVER:
            i = ranks.index(lowest)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank.get((symbols[i - 1], symbols[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank.get((symbols[i], symbols[i + 1]), NEVER)
        return [self.vocab[s] for s in symbols]

    def _merge_long(self, symbols: list[str]) -> list[int]:
        """The same with a heap and links between neighbours, for words where lists would be slow."""
        n, rank = len(symbols), self.rank
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := rank.get((a, b))) is not None]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j < 0 or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], gone[j] = a + b, 1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
            if (h := before[i]) >= 0 and (r := rank.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
        return [self.vocab[s] for s, g in zip(symbols, gone) if not g]

    def symbols(self, text: str, last: bool) -> list[str]:
        out = list(text)
        if last:
            out[-1] += self.end
        return out

    # speculation ---------------------------------------------------------------------------------

    def guess(self, text: str) -> list[int]:
        """Greedy longest match; the token that reaches the word's end carries the suffix."""
        vocab, beginnings, n, i, out = self.vocab, self.beginnings, len(text), 0, []
        while i < n:
            best, at, j = None, i, i + 1
            while (piece := text[i:j]) in beginnings:
                if j == n:
                    if (t := vocab.get(piece + self.end)) is not None:
                        out.append(t)
                        return out
                    break
                if (t := vocab.get(piece)) is not None:
                    best, at = t, j
                j += 1
            if best is None:
                return []  # no token fits here: left to exact merging
            out.append(best)
            i = at
        return out

    def pieces(self, token: int) -> tuple[list[str], bool]:
        name = self.names[token]
        last = bool(self.end) and name.endswith(self.end)
        return self.symbols(name.removesuffix(self.end) if last else name, last), last

    def stands(self, token: int) -> bool:
        """Does the token encode to itself?"""
        if token not in self.single:
            self.single[token] = self.merge(self.pieces(token)[0]) == [token]
        return self.single[token]

    def judge(self, pairs: np.ndarray) -> None:
        """Extend the table of judged pairs by those that are new; a full table starts again from these."""
        if len(self.judged) > PAIRS_KEPT:
            self.judged, self.good = self.judged[:0], self.good[:0]
        fresh = np.setdiff1d(pairs, self.judged)
        if len(fresh):
            verdict = np.fromiter((self._compatible(int(p) // self.size, int(p) % self.size) for p in fresh), bool, len(fresh))
            merged = np.concatenate([self.judged, fresh])
            order = np.argsort(merged, kind="stable")
            self.judged, self.good = merged[order], np.concatenate([self.good, verdict])[order]

    def _compatible(self, a: int, b: int) -> bool:
        (left, ended), (right, _) = self.pieces(a), self.pieces(b)
        return not ended and self.stands(a) and self.stands(b) and self.merge(left + right) == [a, b]

    def learn(self, words: set[str]) -> None:
        """Encode words that aren't remembered yet."""
        words = list(words)
        texts = ["".join([self.letters[b] for b in w.encode("utf-8", "surrogatepass")]) for w in words]
        found = [self.guess(t) for t in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for f in found for t in f), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(words)), counts)
        pairs = flat[:-1] * self.size + flat[1:]
        inside = owner[:-1] == owner[1:]
        pairs, owner = pairs[inside], owner[:-1][inside]
        self.judge(np.unique(pairs))
        failed = counts == 0
        failed[owner[~self.good[np.searchsorted(self.judged, pairs)]]] = True
        for k in np.flatnonzero(counts == 1):
            failed[k] |= not self.stands(found[k][0])
        for k in np.flatnonzero(failed):
            found[k] = self.merge(self.symbols(texts[k], True))
        self.stats["words"] += len(words)
        self.stats["merged"] += int(failed.sum())
        for w, f in zip(words, found):
            self.ids[w] = np.asarray(f, "<u4").tobytes()
            self.shown[w] = self.decode(f).encode()

    # whole texts ---------------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # lower-cased letter by letter: no special form at a word's end
                text = text.replace("Σ", "σ")
        return self.split.findall(text.lower())

    def parts(self, text: str) -> list[list[str] | int]:
        """Lists of words, and ids of special tokens between them."""
        if self.cut is None or not self.cut.search(text):
            return [self.words(text)]
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [self.words(text[at : m.start()]), self.special[m.group()]]
            at = m.end()
        return [*out, self.words(text[at:])]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids as little-endian unsigned 32-bit integers, and the decoded text in UTF-8."""
        split = [self.parts(t) for t in texts]
        if len(self.ids) > WORDS_KEPT:  # before asking what is known, so that all of this block is known after it
            self.ids.clear()
            self.shown.clear()
        fresh = {w for ps in split for p in ps if isinstance(p, list) for w in p}
        fresh.difference_update(self.ids)
        if fresh:
            self.learn(fresh)
        out = []
        for ps in split:
            if len(ps) == 1:
                out.append((b"".join(map(self.ids.__getitem__, ps[0])), b" ".join(map(self.shown.__getitem__, ps[0]))))
            else:
                a = [x for p in ps for x in (map(self.ids.__getitem__, p) if isinstance(p, list) else [p.to_bytes(4, "little")])]
                b = [x for p in ps for x in (map(self.shown.__getitem__, p) if isinstance(p, list) else [self.names[p].encode()])]
                out.append((b"".join(a), b" ".join(b)))
        return out

    def decode(self, ids: list[int]) -> str:
        """Token names joined by spaces, as a vocabulary without a decoder is shown; unknown ids are left out."""
        return " ".join(self.names[i] for i in ids if i in self.names)


_CODEC: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per Python worker and file."""
    if path not in _CODEC:
        with open(path, encoding="utf-8") as f:
            _CODEC[path] = Codec(json.load(f))
    return _CODEC[path]


def encode_decode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add `ids` (binary, little-endian unsigned 32-bit integers) and `decoded` (string) to every row.

    `path` is a vocabulary file that every node has; it is opened there, never copied. Null and empty
    texts have no ids and an empty decoding. Repeated rows are coded alike and stay. Texts are coded whole;
    memory follows the length of the longest, and what a worker remembers is emptied when it is full. An
    empty table gives an empty result. Input columns named ids or decoded go.
    """
    small_batches(df.sparkSession)
    keep = [c for c in df.columns if c not in ("ids", "decoded")]
    out = df.select([F.col(f"`{c}`") for c in keep])
    shape = out.select("*", F.lit(b"").alias("ids"), F.lit("").alias("decoded")).schema
    at = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            texts = b.column(at)
            for i, j in groups(buffers(texts)[1], 1 << 20):
                got = c.encode([t or "" for t in texts.slice(i, j - i).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*b.slice(i, j - i).columns, pa.array([x for x, _ in got], pa.binary()), pa.array([y for _, y in got], pa.binary()).cast(pa.string())],
                    names=[*b.schema.names, "ids", "decoded"],
                )

    return out.mapInArrow(run, shape)


def decode_ids(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the decoding of a column of ids (as `encode_decode` gives them); null gives an empty text."""
    keep = [c for c in df.columns if c != out]
    df = df.select([F.col(f"`{c}`") for c in keep])
    shape = df.select("*", F.lit("").alias(out)).schema
    at = keep.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            shown = [c.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shown, pa.string())], names=[*b.schema.names, out])

    return df.mapInArrow(run, shape)
