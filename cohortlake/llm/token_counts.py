"""Token counts by the whole-token shortcut: most pre-tokens are one token, and that is known beforehand.

A merge joins two neighbours only if their concatenation is a vocabulary string. So a text can be cut,
without changing its encoding, between two characters that no vocabulary string holds side by side. The
vocabulary decides whether that covers every place where a word ends and the space mark of the next one
begins; the pieces between such places are the pre-tokens, and a text's count is the sum of theirs.

Once, on the driver, every vocabulary string is encoded by exact merging; those that come out as one
token are the proved ones. A pre-token among them counts one by a look-up, any other is merged exactly,
best score first and leftmost of equals, and its count remembered for a while.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import small_batches
from .textcore import buffers, groups

#: The mark that stands for a space in this kind of vocabulary, a fixed value.
MARK = "▁"
#: Counts of merged pre-tokens remembered per worker; results don't depend on it.
WORDS_KEPT = 400_000
#: Characters of a text handled at once.
SEGMENT = 1 << 20
#: Longer pre-tokens are cut further and merged with a heap.
LONG_WORD = 200


class Pieces:
    """Mergeable strings with their ranks (equal scores, equal ranks) and what is proved about them."""

    def __init__(self, rank: dict[str, int]):
        self.rank = rank
        self.pairs = frozenset(p[i : i + 2] for p in rank for i in range(len(p) - 1))
        known = {c for p in rank for c in p}
        if any(p[0] != MARK and p[1] == MARK for p in self.pairs):
            # Some string goes on over a space mark: the only sure cuts are at characters of no string at all.
            every = re.escape("".join(sorted(known)))
            self.shape, self.cut = f"[{every}]+|[^{every}]+", f"(?=[^{every}])"
        else:
            kinds = [f"[{re.escape(''.join(k))}]+" for k in self._kinds(known - {MARK})]
            self.shape, self.cut = f"{MARK}*(?:{'|'.join([*kinds, f'[^{MARK}]'])})|{MARK}+", f"(?<=[^{MARK}])(?={MARK})"
        self.whole = frozenset(p for p in rank if self.merged(p) == 1)

    def _kinds(self, known: set[str]) -> list[list[str]]:
        """Characters that strings hold side by side, directly or through others, most first; between two kinds no merge crosses."""
        root = {c: c for c in known}

        def find(c: str) -> str:
            while root[c] != c:
                c = root[c]
            return c

        joined = {c for p in self.pairs for c in p if MARK not in p}
        for a, b in sorted(p for p in self.pairs if MARK not in p):
            root[find(a)] = find(b)
        kinds: dict[str, list[str]] = {}
        for c in sorted(joined):
            kinds.setdefault(find(c), []).append(c)
        return sorted(kinds.values(), key=lambda k: (-len(k), k))

    # exact merging

    def merged(self, word: str) -> int:
        """Tokens of a pre-token; a character that is no token itself counts as its UTF-8 bytes."""
        if len(word) > LONG_WORD:
            return sum(map(self._heaped, self._runs(word)))
        rank, parts = self.rank, list(word)
        get, never = rank.get, len(rank)
        ranks = [get(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != never:
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], never)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], never)
        return sum([1 if p in rank else len(p.encode()) for p in parts])

    def _runs(self, word: str) -> Iterator[str]:
        """Stretches between characters that no string holds side by side."""
        start = 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in self.pairs:
                yield word[start:i]
                start = i
        yield word[start:]

    def _heaped(self, word: str) -> int:
        """The same merging with a heap of rank and place, packed into one number each."""
        n, rank = len(word), self.rank
        parts: list[str | None] = list(word)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        width = n.bit_length()
        heap: list[int] = []

        def offer(i: int, j: int) -> None:
            r = rank.get(parts[i] + parts[j])
            if r is not None:
                heapq.heappush(heap, r << width | i)

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            top = heapq.heappop(heap)
            r, i = top >> width, top & ((1 << width) - 1)
            j = after[i]
            # An entry is stale if its place is gone or what stands there now has another rank.
            if parts[i] is None or j < 0 or rank.get(parts[i] + parts[j]) != r:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return sum(1 if p in rank else len(p.encode()) for p in parts if p is not None)


class Counter:
    """Counts tokens of texts with the proved strings of `pieces` and a bounded memory of merged ones."""

    def __init__(self, pieces: Pieces, kept: int = WORDS_KEPT):
        self.pieces, self.kept = pieces, kept
        self.find = re.compile(pieces.shape).findall
        self.cut = re.compile(pieces.cut)
        self.known = dict.fromkeys(pieces.whole, 1)
        self.stats = {"seen": 0, "merged": 0}

    def segments(self, text: str) -> Iterator[str]:
        """Parts of about SEGMENT characters, cut where no merge can cross."""
        at = 0
        while len(text) - at > SEGMENT:
            m = self.cut.search(text, at + SEGMENT)
            if m is None:
                break
            yield text[at : m.start()]
            at = m.start()
        yield text[at:]

    def count(self, text: str) -> int:
        if not text:
            return 0
        total = 0
        for part in self.segments(MARK + text.replace(" ", MARK)):
            words = self.find(part)
            got = list(map(self.known.get, words))
            if None in got:
                new = {w for w, n in zip(words, got) if n is None}
                self.known |= {w: self.pieces.merged(w) for w in new}
                self.stats["merged"] += len(new)
                got = map(self.known.__getitem__, words)
            self.stats["seen"] += len(words)
            total += sum(got)
            if len(self.known) > self.kept + len(self.pieces.whole):
                self.known = dict.fromkeys(self.pieces.whole, 1)
        return total


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """Read a model with byte fallback and prove its strings, once per driver and file."""
    if path not in _PIECES:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        order = {s: k for k, s in enumerate(sorted({-model.get_score(i) for i in ids}))}
        made = Pieces({model.id_to_piece(i): order[-model.get_score(i)] for i in ids})
        own = Counter(made)
        for probe in ("a", " a", "  a  b ", "éﬁ　x", "\n\n", "<s> </s>"):  # the normalisation that is taken for granted
            if own.count(probe) != len(model.encode(probe)):
                raise ValueError(f"{path}: this vocabulary normalises texts in a way that isn't supported")
        _PIECES[path] = made
    return _PIECES[path]


_COUNTERS: dict[str, Counter] = {}


def count_tokens(df: DataFrame, path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """Add `n_bytes` (of the text in UTF-8), `n_tokens` and `over_limit` (more than `limit` tokens) to every row.

    `path` is a model file that the driver has; tasks get its strings, a table bounded by the vocabulary.
    Null and empty texts have no bytes and no tokens. Whole texts are counted, in segments of about a
    million characters, so memory follows the longest stretch without a cut, not the text. Repeated rows
    are counted alike and stay; an empty table gives an empty result. Input columns of the new names go.
    """
    spark: SparkSession = df.sparkSession
    small_batches(spark)
    new = ("n_bytes", "n_tokens", "over_limit")
    keep = [c for c in df.columns if c not in new]
    out = df.select([F.col(f"`{c}`") for c in keep])
    shape = out.select("*", F.lit(0).cast("long").alias(new[0]), F.lit(0).cast("long").alias(new[1]), F.lit(False).alias(new[2])).schema
    at = keep.index(text)
    proved = spark.sparkContext.broadcast(pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:  # a worker lives on from task to task, and so does what it has merged
            _COUNTERS[path] = Counter(proved.value)
        counter = _COUNTERS[path]
        for b in batches:
            texts = b.column(at).cast(pa.binary())
            offsets = buffers(texts)[1]
            for i, j in groups(offsets):
                n = [counter.count((t.as_py() or b"").decode("utf-8", "replace")) for t in texts.slice(i, j - i)]
                size = offsets[i + 1 : j + 1] - offsets[i:j]
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=[*keep, *new])

    return out.mapInArrow(run, shape)
