"""URL filters: all glob rules at once, as one bit-parallel Shift-And automaton.

Every rule (host, path) becomes two globs over the canonical URL, host + 0xFF + path: `host 0xFF path*`
and `*.host 0xFF path*`. That byte occurs in no UTF-8 text and no star takes it, so hosts and paths
can't run into each other. The patterns are packed into the bits of as many 64-bit words as they need; one step
shifts all of them and masks with the bits that accept the next byte. The URLs of a batch advance
together, one byte position at a time, so a step is a few numpy operations on (urls x words).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textcore import buffers

#: The rules of the `op6` query as (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Automaton:
    """accept[b, w]: bits whose pattern position takes byte b. start: bits set before the first byte.
    loop: bits that stay on any byte (a star). final: (pattern, word, bit) of last positions."""

    accept: np.ndarray
    start: np.ndarray
    loop: np.ndarray
    final: list[tuple[int, int, int]]


def compile_globs(globs: list[bytes]) -> Automaton:
    """A glob is bytes in which `*` stands for any bytes but 0xFF, also none; it must fit the whole string.

    A star occupies a bit that loops; since it may match nothing, whatever enters it also enters the
    next position. Runs of stars count as one.
    """
    pieces = []
    for g in globs:
        while b"**" in g:
            g = g.replace(b"**", b"*")
        pieces.append(g)
    size = sum(len(g) + 1 for g in pieces)
    words = max(1, (size + 63) // 64)
    accept, start, loop = np.zeros((256, words), np.uint64), np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    final, at = [], 0
    for k, g in enumerate(pieces):
        # bit `at` is the pattern's state "nothing read yet"; it is set once before the first byte.
        start[at >> 6] |= np.uint64(1 << (at & 63))
        for c in g:
            at += 1
            bit = np.uint64(1 << (at & 63))
            if c == 42:
                loop[at >> 6] |= bit
                accept[:255, at >> 6] |= bit
            else:
                accept[c, at >> 6] |= bit
        final.append((k, at >> 6, at & 63))
        at += 1
    return Automaton(accept, start, loop, final)


def _shift(x: np.ndarray) -> np.ndarray:
    """One bit up across the words of each row."""
    out = x << np.uint64(1)
    if x.shape[1] > 1:
        out[:, 1:] |= x[:, :-1] >> np.uint64(63)
    return out


def simulate(a: Automaton, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(strings x patterns) of bool: which globs fit which whole strings."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = offsets[:-1][order], lengths[order]
    state = np.broadcast_to(a.start, (n, len(a.start))).copy()
    state |= _shift(state) & a.loop  # a star right at the start may match nothing
    live = n
    for j in range(int(lengths[0]) if n else 0):
        while live and lengths[live - 1] <= j:
            live -= 1
        s = state[:live]
        s = (_shift(s) | (s & a.loop)) & a.accept[buf[begin[:live] + j]]
        state[:live] = s | (_shift(s) & a.loop)
    out = np.zeros((n, len(a.final)), bool)
    for k, w, b in a.final:
        out[order, k] = (state[:, w] >> np.uint64(b)) & np.uint64(1)
    return out


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def filter_urls(df: DataFrame, url: str = "url", rules: list[tuple[str, str, str]] = RULES, default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to every row; the input's other columns stay, its columns of these names go.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest fitting
    rule decides, equal lengths by their text. Without one, rule is null and verdict is `default`.
    Null and odd URLs have an empty host and path, which no rule with a host fits. URLs of any length are
    read to their end. Repeated rows are judged alike and stay; an empty table gives an empty result.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    globs = [g for _, h, p in ranked for g in (h.encode() + b"\xff" + p.encode() + b"*", b"*." + h.encode() + b"\xff" + p.encode() + b"*")]
    names, verdicts = [h + p for _, h, p in ranked], [v for v, _, _ in ranked]

    host, path = url_parts(F.col(f"`{url}`"))
    keep = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    out = df.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"))
    shape = out.select("*", F.lit("").alias("rule"), F.lit("").alias("verdict")).schema
    for f in shape.fields[-2:]:
        f.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = compile_globs(globs)
        for b in batches:
            joined = pc.binary_join_element_wise(b.column(len(keep)).cast(pa.binary()), b.column(len(keep) + 1).cast(pa.binary()), b"\xff")
            hits = simulate(a, *buffers(joined))
            fits = hits[:, 0::2] | hits[:, 1::2] if len(ranked) else np.zeros((b.num_rows, 0), bool)
            best = np.where(fits.any(1), fits.argmax(1), len(ranked)) if len(ranked) else np.zeros(b.num_rows, int)
            rule = pa.array([*names, None], pa.string()).take(pa.array(best))
            verdict = pa.array([*verdicts, default], pa.string()).take(pa.array(best))
            yield pa.RecordBatch.from_arrays([*b.columns, rule, verdict], names=[*b.schema.names, "rule", "verdict"])

    return out.mapInArrow(run, shape)
