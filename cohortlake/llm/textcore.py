"""Vectorised handling of words inside tasks: one Arrow column of texts in, numpy arrays out.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. A word's hash is the sum of its bytes,
each mixed with its place in the word, taken from prefix sums over the whole buffer and mixed again, so
that no Python object is made per word. Where equality must be sure, digests of the words' bytes decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
_M = np.uint64(0x9E3779B97F4A7C15)
_POW: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        x = np.full(max(n, BLOCK + 1), base, np.uint64)
        x[0] = 1
        have = _POW[base] = np.multiply.accumulate(x)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and n+1 offsets into them; a null text has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if offs else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(offsets: np.ndarray, most: int = 4 * BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts that have about `most` bytes together, or one longer text.

    After the last range, memory that the blocks have freed goes back to the system: a worker lives on
    from task to task, and what its allocators hold back would count against the executor.
    """
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (n+1 numbers)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    sep = (buf == 32) | ((buf - np.uint8(9)) < 5)
    full = offsets[:-1] < offsets[1:]
    first, last = np.empty(len(buf), bool), np.empty(len(buf), bool)
    first[0], last[-1] = True, True
    first[1:], last[:-1] = sep[:-1], sep[1:]
    first[offsets[:-1][full]] = True
    last[offsets[1:][full] - 1] = True
    word = ~sep
    first &= word
    last &= word
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(buf: np.ndarray) -> np.ndarray:
    """A-Z become a-z; every other byte stays."""
    return buf + ((buf - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int = 0) -> np.ndarray:
    """A hash of each word's bytes. With a `key` that nobody knows no words can be made up that collide."""
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    own = np.uint64((key * int(_M) + 0xD6E8FEB86659FD93) % (1 << 64))
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        a, b = starts[i], ends[j - 1]
        s, e = starts[i:j] - a, ends[i:j] - a
        # Distance from the start of the word that a byte belongs to; separators go with the word before.
        x = np.arange(b - a, dtype=np.uint64) - np.repeat(s, np.diff(np.append(s, b - a))).astype(np.uint64)
        x <<= np.uint64(8)
        x |= buf[a:b]
        x += np.uint64(1)
        x *= _M
        x += own
        x = mix(x)
        c = np.empty(len(x) + 1, np.uint64)
        c[0] = 0
        np.cumsum(x, out=c[1:])
        out[i:j] = c[e] - c[s]
        i = j
    out += (ends - starts).astype(np.uint64) * _M
    return mix(out)


def normal(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space between them (none where texts meet), and where each starts and ends there."""
    sep = (buf == 32) | ((buf - np.uint8(9)) < 5)
    keep = ~sep
    after = ends[ends < len(buf)]
    keep[after] = True
    place = np.cumsum(keep)
    out = np.where(sep, np.uint8(32), buf)[keep]
    return out, place[starts] - 1, place[ends - 1]


def rolled(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """For each i up to len(h)-width a hash of h[i:i+width], in their order."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    c = np.empty(len(h) + 1, np.uint64)
    c[0] = 0
    np.cumsum(h * powers(base, len(h)), out=c[1:])
    out = c[width:] - c[:n]
    out *= powers(pow(base, -1, 1 << 64), n)
    return mix(out)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], .. starts[0]+counts[0]-1, starts[1], .. as one array."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)
