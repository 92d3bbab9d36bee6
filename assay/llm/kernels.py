"""Vectorised kernels over the UTF-8 bytes of Arrow string columns.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; none of those bytes occurs inside a
multi-byte character, so words can be found in the encoded text. All hashes are 64-bit and depend on
content alone, so they agree between tasks, executors and runs.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
#: Bytes whose hash prefix sums are held at once. Longer words are hashed by xxhash.
BLOCK = 1 << 20
#: Text bytes that a kernel works on at once; one longer document is taken alone.
CHUNK = 512 << 10
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


#: Classes of code points, as bits: letters, combining marks, capitals, digits, ends of sentences, and letters of scripts that
#: are written without blanks between words.
LETTER, MARK, UPPER, DIGIT, STOP, UNSPACED = 1, 2, 4, 8, 16, 32
# Ends of sentences, and the blocks of scripts without blanks (Thai to Myanmar, Khmer, Kana to Han, Han beyond the first plane).
STOPS = ".!?…。！？｡؟۔।॥።"
UNSPACED_BLOCKS = ((0x0E00, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_CLASS: np.ndarray | None = None


def classes() -> np.ndarray:
    """The class bits of every code point; made once a process."""
    global _CLASS
    if _CLASS is None:
        kinds = {"Lu": LETTER | UPPER, "Lt": LETTER | UPPER, "Ll": LETTER, "Lm": LETTER, "Lo": LETTER, "Mn": MARK, "Mc": MARK, "Me": MARK, "Nd": DIGIT}
        made = np.fromiter((kinds.get(unicodedata.category(chr(c)), 0) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
        made[[ord(c) for c in STOPS]] |= STOP
        for low, high in UNSPACED_BLOCKS:
            part = made[low : high + 1]
            part[(part & LETTER) > 0] |= UNSPACED
        _CLASS = made
    return _CLASS


def code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each code point of UTF-8 text begins, its class bits)."""
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    first = raw[at].astype(np.int64)
    value = first.copy()
    wide = np.flatnonzero(first >= 0xC0)
    if len(wide):
        ahead = np.concatenate([raw, np.zeros(3, np.uint8)]).astype(np.int64) & 0x3F
        lead, begin = first[wide], at[wide]
        two = ((lead & 0x1F) << 6) | ahead[begin + 1]
        three = ((lead & 0x0F) << 12) | (ahead[begin + 1] << 6) | ahead[begin + 2]
        four = ((lead & 0x07) << 18) | (ahead[begin + 1] << 12) | (ahead[begin + 2] << 6) | ahead[begin + 3]
        value[wide] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, np.minimum(four, sys.maxunicode)))
    return at, classes()[value]


def byte_classes(raw: np.ndarray) -> np.ndarray:
    """The class bits of the code point to which each byte belongs."""
    at, bits = code_points(raw)
    return np.repeat(bits, np.diff(np.append(at, len(raw)))) if len(at) else np.zeros(len(raw), np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = np.asarray(x, U)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_BASE = 0x9E3779B97F4A7C15
_TABLE = mix(np.arange(1, 257, dtype=U))
_POWERS: tuple[np.ndarray, np.ndarray] | None = None


def _powers() -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if _POWERS is None:
        made = []
        for base in (_BASE, _inverse(_BASE)):
            x = np.full(BLOCK + 1, base, U)
            x[0] = 1
            made.append(np.cumprod(x, dtype=U))
        _POWERS = tuple(made)
    return _POWERS


def string_parts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def chunks(raw: np.ndarray, offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of groups of whole texts of about `limit` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at text boundaries."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of all words."""
    start, end = runs(~WHITE[raw], offsets)
    return start, end, np.searchsorted(offsets, start, "right") - 1


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; spans are ascending and disjoint."""
    power, inverse = _powers()
    out = np.empty(len(start), U)
    i = 0
    while i < len(start):
        base = start[i]
        j = int(np.searchsorted(end, base + BLOCK, "right"))
        if j <= i:
            out[i] = U(xxhash.xxh64_intdigest(raw[start[i] : end[i]].tobytes()))
            i += 1
            continue
        seg = raw[base : end[j - 1]]
        total = np.zeros(len(seg) + 1, U)
        np.cumsum(_TABLE[seg] * power[: len(seg)], out=total[1:])
        s, e = start[i:j] - base, end[i:j] - base
        out[i:j] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(U))
        i = j
    return out


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """out[i]: a hash of the sequence h[i : i + n]."""
    if len(h) < n:
        return np.zeros(0, U)
    power, size, out, done = h, 1, None, 0
    m = n
    while m:
        if m & 1:
            part = power
            if out is None:
                out, done = part, size
            else:
                k = len(h) - done - size + 1
                out = mix(out[:k] * U(0xFF51AFD7ED558CCD) + part[done : done + k] + U(done))
                done += size
        m >>= 1
        if m:
            k = len(power) - size
            power = mix(power[:k] * U(0xC2B2AE3D27D4EB4F) + power[size : size + k] + U(size))
            size *= 2
    return out


def windows(doc: np.ndarray, n: int) -> np.ndarray:
    """Starts of the n-word windows that stay in one text."""
    if len(doc) < n:
        return np.zeros(0, np.int64)
    return np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])


def per_text(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marked bytes each text has."""
    return np.diff(np.searchsorted(np.flatnonzero(marked), offsets))


def covered(start: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n positions lie in one of the spans [start, start + length)."""
    step = np.bincount(start, minlength=n + 1) - np.bincount(start + length, minlength=n + 1)
    return np.cumsum(step[:n]) > 0
