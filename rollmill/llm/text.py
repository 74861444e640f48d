"""Words of Arrow text columns as numpy arrays: no Python string per word on the hot path.

A piece is a run of whole texts in one byte buffer, each followed by one separator byte. Words are byte
ranges of a piece; their 64-bit hashes are polynomial sums taken from one running sum over the bytes.
Two different words of a corpus of n distinct words collide with probability about n * n / 2**65.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
U64 = np.uint64

_bytes = np.arange(256)
#: Bytes that end a word: space and tab to carriage return.
SPACE = (_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D))
#: Bytes that end a word of letters and digits: all of ASCII but 0-9 A-Z a-z. Multi-byte characters are letters.
NOT_ALNUM = (_bytes < 0x80) & ~(((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x41) & (_bytes <= 0x5A)) | ((_bytes >= 0x61) & (_bytes <= 0x7A)))
LOWER = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over the output."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_CODE_LOWER = _CODE[LOWER]
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if len(have := _powers.get(base, ())) < n:
        out = np.full(max(n, 1 << 16), base, U64)
        out[0] = 1
        have = _powers[base] = np.multiply.accumulate(out)
    return have[:n]


@dataclass
class Piece:
    """Texts ``lo`` to ``hi`` of a batch: their bytes, each text's first byte, and the words with their texts."""

    lo: int
    hi: int
    buf: np.ndarray
    text_at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each text's words, with one more entry at the end

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = True) -> np.ndarray:
        return hash_ranges(self.buf, self.start, self.end, lower)


def unused(names: list[str], wanted: str) -> str:
    """``wanted``, with as many underscores at its end as make it a name that isn't taken (case aside)."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks, and allocators keep what was freed."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


def pieces(column: pa.Array | pa.ChunkedArray, ends_word: np.ndarray = SPACE, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cut a text column into pieces of about ``limit`` bytes. A null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1))
        buf = np.insert(data[at[lo] : at[hi]], at[lo + 1 : hi + 1] - at[lo], np.uint8(0x20))
        text_at = at[lo:hi] - at[lo] + np.arange(hi - lo)
        edge = np.diff(ends_word[buf].view(np.int8), prepend=np.int8(1))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        first = np.append(np.searchsorted(start, text_at), len(start))
        yield Piece(lo, hi, buf, text_at, start, end, first)
        lo = hi
    if n:
        del buf, text_at, edge, start, end, first
        give_back()


def hash_ranges(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True, block: int = 1 << 18) -> np.ndarray:
    """64-bit hash of each byte range (ranges ascend and don't overlap), in blocks of about ``block`` bytes."""
    out, code, k = np.empty(len(start), U64), _CODE_LOWER if lower else _CODE, 0
    while k < len(start):
        a = int(start[k])
        m = max(k + 1, int(np.searchsorted(end, a + block, "right")))
        s, e = start[k:m] - a, end[k:m] - a
        size = int(e[-1])
        run = np.zeros(size + 1, U64)
        np.cumsum(code[buf[a : a + size]] * _power(_BASE, size), out=run[1:])
        out[k:m] = (run[e] - run[s]) * _power(_INVERSE, size + 1)[s] + (e - s).astype(U64)
        k = m
    return mix(out)


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words; a shorter text has one run, of all its words."""
    n = len(words)
    factors = mix(np.arange(1, width + 1, dtype=U64) * U64(0xA24BAED4963EE407)) | U64(1)
    whole = np.zeros(0, U64)
    if n >= width:
        whole = words[: n - width + 1] * factors[0]
        for j in range(1, width):
            whole = whole + words[j : n - width + 1 + j] * factors[j]
        whole = mix(whole)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            short = (words[a:b] * factors[: b - a]).sum(dtype=U64) ^ (U64(b - a) << U64(59))
            out.append(mix(np.array([short], U64)))
        else:
            out.append(np.zeros(0, U64))
    return out
