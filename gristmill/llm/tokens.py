"""Vectorised hashing of the words of whole Arrow string columns.

Everything here works on the UTF-8 bytes that Arrow already holds, a bounded
slice of a few hundred kilobytes at a time, so the memory needed does not
depend on how long a single text is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = b" \t\n\x0b\x0c\r"
CHUNK = 1 << 19
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def separators(chars: bytes = SPACE) -> np.ndarray:
    """A table of 256 flags: is this byte between words?"""
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: Words of letters and digits only, for classifiers: all other ASCII separates.
PLAIN = separators(bytes(b for b in range(128) if not (chr(b).isalnum())))
WORDS = separators()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets of the texts in them (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[at[0] : at[-1]], at - at[0]


def word_hashes(buf: np.ndarray, at: np.ndarray, gaps: np.ndarray = WORDS, fold: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words, n + 1 offsets of the texts' words, and each word's byte position.

    A word is a maximal run of bytes that gaps does not mark, and never crosses
    two texts. fold maps bytes before hashing.
    """
    edge = np.zeros(len(buf) + 1, bool)
    edge[at] = True
    hashes, starts = [], []
    lo = 0
    while lo < len(buf):
        hi = min(lo + CHUNK, len(buf))
        if hi < len(buf):  # cut where no word is cut
            cut = np.flatnonzero(gaps[buf[lo:hi]] | edge[lo:hi])
            if len(cut) and cut[-1] > 0:
                hi = lo + int(cut[-1])
            else:
                more = hi
                while more < len(buf) and not (gaps[buf[more]] or edge[more]):
                    more += 1
                hi = more
        b = buf[lo:hi]
        inside = ~gaps[b]
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[lo + 1 : hi]
        where = np.flatnonzero(inside)
        if len(where):
            heads = np.flatnonzero(first)
            letters = b[where] if fold is None else fold[b[where]]
            head_at = np.searchsorted(where, heads)
            sizes = np.diff(np.append(head_at, len(where)))
            place = np.arange(len(where)) - np.repeat(head_at, sizes)
            h = np.add.reduceat(_BYTE[letters] * _powers(int(sizes.max()))[place], head_at)
            hashes.append(mix(h + sizes.astype(np.uint64)))
            starts.append(heads + lo)
        lo = hi
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return h, np.searchsorted(s, at), s


def stem_hashes(buf: np.ndarray, at: np.ndarray, starts: np.ndarray, n: int, gaps: np.ndarray = WORDS, fold: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the first n bytes of the words that start there (of the whole word, if shorter)."""
    last = np.repeat(at[1:], np.diff(np.searchsorted(starts, at)))
    h, alive = np.zeros(len(starts), np.uint64), np.ones(len(starts), bool)
    for i in range(n):
        here = starts + i
        alive = alive & (here < last)
        b = buf[np.minimum(here, max(len(buf) - 1, 0))]
        alive &= ~gaps[b]
        with np.errstate(over="ignore"):
            h += np.where(alive, _BYTE[b if fold is None else fold[b]] * _powers(n)[i], np.uint64(0))
    return mix(h + np.uint64(1))


_known = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _known
    if len(_known) < n:
        with np.errstate(over="ignore"):
            _known = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1024) * 2, _BASE))])
    return _known


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words; len(words) - n + 1 of them, across texts too."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out + words[i : len(words) - n + 1 + i]) * _BASE
    return mix(out)


def per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of flags within each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def batches(table: pa.RecordBatch, text: str = "text", most: int = 4 << 20):
    """Slices of a batch with about `most` bytes of text each (a longer text is alone)."""
    column = table.column(table.schema.get_field_index(text))
    _, at = raw(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield table.slice(lo, hi - lo)
        lo = hi
