"""Vectorised word hashing over Arrow string columns (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes of text worked on at a time; their 64-bit hashes fit a core's own cache.
SLICE = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * _R)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
#: White space of the word rule [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers["r"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for k, base in (("r", _R), ("i", _R_INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x)
    return _powers["r"][:n], _powers["i"][:n]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its row offsets; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _hash_slice(b: np.ndarray, first: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and word starts of b; no word runs across a position in first."""
    word = ~SPACE[b]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    first = first[first < len(b)]
    begin[first] = word[first]
    at = np.flatnonzero(begin)
    if not len(at):
        return np.zeros(0, np.uint64), at
    last = word.copy()
    last[:-1] &= ~word[1:]
    edge = first[first > 0] - 1
    last[edge] = word[edge]
    to = np.flatnonzero(last) + 1
    up, down = powers(len(b))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(table[b] * up, out=total[1:])
    return mix((total[to] - total[at]) * down[at] + (to - at).astype(np.uint64)), at


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of each row, in order, and row offsets into them.

    Words are maximal runs of bytes other than 0x20 and 0x09 to 0x0D; lower
    folds A-Z. Long rows are worked on in slices cut at white space, so memory
    beyond the result stays bounded by the slice and the longest word.
    """
    table, hashes, counts = (_LOWER if lower else _TABLE), [], np.zeros(len(offsets) - 1, np.int64)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        lo, hi = int(offsets[i]), int(offsets[j])
        if j > i + 1 or hi - lo <= SLICE:
            h, at = _hash_slice(data[lo:hi], offsets[i:j] - lo, table)
            counts[i:j] = np.diff(np.searchsorted(at, offsets[i : j + 1] - lo))
            hashes.append(h)
        else:
            at = lo
            while at < hi:
                to = min(at + SLICE, hi)
                if to < hi:
                    gaps = np.flatnonzero(SPACE[data[at:to]])
                    if len(gaps):
                        to = at + int(gaps[-1]) + 1
                    else:
                        while to < hi and not SPACE[data[to]]:
                            to += 1
                h, _ = _hash_slice(data[at:to], np.zeros(1, np.int64), table)
                hashes.append(h)
                counts[i] += len(h)
                at = to
        i = j
    out = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return out, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's k-word shingles, repeats included; a row of 1 to k-1 words gives its whole sequence as one."""
    n = np.diff(offsets)
    out_n = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_at = np.concatenate([[0], np.cumsum(out_n)]).astype(np.int64)
    out = np.zeros(int(out_at[-1]), np.uint64)
    long = np.flatnonzero(n >= k)
    if len(long):
        acc = np.zeros(len(words) - k + 1, np.uint64)
        for t in range(k):
            acc = acc * _R + words[t : len(words) - k + 1 + t]
        take = np.repeat(offsets[long] - out_at[long], out_n[long])
        where = np.repeat(out_at[long] - np.concatenate([[0], np.cumsum(out_n[long])[:-1]]), out_n[long]) + np.arange(int(out_n[long].sum()))
        out[where] = mix(acc[where + take])
    for size in range(1, k):
        rows = np.flatnonzero(n == size)
        acc = np.full(len(rows), size, np.uint64)
        for t in range(size):
            acc = acc * _R + words[offsets[rows] + t]
        out[out_at[rows]] = mix(acc + np.uint64(size))
    return out, out_at
