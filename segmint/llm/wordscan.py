"""Words of many texts at once, from their UTF-8 bytes in numpy: places,
64-bit hashes, and hashes of runs of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of blanks between words (space and \t to \r).
BLANKS = b" \t\n\v\f\r"
#: Bytes of text hashed at a time: bounds the temporary arrays.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C55
_RUN = 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """base^i and base^-i modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(self.base, 2 * n), _powers(pow(self.base, -1, 1 << 64), 2 * n)
        return self.up, self.down


_POWERS: dict[int, _Powers] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blank_mask(blanks: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(blanks)] = True
    return out


def word_places(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of the texts that lie one behind the other
    in ``data`` (text t from offsets[t] to offsets[t + 1]), and the number of
    the first word of each text, with the number of all words at the end."""
    full = ~blank[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = full[:-1], full[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[edge] = False
    after[edge[1:] - 1] = False
    start, end = np.flatnonzero(full & ~before), np.flatnonzero(full & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word: a polynomial of its bytes, by differences of
    running sums, then mixed. ``data`` is read a chunk at a time."""
    base = (_BASE + 2 * seed * 0x632BE59BD9B4E019) & (2**64 - 1) | 1
    powers = _POWERS.setdefault(base, _Powers(base))
    out = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        first = int(start[lo])
        hi = max(lo + 1, int(np.searchsorted(end, first + CHUNK, "right")))
        last = int(end[hi - 1])
        up, down = powers.get(last - first + 1)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum((data[first:last].astype(np.uint64) + np.uint64(1)) * up[: last - first], out=sums[1:])
        a, b = start[lo:hi] - first, end[lo:hi] - first
        out[lo:hi] = mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        lo = hi
    return out


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (runs may cross texts)."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(_RUN) + words[k : k + n]
    return mixed(out)


def text_blocks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of whole texts of a binary or string column (nulls count as
    empty), each of about ``size`` bytes or one longer text: first row, row
    behind the last, bytes, offsets from 0."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, place, values = column.buffers()
    offsets = np.frombuffer(place, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
