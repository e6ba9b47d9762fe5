"""Words and word windows of whole Arrow batches as numpy arrays.

Words are ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes, with A-Z lower-cased on request.  A word is
a 64-bit hash: two words share one with a chance of 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * ODD)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD**i and its inverse modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
        for k, base in enumerate((ODD, inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, null as empty, and the n + 1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of some texts: ``hashes``, byte spans and ``first``, where each text's words begin."""

    __slots__ = ("hashes", "starts", "ends", "first", "data")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        self.data = data = (LOWER if lower else SAME)[data]
        n = len(data)
        solid = ~SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        after, before = np.empty(n, bool), np.empty(n, bool)
        if n:
            after[0], after[1:] = True, ~solid[:-1]
            before[-1], before[:-1] = True, ~solid[1:]
        self.starts = np.flatnonzero(solid & (after | edge[:n]))
        self.ends = np.flatnonzero(solid & (before | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        up, down = powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        codes = BYTE_CODES[data]
        codes *= up[:n]
        np.cumsum(codes, out=sums[1:])
        size = (self.ends - self.starts).astype(np.uint64)
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + size)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words; of the whole sequence if it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(n, width)
    out = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        out = out * ODD + hashes[k : k + len(out)]
    return mix(out + np.uint64(size))


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield row, end
        row = end


def batch_words(column, lower: bool = True) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) over a column, so that working memory is bounded."""
    data, offsets = text_bytes(column)
    for a, b in slices(offsets):
        yield a, b, Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower)
