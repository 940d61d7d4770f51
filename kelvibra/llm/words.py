"""Words and shingles of whole columns of texts, as arrays of 64-bit fingerprints.

A word is a run of bytes other than the six ASCII white-space characters; A-Z count as a-z. A column is
worked through in blocks of a quarter of a megabyte, whatever the lengths of its texts, without a step per word.
Two different words share a fingerprint with a probability of about 2**-64.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
SPACES = b" \t\n\x0b\f\r"
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
U64 = np.uint64


def worker_cache(key: object, build: Callable[[], object]) -> object:
    """A value that a Python worker builds once for all of its tasks."""
    held = sys.modules.setdefault("_kelvibra_worker_cache", types.ModuleType("_kelvibra_worker_cache")).__dict__
    if key not in held:
        held[key] = build()
    return held[key]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all of its bits; one to one."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def numbers(seed: int, count: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, count + 1, dtype=U64) * U64(BASE) + U64(seed))


def _tables() -> tuple[np.ndarray, ...]:
    codes = numbers(1, 256)
    codes[65:91] = codes[97:123]
    space = np.zeros(256, bool)
    space[list(SPACES)] = True
    powers = np.full(BLOCK, BASE, U64)
    powers[0] = 1
    inverses = np.full(BLOCK, INVERSE, U64)
    inverses[0] = 1
    return codes, ~space, np.multiply.accumulate(powers), np.multiply.accumulate(inverses)


@dataclass(frozen=True)
class Block:
    """Consecutive texts: `data` holds the bytes of rows first .. first + len(bounds) - 2, cut at `bounds`."""
    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[Block]:
    """The texts of a column in blocks of about `size` bytes; a longer text is a block of its own. A null
    counts as an empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(cuts, cuts[row] + size, "right")) - 1)
        yield Block(row, data[cuts[row]:cuts[end]], cuts[row:end + 1] - cuts[row])
        row = end


@dataclass(frozen=True)
class Words:
    """Fingerprints of a block's words, the bytes they span, and the words at which its rows are cut."""
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def words(block: Block) -> Words:
    codes, letters, powers, inverses = worker_cache("words", _tables)
    hashes, starts, ends = [], [], []
    opens = False  # the last word so far reaches the end of its piece
    for at in range(0, len(block.data), BLOCK):
        piece = block.data[at:at + BLOCK]
        cuts = block.bounds[(block.bounds >= at) & (block.bounds < at + len(piece))] - at
        word = letters[piece]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        first[cuts] = word[cuts]
        last[:-1] &= ~word[1:]
        before = cuts[cuts > 0] - 1
        last[before] = word[before]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        sums = np.zeros(len(piece) + 1, U64)
        np.cumsum(codes[piece] * powers[:len(piece)], out=sums[1:])
        h = (sums[e] - sums[s]) * inverses[s]
        s, e = s + at, e + at
        if opens and len(s) and s[0] == at and not (len(cuts) and cuts[0] == 0):
            length = int(at - starts[-1][-1])  # the word goes on from the piece before
            h0 = (int(hashes[-1][-1]) + int(h[0]) * pow(BASE, length, 1 << 64)) % (1 << 64)
            hashes[-1][-1], ends[-1][-1] = h0, e[0]
            h, s, e = h[1:], s[1:], e[1:]
        if len(s):
            hashes, starts, ends = [*hashes, h], [*starts, s], [*ends, e]
        opens = bool(ends) and ends[-1][-1] == at + len(piece)
    if not hashes:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, U64), none, none, np.zeros(block.rows + 1, np.int64))
    s, e = np.concatenate(starts), np.concatenate(ends)
    return Words(mix(np.concatenate(hashes) + (e - s).astype(U64)), s, e, np.searchsorted(s, block.bounds))


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of each row's runs of `width` words, and the cuts between rows. A row with fewer words
    has its whole sequence as its one shingle, a row without words none."""
    factors = numbers(2, width) | U64(1)
    counts = np.diff(bounds)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    n = len(hashes)
    whole = np.zeros(max(0, n - width + 1), U64)
    for j in range(width):
        whole += hashes[j:n - width + 1 + j] * factors[j]
    out = np.zeros(cuts[-1], U64)
    long = counts >= width
    own = np.repeat(long, sizes)
    at = np.arange(cuts[-1]) - np.repeat(cuts[:-1] - bounds[:-1], sizes)  # each shingle's first word
    out[own] = whole[at[own]]
    for r in np.flatnonzero((counts > 0) & ~long):
        own_words = hashes[bounds[r]:bounds[r + 1]]
        out[cuts[r]] = (own_words * factors[:len(own_words)]).sum(dtype=U64) + U64(len(own_words))
    return mix(out), cuts
