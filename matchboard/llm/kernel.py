"""Vectorised text helpers used inside tasks.

All functions work on a *slice*: the UTF-8 bytes of some whole documents laid end to
end, with the bounds between them. Slices hold about ``SLICE`` bytes (one document at
least), so the memory of a task follows that bound or the longest single document, not
the Arrow batch.

Strings are compared by two polynomial hashes modulo the prime 2**31 - 1, with bases of their
own over random symbol values, 62 bits together. Modulo a prime no sequence collides
for every base, as Thue-Morse sequences do modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 18  # its arrays of eight bytes a byte fit a core's cache

U = np.uint64
_PRIME = U((1 << 31) - 1)
_BASES = (1_390_204_517, 822_731_639)
_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=U) | U(1)
_powers: dict[int, np.ndarray] = {}
_SIGN = U(1 << 62)  # set in every hash, so that none is zero

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _folded(x: np.ndarray) -> np.ndarray:
    """Less values that are equal modulo the prime, in place."""
    high = x >> U(31)
    x &= _PRIME
    x += high
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    """Values modulo the prime, in place."""
    x = _folded(_folded(x))
    return np.minimum(x, x - _PRIME, out=x)  # the difference wraps round where x is the less


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo the prime, kept and grown between calls."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, dtype=np.uint32)
    while len(have) < max(n, SLICE):
        step = U(pow(base, len(have), int(_PRIME)))
        have = np.concatenate((have, _reduced(have.astype(U) * step).astype(np.uint32)))
    _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


class Prefix:
    """Hashes of any range of a sequence of fewer than 2**31 64-bit symbols, from prefix sums."""

    def __init__(self, symbols: np.ndarray):
        n = self.n = len(symbols)
        self.lanes: list[tuple[np.ndarray, np.ndarray]] = []
        for base, values in zip(_BASES, (symbols & _PRIME, symbols >> U(33))):
            values *= powers(base, n)
            sums = np.zeros(n + 1, dtype=U)
            np.cumsum(_folded(values), out=sums[1:])  # terms below 2**32, so sums below 2**63
            self.lanes.append((sums, powers(pow(base, -1, int(_PRIME)), n + 1)))

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        hashes: list[np.ndarray] = []
        for sums, back in self.lanes:
            value = _folded(sums[end] - sums[start])
            value *= back[start]
            hashes.append(_reduced(value))
        first, second = hashes
        first <<= U(31)
        first |= second
        return mix(first | _SIGN)

    def all(self, width: int) -> np.ndarray:
        """Hash of the range of that width from every position where it fits."""
        return self.of(slice(0, self.n + 1 - width), slice(width, None))


_GRAM_BASE = 0x9E3779B97F4A7C15
_gram_powers: dict[int, np.ndarray] = {}


def _wrapping(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown between calls."""
    have = _gram_powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE), base, dtype=U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _gram_powers[base] = have
    return have[:n]


def gram_hashes(symbols: np.ndarray, width: int) -> np.ndarray:
    """Cheap hashes modulo 2**64 of all ranges of a width, to choose minimizers by.

    Equal ranges have equal hashes. Different ones may be made to collide, so equality of
    text is never concluded from them.
    """
    n = len(symbols)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum(symbols * _wrapping(_GRAM_BASE, n), out=sums[1:])
    values = sums[width:] - sums[: n + 1 - width]
    values *= _wrapping(pow(_GRAM_BASE, -1, 1 << 64), n + 1)[: n + 1 - width]
    return mix(values)


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _VALUES[data]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a text column; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)
    bounds = bounds[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, bounds from 0) of whole documents."""
    if not len(column):
        return
    data, bounds = buffers(column)
    first, rows = 0, len(column)
    while first < rows:
        after = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        after = min(max(after, first + 1), rows)
        start, end = bounds[first], bounds[after]
        yield first, after, data[start:end], bounds[first : after + 1] - start
        first = after


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and per-document bounds of the words ``[^\\x20\\x09-\\x0D]+``."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(bounds), dtype=np.int64)
    gap = np.empty(n + 2, dtype=bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    inside = ~gap[1:-1]
    starts = np.flatnonzero(inside & (gap[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside & (gap[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def owners(bounds: np.ndarray) -> np.ndarray:
    """The document number of each item, from bounds of items per document."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def per_document(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of flags between bounds."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """True where at least one range lies."""
    steps = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(steps)[:n] > 0


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n, span, current = len(values) - width + 1, 1, values
    while span * 2 <= width:
        current = np.minimum(current[:-span], current[span:])
        span *= 2
    return np.minimum(current[:n], current[width - span : width - span + n])


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    steps = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def suffix_ranks(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and longest common prefixes of many documents at once.

    Prefix doubling: every suffix gets the rank of its first 1, 2, 4, ... symbols, and
    only suffixes that still tie are ranked again. The first rank includes the
    document, so suffixes of two documents never tie. The ranks of all levels give the
    common prefix of neighbours by descent. Returns (order, lcp): lcp[i] is the common
    prefix of order[i-1] and order[i], lcp[0] = 0.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    doc = owners(bounds)
    order = np.lexsort((symbols, doc))
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (symbols[order[1:]] != symbols[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    end = bounds[1:][doc]
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, step = [rank.copy()], 1
    while True:
        last = np.append(fresh[1:], True)
        tied = np.flatnonzero(~(fresh & last))  # places in the order, whole groups
        if not len(tied):
            break
        at = order[tied]
        ahead = at + step
        second = np.where(ahead < end[at], rank[np.minimum(ahead, n)], -1)
        first = rank[at]
        again = np.lexsort((second, first))
        at, first, second = at[again], first[again], second[again]
        order[tied] = at
        new = np.ones(len(at), dtype=bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        fresh[tied] = new
        rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        step *= 2
        levels.append(rank.copy())
    lcp = np.zeros(n, dtype=np.int64)
    a, b = order[:-1], order[1:]
    low = np.zeros(n - 1, dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + low, b + low
        inside = (x < end[a]) & (y < end[b])
        same = inside & (levels[level][np.minimum(x, n)] == levels[level][np.minimum(y, n)])
        low += same.astype(np.int64) << level
    lcp[1:] = low
    return order, lcp
