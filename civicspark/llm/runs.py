"""Runs of windows with one minimizer: the positions at which two texts can share a long string.

A window is ``width`` consecutive symbols of one document (bytes or words). Its
minimizer is the window's ``gram`` of the smallest hash, the leftmost of equal
ones, so equal windows have equal minimizers at equal offsets. Neighbouring
windows mostly share theirs: the windows of a document fall into runs (about
2 / (width - gram + 2) per symbol), and a run stands for all its windows. Two
runs whose whole spans are equal have pairwise equal windows; windows of runs
with different minimizers are never equal. Only runs that share a minimizer but
differ in their spans need a look at their single windows.

All hashes are functions of the content, 64 bits each; equal spans are those with
equal minimizer, length and span hash, equal windows those with two equal hashes.
"""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
#: Odd multipliers of the two polynomial hashes.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit values (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


class Prefix:
    """Hash of any stretch of ``symbols`` from running sums of symbol x base^position."""

    def __init__(self, symbols: np.ndarray, base: int):
        n = len(symbols)
        self.back = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
        powers = np.full(n, base, np.uint64)
        if n:
            powers[0] = 1
            np.cumprod(powers, out=powers)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * powers, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64) * MIX)


def _gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` symbols from each position on, by doubling."""
    parts, size, at, out = symbols, 1, 0, None
    left = gram
    while left:
        if left & 1:
            piece = parts[at:]
            out = piece if out is None else out[:len(piece)] * np.uint64(BASES[1]) + piece
            at += size
        left >>= 1
        if left:
            parts = parts[:-size] * np.uint64(pow(BASES[0], size, 1 << 64)) + parts[size:]
            size *= 2
    return mix(out[:len(symbols) - gram + 1])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def runs(
    symbols: np.ndarray, lengths: np.ndarray, width: int, gram: int, wanted: np.ndarray | None = None,
) -> dict[str, np.ndarray]:
    """Runs of the windows of documents laid end to end in ``symbols`` (uint64).

    With ``wanted`` only the windows at its true positions count; a run ends where they end.
    Columns: doc (index into ``lengths``), start (of the run's first window within
    its document), windows, minimizer, span (hash of the symbols of all windows).
    """
    n = len(symbols)
    ends = np.cumsum(lengths)
    none = np.zeros(0, np.int64)
    if n < width:
        return {"doc": none, "start": none, "windows": none, "minimizer": none, "span": none}
    position_bits = max(1, int(n).bit_length())
    hashes = _gram_hashes(symbols, gram)
    low = np.uint64((1 << position_bits) - 1)
    ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    best = _sliding_min(ranked, width - gram + 1) & low
    doc = np.repeat(np.arange(len(lengths)), lengths)[:len(best)]
    inside = np.arange(len(best)) + width <= ends[doc]
    if wanted is not None:
        inside &= wanted[:len(best)]
    fresh = np.ones(len(best), bool)
    fresh[1:] = (best[1:] != best[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(best)))
    valid = inside[first]
    first, count = first[valid], count[valid]
    anchor = hashes[best[first]]
    span = Prefix(symbols, BASES[0]).of(first, first + count + width - 1)
    starts = ends - lengths
    return {
        "doc": doc[first], "start": first - starts[doc[first]], "windows": count,
        "minimizer": anchor.astype(np.int64), "span": span.astype(np.int64),
    }


def union_lengths(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal disjoint stretches of intervals sorted by start; touching ones are joined."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = starts[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    return starts[at], reach[np.append(at[1:], len(starts)) - 1]
