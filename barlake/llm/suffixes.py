"""Sampled suffixes of byte strings: where to look for long repeats.

Every window of ``MATCH`` bytes picks one of its positions, its anchor: the one
whose next ``SEED`` bytes hash lowest, the leftmost of equals.  The choice depends
on the window's bytes only, so equal windows have equal anchors at equal places.
Neighbouring windows mostly share an anchor; an entry stands for all windows of
a text with one anchor and carries a hash of the seed and one of all the bytes
that these windows cover.  Entries with equal seed and cover hold equal windows.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a repeat, bytes of a seed, seeds in a window.
MATCH = 100
SEED = 24
SEEDS = MATCH - SEED + 1
#: Windows of a very long text that are handled at a time.
SEGMENT = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any stretch of a byte string from prefix sums: sum of value(byte) * base**-place, moved back."""

    def __init__(self, base: int, salt: int):
        size = SEGMENT + MATCH + 1
        self.values = mix(np.arange(256, dtype=np.uint64) + np.uint64(salt << 8))
        self.powers = self._powers(base, size)
        self.inverse = self._powers(pow(base, -1, 1 << 64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.inverse[: len(data)], out=out[1:])
        return out

    def stretch(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.powers[start]

    def every(self, prefix: np.ndarray, length: int) -> np.ndarray:
        n = len(prefix) - length
        return (prefix[length:] - prefix[:n]) * self.powers[:n]


FIRST = Rolling(0x9E3779B97F4A7C15, 1)
SECOND = Rolling(0xD1342543DE82EF95, 2)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def entries(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(seed hash, cover hash, first window, anchor's distance from it, windows) of a byte string; less than MATCH bytes have none."""
    out = []
    for at in range(0, len(data) - MATCH + 1, SEGMENT):
        part = data[at : at + SEGMENT + MATCH - 1]
        prefix = FIRST.prefix(part)
        seeds = mix(FIRST.every(prefix, SEED))
        keyed = (seeds & ~_PLACE) | np.arange(len(seeds), dtype=np.uint64)
        anchor = (_sliding_min(keyed, SEEDS) & _PLACE).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
        count = np.diff(np.append(first, len(anchor)))
        place = (anchor[first] - first).astype(np.uint64)
        cover = FIRST.stretch(prefix, first, first + count - 1 + MATCH)
        cover = mix(cover + mix(place * np.uint64(256) + count.astype(np.uint64) + np.uint64(1)))
        out.append((seeds[anchor[first]], cover, first + at, place.astype(np.int64), count))
    if not out:
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def windows(data: np.ndarray, first: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits, in two halves, for each of ``count`` windows from ``first`` on."""
    part = data[first : first + count - 1 + MATCH]
    return mix(FIRST.every(FIRST.prefix(part), MATCH)), mix(SECOND.every(SECOND.prefix(part), MATCH))
