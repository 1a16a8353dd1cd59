"""Words and spans of whole batches: byte runs, their checksums and copies, without a loop over texts.

*Checksums.*  CRC-32 is linear up to a constant for each length: a byte adds by
exclusive or what depends on its value and its distance from the end alone.  A
table of these contributions turns the checksums of all spans of a batch into
one gather and one ``bitwise_xor.reduceat``.  The table covers ``DEPTH``
distances; longer spans are cut into blocks of that size from their end, and the
sum over the blocks so far moves on by ``DEPTH`` zero bytes for each block.
"""

from __future__ import annotations

import zlib

import numpy as np

DEPTH = 64
#: Bytes of features gathered at once.
GATHER = 1 << 20

#: DEPTH * 256 contributions: row d holds those of a byte with d bytes after it.
_AT = np.array(
    [zlib.crc32(bytes((b,)) + bytes(d)) ^ zlib.crc32(bytes(d + 1)) for d in range(DEPTH) for b in range(256)], np.uint32
)
#: What every length adds.
_LENGTH = np.array([zlib.crc32(bytes(n)) for n in range(DEPTH + 1)], np.uint32)


def _moved(crc: int, n: int) -> int:
    """The linear part of a checksum after ``n`` more zero bytes."""
    return zlib.crc32(bytes(n), crc) ^ zlib.crc32(bytes(n))


#: The same for DEPTH bytes, by the four bytes of a checksum.
_ONWARD = np.array([[_moved(b << 8 * k, DEPTH) for b in range(256)] for k in range(4)], np.uint32)

#: A-Z to a-z, for ``bytes.translate``.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _linear(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Linear parts of the checksums of spans of 1 to DEPTH bytes."""
    sizes = ends - starts
    firsts = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(starts - firsts, sizes)
    after = np.repeat(ends, sizes) - at - 1
    return np.bitwise_xor.reduceat(_AT[(after << 8) + data[at]], firsts)


def _folded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Linear parts for spans of any length: a head of up to DEPTH bytes, then whole blocks."""
    blocks = (ends - starts - 1) // DEPTH
    order = np.argsort(-blocks, kind="stable")
    starts, ends, blocks = starts[order], ends[order], blocks[order]
    crc, n = _linear(data, starts, ends - DEPTH * blocks), len(starts)
    for k in range(int(blocks[0])):
        n = int(np.searchsorted(-blocks[:n], -k, side="left"))
        part, end = crc[:n], ends[:n] - DEPTH * (blocks[:n] - k - 1)
        moved = _ONWARD[0][part & 255] ^ _ONWARD[1][part >> 8 & 255] ^ _ONWARD[2][part >> 16 & 255] ^ _ONWARD[3][part >> 24]
        crc[:n] = moved ^ _linear(data, end - DEPTH, end)
    out = np.empty_like(crc)
    out[order] = crc
    return out


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:end]`` for every (non-empty) span."""
    sizes = ends - starts
    out = np.empty(len(starts), np.uint32)
    short = sizes <= DEPTH
    for chosen, sums in ((np.flatnonzero(short), _linear), (np.flatnonzero(~short), _folded)):
        # as many spans at once as GATHER bytes hold; a longer one goes alone
        group = np.cumsum(sizes[chosen]) // GATHER
        for part in np.split(chosen, np.flatnonzero(np.diff(group)) + 1):
            if len(part):
                out[part] = sums(data, starts[part], ends[part])
    out[short] ^= _LENGTH[sizes[short]]
    lengths, which = np.unique(sizes[~short], return_inverse=True)
    out[~short] ^= np.array([zlib.crc32(bytes(int(n))) for n in lengths], np.uint32)[which]
    return out


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, sizes) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edges[::2], edges[1::2] - edges[::2]


def spaced(data: np.ndarray, inside: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words marked by ``inside`` with one space after each, and where each begins."""
    at = np.cumsum(sizes + 1) - sizes - 1
    out = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
    out[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = data[inside]
    return out, at


def copied(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all spans one after the other, and their offsets (one more than spans)."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    return data[np.arange(int(offsets[-1])) + np.repeat(starts - offsets[:-1], sizes)], offsets
