"""Sets of word shingles as 64-bit hashes, computed over arrays of bytes.

A text's words are its runs of bytes other than space and 0x09-0x0D, with A-Z
lower-cased.  Its set holds a hash of every ``width`` words in a row; with
fewer words the whole sequence is the one element; without words the set is
empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

WIDTH = 5
PIECE_BYTES = 1 << 19

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = 0xD6E8FEB86659FD93 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_VALUE = np.random.default_rng(20240229).integers(1, 2 ** 63, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16, 2 * len(self.up))
            self.up, self.down = (
                np.concatenate([[np.uint64(1)],
                                np.cumprod(np.full(size - 1, b, np.uint64))]).astype(np.uint64)
                for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        return self.up, self.down


_POWERS = _Powers()


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte's place) of each word: a polynomial over its bytes,
    from differences of one running sum."""
    raw = np.frombuffer(data, np.uint8)
    space = _SPACE[raw]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.empty(0, np.uint64), start
    up, down = _POWERS.upto(len(raw) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[raw] * up[:len(raw)])])
    value = (total[end] - total[start]) * down[start]
    return mix(value + (end - start).astype(np.uint64) * _M2), start


def _pieces(texts: list[str | None]) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """Byte strings of about ``PIECE_BYTES``, each with the rows it holds and
    where they begin; a longer text is cut at white space."""
    held, rows, begins, size = [], [], [], 0
    for row, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        at = 0
        while at < len(data):
            end = len(data)
            if end - at > PIECE_BYTES:
                cuts = [data.rfind(c, at, at + PIECE_BYTES) for c in (b" ", b"\n")]
                cut = max(cuts)
                end = cut if cut > at else end
            rows.append(row)
            begins.append(size)
            held.append(data[at:end])
            size += end - at + 1
            at = end
            if size >= PIECE_BYTES:
                yield b" ".join(held), rows, begins
                held, rows, begins, size = [], [], [], 0
    if held:
        yield b" ".join(held), rows, begins


def sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    hashes, owners = [], []
    for data, rows, begins in _pieces(texts):
        value, start = word_hashes(data)
        owner = np.array(rows)[np.searchsorted(begins, start, "right") - 1]
        hashes.append(value)
        owners.append(owner)
    if not hashes:
        return [np.empty(0, np.uint64)] * len(texts)
    words, owner = np.concatenate(hashes), np.concatenate(owners)
    count = np.bincount(owner, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(count)])
    n = max(0, len(words) - width + 1)
    joined = words[:n].copy()
    for k in range(1, width):
        joined = mix(joined) + words[k:n + k]
    joined = mix(joined)
    out = []
    for i in range(len(texts)):
        a, c = begin[i], count[i]
        if c >= width:
            one = np.sort(joined[a:a + c - width + 1])
            out.append(one[np.concatenate([[True], one[1:] != one[:-1]])])
        elif c:
            h = xxhash.xxh3_64_intdigest(words[a:a + c].tobytes(), seed=int(c))
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def digest(one: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    raw = np.frombuffer(xxhash.xxh3_128_digest(one.tobytes()), "<i8")
    return int(raw[0]), int(raw[1])
