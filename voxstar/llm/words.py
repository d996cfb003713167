"""Words of whole texts as arrays: places, 64-bit hashes and hashes of word windows.

A word is ``[^\\x20\\x09-\\x0D]+``. Texts are UTF-8 bytes; those six white-space bytes never occur inside a longer
character, so bytes can be cut where characters would be.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

WORD = r"[^\x20\x09-\x0D]+"

#: Bytes handled together: enough to keep numpy busy, little enough for a worker's memory.
SLICE = 1 << 20
_SPACE = np.zeros(256, np.bool_)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: The first n bytes of eight, and eight blanks.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_BLANK = np.uint64(0x2020202020202020)
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sixteen(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 16 bytes of each word as two numbers; a shorter word is filled up with blanks, which no word holds."""
    padded = np.append(data, np.full(16, 0x20, np.uint8))
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    length = ends - starts
    low, high = ((eight[at] & _FIRST[n]) | (_BLANK & ~_FIRST[n]) for at, n in (
        (starts, np.minimum(length, 8)), (starts + 8, np.clip(length - 8, 0, 8))))
    return low, high


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_BASE, SLICE + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), SLICE + 1)


@dataclass
class Words:
    """``offsets[d]:offsets[d + 1]`` are the words of text d; starts and ends are places in ``data``."""

    data: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same wherever the word stands."""
        low, high = sixteen(self.data, self.starts, self.ends)
        out = mix(mix(low) + high)
        long = np.flatnonzero(self.ends - self.starts > 16)
        out[long] = self._long_hashes(self.starts[long], self.ends[long])
        return out

    def _long_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of words of over 16 bytes: their bytes only, taken together in parts of a slice."""
        lengths = ends - starts
        out, stops, at = np.empty(len(starts), np.uint64), np.cumsum(lengths), 0
        while at < len(out):
            done = int(stops[at] - lengths[at])
            to = int(np.searchsorted(stops, done + SLICE, side="right"))
            if to <= at:  # one word longer than a slice
                word = self.data[starts[at]:ends[at]].tobytes()
                out[at] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
                at += 1
                continue
            last, length = stops[at:to] - done, lengths[at:to]
            first = last - length
            part = self.data[np.repeat(starts[at:to] - first, length) + np.arange(last[-1])]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * _UP[:len(part)], dtype=np.uint64, out=sums[1:])
            out[at:to] = mix((sums[last] - sums[first]) * _DOWN[first] + length.astype(np.uint64))
            at = to
        return out


def find(texts: list[bytes], lower: bool = False) -> Words:
    """The words of some texts; ``lower`` turns A-Z into a-z first."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = _LOWER[data]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(lengths)))
    space = np.concatenate(([True], _SPACE[data]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    return Words(data, begins, starts, ends, np.searchsorted(starts, begins))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` words, by its first word; empty if there are too few words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total = total * np.uint64(_BASE) + hashes[j:j + n]
    return mix(total)


def inside(words: Words, width: int) -> np.ndarray:
    """First words of the windows that lie within one text."""
    n = max(0, len(words.starts) - width + 1)
    room = np.repeat(words.offsets[1:], words.counts)[:n] - np.arange(n)
    return np.flatnonzero(room >= width)


def slices(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of consecutive rows with about SLICE bytes; null counts as empty."""
    part, size, first = [], 0, 0
    for i, text in enumerate(texts):
        text = text or b""
        if part and size + len(text) > SLICE:
            yield first, part
            part, size, first = [], 0, i
        part.append(text)
        size += len(text)
    if part:
        yield first, part


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets; 0 for an empty stretch."""
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]
