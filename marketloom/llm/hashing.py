"""Words, shingles and minhashes of many texts at once, as numpy arrays inside tasks.

Words are runs of bytes outside a set of ASCII separators, lower-cased A-Z, and are compared by
64-bit hashes; so are shingles. Two different ones agree with probability 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit number over all of it."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def chunks(texts: Sequence[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` characters each; a longer text is alone."""
    start = used = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if used and used + n > limit:
            yield start, i
            start, used = i, 0
        used += n + 1
    if start < len(texts):
        yield start, len(texts)


class Words:
    """Hashes and byte ranges of the words of some texts; ``first[d]:first[d + 1]`` are text d's."""

    def __init__(self, hashes, starts, ends, first, base, data):
        self.hashes, self.starts, self.ends, self.first, self.base, self.data = hashes, starts, ends, first, base, data

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self, i: int, j: int) -> str:
        """Bytes from word i to word j (inclusive), lower-cased."""
        return self.data[self.starts[i]:self.ends[j]].tobytes().decode("utf-8", "replace")


class Hasher:
    """Tables for word hashes; made once per task."""

    def __init__(self, separators: bytes = SPACES):
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.is_word = np.ones(256, np.int8)
        self.is_word[list(separators)] = 0
        self.value = odd_numbers(256, 1)
        self.root = int(odd_numbers(1, 2)[0]) | 5
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        n = 1 << int(n - 1).bit_length()
        one = np.ones(n, np.uint64)
        up, down = one.copy(), one.copy()
        up[1:], down[1:] = np.uint64(self.root), np.uint64(pow(self.root, -1, 1 << 64))
        self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)

    def words(self, texts: Iterable[str | None]) -> Words:
        coded = [t.encode("utf-8", "replace") if t else b"" for t in texts]
        data = self.lower[np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)]
        base = np.zeros(len(coded) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in coded], out=base[1:])
        inside = np.zeros(len(data) + 1, np.int8)
        inside[1:] = self.is_word[data]
        edge = np.diff(inside)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        hashes = np.empty(len(starts), np.uint64)
        lo = 0
        while lo < len(starts):  # some whole words at a time, so that a very long text takes no more room
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + 2 * CHUNK_BYTES, "right")))
            hashes[lo:hi] = self._hash(data[starts[lo]:ends[hi - 1]], starts[lo:hi] - starts[lo], ends[lo:hi] - starts[lo])
            lo = hi
        return Words(hashes, starts, ends, np.searchsorted(starts, base), base, data)

    def _hash(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A polynomial over the bytes of each word, from running sums."""
        if len(data) > len(self.up):
            self._grow(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.up[:len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def words_of(texts: Sequence[str | None], separators: bytes = SPACES) -> Words:
    """Words of many texts as one, hashed chunk by chunk."""
    hasher, parts = Hasher(separators), []
    for lo, hi in chunks(texts):
        parts.append(hasher.words(texts[lo:hi]))
    if not parts:
        return hasher.words([])
    at = np.cumsum([0, *(len(p.data) for p in parts)])
    n = np.cumsum([0, *(len(p.hashes) for p in parts)])
    pairs = list(zip(parts, at, strict=False))
    return Words(
        np.concatenate([p.hashes for p in parts]), np.concatenate([p.starts + a for p, a in pairs]),
        np.concatenate([p.ends + a for p, a in pairs]),
        np.concatenate([p.first[:-1] + k for p, k in zip(parts, n, strict=False)] + [n[-1:]]),
        np.concatenate([p.base[:-1] + a for p, a in pairs] + [at[-1:]]), np.concatenate([p.data for p in parts]))


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words per text, and their offsets per text.

    A text of fewer words has its whole sequence as one; a text without words has none.
    """
    counts = np.diff(first)
    by_place = odd_numbers(size, 3)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(n, out=offsets[1:])
    # Start word of every run.
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n) + np.repeat(first[:-1], n)
    total = np.zeros(len(at), np.uint64)
    short = np.repeat(np.where(counts < size, counts, size), n)
    for k in range(size):
        there = np.minimum(at + k, max(len(hashes) - 1, 0))
        if k and len(short) and short.min() < size:
            total += np.where(short > k, hashes[there] * by_place[k], np.uint64(0))
        elif len(at):
            total += hashes[there] * by_place[k]
    return mix(total + short.astype(np.uint64)), offsets


def distinct_sets(values: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct values per text."""
    return [np.unique(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def set_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit key per set, equal for equal sets."""
    parts = np.array([(len(x), x.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(x))) if len(x) else (0, 0, 0)
                      for x in sets], np.uint64).reshape(-1, 3)
    return mix(parts[:, 0] + parts[:, 1] * np.uint64(3) + parts[:, 2])


def minhashes(values: np.ndarray, offsets: np.ndarray, n: int, seed: int = 4) -> np.ndarray:
    """n minwise tokens (32 bits) per non-empty text; every text must have a value."""
    out = np.empty((len(offsets) - 1, n), np.uint32)
    for i, a in enumerate(odd_numbers(n, seed)):
        low = np.minimum.reduceat(values * a, offsets[:-1])
        out[:, i] = (mix(low) >> np.uint64(32)).astype(np.uint32)
    return out
