"""Sets of grams in numpy: what tasks and the driver compare bounded blocks of texts with."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

#: One odd multiplier for each character of a gram, which together hash it to 64 bits.
_ODD = np.random.default_rng(5).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_set(s: str, n: int) -> np.ndarray:
    """Hashes of the distinct character n-grams, sorted; a shorter text is its own one gram, the empty text too."""
    points = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    count = max(1, len(points) - n + 1)
    h = np.zeros(count, np.uint64)
    for i in range(min(n, len(points))):
        h += points[i : i + count] * _ODD[i]
    h ^= h >> np.uint64(31)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


class Index:
    """Which of some sets hold a gram. ``matches`` gives those that a set is like."""

    def __init__(self, sets: Sequence[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owners = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        order = np.argsort(grams, kind="stable")
        grams, self.owners = grams[order], owners[order]
        first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.zeros(0, np.int64)
        self.grams, self.starts = grams[first], np.append(first, len(grams))

    def matches(self, s: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Positions, ascending, of the sets whose Jaccard index with ``s`` is at least the threshold, and the index.

        A match shares at least ceil(t n) of the n grams of ``s``. The rarest grams, all but ceil(t n) and a few more,
        thus hold at least those few; only if some set reaches that, the frequent grams are counted too.
        """
        none = np.zeros(0, np.int64), np.zeros(0)
        if not len(self.grams):
            return none
        at = np.minimum(np.searchsorted(self.grams, s), len(self.grams) - 1)
        at = at[self.grams[at] == s]
        n = len(s)
        need = max(1, math.ceil(threshold * n - 1e-9))
        if len(at) < need:
            return none
        starts, ends = self.starts[at], self.starts[at + 1]
        order = np.argsort(ends - starts, kind="stable")
        starts, ends = starts[order].tolist(), ends[order].tolist()
        few = -(-need // 4)
        rare = len(at) - need + few
        count = self._count(starts[:rare], ends[:rare])
        if rare < len(at):
            if count.max() < few:
                return none
            count += self._count(starts[rare:], ends[rare:])
        near = np.flatnonzero(count >= need)
        jaccard = count[near] / (n + self.sizes[near] - count[near])
        alike = jaccard >= threshold
        return near[alike], jaccard[alike]

    def _count(self, starts: list[int], ends: list[int]) -> np.ndarray:
        return np.bincount(np.concatenate([self.owners[a:b] for a, b in zip(starts, ends)]), minlength=len(self.sizes))


def first_kept(sets: Sequence[np.ndarray], threshold: float) -> np.ndarray:
    """Position of the first kept set that each is like, the sets taken in order; -1 if it is kept itself."""
    index, leader = Index(sets), np.full(len(sets), -1, np.int64)
    for i, s in enumerate(sets):
        if leader[i] < 0:
            later = index.matches(s, threshold)[0]
            later = later[later > i]
            leader[later[leader[later] < 0]] = i
    return leader


#: Bits of a mark.
BITS = 2048


def mark(s: np.ndarray) -> bytes:
    """Parities of how many grams fall in each of BITS bins. Marks differ in no more bins than sets differ in grams."""
    counts = np.bincount((s >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64), minlength=BITS)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def block_of(ords: np.ndarray, blocks: int) -> np.ndarray:
    """The block, of ``blocks``, to which a row belongs by its number."""
    return ((ords.astype(np.uint64) * _ODD[0] >> np.uint64(33)) % np.uint64(blocks)).astype(np.int64)


class Marks:
    """Marks in order of the sizes of their sets; ``near`` gives the rows that a set may be like."""

    def __init__(self, ords: np.ndarray, sizes: np.ndarray, marks: Sequence[bytes]):
        order = np.lexsort((ords, sizes))
        self.ords, self.sizes = ords[order], sizes[order]
        words = np.frombuffer(b"".join(marks), np.uint64).reshape(len(marks), BITS // 64)
        self.words = np.ascontiguousarray(words[order].T)

    def near(self, o: int, n: int, mark: bytes, threshold: float, step: int = 16_384) -> np.ndarray:
        """Positions of rows before (n, o), in order of size and number, whose sets may match."""
        first = np.searchsorted(self.sizes, math.ceil(threshold * n - 1e-9))
        same, behind = np.searchsorted(self.sizes, n), np.searchsorted(self.sizes, n, "right")
        last = same + np.searchsorted(self.ords[same:behind], o)
        own, found = np.frombuffer(mark, np.uint64), []
        for a in range(first, last, step):
            b = min(a + step, last)
            differ = np.zeros(b - a, np.uint16)
            for w, x in zip(self.words, own):
                differ += np.bitwise_count(w[a:b] ^ x)
            # Sets that match differ in (1 - t) / (1 + t) of their sizes' sum at most.
            found.append(a + np.flatnonzero(differ <= (self.sizes[a:b] + n) * ((1 - threshold) / (1 + threshold)) + 1e-6))
        return np.concatenate(found) if found else np.zeros(0, np.int64)
