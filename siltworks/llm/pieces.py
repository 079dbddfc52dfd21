"""SentencePiece encoding by sampled segmentation, and decoding.

A text's lattice has a node at each character and an edge for each piece that
spells the characters from there. Pieces weigh by rank (Zipf), and a segmentation
has the product of its pieces' weights as its share. ``Encoder.sample`` draws k
distinct segmentations without replacement by perturbed A-star search:

- a subtree of the search (all segmentations with one prefix) has a log share phi
  and a Gumbel(phi) key, the maximum over its segmentations;
- the best child of a node inherits the node's key and is drawn by its share; the
  other children together get the key of a Gumbel below it;
- the subtree of the largest key is always opened next, so complete
  segmentations come out in the order of their keys.

With kappa the key that would have come out next, exp(-exp(phi - kappa)) is the
probability that a segmentation is not among the k; its complement's logarithm is
the inclusion score. All draws come from a counter-based generator seeded by the
row's key, so they don't depend on how rows are dealt to tasks.

Pieces don't cross a space, and a text's lattice is the chain of its words'; a
word's is the chain of its units', which no piece reaches across. So lattices are
made once for each distinct unit among those that a task holds, in numpy, and all
units of many texts are walked together, an edge at a time.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice, pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from .common import table, trimmed

SPACE = "▁"
#: Symbols of a character that is no piece: its bytes, above all code points.
BYTE = 0x110000
#: Places that a hash is looked for at, as a power of two.
SLOT_BITS = 16
#: Neighbours below this code point are looked up in a square table.
COMMON = 0x250
#: Words walked at a time, and lattice nodes and words kept before all are dropped.
CHUNK_WORDS, KEEP_NODES, KEEP_WORDS = 20_000, 1_500_000, 300_000
#: No Gumbel drawn from 53 bits exceeds its location by this much.
REACH = 40.0
SAMPLES = 2
#: Rows handed on at a time, as their piece ids take several times the memory of their texts.
OUT_ROWS = 256
_SLOW = re.compile(f"{SPACE}({SPACE}*[^{SPACE}]*)")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _uniform(x: np.ndarray) -> np.ndarray:
    """Counter-based: 64-bit counters to (0, 1)."""
    x = (x + _MIX).astype(np.uint64, copy=False)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    x >>= np.uint64(11)
    u = x.astype(np.float64)
    u *= 2.0**-53
    u += 2.0**-54
    return u


def _spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``n`` numbers from each ``first`` on, end to end."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Grown:
    """A numpy array that is appended to."""

    def __init__(self, dtype):
        self.data, self.n = np.empty(1024, dtype), 0

    def append(self, x: np.ndarray) -> None:
        if self.n + len(x) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.empty(max(len(self.data), len(x)), self.data.dtype)])
        self.data[self.n : self.n + len(x)] = x
        self.n += len(x)

    @property
    def view(self) -> np.ndarray:
        return self.data[: self.n]


class Pieces:
    """The vocabulary of a model file: spellings, weights, and which neighbours occur inside pieces."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes = [b""] * n
        self.by_byte = np.full(256, -1)
        spelled: list[tuple[str, int]] = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.by_byte[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                spelled.append((piece, i))
                self.bytes[i] = piece.replace(SPACE, " ").encode()
        if (self.by_byte < 0).any():
            raise ValueError(f"{path}: no byte pieces")
        self.spelled = pa.array(self.bytes, pa.large_binary())
        self.single = {p for p, _ in spelled if len(p) == 1}
        crossed = {(ord(a), ord(b)) for p, _ in spelled for a, b in pairwise(p)}
        self.crossed = np.array(sorted(a << 32 | b for a, b in crossed), np.uint64)
        self.crossed_common = np.zeros((COMMON, COMMON), bool)
        for a, b in crossed:
            if a < COMMON and b < COMMON:
                self.crossed_common[a, b] = True
        if any(SPACE in p.lstrip(SPACE) for p, _ in spelled):
            raise ValueError(f"{path}: pieces cross spaces")
        self.longest = max(len(p) for p, _ in spelled)
        #: Weight of a piece by its rank in the vocabulary.
        self.logit = -np.log(np.arange(n) + 1.0)
        #: By length: hashes of all beginnings of spellings, the piece that is one (-1: none), and where to look for a hash.
        spelled_as = {tuple(map(ord, p)): i for p, i in spelled} | {(BYTE + b,): int(i) for b, i in enumerate(self.by_byte)}
        begun = {t[:k] for t in spelled_as for k in range(1, len(t) + 1)}
        by_length: list[list[tuple[int, int]]] = [[] for _ in range(self.longest + 1)]
        for t in begun:
            by_length[len(t)].append((self.hash(t), spelled_as.get(t, -1)))
        self.hashes, self.ids, self.slots, self.next = [], [], [], []
        for rows in by_length:
            hashes = np.array([h for h, _ in rows], np.uint64)
            if len(set(hashes.tolist())) != len(rows):
                raise ValueError(f"{path}: spellings collide")
            slots, chained = np.full(1 << SLOT_BITS, -1, np.int32), np.full(len(rows), -1, np.int32)
            for e, slot in enumerate((hashes * _MIX >> np.uint64(64 - SLOT_BITS)).tolist()):
                chained[e], slots[slot] = slots[slot], e
            self.hashes.append(hashes)
            self.ids.append(np.array([i for _, i in rows], np.int32))
            self.slots.append(slots)
            self.next.append(chained)

    def find(self, size: int, h: np.ndarray) -> np.ndarray:
        """Of hashes of ``size`` symbols, which beginning each is; -1: none."""
        e = self.slots[size][h * _MIX >> np.uint64(64 - SLOT_BITS)]
        wrong = np.flatnonzero(e >= 0)
        while len(wrong := wrong[self.hashes[size][e[wrong]] != h[wrong]]):
            e[wrong] = self.next[size][e[wrong]]
            wrong = wrong[e[wrong] >= 0]
        return e

    @staticmethod
    def hash(symbols) -> int:
        h = 0
        for s in symbols:
            h = (h * 0x9E3779B97F4A7C15 + s + 1) & (2**64 - 1)
        return h

    def crosses(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of neighbouring characters, whether a piece reaches across."""
        common = (a < COMMON) & (b < COMMON)
        out = self.crossed_common[np.where(common, a, 0), np.where(common, b, 0)] & common
        rare = np.flatnonzero(~common)
        if len(rare) and len(self.crossed):
            key = a[rare].astype(np.uint64) << np.uint64(32) | b[rare]
            at = np.minimum(np.searchsorted(self.crossed, key), len(self.crossed) - 1)
            out[rare] = self.crossed[at] == key
        return out

    def units(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """Words, each with its space mark, cut into units where no piece reaches across: all end to end, and how many each word has."""
        joined = SPACE + SPACE.join(words)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        starts = np.cumsum(sizes) - sizes
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.crosses(points[:-1], points[1:])
        cut[starts] = True
        bounds = [*np.flatnonzero(cut).tolist(), len(points)]
        return [joined[a:b] for a, b in pairwise(bounds)], np.add.reduceat(cut, starts, dtype=np.int64)

    def symbols(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of units end to end (code points; the bytes of characters that are no piece), and how many each unit has."""
        joined = "".join(units)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        symbols = points.astype(np.uint64)
        if odd := set(joined) - self.single:
            spelled = {ord(c): [BYTE + b for b in c.encode("utf-8", "replace")] for c in odd}
            wide = np.ones(len(points), np.int64)
            at = np.flatnonzero(np.isin(points, np.fromiter(spelled, np.uint32)))
            wide[at] = [len(spelled[int(c)]) for c in points[at]]
            place = np.cumsum(wide) - wide
            symbols = np.repeat(symbols, wide)
            for k in at.tolist():
                symbols[place[k] : place[k] + wide[k]] = spelled[int(points[k])]
            return symbols, np.add.reduceat(wide, np.cumsum(sizes) - sizes)
        return symbols, sizes

    def decode(self, ids) -> str:
        """The text of piece ids. The space that encoding puts before a text is taken off."""
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def decoded(self, ids: list[np.ndarray]) -> list[bytes]:
        """What ``decode`` gives for each, as bytes; all of them at once."""
        flat = np.concatenate([*ids, np.zeros(1, np.int32)])  # one more, so that there are bytes in any case
        _, ends, text = self.spelled.take(pa.array(flat)).buffers()
        bounds = np.frombuffer(ends, np.int64)[np.cumsum([0, *map(len, ids)])].tolist()
        text = text.to_pybytes()
        return [text[a:b].removeprefix(b" ") for a, b in pairwise(bounds)]


def numbers() -> defaultdict[str, int]:
    """Numbers strings from 0 on, as they are first asked for."""
    return defaultdict(count().__next__)


def newest(of: defaultdict[str, int], since: int) -> list[str]:
    """Those numbered ``since`` and higher, in order."""
    return list(islice(reversed(of), len(of) - since))[::-1]


class Lattices:
    """Lattices of the units of the words seen so far: nodes are numbered through, a node's edges stand together, the longest first."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.words, self.units = numbers(), numbers()
        #: By unit its first node; by word where its units' first nodes stand, and how many.
        self.unit_node, self.word_first, self.word_count, self.word_nodes = Grown(np.int32), Grown(np.int64), Grown(np.int32), Grown(np.int32)
        self.first, self.degree = Grown(np.int32), Grown(np.int16)
        self.cum, self.logp = Grown(np.float64), Grown(np.float64)
        self.target, self.piece = Grown(np.int32), Grown(np.int32)

    def add(self, words: list[str]) -> np.ndarray:
        """Numbers of words. Of those that are new, lattices are made of the units that are new."""
        out = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        if fresh := newest(self.words, self.word_first.n):
            units, per_word = self.pieces.units(fresh)
            of_unit = np.fromiter(map(self.units.__getitem__, units), np.int64, len(units))
            if new := newest(self.units, self.unit_node.n):
                symbols, sizes = self.pieces.symbols(new)
                self.unit_node.append(self.first.n + np.cumsum(sizes) - sizes)
                self._build(symbols, sizes)
            self.word_first.append(self.word_nodes.n + np.cumsum(per_word) - per_word)
            self.word_count.append(per_word)
            self.word_nodes.append(self.unit_node.view[of_unit])
        return out

    def _build(self, symbol: np.ndarray, sizes: np.ndarray) -> None:
        starts, n = np.cumsum(sizes) - sizes, len(symbol)
        left = np.repeat(starts + sizes, sizes) - np.arange(n)  # symbols from here to the unit's end
        # Pieces from every node, by length. A node drops out once no piece begins with its symbols so far.
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        at, h, degree = np.arange(n), np.zeros(n, np.uint64), np.zeros(n, np.int64)
        for size in range(1, self.pieces.longest + 1):
            on = np.flatnonzero(left[at] >= size)
            at = at[on]
            h = h[on] * np.uint64(0x9E3779B97F4A7C15) + symbol[at + (size - 1)] + np.uint64(1)
            where = self.pieces.find(size, h)
            hit = np.flatnonzero(where >= 0)
            if not len(hit):
                break
            at, h, ids = at[hit], h[hit], self.pieces.ids[size][where[hit]]
            whole = np.flatnonzero(ids >= 0)
            found.append((size, at[whole], ids[whole]))
            degree[at[whole]] += 1
        # Edges by distance of their node from the end of its unit; of a node, the longest first.
        order = np.argsort(left.astype(np.uint16) if left.max(initial=0) < 1 << 16 else left, kind="stable")  # few bits are sorted by radix
        first = np.empty(n, np.int64)
        first[order] = np.cumsum(degree[order]) - degree[order]
        filled, m = first.copy(), int(degree.sum())
        piece, target = np.empty(m, np.int32), np.empty(m, np.int64)
        for size, src, ids in reversed(found):
            e = filled[src]
            filled[src] = e + 1
            piece[e], target[e] = ids, np.where(left[src] == size, n, src + size)
        # Log sums over all ways from a node to the end of its unit, from the ends backward.
        total, logp, deg = np.zeros(n + 1), self.pieces.logit[piece], degree[order]
        bounds = np.searchsorted(left[order], np.arange(1, int(left.max(initial=0)) + 2))
        ends = np.cumsum(deg)
        begins = ends - deg
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if lo == hi:
                continue
            e0, e1 = int(begins[lo]), int(ends[hi - 1])
            v = logp[e0:e1]
            v += total[target[e0:e1]]
            cuts = begins[lo:hi] - e0
            top = np.maximum.reduceat(v, cuts)
            total[order[lo:hi]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, deg[lo:hi])), cuts))
        logp -= np.repeat(total[order], deg)
        # A node's own running sum, so that it doesn't depend on what stands before. Its last edge is taken in any case.
        cum, more, k = np.exp(logp), deg > 2, 1
        at = begins[more]
        more = deg[more]
        while len(at):
            cum[at + k] += cum[at + k - 1]
            k += 1
            at, more = at[more > k + 1], more[more > k + 1]
        cum[ends - 1] = 2.0
        logp[begins[deg == 1]] = 0.0
        base_node, base_edge = self.first.n, self.cum.n
        self.first.append(base_edge + first)
        self.degree.append(degree)
        self.cum.append(cum)
        self.logp.append(logp)
        self.target.append(np.where(target == n, -1, base_node + target))
        self.piece.append(piece)

    def nodes(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First nodes of the units of word numbers, end to end, and how many each word has."""
        first, n = self.word_first.view[words], self.word_count.view[words].astype(np.int64)
        return self.word_nodes.view[_spans(first, n)].astype(np.int64), n


class Encoder:
    def __init__(self, path: str, samples: int = SAMPLES):
        if samples < 1:
            raise ValueError("at least one sample")
        self.pieces, self.k = Pieces(path), samples
        self.lattices = Lattices(self.pieces)

    def words(self, text: str | None) -> list[str]:
        """What follows each space mark, after one is put before the text; none for an empty text."""
        if not text:
            return []
        if SPACE in text or "  " in text or text.startswith(" "):  # spaces that stand together, the one put before included
            return _SLOW.findall(SPACE + text.replace(" ", SPACE))
        return text.split(" ")

    def sample(self, texts: list[str | None], keys: list[str]) -> Iterator[list[tuple[np.ndarray, float, float]]]:
        """Per text up to k of (piece ids, log share, log inclusion), in the order of their keys."""
        held, size = [], 0
        for text, key in zip(texts, keys, strict=True):
            held.append((self.words(text), xxhash.xxh64_intdigest(key.encode("utf-8", "replace"), 7)))
            size += len(held[-1][0])
            if size >= CHUNK_WORDS:
                yield from self._chunk(held)
                held, size = [], 0
        if held:
            yield from self._chunk(held)

    def _walk(self, node: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each node to its unit's end. Edges taken, end to end, and how many from each node."""
        x = self.lattices
        first, cum, target = x.first.view, x.cum.view, x.target.view
        active, steps = np.arange(len(node)), []
        counts = np.zeros(len(node), np.int64)
        while len(active):
            u = _uniform((seed[active] if steps else seed) + np.uint64(len(steps)) * np.uint64(0xD1342543DE82EF95))
            e = first[node].astype(np.int64)
            over = np.flatnonzero(u >= cum[e])
            while len(over):
                e[over] += 1
                over = over[u[over] >= cum[e[over]]]
            steps.append((active, e))
            counts[active] += 1
            node = target[e]
            on = node >= 0
            active, node = active[on], node[on]
        place = np.cumsum(counts) - counts
        edges = np.empty(int(counts.sum()), np.int64)
        for s, (a, e) in enumerate(steps):
            edges[place[a] + s] = e
        return edges, counts

    def _rests(self, branches: list[tuple[np.ndarray, int, float, float, int, int, list]]) -> None:
        """Push the unopened siblings along each branch.

        A branch: its path, from where on it is new, the log share before that,
        the path's key, a seed, the path's number, and what is begun of its text.
        """
        logp, width = self.lattices.logp.view, 256
        branches = [b for b in branches if b[1] < len(b[0])]
        while branches:
            # The next edges of all branches, a row each; behind a path's end nothing is left to share.
            ends = np.array([min(width, len(path) - start) for path, start, *_ in branches])
            edges = np.zeros((len(branches), width), np.int64)
            inside = np.arange(width)[None, :] < ends[:, None]
            edges[inside] = np.concatenate([path[start : start + width] for path, start, *_ in branches])
            start, phi, key, seed = (np.array([b[i] for b in branches], t)[:, None] for i, t in ((1, np.uint64), (2, float), (3, float), (4, np.uint64)))
            lp = np.where(inside, logp[edges], 0.0)
            before = phi + np.cumsum(lp, axis=1) - lp
            near = inside & (-before <= REACH - key)
            far, end = near[:, -1].tolist(), before[:, -1] + lp[:, -1]
            stop = int(np.flatnonzero(near.any(axis=0)).max(initial=-1)) + 1  # shares fall along a path, so most of a row is too far
            near, lp, before = near[:, :stop], lp[:, :stop], before[:, :stop]
            rest = np.where(near & (lp < 0), before + np.log(np.maximum(-np.expm1(lp), 5e-324)), -np.inf)
            u = _uniform(seed + (start + np.arange(stop, dtype=np.uint64)[None, :]) * np.uint64(0xA0761D6478BD642F))
            with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
                keys = np.where(rest > -np.inf, rest - np.log(np.exp(rest - key) - np.log(u)), -np.inf)
            best = np.argsort(-keys, axis=1, kind="stable")[:, : self.k]
            more = []
            for row, (path, begin, _, its_key, its_seed, which, begun) in enumerate(branches):
                for j in best[row].tolist():
                    if keys[row, j] > -np.inf:
                        heapq.heappush(begun, (-float(keys[row, j]), which, begin + j, float(before[row, j]), (int(path[begin + j]),)))
                if far[row] and len(path) > begin + width:
                    more.append((path, begin + width, float(end[row]), its_key, its_seed, which, begun))
            branches = more

    def _chunk(self, held: list[tuple[list[str], int]]) -> Iterator[list[tuple[np.ndarray, float, float]]]:
        x = self.lattices
        if x.first.n > KEEP_NODES or len(x.words) > KEEP_WORDS:
            x.clear()
        flat = [w for words, _ in held for w in words]
        nodes, per_word = x.nodes(x.add(flat))
        word_ends = np.cumsum([0, *(len(words) for words, _ in held)])
        units_before = np.concatenate([[0], np.cumsum(per_word)])[word_ends]
        seeds = np.array([s for _, s in held], np.uint64)
        n_units = np.diff(units_before)
        inside = np.arange(len(nodes)) - np.repeat(units_before[:-1], n_units)
        logp, first, degree, target, piece = x.logp.view, x.first.view, x.degree.view, x.target.view, x.piece.view
        with np.errstate(over="ignore"):
            unit_seeds = inside.astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3) + np.repeat(seeds, n_units)
            edges, counts = self._walk(nodes, unit_seeds)
            ends = np.concatenate([[0], np.cumsum(counts)])
            doc_ends = ends[units_before]
            #: Per text: its samples as (edges, the unit of each edge, log share, key), and what is begun.
            paths, begun = [], []
            unit_of = np.repeat(inside, counts)
            keys = -np.log(-np.log(_uniform(seeds ^ np.uint64(0x5851F42D4C957F2D))))
            for d, key in enumerate(keys.tolist()):
                path = edges[doc_ends[d] : doc_ends[d + 1]]
                paths.append([(path, unit_of[doc_ends[d] : doc_ends[d + 1]], float(logp[path].sum()), key)])
                begun.append([])
            self._rests([(paths[d][0][0], 0, 0.0, paths[d][0][3], seed ^ 0x14057B7EF767814F, 0, begun[d]) for d, (_, seed) in enumerate(held)])
            for turn in range(1, self.k):
                opened, popped = [], [(d, *heapq.heappop(b)) for d, b in enumerate(begun) if b]
                if not popped:
                    break
                drawn = (
                    _uniform(np.array([(held[d][1] + turn * salt + at) & (2**64 - 1) for d, _, _, at, _, _ in popped], np.uint64)).tolist()
                    for salt in (0x632BE59BD9B4E019, 0x9FB21C651E98DF25)
                )
                for (d, minus, which, at, phi, closed), u, v in zip(popped, *drawn, strict=True):
                    parent, units = paths[d][which][0], paths[d][which][1]
                    # The node of the parent's edge, where the edge before ends or else its unit begins: its siblings stand beside it.
                    before = int(target[parent[at - 1]]) if at else -1
                    node = before if before >= 0 else int(nodes[units_before[d] + units[at]])
                    beside = np.array([e for e in range(int(first[node]), int(first[node]) + int(degree[node])) if e not in closed])
                    share = np.exp(logp[beside])
                    chosen = int(beside[min(int(np.searchsorted(np.cumsum(share), u * share.sum(), side="right")), len(beside) - 1)])
                    if len(beside) > 1:
                        rest = phi + np.log(share.sum() - np.exp(logp[chosen]))
                        heapq.heappush(begun[d], (-float(rest - np.log(np.exp(rest + minus) - np.log(v))), which, at, phi, (*closed, chosen)))
                    opened.append((d, which, at, phi, chosen, int(units[at]), -minus))
                # Units after the branch are drawn anew, the branch's own from behind the chosen edge.
                docs, chosen, unit = (np.array([o[i] for o in opened], np.int64) for i in (0, 4, 5))
                behind = target[chosen]
                inner = behind >= 0
                low = units_before[docs] + unit + ~inner
                sizes = units_before[docs + 1] - low
                of, ends = _spans(low, sizes), np.cumsum(sizes)
                start = nodes[of]
                start[(ends - sizes)[inner]] = behind[inner]
                new, new_counts = self._walk(start, unit_seeds[of] + np.uint64(turn) * np.uint64(0x2545F4914F6CDD1D))
                new_units = np.repeat(inside[of], new_counts)
                new_ends = np.concatenate([[0], np.cumsum(new_counts)])[np.concatenate([[0], ends])]
                branches = []
                for j, (d, which, at, phi, chosen, unit, key) in enumerate(opened):
                    old, old_units = paths[d][which][:2]
                    path = np.concatenate([old[:at], [chosen], new[new_ends[j] : new_ends[j + 1]]])
                    paths[d].append((path, np.concatenate([old_units[:at], [unit], new_units[new_ends[j] : new_ends[j + 1]]]), float(logp[path].sum()), key))
                    branches.append((path, at + 1, phi + float(logp[chosen]), key, (held[d][1] + turn * 0xE7037ED1A0B428DB) & (2**64 - 1), len(paths[d]) - 1, begun[d]))
                self._rests(branches)
        for d in range(len(held)):
            kappa = -begun[d][0][0] if begun[d] else -np.inf
            yield [(piece[path], share, float(_log_inclusion(share - kappa))) for path, _, share, _ in paths[d]]


def _log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x))), also where exp(x) is too small or too large to hold."""
    if x == np.inf or x > 4:
        return -np.exp(-np.exp(min(x, 7.0)))
    return x if x < -30 else float(np.log(-np.expm1(-np.exp(x))))


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, samples: int) -> Encoder:
    """One for each worker process."""
    if (path, samples) not in _encoders:
        _encoders.clear()
        _encoders[path, samples] = Encoder(path, samples)
    return _encoders[path, samples]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, samples: int = SAMPLES) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) and ``segmentations``, which replaces a column of its name.

    segmentations: array of (ids, n_pieces, log_prob, log_inclusion, decoded_ok).
    The seed is the row's key as text, so rows that repeat get the same
    segmentations. Null and empty texts have one segmentation without pieces.
    Texts with fewer distinct segmentations than ``samples`` get all of them.
    Texts of any length are encoded whole. decoded_ok: decoding gives the text
    back, with any U+2581 of it as a space, as the format has it.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "segmentations"]
    inputs = [*keep, *(c for c in dict.fromkeys((id_col, text_col)) if c not in keep)]
    rows = docs.select(*[docs[f"`{c}`"] for c in inputs])
    id_at, text_at = inputs.index(id_col), inputs.index(text_col)
    item = pa.struct([("ids", pa.list_(pa.int32())), ("n_pieces", pa.int64()), ("log_prob", pa.float64()), ("log_inclusion", pa.float64()), ("decoded_ok", pa.bool_())])
    sql = "array<struct<ids:array<int>,n_pieces:bigint,log_prob:double,log_inclusion:double,decoded_ok:boolean>>"
    out = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields[: len(keep)]]).add("segmentations", _parse_datatype_string(sql))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, samples)
        for batch in (b.slice(at, OUT_ROWS) for b in batches for at in range(0, b.num_rows, OUT_ROWS)):
            texts = batch.column(text_at).to_pylist()
            drawn = list(enc.sample(texts, [str(k) for k in batch.column(id_at).to_pylist()]))
            spelled = iter(enc.pieces.decoded([ids for of_text in drawn for ids, _, _ in of_text]))
            found = []
            for text, of_text in zip(texts, drawn, strict=True):
                whole = (text or "").replace(SPACE, " ").encode("utf-8", "replace")
                found.append(
                    [
                        {"ids": ids, "n_pieces": len(ids), "log_prob": share, "log_inclusion": inclusion, "decoded_ok": next(spelled) == whole}
                        for ids, share, inclusion in of_text
                    ]
                )
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(found, pa.list_(item))], names=out.names)
        enc.lattices.clear()  # the worker may idle through other stages

    return rows.mapInArrow(trimmed(run), out)


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document the piece ids of its sampled segmentations, whole, with their figures."""
    import public_tokenizers

    found = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
    one = lambda k, name: F.get("segmentations", F.lit(k))[name]
    return found.select(
        "doc_id",
        F.size("segmentations").cast("long").alias("n_segmentations"),
        *[one(k, name).alias(f"{name}_{k + 1}") for k in range(SAMPLES) for name in ("ids", "n_pieces", "log_prob", "log_inclusion", "decoded_ok")],
    )
