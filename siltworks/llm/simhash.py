"""Near-duplicates by SimHash, linked with a self-join of binary tries.

A text's fingerprint has a bit set where over half of its shingle hashes have
it. Fingerprints that differ in at most ``BUDGET`` (3) bits are linked, and
linked texts form components.

Equal fingerprints are folded into one row first, so copies cost nothing later.
Two fingerprints within the budget agree on at least one of four 16-bit blocks.
Each fingerprint is therefore put, once per block, under that block's value, and
all that share a value form a trie over the other 48 bits. The self-join of a
trie walks pairs of nodes together, adds up the bits in which the two paths
differ, and drops a pair once the sum exceeds the budget. All tries of a task
are walked at once, level by level, as numpy arrays.

A block value that very many fingerprints share is dealt to cells: its members
get one of s numbers, and each pair of numbers is a task of its own with both
parts. So no task holds more than about two shares, and no pair is lost.

A task unites what it links and emits only a spanning forest, never all pairs of
a group. Components of the remaining links are found by alternately hooking the
larger neighbours and the smaller neighbours of every node to its minimum.

To keep one of each group (``keep_one``), texts are alike if their sets of
five-word shingles have a Jaccard index of 0.8. The tries link fingerprints of
these sets, and every link is checked on whole sets. As alike texts may differ in
more bits than the budget, an exact way handles the rest: two such sets share a
shingle among the rarest fifth of each (prefix filter). Pairs that do, are not in
one component yet and whose sketches (parities of the shingles in each of ``BINS``
bins) differ in no more bins than alike sets may differ in shingles are checked on
whole sets too. So no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, most_frequent, shuffle_width, table, trimmed

BUDGET = 3
BLOCKS, BLOCK_BITS = 4, 16
SHINGLE = 3
#: Likeness of whole texts, for ``classes`` and ``keep_one``: words in a shingle and least Jaccard index.
WORDS, SIMILARITY = 5, 0.8
#: Texts looked at for frequent shingles (this share of all, and as many at least), and how many of these are sent to all tasks at most.
SAMPLE_SHARE, SAMPLE_ROWS, COMMON = 0.1, 2000, 1 << 18
#: Bins of a sketch, in words of 64.
BINS = 512
#: Texts to compare that are named to all tasks at most; more are joined.
NAMED = 1 << 20
#: Texts whose shingles are hashed at a time, and pairs that name one set before it is copied.
TEXTS, PAIRS = 256, 512
#: Shingle hashes whose bits are counted at a time.
STRIP = 1 << 15
#: Fingerprints under one block value before it is dealt to cells, at least.
CELL_ROWS = 512
#: Node pairs walked at a time, and pairs of leaves compared directly instead of split further.
FRONTIER = 1 << 18
LEAF_PAIRS = 64


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text; 0 if it has no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    counts, total = np.zeros(64, np.int64), max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, STRIP):
        part = words[at : at + STRIP + size - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
        hashes = np.array([digest(s, 42) for s in shingles], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((counts * 2 > total).astype(np.uint8), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprints(batches):
    for batch in batches:
        prints = np.array([fingerprint(t) for t in batch.column(batch.num_columns - 1).to_pylist()], np.uint64)
        yield pa.record_batch([*batch.columns[:-1], pa.array(prints.view(np.int64))], names=[*batch.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fp (the fingerprint's bits as a signed long) of every row."""
    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("id"), docs[f"`{text_col}`"].cast("string").alias("t"))
    return rows.mapInArrow(_fingerprints, "id long, fp long")


# --- trie self-join -------------------------------------------------------


class Forest:
    """Union-find over array positions; the root is the smallest member."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.up[x]
        while True:
            above = self.up[r]
            if (above == r).all():
                return r
            r = above

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))
        self.up = self.roots(np.arange(len(self.up)))


def _expand(lo1, hi1, lo2, hi2):
    """All (i, j) of each pair of ranges."""
    n1, n2 = hi1 - lo1, hi2 - lo2
    sizes = n1 * n2
    which = np.repeat(np.arange(len(sizes)), sizes)
    k = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return which, lo1[which] + k // n2[which], lo2[which] + k % n2[which]


def join_tries(keys: np.ndarray, low: np.ndarray, high: np.ndarray, budget: int = BUDGET) -> Forest:
    """Link positions within ``budget`` bits that lie in one trie.

    ``keys`` holds each trie's fingerprints in ascending order, all alike in
    their top BLOCK_BITS bits; trie t spans low[t]:high[t].
    """
    forest = Forest(len(keys))
    stack = [(low, high, low, high, np.full(len(low), 64 - BLOCK_BITS, np.int64))]
    while stack:
        lo1, hi1, lo2, hi2, bit = stack.pop()
        if len(lo1) > FRONTIER:
            half = len(lo1) // 2
            stack.append(tuple(x[half:] for x in (lo1, hi1, lo2, hi2, bit)))
            lo1, hi1, lo2, hi2, bit = (x[:half] for x in (lo1, hi1, lo2, hi2, bit))
        # Bits above ``bit`` are the path so far. The two paths' differing bits must fit the budget.
        at = bit.astype(np.uint64)
        live = np.bitwise_count((keys[lo1] >> at) ^ (keys[lo2] >> at)) <= budget
        # Nodes that are wholly in one component have nothing left to link.
        ends = forest.up
        same = (ends[lo1] == ends[hi1 - 1]) & (ends[lo1] == ends[lo2]) & (ends[lo1] == ends[hi2 - 1])
        if same.any():
            joined = np.concatenate([[0], np.cumsum(ends[1:] != ends[:-1])])
            same &= (joined[hi1 - 1] == joined[lo1]) & (joined[hi2 - 1] == joined[lo2])
            live &= ~same
        lo1, hi1, lo2, hi2, bit = (x[live] for x in (lo1, hi1, lo2, hi2, bit))
        small = ((hi1 - lo1) * (hi2 - lo2) <= LEAF_PAIRS) | (bit <= 0)
        if small.any():
            sizes = ((hi1 - lo1) * (hi2 - lo2))[small]
            cuts = np.unique(np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum() + 1, FRONTIER * 4), side="right"))
            for part in np.split(np.flatnonzero(small), cuts[(cuts > 0) & (cuts < len(sizes))]):
                _, i, j = _expand(lo1[part], hi1[part], lo2[part], hi2[part])
                near = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
                forest.unite(i[near], j[near])
        lo1, hi1, lo2, hi2, bit = (x[~small] for x in (lo1, hi1, lo2, hi2, bit))
        if not len(lo1):
            continue
        # Split both nodes at the next bit: children of a node are the ranges before and after its first 1.
        bit = bit - 1
        m1, m2 = _first_one(keys, lo1, hi1, bit), _first_one(keys, lo2, hi2, bit)
        own = (lo1 == lo2) & (hi1 == hi2)
        nxt = [(lo1, m1, lo2, m2), (m1, hi1, m2, hi2), (lo1, m1, m2, hi2)]
        cross = ~own  # of a node with itself the two crossings are the same
        parts = [np.concatenate(x) for x in zip(*nxt, (m1[cross], hi1[cross], lo2[cross], m2[cross]), strict=True)]
        bits = np.concatenate([bit, bit, bit, bit[cross]])
        full = (parts[0] < parts[1]) & (parts[2] < parts[3])
        stack.append(tuple(x[full] for x in (*parts, bits)))
    return forest


def _first_one(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Per range of ascending keys with a common path above ``bit``: where its keys with that bit set begin."""
    a, b = lo.copy(), hi.copy()
    at = bit.astype(np.uint64)
    while (open_ := a < b).any():
        mid = (a + b) // 2
        one = np.zeros(len(a), bool)
        one[open_] = (keys[mid[open_]] >> at[open_]) & np.uint64(1) == 1
        b = np.where(open_ & one, mid, b)
        a = np.where(open_ & ~one, mid + 1, a)
    return a


def _link(batches):
    """Walks the tries of whole cells, as rows come sorted by cell: emits (a, b) with b the first linked of its trie."""
    held: list[pa.RecordBatch] = []

    def walk(t: pa.Table):
        if not t.num_rows:
            return
        cell = np.stack([t[c].to_numpy() for c in ("block", "value", "x", "y")], 1)
        fp = t["fp"].to_numpy().view(np.uint64)
        # The key has the cell's block rotated to the top, so that all of a trie share its path there.
        turn = (cell[:, 0] * BLOCK_BITS).astype(np.uint64)
        keys = np.where(turn > 0, (fp << turn) | (fp >> (np.uint64(64) - np.maximum(turn, np.uint64(1)))), fp)
        by = np.lexsort((keys, cell[:, 3], cell[:, 2], cell[:, 1], cell[:, 0]))
        cell, keys, fp = cell[by], keys[by], fp[by]
        starts = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]).any(1)]))
        forest = join_tries(keys, starts, np.append(starts[1:], len(fp)))
        linked = np.flatnonzero(forest.up != np.arange(len(fp)))
        if len(linked):
            yield pa.record_batch([pa.array(fp[linked].view(np.int64)), pa.array(fp[forest.up[linked]].view(np.int64))], names=["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < FRONTIER:
            continue
        t = pa.Table.from_batches(held)
        last = np.ones(t.num_rows, bool)
        for c in ("block", "value", "x", "y"):
            column = t[c].to_numpy()
            last &= column == column[-1]
        first = int(np.argmax(last))  # the last cell may go on in the next batch
        yield from walk(t.slice(0, first))
        held = t.slice(first).combine_chunks().to_batches()
    if held:
        yield from walk(pa.Table.from_batches(held))


def links(prints: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within the budget; ``prints`` has a distinct column fp."""
    width = shuffle_width(prints.sparkSession)
    block = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block")
    value = F.expr(f"(shiftrightunsigned(fp, 64 - {BLOCK_BITS} * (block + 1)) & {(1 << BLOCK_BITS) - 1})").cast("int")
    placed = prints.select("fp", block).withColumn("value", value)
    # At most 4 * 65536 rows, whatever the input.
    counts = placed.groupBy("block", "value").agg(F.count("*").alias("n"))
    total = prints.count() * BLOCKS
    share = max(cell_rows, -(-total // (4 * width)))
    counts = counts.select("block", "value", F.ceil(F.col("n") / share).cast("int").alias("s"))
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("s")).cast("int")
    dealt = placed.join(counts, ["block", "value"]).withColumn("own", own)
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("s") - 1), lambda o: F.struct(F.least("own", o).alias("x"), F.greatest("own", o).alias("y")))).alias("pair")
    cells = dealt.select("block", "value", "fp", pair).select("block", "value", "pair.x", "pair.y", "fp")
    return cells.repartition(width, "block", "value", "x", "y").sortWithinPartitions("block", "value", "x", "y").mapInArrow(_link, "a long, b long").distinct()


# --- components -------------------------------------------------------------


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """fp and root for every end of an edge but the roots; root is the smallest reachable value.

    Large-star and small-star rounds: each node's larger neighbours are hooked to
    its minimum, then its smaller ones. Hubs are handled by joins and partial
    minima, never by gathering a node's neighbours. Each round is written to the
    shared folder.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = materialize(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = materialize(small.where("u <> v").distinct(), "small-star")
        # Done when only stars are left: one edge for each node, and no root has an edge of its own.
        if now.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty() and now.select(F.col("v").alias("u")).join(now, "u", "left_semi").isEmpty():
            return now.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def print_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fp and component_id of every row: the smallest id reachable over links.

    Null texts and texts without words have fingerprint 0, which is linked like
    any other. Fewer words than a shingle make one shingle of all. Rows with a
    null id are fingerprinted, link others and take part in components; a
    component without any id has a null component_id. Rows that repeat are kept.
    Of an empty table the result is empty. Other columns are ignored.
    """
    prints = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp")))
    placed = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(names, "fp").select("id", "fp", "component_id")


# --- likeness of whole shingle sets -----------------------------------------


def shingle_sets(texts: list[str | None], size: int = WORDS) -> Iterator[np.ndarray]:
    """Per text the ascending distinct 64-bit hashes of its word shingles; fewer words than a shingle make one of all."""
    for at in range(0, len(texts), TEXTS):
        words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts[at : at + TEXTS]]
        known: dict[bytes, int] = {}
        for some in words:
            known.update((w, xxhash.xxh64_intdigest(w)) for w in set(some).difference(known))
        m = np.array([len(x) for x in words])
        h = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.uint64, int(m.sum()))
        ends = np.cumsum(m)
        # Every stretch of ``size`` words of all texts end to end; those that cross an end are not used.
        x = np.full(max(0, len(h) - size + 1), size, np.uint64)
        for k in range(size):
            x = _mixed(x, h[k : k + len(x)])
        for n, end in zip(m.tolist(), ends.tolist(), strict=True):
            if n >= size:
                yield np.unique(x[end - n : end - size + 1])
            else:
                one = np.full(min(n, 1), n, np.uint64)
                for k in range(n):
                    one = _mixed(one, h[end - n + k : end - n + k + 1])
                yield one


def _mixed(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    x = (x ^ h) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    return next(shingle_sets([text], size))


def set_fingerprint(grams: np.ndarray) -> int:
    """SimHash of a set, as a signed long: bits that over half of its hashes have; 0 for the empty one."""
    ones = np.unpackbits(grams.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((ones * 2 > len(grams)).astype(np.uint8), bitorder="little").view(np.int64)[0])


def set_print(grams: np.ndarray) -> int:
    """One signed long for a whole set; 0 for the empty one."""
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).view(np.int64)) if len(grams) else 0


def sketch(grams: np.ndarray) -> np.ndarray:
    """Parities of the shingles in each bin, as signed longs. A shingle that only one of two sets has changes one bin,
    so their sketches differ in no more bins than the sets do in shingles."""
    odd = np.bincount((grams >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64), minlength=BINS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def common_shingles(docs: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent among some texts, ascending, and their counts. They only order shingles: results do not depend on them."""

    def run(batches):
        for batch in batches:
            grams, n = np.unique(np.concatenate([*shingle_sets(batch.column(0).to_pylist()), np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.record_batch([pa.array(grams.view(np.int64)), pa.array(n)], names=["g", "n"])

    texts = docs.select(docs[f"`{text_col}`"].cast("string").alias("t"))
    some = texts.sample(min(1.0, max(SAMPLE_SHARE, SAMPLE_ROWS / max(1, docs.count()))), 7)
    counts = some.mapInArrow(trimmed(run), "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).where("n > 2")
    top = most_frequent(materialize(counts, "common"), "n", COMMON).toPandas()
    grams, n = top["g"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    by = np.argsort(grams)
    return grams[by], n[by]


def prefix(grams: np.ndarray, common: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """Of n shingles, rare ones first, as many as a match cannot all miss: it keeps ceil(similarity * n) at least."""
    if not len(grams):
        return grams
    rank = np.zeros(len(grams), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
        rank = np.where(common[at] == grams, counts[at], 0)
    most = len(grams) - int(np.ceil(similarity * len(grams) - 1e-9)) + 1
    return grams[np.lexsort((grams, rank))[:most]]


def with_sets(pairs: DataFrame, sets: DataFrame, key: str, name: str) -> DataFrame:
    """``pairs`` with the grams of its column ``key`` as ``name``. A set that very many pairs name is copied, and its pairs are dealt to the copies."""
    copies = pairs.groupBy(key).agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("s")).where("s > 1")
    copies = materialize(copies, "copies")
    side = sets.select(F.col("fp").alias(key), F.col("grams").alias(name))
    if copies.isEmpty():
        return pairs.join(side, key)
    dealt = pairs.join(copies, key, "left").withColumn("copy", F.pmod(F.xxhash64("a", "b"), F.coalesce("s", F.lit(1))).cast("int")).drop("s")
    numbers = F.explode(F.sequence(F.lit(0), F.coalesce("s", F.lit(1)) - 1)).alias("copy")
    return dealt.join(side.join(copies, key, "left").select(key, name, numbers), [key, "copy"]).drop("copy")


def verified(pairs: DataFrame, keys: DataFrame, docs: DataFrame, text_col: str, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b; from storage) whose whole sets are alike enough. ``keys``: a text's hash tk for each set fp."""

    def sets_of(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column(0).to_pylist()))
            yield pa.record_batch([pa.array([set_print(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["fp", "grams"])

    def run(batches):
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    named = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    needed = materialize(keys.join(named, "fp", "left_semi").select("tk"), "needed")
    text = docs[f"`{text_col}`"].cast("string")
    # A null text has a hash of its own, so every row is found by it.
    texts = docs.select(F.xxhash64(text).alias("tk"), text.alias("t")).join(F.broadcast(needed) if needed.count() <= NAMED else needed, "tk", "left_semi")
    sets = materialize(texts.groupBy("tk").agg(F.min("t").alias("t")).select("t").mapInArrow(trimmed(sets_of), "fp long, grams binary"), "sets")
    both = with_sets(with_sets(pairs, sets, "a", "x"), sets, "b", "y")
    return both.select("a", "b", "x", "y").mapInArrow(trimmed(run), "a long, b long")


def _sized(x, y, similarity: float):
    """Whether sets of so many shingles can be alike."""
    return F.least(x, y) >= F.greatest(x, y) * similarity - 1e-6


def meetings(split: DataFrame, similarity: float) -> DataFrame:
    """Pairs (p, q) of sets apart, with their sizes np and nq, once for each shingle g of both prefixes: those that can be alike by their sizes and sketches.

    ``split`` has g, fp, n, sketch, root and the main root of each g.
    """
    c = F.col
    x = split.where("root <> main").select("g", c("fp").alias("p"), c("n").alias("np"), c("root").alias("rp"), c("sketch").alias("sp"))
    y = split.select("g", c("fp").alias("q"), c("n").alias("nq"), c("root").alias("rq"), (c("root") == c("main")).alias("in_main"), c("sketch").alias("sq"))
    apart = (c("rp") != c("rq")) & (c("in_main") | (c("p") < c("q")))
    differ = sum((F.bit_count(c("sp")[i].bitwiseXOR(c("sq")[i])) for i in range(BINS // 64)), F.lit(0))
    most = (c("np") + c("nq")) * ((1 - similarity) / (1 + similarity))  # shingles that only one of two alike sets has
    return x.join(y, "g").where(apart & _sized(c("np"), c("nq"), similarity) & (differ <= most + 1e-6)).select("g", "p", "q", "np", "nq")


def set_links(docs: DataFrame, prints: DataFrame, distinct: DataFrame, text_col: str, similarity: float) -> DataFrame:
    """Edges (a, b) that connect all distinct sets at or above ``similarity``.

    ``distinct`` has a row (fp, sim, tk, row, sketch) for each set, and ``prints`` under that
    row its n and prefix. First the links of the tries are checked, and with them
    one pair for each set, which joins most of a group; then all pairs that share enough of their prefixes, have like sketches
    and are not in one component yet. Pairs in one component add nothing, so a large group is never
    compared pair by pair.
    """
    c = F.col
    lead = materialize(distinct.groupBy("sim").agg(F.min("fp").alias("lead")), "sims")
    own = distinct.join(lead, "sim").where("fp <> lead").select(c("lead").alias("a"), c("fp").alias("b"))
    near = links(lead.select(c("sim").alias("fp")))
    of = lambda end: lead.select(c("sim").alias(end), c("lead").alias(f"{end}_lead"))
    near = near.join(of("a"), "a").join(of("b"), "b").select(c("a_lead").alias("a"), c("b_lead").alias("b"))

    # One exchange serves the count and the join.
    heads = prints.join(distinct.select("fp", "row"), ["fp", "row"], "left_semi").select("fp", "n", F.explode("prefix").alias("g"))
    heads = heads.repartition(shuffle_width(docs.sparkSession), "g")
    seen = heads.groupBy("g").agg(F.count("*").alias("m")).where("m > 1").select("g")
    shared = materialize(heads.join(seen, "g", "left_semi"), "shared")

    share = similarity / (1 + similarity)  # of both sets' shingles together, two sets that are alike have this much in common at least
    sized = lambda x, y: _sized(x, y, similarity)
    # Of the sets with a shingle, the one leads that has the fewest shingles to itself, as the original of many copies has. Each set
    # tries the one that leads the most of its shingles.
    central = shared.groupBy("fp").agg((F.count("*") / F.first("n")).alias("central"))
    shown = shared.join(central, "fp")
    leads = shown.groupBy("g").agg(F.max(F.struct("central", "fp", "n")).alias("lead")).select("g", c("lead.fp").alias("lead"), c("lead.n").alias("lead_n"))
    led = shared.join(leads, "g").where((c("fp") != c("lead")) & sized(c("n"), c("lead_n"))).groupBy("fp", "lead").agg(F.count("*").alias("m"))
    led = led.groupBy("fp").agg(F.max_by("lead", F.struct("m", "lead")).alias("a")).select("a", c("fp").alias("b"))
    tried = materialize(own.union(near).union(led).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    first = materialize(verified(tried, distinct, docs, text_col, similarity), "first-links")

    rooted = shared.select("g", "fp", "n").join(components(first), "fp", "left").select("g", "fp", "n", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    # Of two sets apart, one at least is not in the main component of a shingle.
    main = rooted.groupBy("g", "root").agg(F.count("*").alias("m")).groupBy("g").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.count("*").alias("k")).where("k > 1").select("g", "main")
    split = materialize(rooted.join(main, "g"), "split")
    met = meetings(split.join(distinct.select("fp", "sketch"), "fp"), similarity)
    counted = met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), (c("np") + c("nq")).alias("all"), F.greatest("np", "nq").alias("most")).groupBy("a", "b", "all", "most").agg(F.count("*").alias("common"))
    # Behind its prefix a set has ceil(similarity * n) - 1 shingles, so no more can be in common than these and the common ones of both prefixes.
    enough = counted.where(c("common") + F.ceil(c("most") * similarity - 1e-6) - 1 >= c("all") * share - 1e-6).select("a", "b")
    others = materialize(enough.join(tried, ["a", "b"], "left_anti"), "others")
    return first.union(verified(others, distinct, docs, text_col, similarity))


def rooted_sets(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Rows (id, tk, fp) of ``docs``, and the root of each fp; a root stands for one component."""
    common, counts = common_shingles(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((common, counts))

    def run(batches):
        for batch in batches:
            found = [(set_print(x), set_fingerprint(x), len(x), prefix(x, *shared.value, similarity).view(np.int64), sketch(x)) for x in shingle_sets(batch.column(3).to_pylist())]
            columns = zip(*found, strict=True) if found else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.record_batch([*batch.columns[:3], *(pa.array(x, t) for x, t in zip(columns, types, strict=True))], names=["id", "row", "tk", "fp", "sim", "n", "prefix", "sketch"])

    text = docs[f"`{text_col}`"].cast("string")
    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.xxhash64(text).alias("tk"), text.alias("t"))
    prints = materialize(rows.mapInArrow(trimmed(run), "id long, row long, tk long, fp long, sim long, n long, prefix array<long>, sketch array<long>"), "set-prints")
    distinct = materialize(prints.groupBy("fp").agg(F.min(F.struct("row", "tk", "sim", "sketch")).alias("x")).select("fp", "x.row", "x.tk", "x.sim", "x.sketch"), "distinct-sets")
    roots = components(set_links(docs, prints, distinct, text_col, similarity))
    return prints.select("id", "tk", "fp"), distinct.select("fp").join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """id, fp and component_id of every row, by the likeness of whole texts: the smallest id reachable over
    pairs whose sets of five-word shingles have a Jaccard index of ``similarity`` (0.8) at least.

    No pair is lost (tries, prefix filter and exact check). fp names a set of
    shingles; texts without words are alike. Null ids, rows that repeat and empty
    tables are as in ``print_classes``.
    """
    rows, roots = rooted_sets(docs, id_col, text_col, similarity)
    least = rows.groupBy("fp").agg(F.min("id").alias("least")).join(roots, "fp")
    names = least.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return rows.select("id", "fp").join(names, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each component of ``classes``, with the columns of ``docs``.

    The row of the smallest id stands, null ids last; among rows that share it,
    one text by its hash, and one of rows that are alike in id and text. Rows that
    share an id but not a component each stand for their own.
    """
    rows, roots = rooted_sets(docs, id_col, text_col, similarity)
    order = F.struct(F.col("id").isNull().alias("no"), F.coalesce("id", F.lit(0)).alias("id"), "tk")
    least = rows.groupBy("fp").agg(F.min(order).alias("stands")).join(roots, "fp").groupBy("root").agg(F.min("stands").alias("stands"))
    stands = materialize(least.select("stands.no", "stands.id", "stands.tk"), "stands")
    cols = docs.columns
    key = docs[f"`{id_col}`"].cast("long")
    packed = docs.select(key.isNull().alias("no"), F.coalesce(key, F.lit(0)).alias("id"), F.xxhash64(docs[f"`{text_col}`"].cast("string")).alias("tk"), F.struct(*[docs[f"`{c}`"] for c in cols]).alias("row"))
    kept = packed.join(stands, ["no", "id", "tk"], "left_semi").groupBy("no", "id", "tk").agg(F.first("row").alias("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in cols])


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = print_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
