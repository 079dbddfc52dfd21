"""Score texts by cross-entropy difference between two matched n-gram models.

A target model (texts like those wanted) and a background model (all texts) are
word bigram models of the same order, the same smoothing and one vocabulary: all
words of both. Counts of the background are scaled to the target's size. A
text's score is its mean loss per token under the target less that under the
background: the lower, the more it is like the target.

    P(w | h) = (c(h, w) + MU * P(w)) / (c(h) + MU),  P(w) = (c(w) + A) / (N + A * V)

Every word and every bigram has counts of its own; nothing is capped or folded
together. Words and bigrams are told apart by 64-bit hashes. What is counted
grows with the input, and moves in packed form:

1. Texts are cut into chunks of about ``CHUNK_TOKENS``. A chunk keeps its distinct
   words' hashes and each token as a number into them.
2. A chunk asks for its distinct words and bigrams: ascending hashes, as
   differences, with the chunk's own counts, a row for each range of hashes. A
   task adds up one range at a time over all chunks and answers each chunk with
   the totals in the order in which it asked.
3. Chunks and answers meet, and a chunk's texts are scored by numpy.

So a bigram is sent once for each chunk, however often or in how many texts it
occurs, and no key, hot or not, has more rows than there are chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from .common import materialize, shuffle_width, table, trimmed

MU, A = 64.0, 0.5
#: Tokens and rows of a chunk: it is closed once it has as many of either. A text is never cut.
CHUNK_TOKENS, CHUNK_ROWS = 1 << 19, 1 << 16
#: Tokens whose words and bigrams share a range of hashes, so about as many are added up at a time.
RANGE_TOKENS = 1 << 23
#: Bytes of marks (a bit for each text) that are sent to all tasks at most.
MASK_BYTES = 1 << 25
#: The start of a text counts as the word "", once for each text that has tokens.
START = xxhash.xxh64_intdigest(b"")
_MIX = np.uint64(0x9E3779B97F4A7C15)

_ASKED = "chunk long, back int, part int, n int, keys binary, b binary, t binary"
_SUMMED = f"{_ASKED}, fresh long, n_b long, n_t long"
_TYPES = {"chunk": pa.int64(), "back": pa.int32(), "part": pa.int32(), "n": pa.int32(), "keys": pa.binary(), "b": pa.binary(), "t": pa.binary(), "fresh": pa.int64(), "n_b": pa.int64(), "n_t": pa.int64()}


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as bytes; case is kept."""
    return text.encode("utf-8", "replace").split() if text else []


# --- packing ------------------------------------------------------------------


def planes(x: np.ndarray) -> bytes:
    """Whole numbers of at least zero: all lowest bytes, then all next ones, as many as the largest has, compressed."""
    x = np.ascontiguousarray(x, np.uint64)
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes(), 1)


def unplanes(data: bytes, n: int) -> np.ndarray:
    """What ``planes`` packed, as unsigned 64-bit integers."""
    out = np.zeros((n, 8), np.uint8)
    if n:
        data = np.frombuffer(zstandard.decompress(data), np.uint8)
        out[:, : len(data) // n] = data.reshape(-1, n).T
    return out.view(np.uint64).reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending distinct hashes, one at least: the first, and the differences."""
    return keys[:1].tobytes() + planes(np.diff(keys))


def unpacked_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.concatenate([np.frombuffer(data[:8], np.uint64), unplanes(data[8:], n - 1)]), dtype=np.uint64)


# --- chunks -------------------------------------------------------------------


class _Numbers(dict):
    """Numbers words through as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def coded(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """A row for each chunk of ``docs``: chunk, back (a number that deals chunks out evenly) and its packed texts.

    n: tokens; ids: the words' numbers; words: the hashes of those; sizes: tokens
    of each text. The columns ``keep`` of a chunk's rows are in kept, by position.
    """
    kept = F.struct(F.lit(True).alias("k"), *[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(keep)])
    rows = docs.select(kept.alias("kept"), docs[f"`{text_col}`"].cast("string").alias("t"))
    schema = StructType().add("chunk", "long").add("back", "integer").add("n", "long").add("ids", "binary").add("words", "binary").add("sizes", "binary")
    schema.add(StructField("kept", ArrayType(rows.schema["kept"].dataType)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        numbers, held, sizes, kept, total = _Numbers({b"": 0}), [], [], [], 0

        def out() -> pa.RecordBatch:
            words, ids = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers)), np.concatenate(held)
            # Frequent words get small numbers, which pack well; the start keeps 0.
            by = np.concatenate([[0], np.argsort(-np.bincount(ids, minlength=len(words))[1:], kind="stable") + 1])
            rank = np.empty(len(words), np.int64)
            rank[by] = np.arange(len(words))
            numbered, structs = (pa.array([x], t) for x, t in (((task << 32) | made, pa.int64()), (task + made, pa.int32()), (total, pa.int64()))), pa.concat_arrays(kept)
            packed = (pa.array([x], pa.binary()) for x in (planes(rank[ids]), words[by].tobytes(), np.array(sizes, np.int32).tobytes()))
            return pa.record_batch([*numbered, *packed, pa.ListArray.from_arrays(pa.array([0, len(structs)], pa.int32()), structs)], names=schema.names)

        for batch in batches:
            begun = 0
            for at, text in enumerate(batch.column(1).to_pylist(), 1):
                words = tokens(text)
                held.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                sizes.append(len(words))
                total += len(words)
                if total >= CHUNK_TOKENS or len(sizes) >= CHUNK_ROWS:
                    kept.append(batch.column(0).slice(begun, at - begun))
                    yield out()
                    begun, made = at, made + 1
                    numbers, held, sizes, kept, total = _Numbers({b"": 0}), [], [], [], 0
            if begun < batch.num_rows:
                kept.append(batch.column(0).slice(begun))
        if sizes:
            yield out()

    return rows.mapInArrow(trimmed(run), schema)


@dataclass
class Chunk:
    """Distinct words and bigrams of a chunk. ``keys``: ascending hashes of the words, then bigrams, put in ``order``."""

    word: np.ndarray
    bigram: np.ndarray
    first: np.ndarray
    second: np.ndarray
    size: np.ndarray
    keys: np.ndarray
    order: np.ndarray
    n_words: int

    @classmethod
    def of(cls, row: dict) -> Chunk:
        word, known, size = unplanes(row["ids"], row["n"]).astype(np.int64), np.frombuffer(row["words"], np.uint64), np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        history = np.empty_like(word)
        history[1:] = word[:-1]
        starts = (np.cumsum(size) - size)[size > 0]
        history[starts] = 0
        pair, bigram = np.unique(history * len(known) + word, return_inverse=True)
        first, second = pair // len(known), pair % len(known)
        x = (known[first] + _MIX) * np.uint64(0xBF58476D1CE4E5B9)
        x = ((x ^ (x >> np.uint64(31))) + known[second]) * np.uint64(0x94D049BB133111EB)
        x = (x ^ (x >> np.uint64(29))) * _MIX
        # The lowest bit tells words from bigrams.
        keys = np.concatenate([known | np.uint64(1), (x ^ (x >> np.uint64(32))) & ~np.uint64(1)])
        order = np.argsort(keys, kind="stable")
        return cls(word, bigram, first, second, size, keys[order], order, len(known))

    def counts(self, on: np.ndarray) -> np.ndarray:
        """How often each key occurs in the chunk's texts that are ``on``."""
        each = np.repeat(on, self.size).astype(np.float64)
        words = np.bincount(self.word, each, self.n_words)
        words[0] = (on & (self.size > 0)).sum()
        return np.concatenate([words, np.bincount(self.bigram, each, len(self.first))])[self.order].astype(np.uint64)


def asked(chunks: DataFrame, parts: int) -> DataFrame:
    """Rows of _ASKED: what each chunk wants to know, by range of hashes, and what it counts itself.

    ``chunks`` has in_b (whether its texts count in the background) and in_t (a
    bit for each text that counts in the target, to the last such; null: all do).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk.of(row)
                of_target = np.ones(len(chunk.size), bool)
                if row["in_t"] is not None:
                    bits = np.unpackbits(np.frombuffer(row["in_t"], np.uint8), bitorder="little")[: len(of_target)]
                    of_target = np.concatenate([bits, np.zeros(len(of_target) - len(bits), np.uint8)]) > 0
                b, t = chunk.counts(np.full(len(chunk.size), row["in_b"])), chunk.counts(of_target)
                keys, at = np.unique(chunk.keys, return_index=True)  # of equal hashes one is sent
                b, t = np.add.reduceat(b, at), np.add.reduceat(t, at)
                part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                spans = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)], strict=True))
                sent = [[packed_keys(keys[i:j]) for i, j in spans], [planes(b[i:j]) for i, j in spans], [planes(t[i:j]) for i, j in spans]]
                numbers = [np.full(len(spans), row["chunk"]), np.full(len(spans), row["back"], np.int32), part[cuts].astype(np.int32), np.array([j - i for i, j in spans], np.int32)]
                yield pa.record_batch([*map(pa.array, numbers), *(pa.array(x, pa.binary()) for x in sent)], names=list(_TYPES)[:7])

    return chunks.select("chunk", "back", "n", "ids", "words", "sizes", "in_b", "in_t").mapInArrow(trimmed(run), _ASKED)


def summed(rows: DataFrame, parts: int, answer: bool) -> DataFrame:
    """Totals of each hash over all ``rows`` (of _ASKED): back to each chunk if ``answer``, else a row for each range.

    fresh (the words that a range has in either model), n_b and n_t (the tokens
    and starts of each model) are on one row of a range.
    """

    def add(held: list[dict]) -> pa.RecordBatch:
        keys, place = np.unique(np.concatenate([unpacked_keys(r["keys"], r["n"]) for r in held]), return_inverse=True)
        b, t = (np.bincount(place, np.concatenate([unplanes(r[x], r["n"]) for r in held]).astype(np.float64), len(keys)).astype(np.uint64) for x in "bt")
        word = keys & np.uint64(1) > 0
        noted = {"fresh": int((word & (keys != np.uint64(START | 1)) & (b + t > 0)).sum()), "n_b": int(b[word].sum()), "n_t": int(t[word].sum())}
        if not answer:
            out = [{"chunk": -1, "back": held[0]["part"], "part": held[0]["part"], "n": len(keys), "keys": packed_keys(keys), "b": planes(b), "t": planes(t), **noted}]
        else:
            ends, out = np.cumsum([r["n"] for r in held]).tolist(), []
            for r, end in zip(held, ends, strict=True):
                if r["chunk"] >= 0:
                    mine = place[end - r["n"] : end]
                    out.append({"chunk": r["chunk"], "back": r["back"], "part": r["part"], "n": r["n"], "b": planes(b[mine]), "t": planes(t[mine]), **(noted if not out else {})})
        return pa.record_batch([pa.array([r.get(x) for r in out], _TYPES[x]) for x in _TYPES], names=list(_TYPES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["part"] != row["part"]:
                    yield add(held)
                    held = []
                held.append(row)
        if held:
            yield add(held)

    width = min(parts, shuffle_width(rows.sparkSession))
    return rows.repartitionById(width, F.col("part")).sortWithinPartitions("part", "chunk").mapInArrow(trimmed(run), _SUMMED)


def parts_for(chunks: DataFrame) -> int:
    """Ranges of hashes for the tokens of ``chunks``; as many as there are tasks at least."""
    return max(shuffle_width(chunks.sparkSession), -(-(chunks.agg(F.sum("n")).first()[0] or 0) // RANGE_TOKENS))


def totals(counts: DataFrame) -> tuple[int, int, int]:
    """Of rows of _SUMMED: tokens and starts in the background and in the target, and the words of either with two more."""
    found = counts.agg(F.sum("n_b"), F.sum("n_t"), F.sum("fresh")).first()
    return tuple(x or 0 for x in found[:2]) + ((found[2] or 0) + 2,)


# --- models and scores --------------------------------------------------------


@dataclass
class Model:
    """Counts of both models: ``counts`` (rows of _SUMMED, one for each of ``parts`` ranges), their totals, and the size of the vocabulary."""

    counts: DataFrame
    parts: int
    n_background: int
    n_target: int
    size: int


def fit(background: DataFrame, target: DataFrame, text_col: str = "text") -> Model:
    """Both models from all of their texts, all words and bigrams. Only totals reach the driver. Null texts count as empty."""
    nowhere, everywhere = F.lit(b""), F.lit(None).cast("binary")
    sides = [coded(docs, text_col, []).withColumns({"in_b": F.lit(in_b), "in_t": in_t}) for docs, in_b, in_t in ((background, True, nowhere), (target, False, everywhere))]
    chunks = materialize(sides[0].unionByName(sides[1]), "chunks")
    parts = parts_for(chunks)
    counts = materialize(summed(asked(chunks, parts), parts, answer=False), "counts")
    return Model(counts, parts, *totals(counts))


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks = []
        for at in batch.column(1).to_pylist():
            mask = np.zeros(max(at) + 1, np.uint8)
            mask[at] = 1
            masks.append(np.packbits(mask, bitorder="little").tobytes())
        yield pa.record_batch([batch.column(0), pa.array(masks, pa.binary())], names=["chunk", "in_t"])


def marked(chunks: DataFrame, id_at: int, target_ids: DataFrame) -> DataFrame:
    """``chunks`` with in_t: a bit for each text, set where its id (field c<id_at> of kept) is in ``target_ids``.

    Only ids are joined. The bits are sent to all tasks if they are at most
    ``MASK_BYTES`` together, and joined to the chunks by a shuffle beyond that.
    """
    ids = chunks.select("chunk", F.posexplode(F.transform("kept", lambda x: x[f"c{id_at}"]))).where(F.col("col").isNotNull())
    wanted = target_ids.select(target_ids[f"`{target_ids.columns[0]}`"].alias("wanted")).where(F.col("wanted").isNotNull()).distinct()
    found = ids.join(wanted, ids["col"] == wanted["wanted"], "left_semi").groupBy("chunk").agg(F.collect_list("pos").alias("in_t"))  # at most a chunk's rows
    masks = materialize(found.mapInArrow(_masks, "chunk long, in_t binary"), "masks")
    small = (masks.agg(F.sum(F.octet_length("in_t"))).first()[0] or 0) <= MASK_BYTES
    return chunks.join(F.broadcast(masks) if small else masks.hint("merge"), "chunk", "left").withColumn("in_t", F.coalesce("in_t", F.lit(b"")))


def scored(chunks: DataFrame, answers: DataFrame, n_background: int, n_target: int, size: int, names: list[str], schema: StructType) -> DataFrame:
    """A row of ``schema`` for each text of ``chunks``, whose answers are all there. ``names``: the fields of kept that come first."""
    scale = n_target / n_background if n_background and n_target else 1.0

    def losses(chunk: Chunk, counted: np.ndarray, n: float, by: float) -> np.ndarray:
        c = np.empty(len(chunk.keys))
        c[chunk.order] = counted * by
        words, pairs = c[: chunk.n_words], c[chunk.n_words :]
        return np.log((pairs + MU * (words[chunk.second] + A) / (n + A * size)) / (words[chunk.first] + MU))

    def out(head: dict, kept: pa.Array, answers: list[dict]) -> pa.RecordBatch:
        chunk = Chunk.of(head)
        keys, which = np.unique(chunk.keys, return_inverse=True)
        if sum(r["m"] for r in answers) != len(keys):
            raise RuntimeError(f"chunk {head['chunk']} lacks answers")
        b, t = (np.concatenate([unplanes(r[x], r["m"]) for r in answers])[which].astype(np.float64) for x in "bt")
        loss = (losses(chunk, b, n_background * scale, scale) - losses(chunk, t, float(n_target), 1.0))[chunk.bigram]
        text = np.repeat(np.arange(len(chunk.size)), chunk.size)
        mean = np.bincount(text, loss, len(chunk.size)) / np.maximum(chunk.size, 1)
        return pa.record_batch([*(kept.field(x) for x in names), pa.array(chunk.size, pa.int64()), pa.array(mean, pa.float64(), mask=chunk.size == 0)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, kept, held = None, None, []
        for batch in batches:
            lists = batch.column("kept")
            for at, row in enumerate(batch.select([x for x in batch.schema.names if x != "kept"]).to_pylist()):
                if row["part"] >= 0:
                    held.append(row)
                    continue
                if head is not None:
                    yield out(head, kept, held)
                head, kept, held = row, lists.slice(at, 1).flatten(), []
        if head is not None:
            yield out(head, kept, held)

    nothing = lambda like, names: [F.lit(None).cast(like.schema[c].dataType).alias(c) for c in names]
    texts, counts = ["n", "ids", "words", "sizes", "kept"], ["m", "b", "t"]
    answers = answers.select("chunk", "back", "part", F.col("n").alias("m"), "b", "t")
    heads = chunks.select("chunk", "back", F.lit(-1).alias("part"), *texts, *nothing(answers, counts))
    both = heads.unionByName(answers.select("chunk", "back", "part", *nothing(chunks, texts), *counts))
    return both.repartitionById(shuffle_width(chunks.sparkSession), F.col("back")).sortWithinPartitions("chunk", "part").mapInArrow(trimmed(run), schema)


def score(docs: DataFrame, model: Model | None = None, text_col: str = "text", keep: list[str] | None = None, name: str = "ce_difference", target_ids: DataFrame | None = None, id_col: str = "doc_id") -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default), n_scored (tokens) and the score; these replace columns of their names.

    With ``model``, texts are scored under it. With ``target_ids`` (a column of
    ids), ``docs`` are themselves the background, and those whose ``id_col`` is
    named there are the target too: all is counted and scored together. Null ids
    name no text; ids that repeat name every row that has them.

    Null texts and texts without tokens have n_scored 0 and a null score. Texts
    of any length are scored whole; a chunk's texts must fit a task. Rows that
    repeat are kept. Of an empty table the result is empty.
    """
    if (model is None) == (target_ids is None):
        raise ValueError("give either a model or the ids of the target")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (name, "n_scored")]
    schema = StructType([StructField(c, docs.schema[c].dataType) for c in keep]).add("n_scored", "long").add(name, "double")
    inputs = keep if model is not None or id_col in keep else [*keep, id_col]
    chunks = materialize(coded(docs, text_col, inputs), "chunks")
    if model is None:
        parts = parts_for(chunks)
        rows = asked(marked(chunks, inputs.index(id_col), target_ids).withColumn("in_b", F.lit(True)), parts)
    else:
        parts = model.parts
        rows = asked(chunks.withColumns({"in_b": F.lit(False), "in_t": F.lit(b"")}), parts).unionByName(model.counts.select("chunk", "back", "part", "n", "keys", "b", "t"))
    answers = materialize(summed(rows, parts, answer=True), "answers")
    known = totals(answers) if model is None else (model.n_background, model.n_target, model.size)
    return scored(chunks, answers, *known, [f"c{i}" for i in range(len(keep))], schema)


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled of good quality. Background: all documents."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return score(table(spark, sf_dir, "documents"), keep=["doc_id"], target_ids=good)
