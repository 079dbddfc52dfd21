"""Quality classifier from weak labels.

Overlapping heuristic labellers each vote good, bad or nothing on a text. What
they said is counted over all texts by vote pattern (at most 3 to the number of
labellers). Expectation-maximisation on that table estimates how each labeller
votes on good and on bad texts, and with it the probability that a pattern's
texts are good. No true label is used.

These posterior labels then train a linear scorer on hashed features of a
bounded sample of rows: byte trigrams by relative frequency, and a few measures
of the text cut into steps. The scorer, not the votes, decides on every text, so
it also judges texts on which the labellers abstain.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import table, trimmed

#: Votes.
NONE, BAD, GOOD = 0, 1, 2
DIM = 1 << 16
#: The scorer is fitted on this many rows at most, the first by a hash of their id; on the whole text of each.
TRAIN_ROWS = 4000
KEEP = 0.5
#: Added to a text's number of trigrams, so that a few of them cannot decide.
EVEN = 100
#: Bytes hashed at a time.
STRIP = 1 << 20
#: Characters that prose seldom holds.
SYMBOLS = np.isin(np.arange(256), np.frombuffer(rb"#$%&*|!~^=<>{}@\_+", np.uint8))
#: Frequent function words of the languages served.
FUNCTION_WORDS = frozenset(
    "the of and to a in is it that for be by or on with as are this "
    "der die das und zu ein ist für im dem den mit von nicht sich auch auf eine "
    "le la les de des et un une que est en dans pour qui sur par pas du au avec "
    "el los las y es por se lo al del con su para no una".split()
)


#: The same words as they stand in running text.
_IN_TEXT = frozenset(form + end for w in FUNCTION_WORDS for form in (w, w.capitalize(), w.upper()) for end in ("", ",", "."))


def measures(text: str) -> np.ndarray:
    """Of a text, shares of: symbols, capitals among ASCII letters, repeated word pairs, function words, bytes a word,
    clause ends a word, words that repeat the one before, words that occur once; and the number of words."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    words = text.split()
    n, m = max(1, len(data)), len(words)
    counts = np.bincount(data, minlength=256)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    after = words[1:]
    pairs = 1 - len(set(zip(words, after, strict=False))) / (m - 1) if m > 1 else 0.0
    again = sum(map(eq, words, after)) / (m - 1) if m > 1 else 0.0
    once = sum(map((1).__eq__, Counter(words).values())) / max(1, m)
    known = sum(map(_IN_TEXT.__contains__, words)) / max(1, m)
    ends = counts[[33, 44, 46, 58, 59, 63]].sum() / max(1, m)
    width = (n - counts[32] - counts[10]) / max(1, m)
    return np.array([counts[SYMBOLS].sum() / n, upper / max(1, upper + lower), pairs, known, width, ends, again, once, m])


def votes(x: np.ndarray) -> list[int]:
    """The labellers, in order. Each abstains where its measure says little, as all but one do on very short texts."""
    symbols, capitals, pairs, known, width, ends, again, once, m = x
    enough, long = m >= 8, m >= 20
    return [
        BAD if symbols > 0.03 else GOOD if symbols < 0.01 else NONE,
        (BAD if capitals > 0.6 else GOOD if capitals < 0.2 else NONE) if enough else NONE,
        (BAD if pairs > 0.45 else GOOD if pairs < 0.25 else NONE) if long else NONE,
        (BAD if known < 0.06 else GOOD if known > 0.12 else NONE) if long else NONE,
        (BAD if width > 7.2 else GOOD if 3.5 < width < 6.5 else NONE) if long else NONE,
        (BAD if ends < 0.03 or ends > 0.5 else GOOD if 0.08 < ends < 0.35 else NONE) if long else NONE,
        (BAD if again > 0.2 else GOOD if again < 0.05 else NONE) if long else NONE,
        (BAD if once < 0.04 else GOOD if once > 0.1 else NONE) if long else NONE,
    ]


LABELLERS = 8


@dataclass
class LabelModel:
    """good: share of good texts; p[labeller, class, vote], class 0 bad and 1 good. An abstention (p 1) says nothing."""

    good: float
    p: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes."""
        logs = np.log(self.p)
        rows = np.arange(self.p.shape[0])
        bad, good = (np.log(prior) + logs[rows[None, :], c, patterns].sum(1) for c, prior in ((0, 1 - self.good), (1, self.good)))
        return 1 / (1 + np.exp(np.clip(bad - good, -50, 50)))


def fit_labels(patterns: np.ndarray, n: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns and their counts, from the majority vote."""
    good, bad = (patterns == GOOD).sum(1), (patterns == BAD).sum(1)
    q = np.clip((good + 1) / (good + bad + 2), 0.05, 0.95)
    model = None
    for _ in range(rounds):
        weight = np.stack([n * (1 - q), n * q])
        p = np.ones((patterns.shape[1], 2, 3))
        for v in (BAD, GOOD):
            p[:, :, v] = ((patterns == v).T[:, None, :] * weight[None]).sum(2) + 1.0
        p[:, :, BAD:] /= p[:, :, BAD:].sum(2, keepdims=True)
        model = LabelModel(float(np.clip(weight[1].sum() / max(weight.sum(), 1), 0.01, 0.99)), p)
        new = model.posterior(patterns)
        if np.abs(new - q).max(initial=0) < 1e-9:
            break
        q = new
    return model


def trigrams(data: bytes) -> Iterator[np.ndarray]:
    """Places of a text's byte trigrams, STRIP of them at a time."""
    for at in range(0, max(1, len(data) - 2), STRIP):
        b = np.frombuffer(data[at : at + STRIP + 2], np.uint8).astype(np.uint32)
        yield ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(16) if len(b) > 2 else np.zeros(0, np.uint32)


def gram_counts(data: bytes) -> tuple[bytes, bytes]:
    """The places that a text's trigrams have (unsigned 16 bit) and how many have each (32 bit), packed: of any text at most DIM."""
    n = sum((np.bincount(g, minlength=DIM) for g in trigrams(data)), np.zeros(DIM, np.int64))
    place = np.flatnonzero(n)
    return zstandard.compress(place.astype(np.uint16).tobytes(), 1), zstandard.compress(n[place].astype(np.uint32).tobytes(), 1)


def stepped(x: np.ndarray) -> np.ndarray:
    """Places of a text's stepped measures."""
    steps = [int(s) for s in (x[0] * 100, x[1] * 10, x[2] * 10, x[3] * 40, x[4] * 2, x[5] * 20, x[6] * 20, x[7] * 50)]
    size = int(np.log2(x[8] + 1))
    return np.array([zlib.crc32(f"{i}:{min(s, 40)}:{min(size, 5)}".encode()) % DIM for i, s in enumerate(steps)], np.int64)


@dataclass
class Scorer:
    """grams and steps: weights by place; bias. A text's score is the sigmoid of their sum."""

    grams: np.ndarray
    steps: np.ndarray
    bias: float

    def score(self, text: str, x: np.ndarray) -> float:
        total, n = 0.0, 0
        for g in trigrams(text.encode("utf-8", "replace")):
            total, n = total + float(self.grams[g].sum()), n + len(g)
        z = self.bias + float(self.steps[stepped(x)].sum()) + total / (n + EVEN)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def fit_scorer(grams: list[tuple[bytes, bytes]], xs: list[np.ndarray], y: np.ndarray, rounds: int = 300, rate: float = 0.05, ridge: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels ``y`` by Adam; a gram (packed by ``gram_counts``) weighs 30 times its share, so both kinds learn alike."""
    places = [np.frombuffer(zstandard.decompress(p), np.uint16) for p, _ in grams]
    counts = [np.frombuffer(zstandard.decompress(c), np.uint32) for _, c in grams]
    row = np.repeat(np.arange(len(grams), dtype=np.int32), [len(p) for p in places]) if grams else np.zeros(0, np.int32)
    gram = np.concatenate([*places, np.zeros(0, np.uint16)]).astype(np.int32)
    weight = np.concatenate([*(30.0 * c / (c.sum(dtype=np.int64) + EVEN) for c in counts), np.zeros(0)])
    step = np.stack([stepped(x) for x in xs]) if xs else np.zeros((0, LABELLERS), np.int64)
    n = len(grams)
    params = [np.zeros(DIM), np.zeros(DIM), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, rounds + 1 if n else 1):
        z = params[2][0] + params[1][step].sum(1) + np.bincount(row, weight * params[0][gram], n)
        d = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / n
        grads = [
            np.bincount(gram, weight * d[row], DIM) + ridge * params[0],
            np.bincount(step.ravel(), np.repeat(d, step.shape[1]), DIM) + ridge * params[1],
            np.array([d.sum()]),
        ]
        for p, g, m, s in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return Scorer(params[0] * 30.0, params[1], float(params[2][0]))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> tuple[LabelModel, Scorer]:
    """The label model from all texts, the scorer from at most ``rows`` of them.

    Null texts count as empty. Of an empty table both models are flat: every
    text then scores one half.
    """
    named = docs.select(docs[f"`{id_col}`"].cast("string").alias("id"), F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("t"))
    order = named.select("id", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(rows).agg(F.max("h")).first()[0]
    limit = order if order is not None else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each pattern seen (n), and for each text of the sample one with its trigrams (n 0)."""
        seen: dict[int, int] = {}
        for batch in batches:
            out = []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = measures(text)
                code = sum(v * 3**i for i, v in enumerate(votes(x)))
                seen[code] = seen.get(code, 0) + 1
                if h <= limit:
                    out.append((code, 0, h, *gram_counts(text.encode("utf-8", "replace")), x.tolist()))
            yield pa.record_batch([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)
        none = len(seen)
        yield pa.record_batch([pa.array(list(seen), types[0]), pa.array(list(seen.values()), types[1]), *(pa.nulls(none, t) for t in types[2:])], names=names)

    names, types = ["code", "n", "h", "places", "counts", "x"], [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.float64())]
    found = named.select(F.xxhash64("id").alias("h"), "t").mapInArrow(trimmed(run), "code int, n long, h long, places binary, counts binary, x array<double>")
    # One pass: patterns are summed under no hash, samples stay rows of their own.
    tallied = found.groupBy("code", "h").agg(F.sum("n").alias("n"), F.min(F.struct("places", "counts", "x")).alias("sample")).orderBy(F.col("h").asc_nulls_first(), "code").limit(3**LABELLERS + rows).collect()
    decode = lambda codes: np.array([[c // 3**i % 3 for i in range(LABELLERS)] for c in codes], np.int64).reshape(-1, LABELLERS)
    patterns = [r for r in tallied if r["h"] is None]
    samples = [r for r in tallied if r["h"] is not None]
    labels = fit_labels(decode([r["code"] for r in patterns]), np.array([r["n"] for r in patterns], float))
    y = labels.posterior(decode([r["code"] for r in samples])) if samples else np.zeros(0)
    return labels, fit_scorer([(bytes(r["sample"]["places"]), bytes(r["sample"]["counts"])) for r in samples], [np.array(r["sample"]["x"]) for r in samples], y)


def classify(docs: DataFrame, models: tuple[LabelModel, Scorer], text_col: str = "text", keep: list[str] | None = None, threshold: float = KEEP) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default), quality_score, quality_label (the votes' posterior) and quality_keep.

    The three replace columns of their names. Null and empty texts are judged by
    the scorer like any other. Texts of any length are read whole; rows that
    repeat are kept.
    """
    labels, scorer = models
    added = ("quality_score", "quality_label", "quality_keep")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    apart = text_col not in keep
    rows = docs.select(*[docs[f"`{c}`"] for c in keep], *[docs[f"`{text_col}`"]] * apart)
    at = len(keep) if apart else keep.index(text_col)
    out = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields[: len(keep)]]).add(added[0], "double").add(added[1], "double").add(added[2], "boolean")
    shared = docs.sparkSession.sparkContext.broadcast((labels, scorer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, scorer = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            xs = [measures(t) for t in texts]
            posterior = labels.posterior(np.array([votes(x) for x in xs], np.int64).reshape(-1, LABELLERS))
            scores = [scorer.score(t, x) for t, x in zip(texts, xs, strict=True)]
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(scores, pa.float64()), pa.array(posterior, pa.float64()), pa.array([s >= threshold for s in scores], pa.bool_())], names=out.names)

    return rows.mapInArrow(trimmed(run), out)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, fit(docs), keep=["doc_id"])
