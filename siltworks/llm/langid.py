"""Language identification with a convolutional network over bytes, trained in numpy.

Bytes are embedded, filters of widths 2, 3 and 4 run over a window of fixed
length, the maximum of each filter over the window is taken, and a softmax over
the languages follows. A text is cut into windows from its first byte to its
last; their log-probabilities, weighted by the bytes they hold, make the text's.

For use, embedding and filters are multiplied out into tables over pairs of
bytes, so a position costs three table rows and no matrix product.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import table, trimmed

WINDOW = 256
WIDTHS = (2, 3, 4)
PAD = max(WIDTHS) - 1
FILTERS, EMBED = 16, 8
#: The network is fitted on this many labelled rows at most, and this many windows of each.
TRAIN_ROWS, TRAIN_WINDOWS = 3000, 4
STEPS, BATCH, RATE = 700, 64, 0.004
#: Windows convolved at a time.
CHUNK = 32
UNKNOWN = "und"


@dataclass
class Net:
    """languages; e (256, EMBED); w per width (width, EMBED, FILTERS); b (filters); v, c of the last layer."""

    languages: list[str]
    e: np.ndarray
    w: list[np.ndarray]
    b: np.ndarray
    v: np.ndarray
    c: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows to add up at a position: by its first two bytes, by its third byte, by its third and fourth."""
        t = [[self.e @ w[k] for k in range(len(w))] for w in self.w]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        first = np.hstack([pair(x[0], x[1]) for x in t]).astype(np.float32)
        return np.ascontiguousarray(first), np.ascontiguousarray(t[1][2], np.float32), np.ascontiguousarray(pair(t[2][2], t[2][3]), np.float32)

    def digest(self) -> str:
        return hashlib.sha256(b"".join(np.ascontiguousarray(x).tobytes() for x in (self.e, *self.w, self.b, self.v, self.c))).hexdigest()


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def train(windows: list[bytes], langs: list[str], steps: int = STEPS, seed: int = 0) -> Net:
    """Fit by Adam. Each window holds up to WINDOW bytes; the rest is zero bytes, as at the end of a text."""
    languages = sorted(set(langs))
    rng = np.random.default_rng(seed)
    x = np.zeros((len(windows), WINDOW + PAD), np.uint8)
    for i, b in enumerate(windows):
        b = b[: WINDOW + PAD]
        x[i, : len(b)] = np.frombuffer(b, np.uint8)
    lengths = np.array([min(len(b), WINDOW) for b in windows])
    y = np.searchsorted(np.array(languages), np.array(langs))
    net = Net(languages, rng.normal(0, 0.5, (256, EMBED)), [rng.normal(0, (1 / (k * EMBED)) ** 0.5, (k, EMBED, FILTERS)) for k in WIDTHS], np.zeros(FILTERS * len(WIDTHS)), rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))), np.zeros(len(languages)))
    params = [net.e, *net.w, net.b, net.v, net.c]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    at = np.arange(BATCH)
    weights = 1 / np.bincount(y, minlength=len(languages))[y]  # every language is drawn as often
    for step in range(1, steps + 1 if len(languages) > 1 else 1):
        pick = rng.choice(len(x), BATCH, p=weights / weights.sum())
        bytes_, emb = x[pick], net.e[x[pick]]
        inside = np.arange(WINDOW)[None, :] < lengths[pick][:, None]
        best, top = [], []
        for w in net.w:
            k = len(w)
            cols = np.concatenate([emb[:, j : j + WINDOW] for j in range(k)], axis=2)
            r = cols.reshape(-1, k * EMBED) @ w.reshape(k * EMBED, FILTERS)
            r = np.where(inside[:, :, None], r.reshape(BATCH, WINDOW, FILTERS), -np.inf)
            best.append(r.argmax(1))
            top.append(r.max(1))
        pre = np.hstack(top) + net.b
        h = np.maximum(pre, 0)
        p = _softmax(h @ net.v + net.c)
        p[at, y[pick]] -= 1
        p /= BATCH
        grads = [np.zeros_like(q) for q in params]
        grads[-1], grads[-2] = p.sum(0), h.T @ p
        dh = (p @ net.v.T) * (pre > 0)
        grads[-3] = dh.sum(0)
        for i, w in enumerate(net.w):
            d = dh[:, i * FILTERS : (i + 1) * FILTERS]
            for k in range(len(w)):
                where = best[i] + k
                e = emb[at[:, None], where]  # the embeddings that won: batch, filter, EMBED
                grads[1 + i][k] = np.einsum("bfe,bf->ef", e, d)
                np.add.at(grads[0], bytes_[at[:, None], where], d[:, :, None] * w[k].T[None])
        for q, g, m, s in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            q -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


_tables: dict[str, tuple] = {}


def classify(net: Net, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and its probability for every text; UNKNOWN and 0 without letters."""
    if not net.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    key = net.digest()
    if key not in _tables:
        _tables.clear()
        _tables[key] = net.tables()
    by_two, by_third, by_last = _tables[key]
    datas = [t.encode("utf-8", "replace") if t and any(map(str.isalpha, t)) else b"" for t in texts]
    sums = np.zeros((len(texts), len(net.languages)))
    pending: list[tuple[int, bytes, int]] = []

    def flush() -> None:
        if not pending:
            return
        buf = np.frombuffer(b"".join(d + b"\0" * (PAD + 1) for _, d, _ in pending), np.uint8)
        sizes = np.array([n for _, _, n in pending])
        spans = np.array([len(d) for _, d, _ in pending]) + PAD + 1
        starts = np.cumsum(spans) - spans
        two = (buf[:-1].astype(np.int32) << 8) | buf[1:]
        n = len(buf) - PAD
        r = by_two[two[:n]]
        f = FILTERS
        r[:, f : 2 * f] += by_third[buf[2 : n + 2]]
        r[:, 2 * f :] += by_last[two[2 : n + 2]]
        edges = np.stack([starts, starts + sizes], 1).ravel()
        top = np.maximum.reduceat(r, edges, axis=0)[::2]
        logits = np.maximum(top + net.b, 0) @ net.v + net.c
        logits -= logits.max(1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(1, keepdims=True))
        np.add.at(sums, [i for i, _, _ in pending], logits * sizes[:, None])
        pending.clear()

    for i, data in enumerate(datas):
        for at in range(0, len(data), WINDOW):
            piece = data[at : at + WINDOW + PAD]
            pending.append((i, piece, min(WINDOW, len(data) - at)))
            if len(pending) >= CHUNK:
                flush()
    flush()
    sizes = np.array([len(d) for d in datas])
    p = _softmax(sums / np.maximum(sizes, 1)[:, None])
    which = p.argmax(1)
    return [net.languages[k] if n else UNKNOWN for k, n in zip(which, sizes, strict=True)], [float(p[i, k]) if n else 0.0 for i, (k, n) in enumerate(zip(which, sizes, strict=True))]


def is_held_out(id_: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS) -> Net:
    """A network from at most ``rows`` labelled rows, held-out rows aside.

    Languages take turns, each with its first rows by a hash of their id, so a
    rare one is learned too. Without labelled texts the network knows no language.
    """
    named = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].cast("string").alias("t"), docs[f"`{lang_col}`"].cast("string").alias("lang"))
    usable = named.where(F.col("lang").isNotNull() & F.col("t").rlike(r"\p{L}") & ~is_held_out(F.col("id")))
    # Twice a language's share passes by hash where it stands, so only so many rows meet in one place. At most ``rows`` languages are looked at.
    counts = named.where(F.col("lang").isNotNull() & ~is_held_out(F.col("id"))).groupBy("lang").agg(F.count("*").alias("m")).orderBy(F.desc("m"), "lang").limit(rows)
    share = 2.0 * -(-rows // max(1, counts.count()))
    passed = usable.select("id", "lang", F.xxhash64("id").alias("h")).join(F.broadcast(counts), "lang").where(F.pmod("h", F.lit(1 << 30)) <= F.lit(share * (1 << 30)) / F.col("m"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    chosen = passed.withColumn("turn", turn).orderBy("turn", "h", "id").limit(rows).select("id").distinct()
    start = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.greatest(F.lit(1), F.length("t") - WINDOW)).cast("int") + 1
    cut = F.array(*[F.substr("t", start(k), F.lit(WINDOW)) for k in range(TRAIN_WINDOWS)])
    found = usable.join(F.broadcast(chosen), "id", "left_semi").select("lang", "id", F.array_distinct(cut).alias("w")).orderBy("id", "lang", "w").limit(rows).collect()
    pairs = [(w.encode("utf-8", "replace"), r["lang"]) for r in found for w in r["w"]]
    return train([w for w, _ in pairs], [lang for _, lang in pairs])


def predict(docs: DataFrame, net: Net, text_col: str = "text", keep: list[str] | None = None, lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and two more, which replace columns of the same names.

    Null texts, empty texts and texts without a letter get UNKNOWN and 0, as do
    all texts if the network knows no language. Texts
    of any length are read whole. Rows that repeat are kept.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (lang_name, score_name)]
    apart = text_col not in keep
    rows = docs.select(*[docs[f"`{c}`"] for c in keep], *[docs[f"`{text_col}`"]] * apart)
    at = len(keep) if apart else keep.index(text_col)
    out = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields[: len(keep)]]).add(lang_name, "string").add(score_name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = classify(net, batch.column(at).to_pylist())
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=out.names)
        _tables.clear()  # the worker may idle through other stages

    return rows.mapInArrow(trimmed(run), out)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs), keep=["doc_id"])
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
