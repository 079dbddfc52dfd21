"""Exact top-k search by inner product with a three-phase uniform threshold.

The components of all vectors are cut into ``lists`` slices. For a query, each
slice is one score list: the partial inner product of every candidate. A list is
spread over shards, and queries come in blocks, so a task scores one slice of
one block against one shard.

1. Every list hands in its k best entries. The totals of these candidates, looked
   up exactly, give a lower bound of the k-th best total. (Partial sums would do,
   but they count missing lists as lowest and make a cutoff that hardly cuts.)
   Divided by the number of lists it is the cutoff: a candidate below it in every
   list cannot reach the bound.
2. The cutoff goes out with the queries, and every list hands in all entries at
   or above it. Their sums give a better bound; a candidate whose sum plus the
   cutoff for each missing list stays below it is dropped.
3. For the few that are left, lists that did not hand them in are looked up, and
   the totals are ranked.

The bounds ask for scores of at least zero, so each list counts from its own
lowest score of that query. Candidates that tie with a bound stay in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, matrix_of, table
from .vectors import clean_vectors, numbered, paired, rows_of

QUERY_BLOCK = 1024
SHARD = 16384
LISTS = 2
#: Queries scored at a time inside a task.
STRIP = 128

_FOUND = pa.schema([("query", pa.int64()), ("list", pa.int32()), ("item", pa.int64()), ("vec_id", pa.int64()), ("part", pa.int64()), ("low", pa.int64())])
_FOUND_SQL = "query long, list int, item long, vec_id long, part long, low long"


def _scores(q: np.ndarray, x: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact integer products: through doubles where every sum fits, else in 64-bit integers; large vectors in whole numbers without bounds.

    Raises OverflowError if a product does not fit a long, but for those of ``own``, which are no candidates.
    """
    width = max(1, q.shape[1])
    most_q, most_x = np.abs(q).max(axis=1, initial=0).astype(np.float64), np.abs(x).max(axis=1, initial=0).astype(np.float64)
    if most_q.max(initial=0) * most_x.max(initial=0) * width < 2**53:
        return np.rint(q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    out = q @ x.T
    large = (2.0**61 / width) ** 0.5
    for rows, cols in ((most_q > large, np.ones(len(x), bool)), (most_q <= large, most_x > large)):
        if rows.any() and cols.any():
            exact = q[rows].astype(object) @ x[cols].astype(object).T
            exact[own[rows][:, cols]] = 0
            if max(abs(exact.max()), abs(exact.min())) >= 2**62:
                raise OverflowError("a score does not fit a long")
            out[np.ix_(rows, cols)] = exact.astype(np.int64)
    return out


def _strips(queries: pa.Table, items: pa.Table, width: int):
    """Per strip of queries: their rows, keys, the items' keys and ids, the scores, and which (query, item) pairs are one and the same."""
    x, of_x = matrix_of(items["c"], width, np.int64), [items[c].to_numpy() for c in ("key", "id", "own")]
    q, key, own = matrix_of(queries["c"], width, np.int64), queries["key"].to_numpy(), queries["own"].to_numpy()
    for at in range(0, len(key), STRIP):
        rows = slice(at, at + STRIP)
        same = own[rows, None] == of_x[2][None, :]
        yield rows, key[rows], of_x[0], of_x[1], _scores(q[rows], x, same), same


def _local_best(k: int, width: int):
    """Phase 1: of each query the k best entries of this shard of the list, and the shard's lowest score."""

    def run(queries: pa.Table, items: pa.Table) -> pa.Table:
        out = []
        if len(queries) and len(items):
            which = queries["list"][0].as_py()
            for _, query, item, xid, s, own in _strips(queries, items, width):
                low = s.min(axis=1)
                s[own] = np.iinfo(np.int64).min
                take = min(k, s.shape[1])
                cols = np.argpartition(s, -take, axis=1)[:, -take:] if take < s.shape[1] else np.broadcast_to(np.arange(s.shape[1]), s.shape)
                r, c = np.repeat(np.arange(len(query)), take), cols.ravel()
                fine = ~own[r, c]
                r, c = r[fine], c[fine]
                out.append(rows_of(_FOUND, query=query[r], list=np.full(len(r), which), item=item[c], vec_id=xid[c], part=s[r, c], low=low[r]))
        return pa.concat_tables(out) if out else _FOUND.empty_table()

    return run


def _above(width: int):
    """Phase 2: all entries of this shard of the list at or above the query's cutoff."""

    def run(queries: pa.Table, items: pa.Table) -> pa.Table:
        out = []
        if len(queries) and len(items):
            which, bar, low = queries["list"][0].as_py(), queries["bar"].to_numpy(), queries["low"].to_numpy()
            for rows, query, item, xid, s, own in _strips(queries, items, width):
                r, c = np.nonzero((s >= bar[rows][:, None]) & ~own)
                out.append(rows_of(_FOUND, query=query[r], list=np.full(len(r), which), item=item[c], vec_id=xid[c], part=s[r, c], low=low[rows][r]))
        return pa.concat_tables(out) if out else _FOUND.empty_table()

    return run


def _kth(value: str, k: int) -> Column:
    """Per query, the k-th largest of ``value`` among rows already cut to the k largest."""
    return F.when(F.count("*") >= k, F.min(value)).otherwise(F.lit(None).cast("long"))


def top_k(queries: DataFrame, items: DataFrame, k: int, lists: int = LISTS, block: int = QUERY_BLOCK, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k items of largest inner product.

    Both inputs have id (long) and c (array of longs). If both have a column row,
    they are rows of one table, and every row but the query's own is a candidate;
    otherwise every item but those of the query's id. Ties go to the smaller id.
    A query with fewer than k candidates gets all of them, and one without
    candidates has no rows. Rows that repeat are candidates and queries of their
    own. Shorter vectors count as padded with zeros. Empty inputs give an empty
    result. Components may have any size; a score beyond a long raises.
    """
    queries, items = (materialize(df.select("key", "id", "own", "c"), name) for df, name in zip(numbered(queries, items), ("queries", "items"), strict=True))
    n_queries = queries.count()
    counted = items.agg(F.count("*").alias("n"), F.max(F.size("c")).alias("w")).first()
    wide = max(counted["w"] or 1, queries.agg(F.max(F.size("c"))).first()[0] or 1)
    lists = max(1, min(lists, wide))
    width = -(-wide // lists)

    def sliced(df: DataFrame) -> DataFrame:
        parts = F.transform(F.sequence(F.lit(0), F.lit(lists - 1)), lambda g: F.struct(g.alias("list"), F.slice("c", g * width + 1, F.lit(width)).alias("c")))
        return df.select("key", "id", "own", F.explode(parts).alias("p")).select("key", "id", "own", "p.list", "p.c")

    def meet(q: DataFrame, run) -> DataFrame:
        a, b = paired(q, sliced(items), n_queries, counted["n"], block, shard)
        key = ["list", "block", "shard"]
        return a.groupBy(*key).cogroup(b.groupBy(*key)).applyInArrow(run, _FOUND_SQL)

    def exact(pairs: DataFrame) -> DataFrame:
        """query, item, vec_id and their whole score, looked up from the vectors."""
        looked = pairs.join(queries.select(F.col("key").alias("query"), F.col("c").alias("a")), "query").join(items.select(F.col("key").alias("item"), F.col("c").alias("b")), "item")
        product = F.aggregate(F.zip_with("a", "b", lambda x, y: F.coalesce(x * y, F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda s, x: s + x)
        return looked.select("query", "item", "vec_id", product.alias("sum"))

    best = Window.partitionBy("query").orderBy(F.desc("sum"), "vec_id", "item")
    # Phase 1
    handed = materialize(meet(sliced(queries), _local_best(k, width)), "heads")
    lows = handed.groupBy("query", "list").agg(F.min("low").alias("low"))
    in_list = Window.partitionBy("query", "list").orderBy(F.desc("part"), "item")
    heads = handed.withColumn("r", F.row_number().over(in_list)).where(F.col("r") <= k).select("query", "item", "vec_id").distinct()
    bounds = exact(heads).withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).groupBy("query").agg(_kth("sum", k).alias("bound"))
    bounds = bounds.join(lows.groupBy("query").agg(F.sum("low").alias("lows")), "query").select("query", (F.col("bound") - F.col("lows")).alias("bound"))
    # With fewer than k candidates there is no bound, and everything is handed in.
    cut = bounds.select("query", F.floor(F.coalesce(F.col("bound"), F.lit(0)) / lists).cast("long").alias("cut"))
    cutoffs = materialize(lows.join(cut, "query").select(F.col("query").alias("key"), "list", "low", "cut", (F.col("cut") + F.col("low")).alias("bar")), "cutoffs")
    # Phase 2
    found = meet(sliced(queries).join(cutoffs, ["key", "list"]), _above(width))
    cutoff = cutoffs.groupBy(F.col("key").alias("query")).agg(F.max("cut").alias("cut"), F.sum("low").alias("lows"))
    sums = materialize(found.groupBy("query", "item", "vec_id").agg(F.sum(F.col("part") - F.col("low")).alias("sum"), F.count("*").alias("seen")), "entries")
    ranked = sums.withColumn("r", F.row_number().over(best))
    second = ranked.where(F.col("r") <= k).groupBy("query").agg(_kth("sum", k).alias("bound"))
    left = sums.join(second, "query").join(cutoff, "query").where(F.col("sum") + (lists - F.col("seen")) * F.col("cut") >= F.coalesce(F.col("bound"), F.lit(0)))
    # Phase 3
    known = left.where(F.col("seen") == lists).select("query", "item", "vec_id", (F.col("sum") + F.col("lows")).alias("sum"))
    missing = left.where(F.col("seen") < lists).select("query", "item", "vec_id")
    totals = known.unionByName(exact(missing)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return totals.join(queries.select(F.col("key").alias("query"), F.col("id").alias("query_id")), "query").select("query_id", "rank", "vec_id", F.col("sum").alias("score"))


def quantized(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """id, row (the place in ``df``) and c: floor(scale * x) of each component, for the vectors that take part.

    A component beyond a long raises, as no score with it could fit one.
    """
    fits = lambda x: F.when(F.abs(x) * float(scale) < 2.0**62, F.floor(x * F.lit(float(scale)))).otherwise(F.raise_error(F.lit("a component does not fit a long")).cast("long"))
    return clean_vectors(df, id_col, vector_col).select("id", F.monotonically_increasing_id().alias("row"), F.transform("v", fits).alias("c"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = materialize(quantized(table(spark, sf_dir, "embeddings")), "quantized")
    return top_k(items.where(F.col("id") % 50 == 0), items, 5)


SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS place, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.place AS query, x.vec_id, x.place, list_inner_product(q.c, x.c)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.place <> x.place),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id, place)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
