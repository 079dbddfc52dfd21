"""Exact top-k and vantage-point trees against brute force."""

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from siltworks.llm import topk, vptree
from siltworks.llm.common import materialize
from siltworks.llm.vectors import clean_vectors

VECTORS = "vec_id long, embedding array<double>, id string, c string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], VECTORS)


def plain(rows, queries, k, score, by_id=True):
    """Candidates: all rows but those of the query's id, or only but the query's own row."""
    out = []
    for at, (q, a) in enumerate(rows):
        if q in queries:
            order = sorted((-score(a, b), i) for n, (i, b) in enumerate(rows) if (i != q if by_id else n != at))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(order)]
    return sorted(out)


def grid(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=False))


def dot(a, b):
    return float(sum(x * y for x, y in zip(a, b, strict=False)))


@pytest.mark.parametrize(("lists", "block", "shard"), [(1, 7, 9), (2, 1000, 1000), (3, 4, 30), (8, 5, 50)])
def test_topk_exact(spark, lists, block, shard):
    rng = np.random.default_rng(lists)
    rows = [(i, np.round(rng.normal(size=6), 2).tolist()) for i in range(70)] + [(70 + i, [0.5] * 6) for i in range(8)]
    items = topk.quantized(vectors(spark, rows))
    got = topk.top_k(items.where("id % 6 = 0"), items, 5, lists, block, shard).collect()
    assert sorted(map(tuple, got)) == plain(rows, {i for i, _ in rows if i % 6 == 0}, 5, grid)


REPEATED = [(0, [1.0, 2.0]), (6, [-1.0, 0.5]), (6, [-1.0, 0.5]), (6, [3.0, 0.25]), (7, [2.0]), (8, [2.0, 0.0])]


def test_topk_edges(spark):
    rows = [*REPEATED, (1, [float("nan"), 1.0]), (2, None), (3, [None, 1.0]), (4, [float("inf"), 0.0]), (5, []), (None, [1.0, 1.0])]
    items = materialize(topk.quantized(vectors(spark, rows)), "items")
    for some, by_id in ((items, False), (items.drop("row"), True)):
        got = sorted(map(tuple, topk.top_k(some.where("id in (0, 6)"), some, 3).collect()))
        assert got == plain(REPEATED, {0, 6}, 3, grid, by_id)
    assert topk.top_k(items.limit(0), items, 5).count() == 0
    assert topk.top_k(items, items.limit(0), 5).count() == 0
    alone = items.where("id = 0")
    assert topk.top_k(alone, alone, 5).count() == 0


def test_topk_large_values(spark):
    rows = [(i, [2.3e5 - i, -2.2e5 - i, 2.1e5]) for i in range(6)]  # products beyond what doubles hold exactly
    rows += [(6, [3e5, 1.0, 0.0]), (7, [0.0, 0.0, 1e8]), (8, [0.0, 1e15, 0.0]), (9, [1.0, 0.0, -4e5])]
    items = topk.quantized(vectors(spark, rows))
    for lists in (1, 2):
        got = sorted(map(tuple, topk.top_k(items.where("id in (0, 6, 7, 9)"), items.where("id <> 8"), 3, lists).collect()))
        assert got == plain([r for r in rows if r[0] != 8], {0, 6, 7, 9}, 3, grid)
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(items, items, 3).collect()


def test_topk_equals_its_sql(spark, tmp_path):
    import duckdb

    vectors(spark, [(50 * i, v) for i, v in REPEATED] + [(None, [1.0, 1.0]), (50, [0.0, 3e5])]).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    short = topk.SQL.replace("list_inner_product(q.c, x.c)", "list_inner_product(list_resize(q.c, 2, 0.0), list_resize(x.c, 2, 0.0))")  # DuckDB doesn't pad
    assert sorted(map(tuple, topk.op3_topk(spark, str(tmp_path)).collect())) == sorted(con.execute(short).fetchall())


@pytest.mark.parametrize(("block", "shard", "leaf"), [(1000, 1000, 4), (5, 25, 3)])
def test_tree_exact_with_factor_one(spark, block, shard, leaf):
    rng = np.random.default_rng(leaf)
    rows = [(i, (rng.normal(size=5) * rng.uniform(0.2, 3)).tolist()) for i in range(120)] + [(120 + i, [0.5] * 5) for i in range(40)]
    items = clean_vectors(vectors(spark, rows), "vec_id", "embedding")
    got = vptree.nearest(items.where("id % 10 = 0"), items, 7, 1.0, block, shard, leaf).collect()
    want = plain(rows, {i for i, _ in rows if i % 10 == 0}, 7, dot)
    assert [r[:3] for r in sorted(map(tuple, got))] == [w[:3] for w in want]
    assert np.allclose([r[3] for r in sorted(map(tuple, got))], [w[3] for w in want], atol=1e-12)


@pytest.mark.parametrize("large", [1.0, 1e8, 1e12])
def test_tree_exact_beside_a_large_vector(spark, large):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * (large if i == 17 else 1)).tolist()) for i in range(300)]
    items = clean_vectors(vectors(spark, rows), "vec_id", "embedding")
    got = vptree.nearest(items.where("id % 10 in (0, 7)"), items, 5, 1.0, leaf=8).collect()
    assert [r[:3] for r in sorted(map(tuple, got))] == [w[:3] for w in plain(rows, {i for i, _ in rows if i % 10 in (0, 7)}, 5, dot)]


def test_tree_recall_on_vectors_without_clusters(spark):
    """The factor that clustered vectors get by with finds about half here; a larger one finds more, and one finds all."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(2000)]
    items = clean_vectors(vectors(spark, rows), "vec_id", "embedding")
    queries = {i for i, _ in rows if i % 100 == 0}
    want = {(q, i) for q, _, i, _ in plain(rows, queries, 20, dot)}
    recall = [len(want & {(r[0], r[2]) for r in vptree.nearest(items.where("id % 100 = 0"), items, 20, factor, leaf=32).collect()}) / len(want) for factor in (0.2, 0.5, 1.0)]
    assert recall[0] < recall[1] < recall[2] == 1.0


def test_tree_recall(spark):
    from conftest import DATA

    got = vptree.op4_vptree(spark, DATA).toPandas()
    t = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas()
    rows = [(int(i), np.asarray(v, float)) for i, v in zip(t["vec_id"], t["embedding"], strict=True)]
    want = plain(rows, {i for i, _ in rows if i % 20 == 0}, 20, lambda a, b: float(a @ b))
    found = set(zip(got["query_id"], got["vec_id"], strict=True))
    assert np.mean([(q, i) in found for q, _, i, _ in want]) >= 0.9


def test_tree_edges(spark):
    rows = [*REPEATED, (1, [0.0, 0.0]), (2, [float("nan"), 1.0]), (3, None), (None, [1.0, 1.0])]
    items = clean_vectors(vectors(spark, rows), "vec_id", "embedding").where("exists(v, x -> x != 0)")
    placed = materialize(items.withColumn("row", F.monotonically_increasing_id()), "placed")
    assert sorted(map(tuple, vptree.nearest(items, items, 20).collect())) == plain(REPEATED, {0, 6, 7, 8}, 20, dot)
    assert sorted(map(tuple, vptree.nearest(placed, placed, 20).collect())) == plain(REPEATED, {0, 6, 7, 8}, 20, dot, by_id=False)
    assert vptree.nearest(items.limit(0), items.limit(0)).count() == 0
    with pytest.raises(ValueError):
        vptree.nearest(items, items, factor=2)
