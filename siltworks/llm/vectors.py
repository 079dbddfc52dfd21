"""What the two vector searches share: clean vectors, and tasks of a query block and a shard."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread


def usable(vector: Column) -> Column:
    """Neither null nor holding null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def clean_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (array of double) of the rows that take part; a null id takes no part either."""
    v = df[f"`{vector_col}`"].cast("array<double>")
    return df.select(df[f"`{id_col}`"].cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")) & (F.size("v") > 0))


def numbered(queries: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with columns key (one for each row), own (of query and item alike: they are one and the same) and id; the rest stays.

    If both have a column row, they are rows of one table: a query's own row alone
    is no candidate. Otherwise no item that has the query's id is one.
    """
    own = "row" if {"row"} <= set(queries.columns) & set(items.columns) else "id"
    return tuple(df.withColumns({"own": F.col(own).cast("long"), "key": F.monotonically_increasing_id()}) for df in (queries, items))


def dealt(side: DataFrame, own: str, buckets: int, other: str, copies: int) -> DataFrame:
    """Give each row its bucket in ``own``, and a copy for every bucket of the other side."""
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")
    return side.withColumn(own, bucket).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def paired(queries: DataFrame, items: DataFrame, n_queries: int, n_items: int, block: int, shard: int):
    """Both sides dealt so that every block of queries meets every shard of items in one task.

    Neither side is broadcast: a task holds about ``block`` queries and ``shard``
    items, however many there are of either.
    """
    blocks, shards = spread(n_queries, block), spread(n_items, shard)
    return dealt(queries, "block", blocks, "shard", shards), dealt(items, "shard", shards, "block", blocks)


def rows_of(schema: pa.Schema, **columns) -> pa.Table:
    return pa.table([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
