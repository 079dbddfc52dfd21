"""Numbering rows in a total order without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dedup import stored


def numbered(df: DataFrame, by: list[str], name: str = "scan_ord") -> DataFrame:
    """``df`` with 1, 2, ... in the order of the columns ``by``.

    Rows are dealt by range, numbered in their own part, and shifted by what the
    parts before hold. Parts are told apart by a stored number, so that all steps
    see the same ones. Rows that are equal in ``by`` stand in any order.
    """
    parts = stored(df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    shifts = parts.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*by))
    return parts.withColumn("_own", own).join(shifts, "_part").withColumn(name, (F.col("_own") + F.col("_shift")).cast("long")).drop("_part", "_own", "_shift")
