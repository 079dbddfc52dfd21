"""Header-named tables of tab-separated text: no quoting, all cells strings, any further columns kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltworks.functions import fixed, text


class TableError(ValueError):
    """A table cannot be read."""


def read_lines(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """line_no and line of a text file. Strict: invalid UTF-8 raises, with a hint."""
    whole = spark.read.format("binaryFile").load(path)
    if strict and not whole.where(~F.is_valid_utf8(F.col("content").cast("string"))).isEmpty():
        raise TableError(f"{path} is not valid UTF-8; write it again from the scan")
    content = F.make_valid_utf8(F.col("content").cast("string"))
    return whole.select(F.posexplode(F.split(content, r"\r\n|\n|\r")).alias("line_no", "line"))


def read_table(spark: SparkSession, path: str, required: Sequence[str] = ("agent", "session_file")) -> DataFrame:
    """The rows of a table with scan_ord; short rows get nulls, blank lines are skipped."""
    lines = read_lines(spark, path)
    head = lines.where("line_no = 0").first()
    if head is None or not head["line"]:
        raise TableError(f"{path} is empty")
    header = head["line"].split("\t")
    if missing := [c for c in required if c not in header]:
        raise TableError(f"{path} lacks the columns {', '.join(missing)}")
    body = lines.where((F.col("line_no") > 0) & ~text.is_blank(F.col("line"))).withColumn("cells", F.split("line", "\t"))
    return body.select(*[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(header)], F.col("line_no").cast("long").alias("scan_ord"))


def as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One column ``value``: the cells as text, nulls empty, tabs and line ends as spaces."""
    return df.select(F.concat_ws("\t", *[F.coalesce(text.one_line(F.col(c).cast("string")), F.lit("")) for c in columns]).alias("value"))


def write_table(df: DataFrame, path: str, columns: Sequence[str], order: str | None = "scan_ord", header: bool = True) -> None:
    """A folder with one text file, header first (unless ``header`` is false), rows in order."""
    spark = df.sparkSession
    rows = as_text(df, columns) if order is None else as_text(df.orderBy(order), columns)
    numbered = rows.select(F.monotonically_increasing_id().alias("i"), "value")
    head = spark.createDataFrame([(-1, "\t".join(columns))] if header else [], "i long, value string")
    head.union(numbered).repartitionByRange(1, "i").sortWithinPartitions("i").select("value").write.mode("overwrite").text(path)


def screen(candidates: DataFrame) -> DataFrame:
    """Candidates with empty columns for a reviewer's suggestion and reason."""
    return candidates.withColumn("suggested", F.lit("")).withColumn("reason", F.lit(""))


def shape(lines: DataFrame) -> DataFrame:
    """width (of the header), rows, malformed: rows of another width."""
    widths = lines.where("line <> ''").select("line_no", F.size(F.split("line", "\t")).alias("w"))
    header = F.max(F.when(F.col("line_no") == 0, F.col("w")))
    per_width = widths.where("line_no > 0").groupBy("w").agg(F.count("*").alias("n"))
    width = widths.agg(header.alias("width")).first()["width"]
    return per_width.agg(F.lit(width).cast("long").alias("width"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("w") != F.lit(width), F.col("n"))), F.lit(0)).alias("malformed"))


def tally(rows: DataFrame, column: str = "decision") -> DataFrame:
    """Rows by decision, blanks and nulls as one bucket."""
    return rows.groupBy(F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("(blank)")).alias(column)).agg(F.count("*").alias("n"))


def well_formed(lines: DataFrame, columns: Sequence[str] = fixed.DECISION_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Decision rows of the right width, carriage returns off; and those of another."""
    cells = lines.where("line_no > 0 AND line <> ''").withColumn("cells", F.split(F.regexp_replace("line", r"\r\z", ""), "\t"))
    good = cells.where(F.size("cells") == len(columns))
    return good.select("line_no", *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns)]), cells.where(F.size("cells") != len(columns)).select("line_no", "line")


def last_by(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with the same key the last."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_r = 1").drop("_r")
