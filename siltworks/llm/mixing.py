"""Mix sources to target weights by systematic sampling (DataFrame functions only).

Every source gets a number of words to supply (``target``). Its documents lie in
a fixed order, each with the same expected number of copies
``r = target / source_size``. The running sum of ``r`` is shifted by one random
offset of the source, and a document is emitted once for every whole number that
its part of the running sum crosses. With ``r`` at most ``max_copies``, no
document is emitted more often than that.

Documents are ordered by size, so that any stretch of the order holds documents
of like size and the words taken stay close to the target.

The running sum needs no source in one task. Counts by (source, size) are added
up in two small steps (size classes of a source, sizes of a class); a size that
very many documents share is cut into ranges of the digest that orders them.
Only such a range, of about ``split_rows`` documents, is numbered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table, word_count

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SEED = "mix-1"
SPLIT_ROWS = 512
#: At most this many ranges share one size.
SPLIT_RANGES = 4096


def _source_key(source: Column) -> Column:
    """Sorts by code point with null last, and joins like any other value."""
    return F.when(source.isNull(), F.lit("z")).otherwise(F.concat(F.lit("a"), source.cast("string")))


def source_targets(by_size: DataFrame, weights: Sequence[int], max_copies: int) -> DataFrame:
    """One row per source: words, docs, total_docs, target.

    ``by_size`` has sk, z (size) and n (documents). A source wants its share of
    all words by weight; above ``max_copies`` times its own words it stops there
    and the others share the rest by weight. In the order of cap by weight the
    stopped sources come first, so one pass of running sums finds the level.
    """
    totals = by_size.groupBy("sk").agg(F.sum(F.col("z") * F.col("n")).alias("words"), F.sum("n").alias("docs"))
    everything = Window.partitionBy()  # one row per source
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = totals.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(Window.orderBy("sk")) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    ranked = (
        ranked.withColumn("cap", F.col("words") * max_copies)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("total", F.sum("words").over(everything))
        .withColumn("total_docs", F.sum("docs").over(everything))
        .withColumn("heavy", F.sum("weight").over(everything))
    )
    before = Window.orderBy("ratio", "sk").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / (F.col("heavy") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    ranked = ranked.withColumn("place", F.row_number().over(Window.orderBy("ratio", "sk"))).withColumn("level", level)
    free = F.when(F.col("level") < F.col("ratio"), F.struct("place", "level"))
    return ranked.withColumn("final", F.min(free).over(everything)["level"]).select(
        "sk", "words", "docs", "total_docs", F.coalesce(F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")), F.lit(0.0)).alias("target")
    )


def mix(
    rows: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str = "size",
    weights: Sequence[int] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """``rows`` as column ``row`` (a struct), with size, source_size, target and copies.

    Null sizes count as 0. Sources are any values, null among them (one source,
    last in order). Rows that repeat are documents of their own, and equal rows
    may swap copies. Null ids are ordered first. Empty input gives an empty
    result. Columns of ``rows`` may have any names, as they stay inside ``row``.
    ``rows`` is read twice; give it from storage, not from a costly plan.
    """
    if not weights or min(weights) <= 0 or max_copies < 1:
        raise ValueError("weights must be positive and max_copies at least 1")
    named = rows.select(
        F.struct(*[rows[f"`{c}`"] for c in rows.columns]).alias("row"),
        _source_key(rows[f"`{source_col}`"]).alias("sk"),
        F.coalesce(rows[f"`{size_col}`"].cast("long"), F.lit(0)).cast("long").alias("z"),
        F.coalesce(rows[f"`{id_col}`"].cast("string"), F.lit("")).alias("id"),
    ).withColumn("digest", F.md5("id"))
    by_size = named.groupBy("sk", "z").agg(F.count("*").alias("n"))
    targets = source_targets(by_size, weights, max_copies)

    classed = by_size.withColumn("class", F.floor(F.log2(F.col("z") + 1) * 4))
    classes = classed.groupBy("sk", "class").agg(F.sum("n").alias("m"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select("sk", "class", F.coalesce(F.sum("m").over(before(Window.partitionBy("sk").orderBy("class"))), F.lit(0)).alias("class_offset"))
    sizes = classed.withColumn("in_class", F.coalesce(F.sum("n").over(before(Window.partitionBy("sk", "class").orderBy("z"))), F.lit(0))).join(classes, ["sk", "class"])
    share = F.greatest(F.lit(split_rows), F.ceil(F.col("total_docs") / SPLIT_RANGES))
    shift = (F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("sk"))), 1, 3), 16, 10).cast("double") + 0.5) / 4096
    sizes = sizes.join(targets, "sk").select(
        "sk",
        "z",
        (F.col("class_offset") + F.col("in_class")).alias("size_offset"),
        F.ceil(F.col("n") / share).alias("ranges"),
        "words",
        "target",
        F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0).alias("rate"),
        shift.alias("shift"),
    )
    where = F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * F.col("ranges") / F.lit(4294967296.0)).cast("long")
    # Dealt by range, or what follows would reuse the join's partitions and number a whole size in one task.
    placed = named.join(sizes, ["sk", "z"]).withColumn("part", where).repartition("sk", "z", "part")
    parts = placed.groupBy("sk", "z", "part").agg(F.count("*").alias("n"))
    parts = parts.select("sk", "z", "part", F.coalesce(F.sum("n").over(before(Window.partitionBy("sk", "z").orderBy("part"))), F.lit(0)).alias("part_offset"))
    order = Window.partitionBy("sk", "z", "part").orderBy("digest", "id")
    rank = F.col("size_offset") + F.col("part_offset") + F.row_number().over(order)
    crossed = lambda at: F.floor(at * F.col("rate") + F.col("shift"))
    return (
        placed.join(parts, ["sk", "z", "part"])
        .withColumn("rank", rank)
        .select("row", F.col("z").alias("size"), F.col("words").alias("source_size"), "target", (crossed(F.col("rank")) - crossed(F.col("rank") - 1)).cast("long").alias("copies"))
    )


def sample_mixture(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` that the mixture emits, a row for each copy, with the columns of ``docs``."""
    sized = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), docs[f"`{id_col}`"].alias("id"), docs[f"`{source_col}`"].alias("source"), word_count(docs[f"`{text_col}`"]).alias("size"))
    mixed = mix(sized, id_col="id", source_col="source", size_col="size", **options)
    kept = mixed.where("copies > 0").select("row.doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", "source", word_count(docs["text"]).alias("size")), "mix")
    return mix(sized).select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL = rf"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 'a' || source END AS sk,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents),
totals AS (SELECT sk, sum(size)::BIGINT AS words FROM sized GROUP BY sk),
weighed AS (
  SELECT sk, words, words * {MAX_COPIES} AS cap,
         list_value({", ".join(map(str, WEIGHTS))})[((row_number() OVER (ORDER BY sk) - 1) % {len(WEIGHTS)}) + 1] AS weight
  FROM totals),
levels AS (
  SELECT *, cap::DOUBLE / weight AS ratio, row_number() OVER (ORDER BY cap::DOUBLE / weight, sk) AS place,
         ((SELECT sum(words) FROM weighed) - coalesce(sum(cap) OVER w, 0))::DOUBLE
           / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM weighed
  WINDOW w AS (ORDER BY cap::DOUBLE / weight, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT sk, words, coalesce(least(cap::DOUBLE, (SELECT arg_min(level, place) FROM levels WHERE level < ratio) * weight), 0.0) AS target,
         (('0x' || substr(md5('{SEED}' || sk), 1, 3))::INTEGER + 0.5::DOUBLE) / 4096::DOUBLE AS shift
  FROM levels),
ranked AS (
  SELECT doc_id, size, words, target, shift, CASE WHEN words > 0 THEN target / words ELSE 0.0 END AS rate,
         row_number() OVER (PARTITION BY sk ORDER BY size, digest, doc_id) AS rank
  FROM sized JOIN targets USING (sk))
SELECT doc_id, size, words::BIGINT AS source_size, target,
       ((floor(rank * rate + shift) - floor((rank - 1) * rate + shift))::BIGINT * size)::BIGINT AS taken
FROM ranked
"""
