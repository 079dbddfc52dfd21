"""Pool everything that can be parsed and is no exact duplicate. No threshold, no policy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import fixed

from . import dedup
from .stages import _words

CARD_CHARS = 2000


def theme_hits(hay: Column, keywords: Sequence[str] | None) -> Column:
    """The keywords, as they are written and in list order, that the haystack contains."""
    if not keywords:
        return F.array().cast("array<string>")
    normal, shown = _words(keywords)
    return F.array_compact(F.array(*[F.when(F.contains(hay, F.lit(n)), F.lit(s)) for n, s in zip(normal, shown, strict=True)]))


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pool, dropped). ``rows``: candidates with scan_ord, sha256 and their view (fmt null: unparseable).

    Duplicates are looked for among parseable rows of one agent; the first stays.
    """
    ranked = dedup.exact(rows.where("fmt IS NOT NULL"), ["agent", "sha256"])
    pool = ranked.where("dup_rank = 1").drop("dup_rank", "kept_as")
    twice = ranked.where("dup_rank > 1").select("scan_ord", "agent", "session_file", F.lit("exact_duplicate").alias("reason"), F.col("kept_as").alias("detail"))
    lost = rows.where("fmt IS NULL").select("scan_ord", "agent", "session_file", F.lit("unparseable").alias("reason"), F.lit("").alias("detail"))
    return pool, twice.unionByName(lost)


def drop_tally(dropped: DataFrame) -> DataFrame:
    return dropped.groupBy("reason").agg(F.count("*").alias("n")).orderBy("reason")


def cards(pool: DataFrame, keywords: Sequence[str] | None = None, chars: int = CARD_CHARS) -> DataFrame:
    """scan_ord and the card's fields in their fixed order."""
    made = {"source": F.col("session_file"), "first_prompt": F.substring("first_user_msg", 1, chars), "theme_hits": theme_hits(F.col("hay"), keywords)}
    return pool.select("scan_ord", *[made.get(k, F.col(k)).alias(k) for k in fixed.CARD_KEYS])


def card_lines(found: DataFrame) -> DataFrame:
    """Cards as JSON, one a row, in order."""
    return found.orderBy("scan_ord").select(F.to_json(F.struct(*fixed.CARD_KEYS)).alias("value"))


def enriched(candidates: DataFrame, view: DataFrame) -> DataFrame:
    """Candidates with all computed columns; empty where a session could not be parsed."""
    columns = (*fixed.ENRICH_COLUMNS, *fixed.ANNOTATION_COLUMNS)
    own = [c for c in candidates.columns if c not in columns]
    return candidates.select(own).join(view.select("session_file", *columns), "session_file", "left").select(*own, *columns)
