"""A direction: the cascade once per theme over one shared view, and what is delivered of the union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions import fixed, text
from siltworks.plans import params

from . import funnel


def selections(rows: DataFrame, direction: Mapping[str, Any] = fixed.DIRECTION_NOCODE, themes: Mapping[str, Any] | None = None) -> tuple[DataFrame, list[str]]:
    """(theme, session_file, scan_ord) of every theme's survivors, and the themes that only report.

    All themes read the same rows; persist or store them before.
    """
    out, only = [], []
    for entry in params.check_direction(direction, themes):
        if entry["report_only"]:
            only.append(entry["theme"])
            continue
        p = params.merge(theme=entry["theme"], override=entry["override"], themes=themes)
        out.append(funnel.survivors(rows, p).select(F.lit(entry["theme"]).alias("theme"), "session_file", "scan_ord"))
    union = out[0] if out else rows.select(F.lit("").alias("theme"), "session_file", "scan_ord").limit(0)
    for s in out[1:]:
        union = union.unionByName(s)
    return union, only


def union(selected: DataFrame) -> DataFrame:
    """Each selected session once, in scan order."""
    return selected.select("session_file", "scan_ord").distinct()


def theme_counts(selected: DataFrame, themes: Sequence[str], report_only: Sequence[str] = ()) -> DataFrame:
    """Survivors by theme, 0 for themes without any; null for themes that only report."""
    spark = selected.sparkSession
    names = spark.createDataFrame([(t, t in report_only) for t in themes], "theme string, report_only boolean")
    counts = selected.groupBy("theme").agg(F.count("*").alias("n"))
    return names.join(counts, "theme", "left").select("theme", F.when(~F.col("report_only"), F.coalesce("n", F.lit(0))).alias("n"))


def themes_per_session(selected: DataFrame) -> DataFrame:
    """session_file and themes, in byte order, comma-joined."""
    return selected.groupBy("session_file").agg(F.array_join(F.array_sort(F.collect_set("theme")), ",").alias("themes"))


def without_credentials(chosen: DataFrame, view: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(delivered, excluded): sessions with credential shapes leave, and are told with their kinds."""
    hits = view.where("credential_hit = 1").select("session_file", "credential_kinds")
    return chosen.join(hits, "session_file", "left_anti"), chosen.join(hits, "session_file").select("session_file", "scan_ord", F.col("credential_kinds").alias("kinds"))


def decisions(candidates: DataFrame, chosen: DataFrame, view: DataFrame | None = None) -> DataFrame:
    """All candidates in order as keep or drop, with the reason, and whether credential shapes were seen."""
    picked = chosen.select("session_file", F.lit(True).alias("picked")).distinct()
    rows = candidates.join(picked, "session_file", "left")
    keep = F.coalesce("picked", F.lit(False))
    if view is not None:
        rows = rows.join(view.select("session_file", "credential_hit"), "session_file", "left")
    seen = F.coalesce("credential_hit", F.lit(0)) == 1 if view is not None else F.lit(False)
    reason = F.when(keep & seen, "selected; credential shapes").when(keep, "selected").when(seen, "not selected; credential shapes").otherwise("not selected")
    return rows.withColumn("decision", F.when(keep, "keep").otherwise("drop")).withColumn("reason", reason).withColumn("suggested", F.lit("")).select(*fixed.DECISION_COLUMNS, *(["scan_ord"] if "scan_ord" in candidates.columns else []))


def review(candidates: DataFrame, screen: DataFrame, order: str = "screen_ord") -> DataFrame:
    """Candidates with the suggestion of the screen table; of several for one session the last. Suggested rows first."""
    from siltworks.sources import tables

    last = tables.last_by(screen, "session_file", order).select("session_file", "suggested", "reason")
    rows = candidates.join(last, "session_file", "left").fillna({"suggested": "", "reason": ""})
    return rows.withColumn("decision", F.col("suggested")).withColumn("place", F.when(F.col("suggested") == "keep", 0).otherwise(1)).orderBy("place", "scan_ord")


def yolo(reviewed: DataFrame) -> DataFrame:
    """Keep what is suggested; if nothing is, keep everything."""
    any_kept = not reviewed.where("suggested = 'keep'").isEmpty()
    return reviewed.withColumn("decision", F.when(F.col("suggested") == "keep", "keep").otherwise("drop" if any_kept else "keep"))


def manifest(kept: DataFrame, themes: DataFrame | None = None, run: Mapping[str, Any] | None = None, provenance: Mapping[str, str] | None = None) -> DataFrame:
    """One entry per delivered session. ``kept``: agent, cwd, session_file, sha256, size_bytes, n_lines, decision, suggested, reason, scan_ord.

    Run fields go into every entry, and the provenance fields only where given.
    Two sessions must not be kept under one name: that raises.
    """
    name = F.concat_ws("--", "agent", text.slug(F.coalesce("cwd", F.lit(""))), text.basename(F.col("session_file")))
    rows = kept.withColumn("kept_as", name)
    if (twice := rows.groupBy("kept_as").agg(F.count("*").alias("n")).where("n > 1").first()) is not None:
        raise ValueError(f"{twice['n']} sessions would be kept as {twice['kept_as']}")
    if themes is not None:
        rows = rows.join(themes.groupBy("session_file").agg(F.array_sort(F.collect_set("theme")).alias("themes")), "session_file", "left")
    listed = F.coalesce("themes", F.array().cast("array<string>")) if themes is not None else F.array().cast("array<string>")
    extra = [F.lit(v).alias(k) for k, v in {**(run or {}), **(provenance or {})}.items()]
    return rows.select("scan_ord", "agent", "cwd", F.col("session_file").alias("source"), "kept_as", "sha256", F.col("size_bytes").alias("bytes"), F.col("n_lines").alias("events"), "decision", "suggested", "reason", listed.alias("themes"), *extra)


def kill_cause(report: DataFrame) -> DataFrame:
    """Which policy keys made the length stage reject rows: cap, floor or both."""
    hit = report.where("name LIKE 'L5%' AND killed > 0")
    return hit.select(F.array_join(F.array_compact(F.array(F.when(F.contains("reason", F.lit("first user msg")), F.lit("max_first_msg_chars")), F.when(F.contains("reason", F.lit("longest later")), F.lit("min_user_msg_chars")))), ",").alias("keys"))
