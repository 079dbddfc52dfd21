"""Whole runs: from candidates and their views to the tables and files of a selection.

Tables are folders with one text file, as ``sources.tables`` writes and reads them.
Each is written beside its place and then moved there, so a run that breaks off
leaves no half table.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import fixed
from siltworks.plans import params as layers
from siltworks.sources import sessions, tables

from . import deliver, direction, funnel, order
from .dedup import stored
from .stages import Params

# The reason of a decision that the cascade made, and what is added where credential shapes are delivered.
CHOSEN = "selected by the funnel"
SHAPES = "credential shapes present (exported: --allow-credentials)"


def scan(files: DataFrame, **filters: Any) -> tuple[DataFrame, DataFrame]:
    """(candidates, view) of session files, each stored once. ``filters``: those of ``sessions.candidates``."""
    found = stored(sessions.candidates(files, **filters), "candidates")
    mine = files.join(found.select("session_file"), "session_file", "left_semi")
    return found, stored(sessions.session_view(sessions.raw_lines(mine), mine.select("session_file", "agent")), "view")


def joined(candidates: DataFrame, view: DataFrame) -> DataFrame:
    """Candidates with their views; what cannot be parsed has nulls. A column of both is the view's."""
    both = [c for c in view.columns if c in candidates.columns and c != "session_file"]
    return candidates.drop(*both).join(view, "session_file", "left")


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _path(spark, source)
    _, new = _path(spark, target)
    fs.delete(new, True)
    if not fs.rename(old, new):
        raise OSError(f"{source} cannot be moved to {target}")


def _staged(path: str) -> str:
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}.tmp"


def put_table(df: DataFrame, path: str, columns: Sequence[str], by: str | None = "scan_ord", header: bool = True) -> None:
    """``tables.write_table``, moved into place when whole."""
    tables.write_table(df, _staged(path), columns, by, header)
    _move(df.sparkSession, _staged(path), path)


def put_manifest(entries: DataFrame, path: str) -> int:
    """The manifest as one JSON array, an entry a line, in order; how many entries. Missing texts are empty, not null."""
    spark = entries.sparkSession
    columns = [c for c in entries.columns if c != "scan_ord"]
    filled = entries.fillna("", [c for c, kind in entries.dtypes if kind == "string"])
    rows = stored(order.numbered(filled.select("scan_ord", F.to_json(F.struct(*columns)).alias("value")), ["scan_ord"], "at"), "manifest")
    n = rows.count()
    marks = [(0, "["), (n + 1, "]")] if n else [(0, "[]")]
    lines = rows.select("at", F.concat("value", F.when(F.col("at") < n, ",").otherwise("")).alias("value")).union(spark.createDataFrame(marks, "at long, value string"))
    lines.repartitionByRange(1, "at").sortWithinPartitions("at").select("value").write.mode("overwrite").text(_staged(path))
    _move(spark, _staged(path), path)
    return n


def replace_candidates(kept: DataFrame, candidates: str, columns: Sequence[str] = fixed.CANDIDATE_COLUMNS) -> None:
    """Put survivors in the place of a table of candidates, and an empty screen table of them beside it.

    The full table becomes candidates.full.tsv in the same folder; if that exists,
    a run has been here before and it stays as it is.
    """
    spark = kept.sparkSession
    folder = candidates.rstrip("/").rpartition("/")[0]
    full, screen = f"{folder}/candidates.full.tsv", f"{folder}/screen.tsv"
    rows = stored(kept, "survivors")  # they may have been read from the table that is replaced
    tables.write_table(rows, _staged(candidates), columns)
    tables.write_table(tables.screen(rows), _staged(screen), [*columns, "suggested", "reason"])
    fs, archived = _path(spark, full)
    if not fs.exists(archived):
        _move(spark, candidates, full)
    _move(spark, _staged(candidates), candidates)
    _move(spark, _staged(screen), screen)


def run(candidates: DataFrame, view: DataFrame, params: Params, out: str | None = None, in_place: str | None = None, hard_gate: bool = False) -> tuple[DataFrame, DataFrame]:
    """(report, survivors) of one cascade; survivors go to the table ``out``, or take the place of the table ``in_place``.

    With ``hard_gate``, credential shapes among survivors raise before anything is written.
    """
    rows = stored(joined(candidates, view), "rows")
    report = stored(funnel.report(rows, params), "report")
    alive = stored(funnel.survivors(rows, params), "survivors")
    if hard_gate:
        funnel.hard_gate(alive)
    columns = [c for c in candidates.columns if c != "scan_ord"]
    if in_place is not None:
        replace_candidates(alive, in_place, columns)
    elif out is not None:
        put_table(alive, out, columns)
    return report, alive


def run_direction(
    files: DataFrame,
    candidates: DataFrame,
    view: DataFrame,
    folder: str,
    plan: Mapping[str, Any] = fixed.DIRECTION_NOCODE,
    themes: Mapping[str, Any] | None = None,
    allow_credentials: bool = False,
    hard_gate: bool = False,
    provenance: Mapping[str, str] | None = None,
) -> int:
    """Select by all themes of a direction and deliver; how many sessions.

    Into ``folder``: candidates.tsv (those delivered), decisions.tsv, manifest.json
    and keep/ with the files, on a local file system or mount; and .direction/ with
    counts.tsv (theme, survivors or n/a, report only, override), thememap.tsv
    (session, themes), union (sessions delivered), cred-excluded.tsv (session,
    kinds), and a table of survivors of each theme.

    Sessions with credential shapes are left out unless ``allow_credentials``;
    with ``hard_gate`` they raise before anything is written. Nothing selected
    gives tables without rows.
    """
    spark = candidates.sparkSession
    rows = stored(joined(candidates, view), "rows")
    entries = layers.check_direction(plan, themes)
    selected, only = direction.selections(rows, plan, themes)
    selected = stored(selected, "selected")
    union = direction.union(selected)
    if hard_gate:
        funnel.hard_gate(union.join(view, "session_file"))
    delivered, excluded = (union, None) if allow_credentials else direction.without_credentials(union, view)

    side = f"{folder.rstrip('/')}/.direction"
    names = [e["theme"] for e in entries]
    told = spark.createDataFrame([(i, e["theme"], "1" if e["report_only"] else "0", json.dumps(e["override"], separators=(",", ":"), ensure_ascii=False)) for i, e in enumerate(entries)], "scan_ord long, theme string, only string, override string")
    counts = told.join(direction.theme_counts(selected, names, only), "theme").withColumn("n", F.coalesce(F.col("n").cast("string"), F.lit("n/a")))
    put_table(counts, f"{side}/counts.tsv", ["theme", "n", "only", "override"], header=False)
    put_table(direction.themes_per_session(selected), f"{side}/thememap.tsv", ["session_file", "themes"], "session_file", header=False)
    put_table(delivered, f"{side}/union", ["session_file"], "session_file", header=False)
    none = spark.createDataFrame([], "session_file string, scan_ord long, kinds string")
    put_table(none if excluded is None else excluded, f"{side}/cred-excluded.tsv", ["session_file", "kinds"], "session_file", header=False)
    for name in names:
        if name not in only:
            of = candidates.join(selected.where(F.col("theme") == name).select("session_file"), "session_file", "left_semi")
            put_table(of, f"{side}/{name}.survivors.tsv", fixed.CANDIDATE_COLUMNS)

    seen = view.select("session_file", (F.col("credential_hit") == 1).alias("seen"))
    chosen = candidates.join(delivered.select("session_file"), "session_file", "left_semi").join(seen, "session_file", "left")
    reason = F.when(F.col("seen"), f"{CHOSEN} - {SHAPES}").otherwise(CHOSEN)
    decided = stored(chosen.select(F.lit("keep").alias("decision"), reason.alias("reason"), F.lit("keep").alias("suggested"), *fixed.CANDIDATE_COLUMNS, "scan_ord"), "decisions")
    put_table(decided, f"{folder}/candidates.tsv", fixed.CANDIDATE_COLUMNS)
    put_table(decided, f"{folder}/decisions.tsv", fixed.DECISION_COLUMNS)

    sums = files.select("session_file", F.sha2("content", 256).alias("sha256"))
    listed = stored(direction.manifest(decided.join(sums, "session_file"), selected, {"direction": plan.get("direction", "")}, provenance), "entries")
    deliver.clear(spark, f"{folder}/keep")
    deliver.copy_kept(listed, f"{folder}/keep")
    return put_manifest(listed, f"{folder}/manifest.json")
