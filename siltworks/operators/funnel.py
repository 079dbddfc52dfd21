"""The cascade in one pass, with a report that keeps rejected, not applicable and switched off apart.

All stages judge every row at once. A row's fate is the first stage that fails
it, and with that one number per row a single aggregate gives survivors, kills
and skips of every stage: no stage is a job of its own.

``rows`` are candidates joined to their session view, with scan_ord (their order)
and session_file. Rows without a view (fmt null) are unparseable: they leave at
the first stage without being counted as its kills.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.functions import text

from . import dedup
from .stages import DEDUP, DEDUP_REQUIRES, FAIL, SKIP, STAGES, Params, StageSpec


class HardGate(RuntimeError):
    """A surviving row carries credential shapes, and the run was told to refuse that."""


def judge(rows: DataFrame, params: Params, stages: Sequence[StageSpec] = STAGES) -> DataFrame:
    """Parsed rows with ``verdicts`` (array of status and reason by stage, null if off) and ``first_fail`` (1-based, null if none)."""
    built = [s.build(params) if s.enabled(params) else None for s in stages]
    verdict = [F.lit(None).cast("struct<status:string,reason:string>") if b is None else F.struct(b[0].alias("status"), b[1].alias("reason")) for b in built]
    judged = rows.where(F.col("fmt").isNotNull()).withColumn("verdicts", F.array(*verdict))
    fails = [F.when(F.get("verdicts", F.lit(i))["status"] == FAIL, F.lit(i + 1)) for i, b in enumerate(built) if b is not None]
    return judged.withColumn("first_fail", F.coalesce(*fails, F.lit(None).cast("int")))


def passed(judged: DataFrame) -> DataFrame:
    """Rows that no row-wise stage fails."""
    return judged.where("first_fail IS NULL").drop("verdicts", "first_fail")


def survivors(rows: DataFrame, params: Params, stages: Sequence[StageSpec] = STAGES) -> DataFrame:
    """Rows that the whole cascade keeps, near-duplicates removed."""
    alive = passed(judge(rows, params, stages))
    threshold = params.get(DEDUP_REQUIRES)
    return alive if threshold is None else dedup.greedy(alive, float(threshold)).where("kept").drop("kept", "leader")


def hard_gate(alive: DataFrame) -> None:
    """Raise if any survivor has a credential hit; to be called before anything is written."""
    if n := alive.where("credential_hit = 1").count():
        raise HardGate(f"{n} surviving sessions carry credential shapes")


def reasons(judged: DataFrame) -> DataFrame:
    """stage_no, status, key, n, first_ord: why rows failed or were skipped. A key is the reason up to its detail, cut to 50."""
    told = judged.select("scan_ord", "first_fail", F.posexplode("verdicts").alias("at", "v")).select("scan_ord", (F.col("at") + 1).alias("stage_no"), "v.status", "v.reason", "first_fail")
    own = told.where(((F.col("status") == FAIL) & (F.col("first_fail") == F.col("stage_no"))) | ((F.col("status") == SKIP) & (F.col("first_fail").isNull() | (F.col("first_fail") > F.col("stage_no")))))
    key = F.substring(F.substring_index("reason", "(", 1), 1, 50)
    return own.groupBy("stage_no", "status", key.alias("key")).agg(F.count("*").alias("n"), F.min("scan_ord").alias("first_ord"))


def reason_lines(judged: DataFrame, most: int = 3) -> DataFrame:
    """stage_no and reason: up to ``most`` reasons, fails before skips, frequent ones first, then in order of appearance."""
    order = Window.partitionBy("stage_no").orderBy(F.when(F.col("status") == FAIL, 0).otherwise(1), F.desc("n"), "first_ord")
    shown = F.concat(F.when(F.col("status") == SKIP, "skip: ").otherwise(""), F.col("key"), F.lit(" x"), F.col("n"))
    top = reasons(judged).withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).select("stage_no", "r", shown.alias("s"))
    return top.groupBy("stage_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "s"))), lambda x: x["s"]), "; ").alias("reason"))


def dedup_lines(fate: DataFrame, threshold: float, stage_no: int, most: int = 2) -> DataFrame:
    """stage_no and reason: the first ``most`` rows that the last stage drops, by what they are like. No row if it drops none."""
    gone = fate.where("NOT kept").orderBy("scan_ord").limit(most).select("scan_ord", "leader")
    leaders = fate.select(F.col("scan_ord").alias("leader"), text.basename(F.col("session_file")).alias("of"))
    said = F.concat(F.lit("near-duplicate of "), F.col("of"), F.lit(f" (jaccard>={threshold}) x1"))
    told = gone.join(leaders, "leader").select("scan_ord", said.alias("s"))
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("scan_ord", "s"))), lambda x: x["s"]), "; ")
    return told.agg(line.alias("reason")).where("reason <> ''").select(F.lit(stage_no).alias("stage_no"), "reason")


def report(rows: DataFrame, params: Params, stages: Sequence[StageSpec] = STAGES, with_reasons: bool = True) -> DataFrame:
    """stage_no, name, survivors, killed, skipped, off, killed_pct, reason: one row per stage, from L0 (scan) to L9 (dedup).

    killed_pct is of the stage before. Of no rows, the report is all zeros.
    """
    judged = judge(rows, params, stages)
    n = len(stages)
    counts: list[Column] = []
    for i, s in enumerate(stages, 1):
        alive = F.col("first_fail").isNull() | (F.col("first_fail") > i)
        status = F.get("verdicts", F.lit(i - 1))["status"]
        skipped = F.count_if((status == SKIP) & alive) if s.enabled(params) else F.lit(0)
        counts.append(F.struct(F.lit(i).alias("stage_no"), F.lit(s.name).alias("name"), F.count_if(alive).alias("survivors"), F.count_if(F.col("first_fail") == i).alias("killed"), skipped.cast("long").alias("skipped"), F.lit(not s.enabled(params)).alias("off")))
    body = judged.agg(F.array(*counts).alias("s")).select(F.inline("s"))
    scan = rows.agg(F.lit(0).alias("stage_no"), F.lit("L0 scan").alias("name"), F.count("*").alias("survivors"), F.lit(0).cast("long").alias("killed"), F.lit(0).cast("long").alias("skipped"), F.lit(False).alias("off"))
    threshold = params.get(DEDUP_REQUIRES)
    alive = passed(judged)
    if threshold is None:
        last = alive.agg(F.count("*").alias("survivors"), F.lit(0).cast("long").alias("killed"))
    else:
        fate = dedup.stored(dedup.greedy(alive, float(threshold)).select("scan_ord", "session_file", "kept", "leader"), "fate")
        last = fate.agg(F.count_if("kept").alias("survivors"), F.count_if(~F.col("kept")).alias("killed"))
    last = last.select(F.lit(n + 1).alias("stage_no"), F.lit(DEDUP).alias("name"), "survivors", "killed", F.lit(0).cast("long").alias("skipped"), F.lit(threshold is None).alias("off"))
    table = scan.unionByName(body).unionByName(last)
    before = F.lag("survivors").over(Window.orderBy("stage_no"))  # ten rows
    table = table.withColumn("killed_pct", F.when(before > 0, F.round(100 * F.col("killed") / before, 2)).otherwise(0.0))
    if not with_reasons:
        return table
    needs = [*(s.requires for s in stages), DEDUP_REQUIRES]
    requires = F.coalesce(*[F.when(F.col("stage_no") == i, F.lit(r)) for i, r in enumerate(needs, 1)])
    off = F.concat(F.lit("off (nothing sets "), requires, F.lit(")"))
    lines = reason_lines(judged)
    if threshold is not None:
        lines = lines.unionByName(dedup_lines(fate, threshold, n + 1))
    return table.join(lines, "stage_no", "left").withColumn("reason", F.when(F.col("off"), off).otherwise(F.coalesce("reason", F.lit(""))))


def injected_summary(rows: DataFrame) -> DataFrame:
    """sessions and blocks: injected user messages over all parsed rows."""
    return rows.where("fmt IS NOT NULL").agg(F.count_if(F.col("injected_user_messages") > 0).alias("sessions"), F.coalesce(F.sum("injected_user_messages"), F.lit(0)).alias("blocks"))


def credential_summary(alive: DataFrame) -> DataFrame:
    """sessions and kinds (sorted, comma-joined) with credential shapes among survivors."""
    kinds = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split("credential_kinds", ",")))))
    return alive.where("credential_hit = 1").agg(F.count("*").alias("sessions"), F.coalesce(F.array_join(kinds, ","), F.lit("")).alias("kinds"))


def unparseable(rows: DataFrame) -> DataFrame:
    return rows.where("fmt IS NULL")


def render(table: list, width: int = 100) -> str:
    """The report as text; ``table`` is its collected rows, ten at most."""
    import textwrap

    lines = [f"{'stage':<16}{'survivors':>12}{'killed':>10}{'%':>8}{'skipped':>10}  why"]
    for r in sorted(table, key=lambda r: r["stage_no"]):
        head = f"{r['name']:<16}{r['survivors']:>12,}" + (f"{'off':>10}{'':>8}{'':>10}" if r["off"] else f"{r['killed']:>10,}{r['killed_pct']:>8.2f}{r['skipped']:>10,}") + "  "
        wrapped = textwrap.wrap(r["reason"] or "", max(20, width - len(head))) or [""]
        lines += [head + wrapped[0], *(" " * len(head) + w for w in wrapped[1:])]
    return "\n".join(lines)

