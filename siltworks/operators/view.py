"""One feature row per session, from normalised messages and tool events.

``messages``: session_file, fmt, line_no, role (user or assistant), text, and
where the format has them injected, stop, signed, unsigned, redacted (counts of
thinking blocks), image, document. Absent optional columns count as their
defaults. ``tools``: session_file, line_no, block_no, kind (call or result),
call_id, name, digest, surface, failed, truncated. ``credentials``: session_file,
counts (array, by kind).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import fixed, text

_OPTIONAL = {
    "injected": ("boolean", False),
    "stop": ("string", None),
    "signed": ("long", 0),
    "unsigned": ("long", 0),
    "redacted": ("long", 0),
    "image": ("boolean", False),
    "document": ("boolean", False),
}


def _all(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def message_features(messages: DataFrame, nfkc: bool = True) -> DataFrame:
    """Counts, first and last values, lengths and the topic haystack of every session."""
    m = messages
    for name, (kind, default) in _OPTIONAL.items():
        if name not in m.columns:
            m = m.withColumn(name, F.lit(default).cast(kind))
    user = (F.col("role") == "user") & ~F.col("injected") & ~text.is_blank(F.col("text"))
    assistant = F.col("role") == "assistant"
    spoken = ~text.is_blank(F.col("text")) & (user | assistant)
    closing = assistant & ((F.col("fmt") == "claude_code") | (F.coalesce("stop", F.lit("")) != ""))
    m = m.withColumn("_user", user).withColumn("_spoken", spoken).withColumn("_closing", closing)
    told = F.when(F.col("_user"), F.struct("line_no", F.length("text").cast("long").alias("n"), F.substring("text", 1, 500).alias("t")))
    grouped = m.groupBy("session_file", "fmt").agg(
        _all(F.col("_user")).alias("user_turns"),
        _all((F.col("role") == "user") & F.col("injected")).alias("injected_user_messages"),
        _all(assistant).alias("assistant_turns"),
        F.max_by(F.coalesce("stop", F.lit("")), F.when(F.col("_closing"), F.col("line_no"))).alias("last_stop"),
        F.min_by("text", F.when(F.col("_user"), F.col("line_no"))).alias("first_user_msg"),
        F.min_by("text", F.when(F.col("_spoken") & assistant, F.col("line_no"))).alias("first_assistant_msg"),
        F.array_sort(F.collect_list(told)).alias("told"),
        F.sum("signed").cast("long").alias("signature_present"),
        F.sum("unsigned").cast("long").alias("signature_empty"),
        F.sum("redacted").cast("long").alias("redacted_blocks"),
        F.max(F.col("_spoken").cast("int")).alias("has_text"),
        F.max((F.col("_spoken") & F.contains("text", F.lit("```"))).cast("int")).alias("has_code"),
        F.max(F.col("image").cast("int")).alias("has_image"),
        F.max(F.col("document").cast("int")).alias("has_document"),
    )
    first = F.coalesce("first_user_msg", F.lit(""))
    flags = F.array(*[F.when(F.col(f"has_{k}") == 1, F.lit(k)) for k in fixed.MODALITIES])
    total = F.col("signature_present") + F.col("signature_empty")
    shaped = grouped.select(
        "session_file",
        "fmt",
        "user_turns",
        "injected_user_messages",
        "assistant_turns",
        F.coalesce("last_stop", F.lit("")).alias("last_stop"),
        first.alias("first_user_msg"),
        F.length(first).cast("long").alias("first_msg_chars"),
        F.transform("told", lambda t: t["n"]).alias("user_chars"),
        F.array_join(F.transform(F.slice("told", 1, 3), lambda t: t["t"]), " ").alias("hay"),
        F.coalesce("first_assistant_msg", F.lit("")).alias("first_assistant_msg"),
        total.alias("thinking_blocks"),
        "signature_present",
        "signature_empty",
        F.when(total > 0, F.col("signature_present") / total).otherwise(0.0).alias("signature_ratio"),
        F.when(total == 0, "absent").when(F.col("signature_present") > 0, "present").otherwise("empty").alias("signature_state"),
        "redacted_blocks",
        F.array_join(F.array_compact(flags), ",").alias("input_modalities"),
        (F.col("user_turns") == 1).cast("int").alias("single_shot"),
    )
    said = shaped.withColumn("hay", text.norm(F.col("hay"), nfkc))
    return (
        said.withColumn("refusal_proxy", text.is_refusal(text.norm(F.col("first_assistant_msg"), nfkc)).cast("int"))
        .withColumn("synthetic_wrapper", text.is_wrapper(text.norm(F.substring("first_user_msg", 1, 2000), nfkc)).cast("int"))
        .drop("first_assistant_msg")
    )


def pairing(tools: DataFrame) -> DataFrame:
    """Distinct call ids without a result, and result ids without a call."""
    ids = tools.where(F.coalesce("call_id", F.lit("")) != "")
    sides = ids.groupBy("session_file", "call_id").agg(F.max((F.col("kind") == "call").cast("int")).alias("c"), F.max((F.col("kind") == "result").cast("int")).alias("r"))
    return sides.groupBy("session_file").agg(_all((F.col("c") == 1) & (F.col("r") == 0)).alias("tool_calls_missing_results"), _all((F.col("c") == 0) & (F.col("r") == 1)).alias("tool_results_orphan"))


def repeats(tools: DataFrame) -> DataFrame:
    """How often the most repeated call of one tool with the same arguments occurs."""
    same = tools.where("kind = 'call'").groupBy("session_file", "name", "digest").agg(F.count("*").alias("n"))
    return same.groupBy("session_file").agg(F.max("n").alias("tool_repeat_max"))


def error_streak(tools: DataFrame) -> DataFrame:
    """Longest run of failed results in file order: one pass over a session's flags."""
    flags = tools.where("kind = 'result'").groupBy("session_file").agg(F.array_sort(F.collect_list(F.struct("line_no", "block_no", F.coalesce("failed", F.lit(False)).alias("failed")))).alias("f"))
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(x["failed"], s["run"] + 1).otherwise(F.lit(0))
        return F.struct(run.alias("run"), F.greatest(s["most"], run).alias("most"))

    return flags.select("session_file", F.aggregate("f", start, step, lambda s: s["most"]).cast("long").alias("tool_error_streak_max"))


def call_features(tools: DataFrame) -> DataFrame:
    """Verification runs, capabilities, unmapped tools, network use, truncated output."""
    calls = F.col("kind") == "call"
    named = calls & (F.coalesce("name", F.lit("")) != "")
    cap = text.capability_of(F.col("name"))
    caps = tools.withColumn("_cap", F.when(named, cap)).withColumn("_unmapped", F.when(named & cap.isNull(), F.col("name")))
    return caps.groupBy("session_file").agg(
        _all(calls).alias("tool_uses"),
        _all(calls & text.is_verification(F.coalesce("surface", F.lit("")))).alias("verification_commands"),
        F.array_join(F.array_sort(F.collect_set("_cap")), ",").alias("capabilities"),
        F.count_distinct("_unmapped").alias("tools_unmapped"),
        F.max(F.coalesce(F.col("_cap").isin(*fixed.NETWORK_CAPABILITIES), F.lit(False)).cast("int")).alias("has_network"),
        F.max(F.coalesce("truncated", F.lit(False)).cast("int")).alias("has_truncation"),
    )


def tool_features(tools: DataFrame) -> DataFrame:
    out = call_features(tools)
    for part in (pairing, repeats, error_streak):
        out = out.join(part(tools), "session_file", "left")
    return out


def credential_features(credentials: DataFrame) -> DataFrame:
    """``counts`` by kind (and ``firsts``, the line of each kind's first match), one row per session, as count, hit and kinds."""
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda s, n: s + n)
    kinds = text.credential_kinds(F.col("counts"), F.col("firsts") if "firsts" in credentials.columns else None)
    return credentials.select("session_file", total.alias("credential_count"), (total > 0).cast("int").alias("credential_hit"), F.array_join(kinds, ",").alias("credential_kinds"))


def sum_counts(rows: DataFrame, key: str = "session_file") -> DataFrame:
    """Add up line-wise arrays ``counts`` by session, and note the first ``line_no`` of each kind."""
    kinds = range(len(fixed.CREDENTIAL_PATTERNS))
    count = lambda i: F.get("counts", F.lit(i))
    return rows.groupBy(key).agg(F.array(*[F.sum(count(i)).cast("long") for i in kinds]).alias("counts"), F.array(*[F.min(F.when(count(i) > 0, F.col("line_no"))) for i in kinds]).alias("firsts"))


_TOOL_DEFAULTS = {
    "tool_uses": 0,
    "verification_commands": 0,
    "capabilities": "",
    "tools_unmapped": 0,
    "has_network": 0,
    "has_truncation": 0,
    "tool_calls_missing_results": 0,
    "tool_results_orphan": 0,
    "tool_repeat_max": 0,
    "tool_error_streak_max": 0,
}


def session_view(messages: DataFrame, tools: DataFrame | None = None, credentials: DataFrame | None = None, nfkc: bool = True) -> DataFrame:
    """All enrich and annotation columns of every session that has messages, beside the text the stages read."""
    view = message_features(messages, nfkc)
    if tools is not None:
        view = view.join(tool_features(tools), "session_file", "left").fillna(_TOOL_DEFAULTS)
    else:
        view = view.withColumns({k: F.lit(v).cast("long" if v == 0 else "string") for k, v in _TOOL_DEFAULTS.items()})
    if credentials is not None:
        view = view.join(credential_features(credentials), "session_file", "left").fillna({"credential_count": 0, "credential_hit": 0, "credential_kinds": ""})
    else:
        view = view.withColumns({"credential_count": F.lit(0).cast("long"), "credential_hit": F.lit(0), "credential_kinds": F.lit("")})
    return view.withColumn("replay_blockers", replay_blockers()).drop("has_network", "has_truncation")


def replay_blockers() -> Column:
    cut = (F.col("has_truncation") == 1) | ((F.col("fmt") == "claude_code") & (F.col("assistant_turns") > 0) & (F.col("last_stop") == ""))
    found = [F.col("tool_calls_missing_results") > 0, cut, F.col("has_network") == 1]
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in zip(found, fixed.BLOCKERS, strict=True)])), ",")
