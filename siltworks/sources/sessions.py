"""Session files: one JSON object per line, in either of two dialects.

A file is read whole (``binaryFile``), cut into numbered lines and parsed with a
thin schema whose varying parts stay VARIANT. Each dialect turns its records
into the same two frames, ``messages`` and ``tools`` (see operators.view); the
agent hint decides which dialect is taken for a file that both accept.

Malformed lines, lines that hold no object and records of other types are
ignored, but lines are scanned for credentials before they are parsed. Invalid
UTF-8 becomes U+FFFD. Files of 2 GB and more exceed a row and fail loudly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import fixed, text
from siltworks.operators import order, view

RECORD = "type string, stop_reason string, cwd string, message struct<role string, stop_reason string, content variant>, payload variant"
_BLOCKS = "array<struct<type string, text string, signature string, id string, tool_use_id string, name string, is_error boolean, input variant, content variant>>"
_PARTS = "array<struct<type string, text string>>"


def read_files(spark: SparkSession, root: str, agent: str, source_no: int = 0) -> DataFrame:
    """session_file, agent, source_no, mtime, size_bytes, content of all *.jsonl below a root; a missing root is empty."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    schema = "session_file string, agent string, source_no int, mtime timestamp, size_bytes long, content binary"
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(root)
    return files.select(F.regexp_replace("path", r"\Afile:(//)?(?=/)", "").alias("session_file"), F.lit(agent).alias("agent"), F.lit(source_no).alias("source_no"), F.col("modificationTime").alias("mtime"), F.col("length").alias("size_bytes"), "content")


def raw_lines(files: DataFrame) -> DataFrame:
    """session_file, agent, line_no, line: stripped, empty lines left out. Lines end as in text mode: LF, CRLF or CR."""
    content = F.make_valid_utf8(F.col("content").cast("string"))
    lines = files.select("session_file", "agent", F.posexplode(F.split(content, r"\r\n|\n|\r")).alias("line_no", "line"))
    return lines.withColumn("line", text.strip(F.col("line"))).where("line <> ''")


def records(lines: DataFrame) -> DataFrame:
    """Lines as parsed records; what is no object has null fields."""
    lines.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # the last one counts
    return lines.select("session_file", "agent", "line_no", F.from_json("line", RECORD).alias("r")).select("session_file", "agent", "line_no", "r.*")


def variant(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def is_kind(v: Column, path: str, kind: str) -> Column:
    """Whether a variant's value at a path is a STRING, ARRAY or OBJECT."""
    return F.coalesce(F.startswith(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit(kind)), F.lit(False))


def command_surface(v: Column) -> Column:
    """The command-like fields of an object, joined by space; empty if there are none."""
    parts = []
    for key in fixed.COMMAND_KEYS:
        listed = F.array_join(F.transform(variant(v, f"$.{key}", "array<variant>"), lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x))), " ")
        parts.append(F.when(is_kind(v, f"$.{key}", "STRING"), variant(v, f"$.{key}", "string")).when(is_kind(v, f"$.{key}", "ARRAY"), listed))
    return F.coalesce(F.concat_ws(" ", *parts), F.lit(""))


# --- dialect A: user and assistant records with content blocks ----------------


def claude_messages(recs: DataFrame) -> DataFrame:
    kept = recs.where(F.col("type").isin("user", "assistant"))
    content = F.col("message.content")
    blocks = F.coalesce(F.when(is_kind(content, "$", "ARRAY"), variant(content, "$", _BLOCKS)), F.array().cast(_BLOCKS))
    kept = kept.select("session_file", "line_no", F.coalesce("message.role", "type").alias("said_by"), F.coalesce(F.nullif("stop_reason", F.lit("")), "message.stop_reason").alias("stop"), F.when(is_kind(content, "$", "STRING"), variant(content, "$", "string")).alias("plain"), blocks.alias("b"))
    of = lambda kind: F.filter("b", lambda x: x["type"] == kind)
    signed = lambda x: F.coalesce(x["signature"], F.lit("")) != ""
    nested = F.exists("b", lambda x: (x["type"] == "tool_result") & F.exists(F.coalesce(F.try_variant_get(x["content"], "$", _PARTS), F.array().cast(_PARTS)), lambda c: F.coalesce(c["type"] == "image", F.lit(False))))
    has = lambda kind: F.exists("b", lambda x: F.coalesce(x["type"] == kind, F.lit(False)))
    return kept.select(
        "session_file",
        F.lit("claude_code").alias("fmt"),
        "line_no",
        F.when(F.col("said_by") == "user", "user").otherwise("assistant").alias("role"),
        F.coalesce("plain", F.array_join(F.transform(of("text"), lambda x: F.coalesce(x["text"], F.lit(""))), "\n")).alias("text"),
        F.lit(False).alias("injected"),
        "stop",
        F.size(F.filter(of("thinking"), signed)).cast("long").alias("signed"),
        F.size(F.filter(of("thinking"), lambda x: ~signed(x))).cast("long").alias("unsigned"),
        F.size(of("redacted_thinking")).cast("long").alias("redacted"),
        (has("image") | ((F.col("said_by") == "user") & F.coalesce(nested, F.lit(False)))).alias("image"),
        has("document").alias("document"),
    )


def claude_tools(recs: DataFrame) -> DataFrame:
    kept = recs.where(F.col("type").isin("user", "assistant") & is_kind(F.col("message.content"), "$", "ARRAY"))
    user = F.coalesce("message.role", "type") == "user"
    blocks = kept.select("session_file", "line_no", user.alias("by_user"), F.posexplode(variant(F.col("message.content"), "$", _BLOCKS)).alias("block_no", "b"))
    wanted = blocks.where((F.col("by_user") & (F.col("b.type") == "tool_result")) | (~F.col("by_user") & (F.col("b.type") == "tool_use")))
    call = F.col("b.type") == "tool_use"
    return wanted.select(
        "session_file",
        F.lit("claude_code").alias("fmt"),
        "line_no",
        "block_no",
        F.when(call, "call").otherwise("result").alias("kind"),
        F.when(call, F.col("b.id")).otherwise(F.col("b.tool_use_id")).alias("call_id"),
        F.when(call, F.coalesce("b.name", F.lit(""))).alias("name"),
        F.when(call, F.coalesce(F.to_json("b.input"), F.lit("null"))).alias("digest"),
        F.when(call, command_surface(F.col("b.input"))).alias("surface"),
        F.when(~call, F.coalesce("b.is_error", F.lit(False))).alias("failed"),
        F.lit(False).alias("truncated"),
    )


# --- dialect B: response items -------------------------------------------------


def codex_messages(recs: DataFrame) -> DataFrame:
    p = F.col("payload")
    kept = recs.where(F.col("type") == "response_item").withColumn("said_by", variant(p, "$.role", "string")).where((variant(p, "$.type", "string") == "message") & F.col("said_by").isin("user", "assistant"))
    parts = F.coalesce(variant(p, "$.content", _PARTS), F.array().cast(_PARTS))
    told = F.array_join(F.transform(parts, lambda x: F.coalesce(x["text"], F.lit(""))), "")
    kept = kept.select("session_file", "line_no", F.col("said_by").alias("role"), told.alias("text"), variant(p, "$.stop_reason", "string").alias("stop"), F.exists(parts, lambda x: F.coalesce(F.contains(x["type"], F.lit("image")), F.lit(False))).alias("image"))
    zero = F.lit(0).cast("long")
    return kept.select("session_file", F.lit("codex").alias("fmt"), "line_no", "role", "text", ((F.col("role") == "user") & text.is_injected(F.col("text"))).alias("injected"), "stop", zero.alias("signed"), zero.alias("unsigned"), zero.alias("redacted"), "image", F.lit(False).alias("document"))


def codex_tools(recs: DataFrame) -> DataFrame:
    p = F.col("payload")
    items = recs.where(F.col("type") == "response_item").withColumn("pt", variant(p, "$.type", "string"))
    items = items.where(F.col("pt").isin("function_call", "local_shell_call", "custom_tool_call") | F.endswith("pt", F.lit("_output")))
    call = ~F.endswith("pt", F.lit("_output"))
    raw = lambda key: F.when(is_kind(p, f"$.{key}", "STRING"), variant(p, f"$.{key}", "string")).otherwise(F.coalesce(F.to_json(variant(p, f"$.{key}", "variant")), F.lit("null")))
    shell, custom = F.col("pt") == "local_shell_call", F.col("pt") == "custom_tool_call"
    parsed = F.try_parse_json(raw("arguments"))
    surface = F.when(shell, command_surface(variant(p, "$.action", "variant"))).when(custom, raw("input")).otherwise(F.when(is_kind(parsed, "$", "OBJECT"), command_surface(parsed)).otherwise(raw("arguments")))
    digest = F.when(shell, F.coalesce(F.to_json(variant(p, "$.action", "variant")), F.lit("null"))).when(custom, raw("input")).otherwise(raw("arguments"))
    listed = F.array_join(F.transform(variant(p, "$.output", _PARTS), lambda x: F.coalesce(x["text"], F.lit(""))), "\n")
    flat = F.coalesce(F.when(is_kind(p, "$.output", "STRING"), variant(p, "$.output", "string")).when(is_kind(p, "$.output", "ARRAY"), listed), F.lit(""))
    code = F.try_variant_get(F.try_parse_json(flat), "$.metadata.exit_code", "variant")
    exit_code = F.when(F.schema_of_variant(code).isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.try_variant_get(code, "$", "long"))
    failed = flat.rlike(r"(?i)\A(?U:\s)*error") | (F.coalesce(exit_code, F.lit(0)) != 0)
    own = F.when(is_kind(p, "$.call_id", "STRING"), variant(p, "$.call_id", "string"))
    return items.select(
        "session_file",
        F.lit("codex").alias("fmt"),
        "line_no",
        F.lit(0).alias("block_no"),
        F.when(call, "call").otherwise("result").alias("kind"),
        F.when(call, F.coalesce(F.nullif(own, F.lit("")), F.when(is_kind(p, "$.id", "STRING"), variant(p, "$.id", "string")))).otherwise(own).alias("call_id"),
        F.when(call, F.when(shell, "local_shell").otherwise(F.coalesce(variant(p, "$.name", "string"), F.lit("")))).alias("name"),
        F.when(call, digest).alias("digest"),
        F.when(call, surface).alias("surface"),
        F.when(~call, failed).alias("failed"),
        F.when(~call, F.contains(F.lower(flat), F.lit("warning: truncated output"))).otherwise(F.lit(False)).alias("truncated"),
    )


@dataclass(frozen=True)
class Adapter:
    """A dialect: strict extractions from records. A file without any of its messages is not of that dialect."""

    name: str
    agent: str
    messages: Callable[[DataFrame], DataFrame]
    tools: Callable[[DataFrame], DataFrame]


ADAPTERS = (Adapter("claude_code", "claude", claude_messages, claude_tools), Adapter("codex", "codex", codex_messages, codex_tools))


def choose(files: DataFrame, messages: DataFrame, adapters=ADAPTERS) -> DataFrame:
    """session_file and fmt: the accepting dialect that the hint puts first; an unknown hint takes them in order.

    ``files`` has session_file and agent (the hint); files that no dialect accepts are left out.
    """
    hinted = F.coalesce(*[F.when(F.col("agent") == a.agent, F.lit(a.name)) for a in adapters], F.lit(adapters[0].name))
    accepted = messages.select("session_file", "fmt").distinct().join(files.select("session_file", hinted.alias("hint")), "session_file")
    place = F.coalesce(*[F.when(F.col("fmt") == a.name, F.lit(i)) for i, a in enumerate(adapters)])
    return accepted.groupBy("session_file").agg(F.min_by("fmt", F.struct((F.col("fmt") != F.col("hint")).alias("other"), place.alias("i"))).alias("fmt"))


def session_view(lines: DataFrame, hints: DataFrame, adapters=ADAPTERS, nfkc: bool = True) -> DataFrame:
    """The feature row of every file that a dialect accepts. ``hints``: session_file and agent."""
    recs = records(lines)
    both = lambda part: _union([getattr(a, part)(recs) for a in adapters])
    messages = both("messages")
    fmt = choose(hints, messages, adapters)
    mine = messages.join(fmt, ["session_file", "fmt"], "left_semi")
    tools = both("tools").join(fmt, ["session_file", "fmt"], "left_semi")
    credentials = view.sum_counts(lines.select("session_file", "line_no", text.credential_counts(F.col("line")).alias("counts")))
    return view.session_view(mine, tools, credentials, nfkc)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def candidates(files: DataFrame, workspace: str | None = None, since: str | None = None, min_lines: int = 0, topic: str | None = None) -> DataFrame:
    """The candidate table in scan order, with scan_ord: sessions that know their workspace and pass the scan filters.

    ``since`` is a date; one that cannot be read raises. Lines are counted as line
    ends, so an unfinished last line is not.
    """
    meta = files
    if since is not None:
        meta = meta.where(F.col("mtime") >= F.to_timestamp(F.lit(since)))
    lines = raw_lines(meta)
    recs = records(lines)
    claude = F.col("agent") == "claude"
    where = F.when(claude, F.col("cwd")).otherwise(F.when(F.col("type") == "session_meta", variant(F.col("payload"), "$.cwd", "string")))
    parts = variant(F.col("payload"), "$.content", _PARTS)
    joined = lambda sep: F.array_join(F.transform(parts, lambda x: x["text"]), sep)
    message = (F.col("type") == "response_item") & (variant(F.col("payload"), "$.type", "string") == "message")
    content = F.col("message.content")
    plain = F.when((F.col("type") == "user") & is_kind(content, "$", "STRING"), variant(content, "$", "string"))
    prompt = F.when(claude, plain).otherwise(F.when(message & (variant(F.col("payload"), "$.role", "string") == "user"), joined(" ")))
    blocks = F.array_join(F.transform(F.filter(variant(content, "$", _BLOCKS), lambda x: x["type"] == "text"), lambda x: x["text"]), "\n")
    prose = F.when(claude, F.when(F.col("type").isin("user", "assistant"), F.coalesce(F.when(is_kind(content, "$", "STRING"), variant(content, "$", "string")), blocks))).otherwise(F.when(message, joined("\n")))
    hit = F.coalesce(prose.rlike(f"(?im){topic}"), F.lit(False)) if topic else F.lit(True)
    shown = text.preview(prompt)
    facts = recs.groupBy("session_file").agg(
        F.min_by(where, F.when(where.isNotNull(), F.col("line_no"))).alias("cwd"),
        # The first prompt that has a line to show; of each whole prompt only that line is kept.
        F.min_by(shown, F.when(shown != "", F.col("line_no"))).alias("first_prompt"),
        F.max(hit.cast("int")).alias("hit"),
    )
    sized = meta.select("session_file", "agent", "source_no", "mtime", "size_bytes", (F.size(F.split(F.decode("content", "ISO-8859-1"), "\n")) - 1).cast("long").alias("n_lines"))
    found = sized.join(facts, "session_file").withColumn("cwd", F.replace("cwd", F.lit("\\"), F.lit("/"))).where("cwd <> ''").where((F.col("n_lines") >= min_lines) & (F.col("hit") == 1))
    if workspace:
        found = found.where(F.contains("cwd", F.lit(workspace)))
    columns = ["agent", "cwd", F.unix_timestamp("mtime").alias("mtime"), "size_bytes", "n_lines", F.coalesce("first_prompt", F.lit("")).alias("first_prompt"), "session_file"]
    return order.numbered(found.select(*columns, "source_no"), ["source_no", "session_file"]).drop("source_no")
