import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltworks import queries
from siltworks.functions import text
from siltworks.operators import dedup, direction, funnel
from siltworks.plans import params

VIEW = "scan_ord long, session_file string, fmt string, user_turns long, assistant_turns long, tool_uses long, thinking_blocks long, signature_ratio double, signature_empty long, last_stop string, first_msg_chars long, user_chars array<long>, hay string, first_user_msg string, credential_hit int, credential_kinds string, injected_user_messages long"


def row(i, **over):
    base = {"fmt": "claude_code", "user_turns": 2, "assistant_turns": 2, "tool_uses": 0, "thinking_blocks": 0, "signature_ratio": 0.0, "signature_empty": 0, "last_stop": "end_turn", "first_msg_chars": 30, "user_chars": [30, 40], "hay": f"text {i}", "first_user_msg": f"{i}" * 30, "credential_hit": 0, "credential_kinds": "", "injected_user_messages": 0}
    return {"scan_ord": i, "session_file": f"f{i}", **base, **over}


def frame(spark, rows):
    names = [c.split()[0] for c in VIEW.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], VIEW)


def table(spark, rows, **over):
    return {r["name"]: r for r in funnel.report(frame(spark, rows), params.merge(**over)).collect()}


def test_signature_classes(spark):
    rows = [row(1, thinking_blocks=12, signature_ratio=1.0), row(2, thinking_blocks=6, signature_ratio=0.0, signature_empty=6), row(3), row(4, thinking_blocks=9, signature_ratio=3 / 9, signature_empty=6), row(5, fmt="codex")]
    r = table(spark, rows, sig_ratio_min=0.3)["L3 signature"]
    assert (r["killed"], r["skipped"], r["survivors"]) == (1, 2, 4)
    assert r["reason"] == "signature_ratio 0.00 < 0.30  x1; skip: no thinking block  x2"
    assert table(spark, rows, sig_ratio_min=0.34)["L3 signature"]["killed"] == 2
    assert table(spark, rows, sig_ratio_min=0.0)["L3 signature"]["killed"] == 0
    off = table(spark, rows, no_signature=True)["L3 signature"]
    assert off["off"] and off["survivors"] == 5 and "sig_ratio_min" in off["reason"]


def test_closure_skip_is_no_pass(spark):
    rows = [row(i, fmt="codex", last_stop="") for i in range(3)] + [row(8, last_stop=""), row(9, last_stop="tool_use")]
    r = table(spark, rows)["L4 end_turn"]
    assert (r["killed"], r["skipped"], r["survivors"]) == (2, 3, 3)


def test_length(spark):
    rows = [row(1, first_msg_chars=11, user_chars=[11, 5]), row(2, user_chars=[30]), row(3, user_turns=0, first_msg_chars=0, user_chars=[], first_user_msg="")]
    r = table(spark, rows, max_first_msg_chars=10, min_user_msg_chars=0)["L5 length"]
    assert r["killed"] == 2 and "first user msg 11 > cap 10" in r["reason"]
    assert table(spark, rows, max_first_msg_chars=0, min_user_msg_chars=20)["L5 length"]["killed"] == 1


def test_unparseable_are_no_kills(spark):
    rows = [row(1), row(2, fmt=None)]
    t = table(spark, rows)
    assert t["L0 scan"]["survivors"] == 2 and t["L1 turns"]["survivors"] == 1 and t["L1 turns"]["killed"] == 0
    assert funnel.unparseable(frame(spark, rows)).count() == 1


def test_empty(spark):
    t = table(spark, [])
    assert all(r["survivors"] == 0 for r in t.values()) and len(t) == 10


def test_hard_gate_and_summaries(spark):
    rows = frame(spark, [row(1, credential_hit=1, credential_kinds="openai_key,aws_access_key"), row(2, injected_user_messages=3)])
    with pytest.raises(funnel.HardGate):
        funnel.hard_gate(rows)
    funnel.hard_gate(rows.where("scan_ord = 2"))
    assert tuple(funnel.credential_summary(rows).first()) == (1, "aws_access_key,openai_key")
    assert tuple(funnel.injected_summary(rows).first()) == (1, 3)


def test_render(spark):
    shown = funnel.render(funnel.report(frame(spark, [row(1), row(2)]), params.merge(no_signature=True)).collect())
    assert "L3 signature" in shown and "off" in shown


def test_thresholds(spark):
    same = "this is a template message that repeats over and over again "
    rows = [row(1, first_user_msg=same + "one"), row(2, first_user_msg="wholly unlike text"), row(3, first_user_msg=same + "two"), row(4, first_user_msg="123456789")]
    kept = lambda t: [r["scan_ord"] for r in dedup.greedy(frame(spark, rows), t).where("kept").orderBy("scan_ord").collect()]
    assert kept(0.6) == [1, 2, 4] and kept(0.0) == [1] and kept(1.0) == [1, 2, 3, 4] and kept(1.5) == [1, 2, 3, 4]
    empty = [row(1, first_user_msg=""), row(2, first_user_msg=""), row(3, first_user_msg=None)]
    assert [r["scan_ord"] for r in dedup.greedy(frame(spark, empty), 0.6).where("kept").collect()] == [1]


def plain_greedy(texts, t):
    def grams(s):
        s = "".join(s.lower().split())
        return {s[i : i + 5] for i in range(max(1, len(s) - 4))}

    kept, lead = [], {}
    for i, s in enumerate(texts):
        g = grams(s)
        hit = next((k for k, h in kept if len(g & h) / len(g | h) >= t), None)
        lead[i] = hit
        if hit is None:
            kept.append((i, g))
    return lead


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abc ", max_size=24), min_size=1, max_size=14), st.sampled_from([0.2, 0.5, 0.8, 1.0]), st.sampled_from([0, 10_000]))
def test_greedy_equals_plain(spark, texts, t, few):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "scan_ord long, first_user_msg string")
    old = dedup.settle.__defaults__
    dedup.settle.__defaults__ = (few,)
    try:
        got = {r["scan_ord"]: r["leader"] for r in dedup.greedy(rows, t).collect()}
    finally:
        dedup.settle.__defaults__ = old
    assert got == plain_greedy(texts, t)


def test_norm(spark):
    import unicodedata

    said = ["Straße", "ＦＵＬＬ", "ﬁne", "ÀÉ", "漢字", "½", None, "", "a\u0301"]
    df = spark.createDataFrame([(s,) for s in said], "s string")
    got = [r[0] for r in df.select(text.norm(F.col("s"))).collect()]
    assert got == [None if s is None else unicodedata.normalize("NFKC", s).lower() for s in said]


def test_white_space(spark):
    df = spark.createDataFrame([("\u3000 a b\x1c\n",), (" \t\u2003",)], "s string")
    assert [tuple(r) for r in df.select(text.strip(F.col("s")), text.is_blank(F.col("s")), text.without_white(F.col("s"))).collect()] == [("a b", False, "ab"), ("", True, "")]


def test_injected(spark):
    said = {"<environment_context>a\nb</environment_context> \n": True, "<Environment_Context>x</Environment_Context>": True, "see <environment_context>x</environment_context>": False, "<example>x</example>": False, "<user_instructions>x</user_instructions>": True}
    df = spark.createDataFrame([(s,) for s in said], "s string")
    assert [r[0] for r in df.select(text.is_injected(F.col("s"))).collect()] == list(said.values())


def test_yolo_and_kill_cause(spark):
    rows = spark.createDataFrame([("a", "keep"), ("b", "")], "session_file string, suggested string")
    assert {tuple(r) for r in direction.yolo(rows).select("session_file", "decision").collect()} == {("a", "keep"), ("b", "drop")}
    assert direction.yolo(rows.where("session_file = 'b'")).first()["decision"] == "keep"
    report = funnel.report(frame(spark, [row(1, first_msg_chars=5000), row(2, user_chars=[30, 3])]), params.merge())
    assert direction.kill_cause(report).first()["keys"] == "max_first_msg_chars,min_user_msg_chars"


def test_greedy_plain_itself():
    assert list(itertools.chain(plain_greedy(["aaaaa", "aaaaa"], 1.0).values())) == [None, 0]


def test_near_pairs_beyond_the_opening(spark, tmp_path):
    """Pairs by brute force, on texts that differ in their first 300 characters or only after them."""
    import random

    rng = random.Random(4)
    draw = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    tails, heads = [draw(1600) for _ in range(3)], [draw(300) for _ in range(3)]
    texts = [draw(300) + x for x in tails for _ in range(2)] + [x + draw(1600) for x in heads for _ in range(2)] + ["", "", draw(2500)]
    texts.append(texts[-1][:2000] + draw(900))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    sigs = ["".join(x[: dedup.HEAD_CHARS].split()) for x in texts]
    grams = [{x[i : i + 5] for i in range(max(1, len(x) - 4))} for x in sigs]
    want = {(a, b) for b in range(len(texts)) for a in range(b) if len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= 0.6}
    assert {(0, 1), (2, 3), (4, 5)} <= want and not {(6, 7), (8, 9), (10, 11)} & want
    assert {(r["a"], r["b"]) for r in queries.near_dedup_edges(spark, str(tmp_path)).collect()} == want
