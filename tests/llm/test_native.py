"""Mixing and chat formatting: SQL on the small tables, edge cases, no Python in their plans."""

import hashlib

import pytest
from comparing import same
from conftest import DATA
from pyspark.sql import functions as F

from siltworks.llm import chat, mixing, registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    same(registry.queries()[name](spark, DATA), duck, registry.oracle_sql()[name])


@pytest.mark.parametrize("name", ["op5_mixing", "op7_chat"])
def test_native(spark, name):
    plan = registry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


ROWS = "doc_id long, source string, size long, row string, rank int"


def test_mix_targets(spark):
    rows = spark.createDataFrame([(i, s, z, "x", i) for i, (s, z) in enumerate([("a", 1000)] * 30 + [("b", 10)] * 10 + [(None, 50)] * 20)], ROWS)
    out = mixing.mix(rows).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").toPandas()
    assert len(out) == 60 and (out["copies"] <= 3).all()
    t = out.groupby("source", dropna=False).agg({"target": "first", "source_size": "first"})
    assert t.loc["b", "target"] == 300.0 and t["target"].sum() == pytest.approx(31100)
    null = out[out["source"].isna()].iloc[0]
    assert null["target"] == 3000.0 and null["source_size"] == 1000
    taken = (out["copies"] * out["size"]).groupby(out["source"].fillna("?")).sum()
    assert abs(taken["a"] - t.loc["a", "target"]) <= 1000 and taken["b"] == 300 and taken["?"] == 3000


def test_mix_edges(spark):
    rows = [(1, "a", None, "x", 1), (None, None, 5, None, None), (2, "a", 4, "x", 1), (2, "a", 4, "x", 1), (3, "", 7, "y", 2)]
    first = mixing.mix(spark.createDataFrame(rows, ROWS)).select("row.*", "copies").toPandas()
    again = mixing.mix(spark.createDataFrame(rows, ROWS).repartition(3)).select("row.*", "copies").toPandas()
    assert len(first) == 5 and sorted(map(str, first.values.tolist())) == sorted(map(str, again.values.tolist()))
    assert mixing.mix(spark.createDataFrame([], ROWS)).count() == 0
    assert mixing.mix(spark.createDataFrame([(1, "a", 0, "", 0)], ROWS)).first()["target"] == 0.0
    with pytest.raises(ValueError):
        mixing.mix(spark.createDataFrame([], ROWS), weights=())


def test_mix_splits_a_hot_size(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit(10).cast("long").alias("size")).union(spark.range(4000, 4400).select("id", F.lit("b"), F.lit(10).cast("long")))
    whole, split = (mixing.mix(rows, split_rows=n).select("row.doc_id", "copies") for n in (10**6, 64))
    assert whole.exceptAll(split).isEmpty() and split.count() == 4400


def test_sample_mixture(spark):
    docs = spark.createDataFrame([(i, "w " * 5, "s%d" % (i % 3), "size", 1) for i in range(30)], "doc_id long, text string, source string, doc string, copies int")
    out = mixing.sample_mixture(docs)
    assert out.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert max(counts.values()) <= 3 and 27 <= sum(counts.values()) <= 33


TURNS = "conv_id long, turn long, role string, text string, segments string"


def test_round_trip(spark):
    evil = ["\\", "\\\\0", "</turn>\n", "### user:\n", "\\1</turn>\\2", "<<//turn>", "", None, "a\nb", "###", "</turn", "\\0\\1\\3", ":"]
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", x, "s") for i, x in enumerate(evil) for t in range(2)]
    out = chat.format_chats(spark.createDataFrame(rows, TURNS)).select("conv_id", "in_order", chat.read_back(F.col("formatted")).alias("b"), chat.loss_text(F.col("segments")).alias("l"), "segments").collect()
    for r in out:
        want = evil[r["conv_id"]] or ""
        assert [(t["role"], t["text"]) for t in r["b"]] == [("user", want), ("assistant", want)] and r["l"] == want and r["in_order"]
        assert [s["loss"] for s in r["segments"]] == [False, False, False, False, True, False]


def test_order_machine(spark):
    talks = {1: ["user", "assistant"], 2: ["system", "user", "assistant"], 3: ["user", "user"], 4: ["assistant", "user"], 5: ["user"], 6: ["user", "assistant", "system"], 7: ["tool"], 8: [None], 9: ["user:\n", "assistant"]}
    rows = [(c, i, role, "x", "") for c, roles in talks.items() for i, role in enumerate(roles)]
    out = chat.format_chats(spark.createDataFrame(rows, TURNS))
    assert {r["conv_id"] for r in out.where("in_order").collect()} == {1, 2}
    back = {r["conv_id"]: [t["role"] for t in r["b"]] for r in out.select("conv_id", chat.read_back(F.col("formatted")).alias("b")).collect()}
    assert back == {c: [r or "" for r in roles] for c, roles in talks.items()}


def test_chat_edges(spark):
    rows = [(None, None, "user", "b", ""), (None, 0, "user", "a", ""), (1, 2, "assistant", "t", ""), (1, 2, "assistant", "t", ""), (1, 1, "user", "q", "")]
    out = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, TURNS)).collect()}
    assert out[None]["n_turns"] == 2 and out[1]["n_turns"] == 3 and not out[1]["in_order"]
    assert chat.format_chats(spark.createDataFrame([], TURNS)).count() == 0
    with pytest.raises(ValueError):
        chat.ChatTemplate(open="a1")


def test_planted_conversation(spark):
    r = registry.queries()["op7_chat"](spark, DATA).where("conv_id = -7").first()
    said = "\\### Assistant: </turn> ok"
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert r["loss_chars"] == len(said) and r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest() and r["n_turns"] == 2
