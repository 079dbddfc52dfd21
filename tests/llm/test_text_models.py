"""Token counts, sampled segmentations, quality, language models and language identification."""

import math
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from siltworks.llm import common, langid, lm, pieces, quality, tokens

WORD_BPE, PIECE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, score string, n long"
ODD = [None, "", "Hello <|endoftext|>World<|startoftext|>", "İstanbul Ça va? it's we'LL ''s \x1c\x1d x 漢字 Σίσυφος 12३४ 😀!!", "a" * 5000, "<|ENDOFTEXT|> \n\n", "dup", "dup"]


def odd(spark):
    return spark.createDataFrame([(i if i != 4 else None, t, "x", 1) for i, t in enumerate(ODD)] + [(6, "dup", "x", 1)], DOCS)


def test_token_counts_equal_the_library(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "FLUSH", 50)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", F.lit("").alias("score"), F.lit(1).cast("long").alias("n")).union(odd(spark))
    t = Tokenizer.from_file(WORD_BPE)
    want = Counter((r["doc_id"], len((r["text"] or "").encode()), len(t.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
    for head in (0, 300):
        assert Counter(map(tuple, tokens.token_counts(docs, WORD_BPE, head=head).collect())) == want
    assert tokens.token_counts(docs.limit(0), WORD_BPE).count() == 0


def test_most_frequent(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([100, 50, 50, 2, 1, 1, 1])], "w long, n long")
    assert common.most_frequent(df, "n", 3).count() == 3 and common.most_frequent(df, "n", 2).count() == 1 and common.most_frequent(df, "n", 99).count() == 7 and common.most_frequent(df, "n", 0).count() == 0


def test_written_tables_leave_no_shuffle_files(spark):
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()) if f.getName().startswith("shuffle_")}
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before, setting = files(), spark.conf.get(common.CLEANUP)
    df = spark.range(5000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
    table = common.materialize(df, "shuffled")
    left = files() - before
    for _ in range(50):
        if not left:
            break
        time.sleep(0.1)
        left = files() - before
    assert not left and spark.conf.get(common.CLEANUP) == setting
    assert table.count() == 10 and df.count() == 10


def segmentations(enc, text):
    """All segmentations of a text of known characters and their shares."""
    spelled = {b.decode("utf-8", "ignore").replace(" ", "▁"): i for i, b in enumerate(enc.pieces.bytes) if i > 258}
    s = "▁" + text.replace(" ", "▁")

    def rest(k):
        if k == len(s):
            return [((), 0.0)]
        return [((spelled[s[k : k + n]], *t), v - math.log(spelled[s[k : k + n]] + 1)) for n in range(1, 17) if k + n <= len(s) and s[k : k + n] in spelled for t, v in rest(k + n)]

    found = rest(0)
    total = sum(math.exp(v) for _, v in found)
    return {t: math.exp(v) / total for t, v in found}


def test_sampling_without_replacement():
    enc, n, k = pieces.Encoder(PIECE_BPE, 3), 6000, 3
    share = segmentations(enc, "in gra")
    first, among, total = Counter(), Counter(), 0.0
    for drawn in enc.sample(["in gra"] * n, map(str, range(n))):
        ids = [tuple(d[0].tolist()) for d in drawn]
        assert len(set(ids)) == len(ids) == min(k, len(share))
        assert all(abs(math.exp(d[1]) - share[i]) < 1e-9 for i, d in zip(ids, drawn, strict=True))
        first[ids[0]] += 1
        among.update(ids)
        total += sum(math.exp(d[1] - d[2]) for d in drawn)
    for t, p in share.items():
        assert abs(first[t] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4
    assert abs(total / n - 1) < 0.02  # shares over inclusion probabilities add up to one
    want = dict.fromkeys(share, 0.0)
    for a, pa in share.items():
        for b, pb in share.items():
            if a != b:
                both, left = pa * pb / (1 - pa), 1 - pa - pb
                want[a] += both
                want[b] += both
                for c, pc in share.items():
                    if c not in (a, b) and left > 1e-12:
                        want[c] += both * pc / left
    for t, p in want.items():
        assert abs(among[t] / n - p) < 5 * math.sqrt(max(p * (1 - p), 0) / n) + 1e-3


def test_segmentations(spark, monkeypatch):
    import sentencepiece

    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate([*ODD, " a  b ", "x▁y", "\n", "a b c d e f g"])], DOCS)
    out = pieces.encode(docs, PIECE_BPE, samples=3)
    assert out.columns == ["doc_id", "text", "score", "n", "segmentations"]
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    seen = out.collect()
    for r in seen:
        ids = [tuple(s["ids"]) for s in r["segmentations"]]
        assert len(ids) == len(set(ids)) >= 1
        for s in r["segmentations"]:
            assert s["decoded_ok"] and s["n_pieces"] == len(s["ids"]) and s["log_inclusion"] <= 0
            if r["text"]:
                assert sp.decode(list(s["ids"])) == r["text"].replace("▁", " ")
    monkeypatch.setattr(pieces, "CHUNK_WORDS", 3)  # how rows are dealt changes nothing
    again = pieces.Encoder(PIECE_BPE, 3)
    for r, drawn in zip(seen, again.sample([r["text"] for r in seen], [str(r["doc_id"]) for r in seen]), strict=True):
        assert [d[0].tolist() for d in drawn] == [s["ids"] for s in r["segmentations"]]
    assert pieces.encode(docs.limit(0), PIECE_BPE).count() == 0


def test_spaces_before_a_text_are_pieces_too():
    """The space that encoding puts before a text and the text's own spaces make one run, of which every piece can be drawn."""
    enc = pieces.Encoder(PIECE_BPE, 400)
    texts = [" ", " a", "  a", "   ", " in", "a  b", "a "]
    for text, drawn in zip(texts, enc.sample(texts, texts), strict=True):
        share = segmentations(enc, text)
        assert {tuple(d[0].tolist()) for d in drawn} == set(share)
        assert all(abs(math.exp(d[1]) - share[tuple(d[0].tolist())]) < 1e-9 for d in drawn)


def test_lattices_are_made_once_for_each_unit(monkeypatch):
    enc = pieces.Encoder(PIECE_BPE, 3)
    words = ["grain,", "grain;", "bread,", "bread;", "grain", "bread"]
    texts = [" ".join(words), *words, *filter(None, ODD)]
    drawn = list(enc.sample(texts[:1], texts[:1]))
    assert enc.lattices.first.n == len("▁grain▁bread,;")  # no piece reaches from a letter to these marks
    drawn += enc.sample(texts[1:], texts[1:])
    monkeypatch.setattr(pieces, "CHUNK_WORDS", 3)
    monkeypatch.setattr(pieces, "KEEP_NODES", 0)  # dropping them changes nothing
    again = pieces.Encoder(PIECE_BPE, 3).sample(texts, texts)
    for of_text, same in zip(drawn, again, strict=True):
        assert [(ids.tolist(), *rest) for ids, *rest in of_text] == [(ids.tolist(), *rest) for ids, *rest in same]


def test_pieces_query_gives_whole_segmentations(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    rows = pieces.op6_pieces(spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        for k in range(1, r["n_segmentations"] + 1):
            assert r[f"n_pieces_{k}"] == len(r[f"ids_{k}"]) and sp.decode(list(r[f"ids_{k}"])) == texts[r["doc_id"]].replace("▁", " ")


def test_quality_against_labels(spark):
    got = quality.op1_quality(spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").toPandas()
    assert got[got["quality"] == 1]["quality_keep"].mean() >= 0.97
    assert got[got["quality"] == 0]["quality_keep"].mean() <= 0.25


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.8
    right = np.array([0.95, 0.8, 0.7, 0.9])
    said = np.where(rng.random((20000, 4)) < right, truth[:, None], ~truth[:, None])
    votes = np.where(rng.random((20000, 4)) < 0.2, quality.NONE, np.where(said, quality.GOOD, quality.BAD))
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_labels(patterns, n.astype(float))
    assert abs(model.good - 0.8) < 0.03 and np.allclose(model.p[:, 1, quality.GOOD], right, atol=0.04)
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.93


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, "x", 1), (None, "", "x", 1), (2, "The cat and the dog are in the house, and it is good.", "x", 1), (2, "x" * 100000, "x", 1)] * 2, DOCS)
    out = quality.classify(docs, quality.fit(docs))
    assert out.columns == ["doc_id", "text", "score", "n", "quality_score", "quality_label", "quality_keep"] and out.count() == 8
    none = docs.limit(0)
    assert quality.classify(none, quality.fit(none)).count() == 0
    assert 0 <= quality.classify(docs, quality.fit(none)).first()["quality_score"] <= 1


def plain_scores(texts, target, scored):
    """The two models of lm.py with dictionaries: of each text that is scored, its tokens and its score."""
    one, two = ([Counter(), Counter()] for _ in range(2))
    for which, docs in enumerate((texts, target)):
        for t in docs:
            e = (t or "").split()
            one[which].update(e + [""] * bool(e))
            two[which].update(zip(["", *e], e, strict=False))
    n, v = [sum(c.values()) for c in one], len((one[0] | one[1]).keys() - {""}) + 2
    f = [n[1] / n[0] if n[0] and n[1] else 1.0, 1.0]

    def log(which, h, w):
        uni = (one[which][w] * f[which] + lm.A) / (n[which] * f[which] + lm.A * v)
        return math.log((two[which][h, w] * f[which] + lm.MU * uni) / (one[which][h] * f[which] + lm.MU))

    for t in scored:
        e = (t or "").split()
        yield len(e), sum(log(0, h, w) - log(1, h, w) for h, w in zip(["", *e], e, strict=False)) / len(e) if e else None


def agree(got, want):
    for (n, score), (m, wanted) in zip(got, want, strict=True):
        assert n == m and (score is None if wanted is None else score == pytest.approx(wanted, abs=1e-9))


def test_lm_equals_plain(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 7)
    texts = ["the cat sat on the mat", "the dog sat", None, "", "cat dog cat dog zebra", "the the the", "  ", "rare words here", "the dog sat"]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], DOCS)
    target, extra = docs.where("doc_id < 2"), spark.createDataFrame([(None, "the new dog", "x", 1), (0, "cat", "x", 1)], DOCS)
    for out in (lm.score(docs, lm.fit(docs, target)), lm.score(docs, target_ids=spark.createDataFrame([(0,), (1,), (1,), (None,), (99,)], "id long"))):
        assert out.columns == ["doc_id", "text", "score", "n", "n_scored", "ce_difference"]
        agree([(r["n_scored"], r["ce_difference"]) for r in out.orderBy("doc_id").collect()], plain_scores(texts, texts[:2], texts))
    monkeypatch.setattr(lm, "MASK_BYTES", 0)  # too many marks to send to all
    # Ids that repeat or are null, a narrow choice of columns, columns of the names that are added.
    more = docs.unionByName(extra).withColumnsRenamed({"score": "ce_difference", "n": "n_scored"})
    out = lm.score(more, keep=["text", "n_scored"], target_ids=target.select("doc_id"))
    assert out.columns == ["text", "n_scored", "ce_difference"]
    order = lambda rows: sorted(rows, key=lambda r: (r[0] or "", r[0] is None))
    all_texts = [*texts, "the new dog", "cat"]
    want = order(zip(all_texts, plain_scores(all_texts, [*texts[:2], "cat"], all_texts), strict=True))
    agree([r[1:] for r in order(map(tuple, out.collect()))], [w for _, w in want])
    none = docs.limit(0)
    assert lm.score(none, lm.fit(none, none)).count() == 0 and lm.score(none, target_ids=target.select("doc_id")).count() == 0
    agree([(r["n_scored"], r["ce_difference"]) for r in lm.score(docs, lm.fit(none, none)).orderBy("doc_id").collect()], plain_scores([], [], texts))


def test_lm_counts_every_bigram(spark, monkeypatch):
    """Over a million bigrams in chunks and ranges that are small, and texts of neither model."""
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 60_000)
    monkeypatch.setattr(lm, "RANGE_TOKENS", 1 << 16)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.05, 3000) % 300_000) for _ in range(200)] + [" ".join(f"u{i}" for i in range(at, at + 50_000)) for at in range(0, 1_000_000, 50_000)] + ["y" * 100 + " z", "dup dup", "dup dup", "", None]
    new, n_target = ["never w1 w2 seen w1", "w1 never"], 60
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], DOCS)
    of_docs = [i for i in range(len(texts)) if i < 5 or i >= 219]
    scored = docs.where("doc_id < 5 or doc_id >= 219").union(spark.createDataFrame([(1000 + i, t, "x", 1) for i, t in enumerate(new)], DOCS))
    model = lm.fit(docs, docs.where(f"doc_id < {n_target}"))
    assert model.counts.agg(F.sum("n")).first()[0] > 1_200_000 and model.parts > 8
    rows = lm.score(scored, model).orderBy("doc_id").collect()
    agree([(r["n_scored"], r["ce_difference"]) for r in rows], plain_scores(texts, texts[:n_target], [texts[i] for i in of_docs] + new))


def test_lm_separates(spark):
    got = lm.op9_lm(spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").toPandas().dropna()
    assert got[got["quality"] == 0]["ce_difference"].median() > got[got["quality"] == 1]["ce_difference"].quantile(0.95)


def test_language_held_out(spark):
    got = langid.op10_langid(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() >= 0.95 and got["score"].between(0, 1).all()


def test_network_equals_plain_convolution():
    net = langid.train([b"abc def", b"xyz uvw qq"], ["a", "b"], steps=5)
    text = "abc xyz é" * 60
    data = np.frombuffer(text.encode() + b"\0" * 3, np.uint8)
    logs, sizes = [], []
    for at in range(0, len(data) - 3, langid.WINDOW):
        n = min(langid.WINDOW, len(data) - 3 - at)
        top = [max((sum(net.e[data[at + i + k]] @ w[k] for k in range(len(w))))[f] for i in range(n)) for w in net.w for f in range(langid.FILTERS)]
        z = np.maximum(np.array(top) + net.b, 0) @ net.v + net.c
        logs.append(z - z.max() - math.log(np.exp(z - z.max()).sum()))
        sizes.append(n)
    p = langid._softmax(np.average(logs, axis=0, weights=sizes)[None])[0]
    lang, score = langid.classify(net, [text])
    assert lang == [net.languages[int(p.argmax())]] and score[0] == pytest.approx(p.max(), abs=1e-4)


def test_language_edges(spark):
    net = langid.train([b"the cat", b"der hund"], ["en", "de"], steps=20)
    docs = spark.createDataFrame([(1, None, "x", 1), (None, "", "x", 1), (2, "123 !?", "x", 1), (2, "the cat " * 20000, "x", 1)], DOCS)
    out = langid.predict(docs, net)
    assert out.columns == ["doc_id", "text", "n", "lang_pred", "score"]
    assert [(r["lang_pred"], r["score"]) for r in out.collect()[:3]] == [("und", 0.0)] * 3 and out.collect()[3]["lang_pred"] in ("en", "de")
    assert langid.predict(docs.limit(0), net).count() == 0
    for nothing in (docs.withColumn("lang", F.lit(None).cast("string")), docs.withColumn("lang", F.lit("en")).limit(0)):
        net = langid.fit(nothing)
        assert net.languages == [] and {(r["lang_pred"], r["score"]) for r in langid.predict(docs, net).collect()} == {("und", 0.0)}


def test_rare_language_is_learned(spark):
    texts = [("the cat and the dog", "en")] * 300 + [("der hund und die katze", "de")] * 3
    net = langid.fit(spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string"), rows=8)
    assert net.languages == ["de", "en"]
