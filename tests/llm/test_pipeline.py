"""The five stages on the smallest table, each against what its operator says."""

import corpus_pipeline
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from siltworks.llm import mixing, quality, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    out["input"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("p") / name)
        stage(spark, docs, DATA).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_shape(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_dedup", "mix", "encode"]
    assert all(stages[n].columns == COLUMNS for n, _ in corpus_pipeline.STAGES[:-1])
    assert stages["encode"].columns == ["doc_id", "source", "segmentations"]


def test_decisions_take_effect(spark, stages):
    docs = stages["input"]
    kept = quality.classify(docs, quality.fit(docs)).where("quality_keep").select("doc_id")
    assert kept.exceptAll(stages["quality"].select("doc_id")).isEmpty() and 0 < stages["quality"].count() < docs.count()
    assert stages["language"].count() >= 0.97 * stages["quality"].count()
    groups = simhash.classes(stages["language"]).select("component_id").distinct()  # ids are distinct in this table
    assert groups.count() == stages["near_dedup"].count() and groups.exceptAll(stages["near_dedup"].select("doc_id")).isEmpty()
    mixed = mixing.sample_mixture(stages["near_dedup"])
    assert mixed.exceptAll(stages["mix"]).isEmpty() and mixed.count() == stages["mix"].count() == stages["encode"].count()
    assert stages["encode"].where("exists(segmentations, s -> NOT s.decoded_ok)").isEmpty()


def test_empty_and_nulls(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "the cat and the dog are in the house and it is good " * 9, "en", None, 3)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame((out := stage(spark, docs, DATA)).collect(), out.schema)


def test_columns_with_the_names_of_predictions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumns({c: F.lit(7.5) for c in ("score", "lang_pred", "quality_score", "quality_label", "quality_keep")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == [*COLUMNS, "score", "lang_pred", "quality_score", "quality_label", "quality_keep"]
    assert 0 < docs.count() == docs.where("score = 7.5 AND lang_pred = 7.5 AND quality_score = 7.5 AND quality_label = 7.5 AND quality_keep = 7.5").count()


@pytest.mark.parametrize("name", ["language", "near_dedup", "encode"])
def test_stages_begin_with_a_collection(spark, name, monkeypatch):
    for module, call in ((corpus_pipeline.langid, "fit"), (corpus_pipeline.simhash, "keep_one"), (corpus_pipeline.pieces, "encode")):
        monkeypatch.setattr(module, call, lambda *_, **__: (_ for _ in ()).throw(InterruptedError))
    docs, sc = spark.read.parquet(f"{DATA}/documents.parquet"), spark.sparkContext
    beans = sc._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    before = full()
    with pytest.raises(InterruptedError):
        dict(corpus_pipeline.STAGES)[name](spark, docs, DATA)
    assert full() > before
