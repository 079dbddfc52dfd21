"""From raw documents to sampled encodings, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. Its result is
written as Parquet and read again as the next stage's docs. All stages but the
last return the columns of ``documents``. Stages that run Python behind others
first have the executors give back the heap that those have grown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import langid, mixing, pieces, quality, simhash
from siltworks.llm.common import give_back_heap, materialize, table

#: A text whose language is less certain than this is rejected, as is one without a letter.
LEAST_LANGUAGE = 0.5


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named by position, which no prediction replaces, and those names by the old ones."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _renamed(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(n).alias(c) for c, n in names.items()])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier, fitted on these rows, does not reject."""
    rows, names = _numbered(docs)
    return _renamed(quality.classify(rows, quality.fit(docs), text_col=names["text"]).where("quality_keep"), names)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is found with enough certainty. Learns from the labelled rows; without any, none is rejected."""
    give_back_heap(spark)
    net = langid.fit(docs)
    if not net.languages:
        return docs
    rows, names = _numbered(docs)
    found = langid.predict(rows, net, text_col=names["text"])
    return _renamed(found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)), names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each group of near-duplicates, that of the smallest doc_id."""
    give_back_heap(spark)
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mixture of sources takes them."""
    return mixing.sample_mixture(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and two sampled segmentations of each row."""
    import public_tokenizers

    give_back_heap(spark)
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id", "source"])


STAGES = [
    ("quality", keep_good),
    ("language", keep_known_languages),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode_pieces),
]

#: The classifiers, fingerprints and sampled encodings have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
