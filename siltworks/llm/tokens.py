"""Token counts of whole texts without token ids.

A tokenizer that cuts text into pre-tokens and splits each on its own gives a
pre-token the same number of pieces wherever it stands. So:

1. Pre-tokens are counted over all texts (map-side first), and every distinct
   pre-token is split once by the tokenizer library. The result is a table
   (pre-token, pieces).
2. The per-document frequencies are joined to that table and summed. The most
   frequent ``HEAD`` pre-tokens, a number that does not grow with the input and
   with a bound on their length, are sent to all tasks and joined while the
   frequencies are made. The others, each rare, are joined by a shuffle.

Special strings inside a text are single tokens, as the library's default has
it: the text is cut at them before anything else.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from tokenizers import Tokenizer

from .common import materialize, most_frequent, table

#: Frequent pre-tokens that every task holds, and the longest (in characters) among them.
HEAD, HEAD_CHARS = 1 << 18, 48
#: Distinct pre-tokens that a task counts before it hands them in.
FLUSH = 1 << 20
LIMIT = 2048


class PreTokenizer:
    """The tokenizer file's own cutting of a text, down to the strings that its model splits.

    Taken from the file: special strings, the normalizer (through the library)
    and the pattern of the pre-tokenizer. Only files of this make are accepted:
    a Split on a pattern that keeps the matches, then bytes.
    """

    def __init__(self, path: str):
        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        split = steps[0]
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or split["behavior"] != "Removed" or not split["invert"] or steps[1]["add_prefix_space"] or steps[1]["use_regex"]:
            raise ValueError(f"{path}: not a Split and ByteLevel pre-tokenizer")
        # White space by its Unicode property, as the library reads \\s.
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError(f"{path}: added tokens with options are not supported")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        #: Latin letters without combining marks: in composed form already, and alike in all versions of Unicode.
        self.plain = re.compile("[\x00-\u024f\u2010-\u2027\u20ac]*\\Z")
        if [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: not an NFC, Replace and Lowercase normalizer")

    def words(self, text: str) -> list[str]:
        if self.plain.match(text):  # runs of white space only part matches, so they may stay
            return self.pattern.findall(text.lower())
        text = self.tokenizer.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def cut(self, text: str) -> tuple[int, list[str]]:
        """How many special strings there are, and the pre-tokens between them."""
        if self.special is not None and (found := self.special.findall(text)):
            return len(found), [w for part in self.special.split(text) if part for w in self.words(part)]
        return 0, self.words(text)

    def pieces(self, words: list[str]) -> list[int]:
        """Number of pieces of each pre-token, encoded on its own."""
        return [len(e.ids) for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]


_made: dict[str, PreTokenizer] = {}


def pretokenizer(path: str) -> PreTokenizer:
    """One for each worker process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _made:
        _made[path] = PreTokenizer(path)
    return _made[path]


def word_pieces(docs: DataFrame, text_col: str, path: str) -> DataFrame:
    """word, n (over all texts), pieces, of every distinct pre-token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = pretokenizer(path).cut, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(cut(text)[1])
                if len(seen) > FLUSH:
                    yield pa.record_batch([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])
                    seen = Counter()
        yield pa.record_batch([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pretokenizer(path).pieces
        for batch in batches:
            yield pa.record_batch([*batch.columns, pa.array(pieces(batch.column(0).to_pylist()), pa.int32())], names=["word", "n", "pieces"])

    words = docs.select(docs[f"`{text_col}`"].cast("string").alias("t")).mapInArrow(count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).mapInArrow(split, "word string, n long, pieces int")


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD) -> DataFrame:
    """id, n_bytes and n_tokens (long) of every row.

    Null and empty texts have no bytes and no tokens. Rows are told apart by
    position, so rows that repeat, also with the same or a null id, each keep
    their own count. Texts of any length are taken whole. An empty table gives an
    empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = materialize(word_pieces(docs, text_col, path), "pieces")
    frequent = most_frequent(pieces.where(F.length("word") <= HEAD_CHARS), "n", head)
    top = frequent.select("word", "pieces").toPandas()  # at most ``head`` rows of bounded length
    known = spark.sparkContext.broadcast(dict(zip(top["word"].tolist(), top["pieces"].tolist(), strict=True)))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].cast("string").alias("t"))
    rows = rows.select("row", "id", F.coalesce(F.octet_length("t"), F.lit(0)).cast("long").alias("n_bytes"), "t")
    out = StructType([StructField(f.name, f.dataType) for f in rows.schema if f.name != "t"]).add("word", "string").add("n", "long")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, sizes = pretokenizer(path).cut, known.value
        for batch in batches:
            sums, rare_row, rare_word, rare_n = [], [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                total, words = cut(text) if text else (0, [])
                for word, n in Counter(words).items():
                    size = sizes.get(word)
                    if size is None:
                        rare_row.append(row)
                        rare_word.append(word)
                        rare_n.append(n)
                    else:
                        total += n * size
                sums.append(total)
            # A row for each text with what is known, and one for each of its rare words.
            none = len(rare_row)
            yield pa.record_batch([*batch.columns[:3], pa.nulls(len(sums), pa.string()), pa.array(sums, pa.int64())], names=out.names)
            yield pa.record_batch([pa.array(rare_row, pa.int64()), pa.nulls(none, batch.schema.field(1).type), pa.nulls(none, pa.int64()), pa.array(rare_word, pa.string()), pa.array(rare_n, pa.int64())], names=out.names)

    counted = materialize(rows.mapInArrow(tally, out), "tallies")
    head_sums = counted.where("word IS NULL").select("row", "id", "n_bytes", "n")
    rare = counted.where("word IS NOT NULL").join(pieces.select("word", "pieces"), "word").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    return head_sums.join(rare, "row", "left").select("id", "n_bytes", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n_tokens"))


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
