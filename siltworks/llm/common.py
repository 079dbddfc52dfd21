"""Helpers shared by the corpus operators: shared storage, sizes and Arrow views."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Whether shuffle files are deleted once the query that wrote them has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only where the session names none and runs on one machine (as tests do) a
    temporary folder is made and set for the rest of the session; a cluster must name one.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="siltworks-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The table survives lost executors, so later stages re-read it instead of
    recomputing what led to it. ``release`` removes the session's tables.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    # What leads to the table is not needed after it: Spark deletes the shuffle files of this write as it ends, not when the driver's JVM happens to collect its plan.
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _written.append(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every table ``materialize`` has written so far."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(hadoop).delete(path, True)


def give_back_heap(spark: SparkSession) -> None:
    """Have the executors' JVMs collect their garbage, after which they return the heap that it took.

    Else heap that earlier steps have grown stays beside what Python workers need
    next. One task for each core, so every executor that is there gets some.
    """
    n = spark.sparkContext.defaultParallelism
    collected = F.java_method(F.lit("java.lang.System"), F.lit("gc")).alias("collected")
    spark.range(0, n, 1, n).select(collected).write.format("noop").mode("overwrite").save()


def word_count(text: Column) -> Column:
    """Number of ASCII-white-space separated words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def most_frequent(df: DataFrame, count_col: str, most: int) -> DataFrame:
    """Rows of the highest counts, ``most`` of them at most.

    A histogram of at most some hundred steps (eighths of powers of two) decides,
    so neither sorting nor a task's own best rows reach the driver. Of the step
    that would hold too many, a part is chosen by hash, less by four standard
    deviations than there is room for.
    """
    step = F.floor(F.log2(F.col(count_col)) * 8).cast("int")
    held, cut, part = 0, None, 0.0
    for s, n in sorted(((r[0], r[1]) for r in df.groupBy(step.alias("s")).agg(F.count("*")).collect()), reverse=True):
        room = most - held
        cut, part = s, 1.0 if room >= n else max(0.0, room - 4 * room**0.5) / n
        held += n
        if held > most:
            break
    if cut is None:
        return df.limit(0)
    chosen = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)) < F.lit(int(part * (1 << 30)))
    return df.where((step > cut) | ((step == cut) & chosen))


def trimmed(run):
    """``run`` over batches, after which the worker gives back the memory that it no longer uses, as it may idle through other stages."""

    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # not every C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(n: int, per: int) -> int:
    """How many buckets of about ``per`` rows hold ``n`` rows; at least one."""
    return max(1, -(-int(n) // per))


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str | None]:
    return column.to_pylist()


def matrix_of(column: pa.ChunkedArray | pa.Array, width: int, dtype) -> np.ndarray:
    """A list column without null elements as rows of ``width``; short rows are padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False) if len(column) else np.zeros(0, int)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width).astype(dtype, copy=False)
    out = np.zeros((len(lengths), width), dtype)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, np.arange(len(flat)) - starts] = flat
    return out
