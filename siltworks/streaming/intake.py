"""Pooling new session files as they arrive. An addition: the batch operators need no stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltworks.sources import sessions


def watch(spark: SparkSession, root: str, agent: str, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append the feature rows of files that are new below ``root`` to the Parquet table ``out``.

    Each batch is the batch code on that batch's files; a file is read once.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    arriving = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(root)

    def pool(batch: DataFrame, batch_id: int) -> None:
        files = batch.select(F.regexp_replace("path", r"\Afile:(//)?(?=/)", "").alias("session_file"), F.lit(agent).alias("agent"), "content")
        view = sessions.session_view(sessions.raw_lines(files), files.select("session_file", "agent"))
        view.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    writer = arriving.writeStream.foreachBatch(pool).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
