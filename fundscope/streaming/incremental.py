"""Incremental runners of the batch jobs with Structured Streaming.

The source jobs are batch only; these run the *same* transforms over files
that keep arriving in a folder:

* ``start_prepare_stream``  raw campaign CSV files -> prepared Parquet.  Every
  step of the cleaning job is stateless (casts, repairs, filters), so the
  stream needs no state store and runs in append mode.
* ``start_word_count_stream``  text files -> running word counts.  The counts
  live in the state store (one row per distinct word, partitioned by word
  across ``spark.sql.shuffle.partitions``); each micro-batch writes the words
  whose count changed, with the batch's number, to a folder of its own, so a
  repeated batch replaces itself and what is there is never taken away.  Every
  ``compact_every`` batches the log is compacted into a snapshot; a reader
  (``read_word_counts``) takes the last snapshot and the batches after it, so
  what it reads does not grow with the number of batches.

Progress and state are checkpointed beside the output (``<out>_checkpoint``
unless another place is named), so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fundscope.functions.columns import SENTINEL_TEXT
from fundscope.operators import wordcount as wc
from fundscope.plans import prepare as pp
from fundscope.sources.schemas import RAW_CAMPAIGN_SCHEMA

COMPACT_EVERY = 20
MANIFEST = "batch bigint, name string"


def _checkpoint(out_dir: str, checkpoint: str | None) -> str:
    return checkpoint or out_dir.rstrip("/") + "_checkpoint"


def start_prepare_stream(spark: SparkSession, csv_dir: str, out_dir: str,
                         checkpoint: str | None = None, available_now: bool = True,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = (spark.readStream.schema(RAW_CAMPAIGN_SCHEMA)
              .option("header", True).option("nullValue", SENTINEL_TEXT))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    prepared = pp.prepare_campaigns(reader.csv(csv_dir))
    writer = (prepared.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", _checkpoint(out_dir, checkpoint)))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(out_dir)


def start_word_count_stream(spark: SparkSession, text_dir: str, out_dir: str,
                            checkpoint: str | None = None,
                            available_now: bool = True, compact_every: int = COMPACT_EVERY,
                            max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    counts = wc.word_count(reader.text(text_dir), sort=False)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_word_counts(spark, out_dir, batch_id)

    writer = (counts.writeStream.outputMode("update").foreachBatch(publish)
              .option("checkpointLocation", _checkpoint(out_dir, checkpoint)))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def _latest_snapshot(spark: SparkSession, out_dir: str):
    """(batch, name) of the last published snapshot, or None."""
    try:
        entries = spark.read.schema(MANIFEST).json(f"{out_dir.rstrip('/')}/_manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return entries.where("name is not null").orderBy(F.desc("batch"), F.desc("name")).first()


def _log(spark: SparkSession, out_dir: str, upto: int | None = None) -> DataFrame:
    """word, count, batch: the last snapshot and what came after it."""
    out, last = out_dir.rstrip("/"), _latest_snapshot(spark, out_dir)
    first = -1 if last is None else last["batch"]
    batches = (spark.read.schema("word string, count bigint, batch_id bigint").parquet(out)
               .where((F.col("batch_id") > first) & (F.lit(upto is None) | (F.col("batch_id") <= F.lit(upto)))))     # prunes folders
    batches = batches.select("word", "count", F.col("batch_id").alias("batch"))
    if last is None:
        return batches
    snapshot = spark.read.schema("word string, count bigint").parquet(f"{out}/_snapshots/{last['name']}")
    return batches.unionByName(snapshot.withColumn("batch", F.lit(first).cast("bigint")))


def compact_word_counts(spark: SparkSession, out_dir: str, upto: int) -> None:
    """Publish the counts as of batch ``upto`` as one snapshot.

    The snapshot is written beside, then named by one line of the manifest, which
    Spark commits by a rename: a reader sees the old state or the new one, and a
    repeated batch publishes the same state again.  Nothing is taken away.
    """
    last = _latest_snapshot(spark, out_dir)
    if last is not None and last["batch"] >= upto:
        return
    name = f"{upto:012d}-{uuid.uuid4().hex}"
    latest = _log(spark, out_dir, upto).groupBy("word").agg(F.max_by("count", "batch").alias("count"))
    latest.write.parquet(f"{out_dir.rstrip('/')}/_snapshots/{name}")
    spark.createDataFrame([(upto, name)], MANIFEST).coalesce(1).write.mode("append").json(f"{out_dir.rstrip('/')}/_manifest")


def read_word_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """word, count: the latest count of each word, from the last snapshot and the batches after it."""
    return _log(spark, out_dir).groupBy("word").agg(F.max_by("count", "batch").alias("count"))
