"""Structured Streaming forms of the queue operators.

The retry count travels in the message, so routing is stateless; only deduplication keeps
state, one key each, which a watermark can bound."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lifecycle
from ..sources.folders import shared_folder


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def read_files(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files at path, present and to come."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run a stream over all that is there, then stop; a restart goes on from the checkpoint."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def deduped(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The first message of each key of the files at path, through a deduplicating stream.

    Without a watermark every key is kept; give the stream one to bound the state."""
    work = _folder(spark, "dedupe")
    # A single file is read through its folder.
    stream = read_files(spark, path) if not path.endswith(".parquet") else _stream_of_table(spark, path, work)
    fresh = stream.where(F.col(key).isNotNull()).dropDuplicates([key])
    query = fresh.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/state").trigger(availableNow=True)
    query.start().awaitTermination()
    return spark.read.parquet(f"{work}/out")


def _stream_of_table(spark: SparkSession, path: str, work: str) -> DataFrame:
    """A stream over a table that is one file: its folder, narrowed to its name."""
    folder, _, name = path.rpartition("/")
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def routed(spark: SparkSession, failures: DataFrame) -> DataFrame:
    """failures as a stream whose batches go to a retry and a park table; both, with outcome."""
    work = _folder(spark, "routing")
    failures.write.parquet(f"{work}/in")

    def each(batch: DataFrame, number: int) -> None:
        # A batch that is run again writes to its own folder again.
        lifecycle.retry_outcomes(batch).write.mode("overwrite").parquet(f"{work}/out/batch={number}")

    run_available(read_files(spark, f"{work}/in", 2), each, f"{work}/state")
    return spark.read.parquet(f"{work}/out").drop("batch")
