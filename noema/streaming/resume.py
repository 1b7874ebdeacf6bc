"""S9 resumable processing.

The reference remembers finished items in a checkpoint file and skips them on
restart.  Here that is a Structured Streaming query over the input folder with
``trigger(availableNow=True)``:

* the stream's checkpoint records which input files were consumed;
* finished keys live in the state store, as a streaming aggregate by key.  It keeps the
  first row of a key (in the caller's order) and when the key was first and last seen; a
  key is new exactly in the micro-batch in which both are the same.  A key that comes
  twice, in one batch or in two, is processed once.  The aggregate combines rows before
  the shuffle, so a key with a third of the rows costs one row a task;
* each micro-batch overwrites the result folder of its own epoch.  A batch that was
  written but not committed is replayed with the same rows and the same epoch after a
  restart, and replaces what it had left.

Checkpoint and results live in a shared folder that the caller names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def pending(inputs: DataFrame, done: DataFrame | None, key: str) -> DataFrame:
    """Batch form: the input rows whose key has no result yet."""
    if done is None:
        return inputs
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def new_keys(stream: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row for each key of a stream, in the micro-batch in which the key comes first: the
    smallest row by ``order`` (default: by all columns) of those that come with it.
    Null keys are no items and are left out.  For output mode ``update``."""
    rest = [c for c in stream.columns if c != key]
    # a micro-batch has one timestamp, also when it is replayed
    at = stream.where(F.col(key).isNotNull()).withColumn("_at", F.current_timestamp())
    first = F.struct("_at", *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                     *[F.col(f"`{c}`") for c in rest])
    seen = at.groupBy(key).agg(F.min(first).alias("_row"), F.max("_at").alias("_last"))
    return seen.where(F.col("_row._at") == F.col("_last")).select(
        *[F.col(f"_row.`{c}`").alias(c) if c != key else F.col(c) for c in stream.columns])


def epoch_writer(process: Callable[[DataFrame], DataFrame], done_path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes ``process(batch)`` to the folder of its epoch;
    run again with the same epoch, it replaces the folder."""
    def handle(batch: DataFrame, epoch_id: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{done_path.rstrip('/')}/epoch={epoch_id}")
    return handle


def results(spark: SparkSession, done_path: str, schema: StructType | str | None = None) -> DataFrame:
    """The results of all epochs so far."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", done_path).parquet(done_path).drop("epoch")


def run_resumable(spark: SparkSession, input_dir: str, input_schema: str | StructType, key: str,
                  process: Callable[[DataFrame], DataFrame], done_path: str,
                  checkpoint_location: str, fmt: str = "parquet",
                  max_files_per_trigger: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """Process every key of the input files once; returns the results of all runs so far.

    ``process`` maps a DataFrame of new keys' rows to result rows.  After a failure, a
    call with the same ``checkpoint_location`` and ``done_path`` continues with the
    unfinished micro-batch and neither loses nor repeats finished work: the results of a
    run that was cut and resumed are those of one that was not.
    """
    stream = (spark.readStream.schema(input_schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(input_dir))
    q = (new_keys(stream, key, order).writeStream.outputMode("update")
         .foreachBatch(epoch_writer(process, done_path)).option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return results(spark, done_path)
