"""Structured Streaming form of the incremental review load.

New raw review files landing in a folder are picked up by a file stream;
each micro-batch goes through staging and the surrogate key and is written
with the same partition-local delete+insert as the batch load, so replaying
a batch (after a failure) is idempotent. ``trigger(availableNow=True)``
processes whatever has arrived and stops — the scheduled daily run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodgeflow.operators.load import write_delete_insert
from lodgeflow.plans import models as M
from lodgeflow.plans.jobs import REVIEW_PARTITION, with_review_partition
from lodgeflow.sources.raw import RAW_REVIEWS_SCHEMA


def review_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_REVIEWS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(landing_dir)


def start_review_load(spark: SparkSession, landing_dir: str, fct_path: str,
                      checkpoint_location: str, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``.

    ``checkpoint_location`` must be on shared storage: it holds the offsets
    that make the load exactly-once across restarts.
    """
    def upsert(batch: DataFrame, _epoch: int) -> None:
        fct = with_review_partition(M.fct_reviews(M.src_reviews(batch)))
        write_delete_insert(batch.sparkSession, fct_path, fct, "review_id", REVIEW_PARTITION)

    writer = (review_stream(spark, landing_dir).writeStream
              .foreachBatch(upsert)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
