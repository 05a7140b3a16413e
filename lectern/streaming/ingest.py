"""Micro-batch ingestion: every batch writes its own partition, so a batch that runs
again after a failure replaces what it wrote, and the checkpoint takes up where the
last finished batch ended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest(spark: SparkSession, source: str, schema, target: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], files_per_batch: int = 2) -> None:
    """Run all files of a folder that no batch has seen through ``work``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        work(batch).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target)

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
