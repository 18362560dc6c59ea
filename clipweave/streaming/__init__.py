"""Resumable ingestion as micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest(spark: SparkSession, source: str, schema: str, ledger: str, key: str, work: Callable[[DataFrame], DataFrame], checkpoint: str, files_a_batch: int = 16) -> StreamingQuery:
    """Runs work over rows whose key has no ledger row that did not fail; commits the ledger after each micro-batch.

    work returns (key, status) rows. A crash repeats at most one micro-batch.
    """

    def batch(rows: DataFrame, number: int) -> None:
        try:
            done = spark.read.parquet(ledger).where(F.col("status") != "failed").select(key)
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            done = rows.select(key).limit(0)
        new = rows.dropDuplicates([key]).join(done, key, "left_anti")
        work(new).withColumn("batch", F.lit(number)).write.mode("append").parquet(ledger)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
