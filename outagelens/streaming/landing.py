"""Bronze ingestion that remembers landed files in a stream checkpoint.

An alternative to the manifest: files that appear in a landing folder are each read
once. Every run works through what is new and stops.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outagelens.sources import tables


def ingest_new_files(
    spark: SparkSession, landing: str, schema: str, bronze_path: str, checkpoint: str,
    run_ts: dt.datetime, year: str, pattern: str = "*.parquet", files_per_batch: int = 1000,
) -> None:
    """Stamp new files and store them, partitioned by year and batch.

    ``year`` is the SQL expression that gives a row's year. A batch repeated after a
    failure carries the same number and replaces its own partitions, so its rows are
    stored once. ``checkpoint`` must be in a folder all executors see.
    """
    landed = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
        .withColumns(
            {
                "_ingest_timestamp": F.lit(run_ts).cast("timestamp"),
                "_source_url": F.col("_metadata.file_path"),
                "_source_last_modified": F.col("_metadata.file_modification_time").cast("string"),
                "_ano_fonte": F.expr(year).cast("int"),
            }
        )
    )

    def store(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn("_lote", F.lit(number))
        tables.replace_partitions(numbered, bronze_path, ["_ano_fonte", "_lote"])

    query = (
        landed.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
