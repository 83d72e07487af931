"""The bronze load (G1) as an incremental Structured Streaming job.

The feed directory is a file source; each run picks up only the files it has
not committed yet (tracked in the checkpoint), adds the date partitions and
appends them to the bronze dataset through the file sink. Each batch is clustered
by day first, so a day gets at most ``files_per_day`` files a batch, not one from
every task. ``availableNow``
processes what is there and stops, so the job runs like a batch load, but a
re-run over the same files adds nothing, and a run that dies midway resumes
from its checkpoint instead of duplicating data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.plans.bronze import add_date_partitions
from lakemart.sources.files import PARTITION_COLUMNS


def stream_bronze(spark: SparkSession, feed_dir: str, out_path: str, checkpoint: str,
                  schema: StructType | str, date_col: str = "last_purchase_date",
                  max_files_per_trigger: int | None = None, files_per_day: int = 4) -> None:
    """Load every new CSV file under ``feed_dir`` into ``out_path`` and stop."""
    reader = spark.readStream.schema(schema).option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    feed = reader.csv(feed_dir)
    bronze = add_date_partitions(feed, date_col)
    part = F.pmod(F.xxhash64(*feed.columns), F.lit(files_per_day))
    bronze = bronze.repartition(*PARTITION_COLUMNS, part)
    query = (bronze.writeStream.format("parquet")
                   .partitionBy(*PARTITION_COLUMNS)
                   .option("path", out_path)
                   .option("checkpointLocation", checkpoint)
                   .outputMode("append")
                   .trigger(availableNow=True)
                   .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
