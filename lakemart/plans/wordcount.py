"""Word count job (G8): text files in, ``word<TAB>count`` lines out.

The output is plain text lines (one per word), the same layout a classic
MapReduce text output has, so it round-trips exactly: words never hold a tab
or a line break because those are separators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.text import word_count
from lakemart.sources.files import read_text
from lakemart.sources.sinks import write_text


def run_word_count(spark: SparkSession, input_path: str, output_path: str) -> None:
    counts = word_count(read_text(spark, input_path), "value")
    write_text(counts.select(F.concat_ws("\t", "word", F.col("n").cast("string")).alias("value")), output_path)


def read_word_counts(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split(F.col("value"), "\t", 2)
    return read_text(spark, path).select(parts.getItem(0).alias("word"),
                                         parts.getItem(1).cast("bigint").alias("n"))
