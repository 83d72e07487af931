"""Split job (P9, S9, K5): one wide headered CSV into two narrow ones.

Both halves keep the id columns; the others are shuffled by the seed and cut in
two (:func:`lakemart.operators.project.shuffled_halves`). The wide file is read
as text columns, so values are copied as they stand and no inference pass is made.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakemart.operators.project import vertical_split
from lakemart.sources.files import read_csv
from lakemart.sources.sinks import write_csv


def split_csv(spark: SparkSession, source: str, left_out: str, right_out: str,
              id_columns: list[str], seed: int = 42) -> None:
    wide = read_csv(spark, source, header=True, infer=False)
    for half, path in zip(vertical_split(wide, id_columns, seed), (left_out, right_out), strict=True):
        write_csv(half, path, header=True)
