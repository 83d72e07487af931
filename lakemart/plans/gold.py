"""Gold marts (G3) built from the silver dataset.

* ``customer_segmentation``: user_id, gender, country, rank_in_country, saved as a
  catalog table in database ``gold`` (created on demand).
* ``predictive_returns``: user_id, age, income_level, return_rate, written as flat
  Parquet for the serving layer and registered as a table too (the reference
  documents reading it by name but never registers it).

Each mart reads only its four columns from silver (pruned at the scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.paging import ROW_BLOCK, number_rows
from lakemart.sources.sinks import ensure_database, save_table, write_parquet

SEGMENTATION_COLUMNS = ["user_id", "gender", "country", "rank_in_country"]
RETURNS_COLUMNS = ["user_id", "age", "income_level", "return_rate"]


def segmentation(silver: DataFrame) -> DataFrame:
    return silver.select(*SEGMENTATION_COLUMNS)


def returns(silver: DataFrame) -> DataFrame:
    return silver.select(*RETURNS_COLUMNS)


def build_segmentation(spark: SparkSession, silver: DataFrame, database: str = "gold",
                       table: str = "customer_segmentation", db_location: str | None = None,
                       table_location: str | None = None) -> DataFrame:
    """Overwrite the segmentation table. With ``table_location`` it is an
    external table at that path, so a re-run from a new session (or a catalog
    that forgot the table) overwrites the files instead of failing on an
    existing managed location."""
    ensure_database(spark, database, db_location)
    name = f"{database}.{table}"
    save_table(segmentation(silver), name, mode="overwrite", location=table_location)
    return spark.table(name)


def build_returns(spark: SparkSession, silver: DataFrame, out_path: str, database: str | None = "gold",
                  table: str = "predictive_returns", with_row_numbers: bool = True,
                  key: str = "user_id") -> DataFrame:
    """Write the returns mart. With ``with_row_numbers`` a dense ``row_no`` in key
    order is stored too, in directories of ``ROW_BLOCK`` rows, and the number
    of rows beside the mart (:func:`stored_total`), so a deep page opens one or
    two directories and nothing is counted.

    The external table is created once; a re-run overwrites its files and
    refreshes it, and a new path only changes its location, so a reader never
    finds the table gone."""
    mart = returns(silver)
    if with_row_numbers:
        mart = number_rows(mart, key).withColumn("row_block", F.expr(f"(row_no - 1) div {ROW_BLOCK}").cast("int"))
        mart.write.mode("overwrite").partitionBy("row_block").parquet(out_path)
        total = spark.read.parquet(out_path).agg(F.coalesce(F.max("row_no"), F.lit(0)).cast("long").alias("total"))
        write_parquet(total, _total_path(out_path))
    else:
        write_parquet(mart, out_path)
    if database:
        ensure_database(spark, database)
        name = f"{database}.{table}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{out_path}'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{out_path}'")
        if with_row_numbers:
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.catalog.refreshTable(name)
    return spark.read.parquet(out_path)


def _total_path(mart_path: str) -> str:
    return mart_path.rstrip("/") + "_total"


def stored_total(spark: SparkSession, mart_path: str) -> DataFrame:
    """One row: ``total``, as stored when the mart with row numbers was built."""
    return spark.read.schema("total long").parquet(_total_path(mart_path))


def build_gold(spark: SparkSession, silver_path: str, returns_path: str, database: str = "gold",
               db_location: str | None = None,
               segmentation_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    silver = spark.read.parquet(silver_path)
    return (build_segmentation(spark, silver, database, db_location=db_location,
                               table_location=segmentation_path),
            build_returns(spark, silver, returns_path, database))
