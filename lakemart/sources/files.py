"""Readers (S1-S8): CSV with and without header, declared delimited tables,
partitioned Parquet, catalog tables, nested JSON and plain text.

Schema inference (``infer=True``) costs an extra pass over the input; on large
feeds pass ``schema=`` instead. Every reader returns a lazy DataFrame, so
filters and column selections applied later reach the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import CharType, StringType, StructType, VarcharType

from lakemart.session import cut_lineage, scoped_conf

PARTITION_COLUMNS = ("year", "month", "day")


def read_table_file(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables: ``<base_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, header: bool = True, infer: bool = True,
             schema: StructType | str | None = None, sep: str = ",", quote: str | None = None) -> DataFrame:
    """Delimited text with a header line.

    With ``schema`` no inference pass is made. ``quote=""`` turns quoting off, so a
    quoted field holding the separator splits, as Hive's delimited text does.
    """
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    if quote is not None:
        reader = reader.option("quote", quote if quote else "\u0000")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", str(infer).lower())
    return reader.csv(path)


def read_csv_raw(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Headerless delimited text (S2): columns ``_c0.._cN``, all strings; a header
    line in the file is an ordinary data row; an empty field is null."""
    return spark.read.option("header", "false").option("sep", sep).csv(path)


def declare_csv_table(spark: SparkSession, table: str, columns_ddl: str, location: str,
                      sep: str = ",", if_not_exists: bool = True, quote: str | None = None) -> DataFrame:
    """A catalog table over a directory of delimited text under a declared
    schema (S3). Lines are not skipped: a header line becomes a row whose
    non-text fields are null. CHAR(n) values are blank-padded on read.
    ``quote=""`` turns quoting off, as Hive's delimited text does."""
    exists = "IF NOT EXISTS " if if_not_exists else ""
    quoting = "" if quote is None else f", quote '{quote or chr(92) + 'u0000'}'"
    spark.sql(
        f"CREATE TABLE {exists}{table} ({columns_ddl}) USING csv "
        f"OPTIONS (header 'false', sep '{sep}', mode 'PERMISSIVE'{quoting}) LOCATION '{location}'"
    )
    return spark.table(table)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None,
                 where: Column | None = None) -> DataFrame:
    """A Parquet dataset (S4/S5); ``year=/month=/day=`` directories come back as
    INT columns. ``columns`` and ``where`` are applied lazily so they are pushed
    into the scan (partition pruning for partition columns)."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return df


def date_range(start: str | None = None, end: str | None = None) -> Column:
    """Predicate on the date partition columns, inclusive; prunes directories."""
    key = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    cond = F.lit(True)
    if start:
        cond = cond & (key >= F.to_date(F.lit(start)))
    if end:
        cond = cond & (key <= F.to_date(F.lit(end)))
    return cond


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table."""
    return spark.table(name)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multiline: bool = False) -> DataFrame:
    """JSON documents, one per line by default, nested fields kept."""
    reader = spark.read.option("multiLine", str(multiline).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Plain text, one row per line in column ``value``."""
    return spark.read.text(path)


def read_json_variant(spark: SparkSession, path: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """JSON documents of changing shape, one per line, in one pass.

    Every line becomes a VARIANT value; no schema is inferred. ``fields`` names the columns wanted: a path
    (``$.fields.name``, ``$.geo[0]``) and the type it is read as. A path that a document lacks, or a value that can't be
    cast, is null; a line that is no JSON gives nulls everywhere. The columns that follow are null or a value, whatever the shape."""
    doc = F.try_parse_json(F.col("value"))
    return read_text(spark, path).select(*[F.try_variant_get(doc, p, t).alias(name) for name, (p, t) in fields.items()])


def read_delimited(spark: SparkSession, path: str, columns_ddl: str, sep: str = ",", escape: str | None = None,
                   null_text: str = "\\N") -> DataFrame:
    """Delimited text as a declared Hive table means it (S3).

    A line is cut at every separator: quotes are ordinary signs, so a quoted separator cuts, too. With ``escape`` a
    separator after it does not cut. A field of ``null_text`` is null (before escapes are taken out), as is one that its column's type can't take
    and one that a short line lacks; what a long line has beyond the columns is dropped. An empty field is null but
    for text. CHAR(n) is padded with blanks and cut at n, VARCHAR(n) cut. A header line is a row like any other."""
    # DDL text keeps the lengths of CHAR and VARCHAR, which a schema object holds as metadata
    schema = StructType.fromDDL(columns_ddl)
    raw = F.split(F.col("value"), re.escape(sep), -1) if escape is None else F.regexp_extract_all(
        F.concat(F.lit(sep), F.col("value")), F.lit(f"{re.escape(sep)}((?:{re.escape(escape)}.|[^{re.escape(sep)}])*)"), F.lit(1))
    lines = read_text(spark, path).select(raw.alias("raw"))
    columns = []
    for i, f in enumerate(schema.fields):
        text = F.get("raw", F.lit(i))
        text = F.when(text != F.lit(null_text), text)
        if escape is not None:
            text = F.regexp_replace(text, f"{re.escape(escape)}(.)", "$1")
        kind = f.dataType
        if isinstance(kind, CharType):
            value = F.rpad(text, kind.length, " ")
        elif isinstance(kind, VarcharType):
            value = F.substring(text, 1, kind.length)
        else:
            value = text if isinstance(kind, StringType) else text.try_cast(kind)
        columns.append(value.alias(f.name))
    return lines.select(*columns)


def footer_count(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``total``, the rows of a Parquet dataset, added up from the files' footers (A5): no row is read.

    The count is pushed into the scan, which the file-source connector of version 2 can do; the two settings that
    ask for it hold while this runs, and the one row is written and read back."""
    with scoped_conf(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}):
        return cut_lineage(footer_count_plan(spark, path), "footer-count")


def footer_count_plan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("total"))
