"""A dataset whose feed changes its columns from day to day.

Every load keeps the types it came with. A dataset is a folder with

* ``schema_log/version=N``: the schema of version N, written once when a load brings a new one,
* ``version=N/year=/month=/day=``: the rows of all loads of that schema.

Reading takes the log, merges all schemas (new columns are added, types that differ are widened, see
:mod:`lakemart.functions.types`) and unions the versions: columns a version lacks are null, the others
are cast. Each version is read under its own schema, so no file is read as a type that it does not have, and day filters and
column selections reach the scan of every version. The union has one branch a version, not one a load
or a day. The merged schema does not depend on the order of loading but for the order of columns.

The log is written before the first row of a version: a load that dies in between leaves a version without
rows. One load runs at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakemart.functions.types import as_type, merge_schemas
from lakemart.sources.files import PARTITION_COLUMNS
from lakemart.sources.sinks import write_partitioned

LOG = "schema_log"


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def is_evolving(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/{LOG}")


def schema_log(spark: SparkSession, path: str) -> dict[int, StructType]:
    """The schema of each version (without the date columns), empty for a new dataset."""
    if not is_evolving(spark, path):
        return {}
    rows = spark.read.schema("schema string, version int").json(f"{path.rstrip('/')}/{LOG}").collect()
    return {r["version"]: StructType.fromJson(json.loads(r["schema"])) for r in sorted(rows, key=lambda r: r["version"])}


def _shape(schema: StructType) -> dict[str, str]:
    return {f.name.lower(): f.dataType.simpleString().lower() for f in schema.fields}


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in schema.fields])


def append_evolving(df: DataFrame, path: str, replace_days: bool = False) -> int:
    """Append ``df`` (with the date columns) under the version of its schema, a new one if no load had it; the version.

    ``replace_days`` replaces the days of ``df`` in that version; days that lie in other versions stay there."""
    spark, root = df.sparkSession, path.rstrip("/")
    own = _nullable(StructType([f for f in df.schema.fields if f.name not in PARTITION_COLUMNS]))
    log = schema_log(spark, root)
    version = next((v for v, s in log.items() if _shape(s) == _shape(own)), None)
    if version is None:
        version = max(log, default=0) + 1
        spark.createDataFrame([(own.json(),)], "schema string").coalesce(1).write.json(f"{root}/{LOG}/version={version}")
    else:  # columns in the order and spelling of the version
        names = {f.name.lower(): f.name for f in df.schema.fields}
        df = df.select(*[F.col(f"`{names[f.name.lower()]}`").alias(f.name) for f in log[version].fields], *PARTITION_COLUMNS)
    write_partitioned(df, f"{root}/version={version}", mode="overwrite" if replace_days else "append",
                      columns=PARTITION_COLUMNS, dynamic_overwrite=replace_days)
    return version


def merged_schema(spark: SparkSession, path: str) -> StructType:
    """The schema that :func:`read_evolving` gives, without the date columns."""
    return reduce(merge_schemas, schema_log(spark, path).values())


def read_evolving(spark: SparkSession, path: str, each: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All rows under the merged schema, with the date columns.

    ``each`` is applied to every version's own frame first and may only drop rows: a rule that names an
    optional column is then decided by the columns the rows came with, not by those of other days."""
    root, log = path.rstrip("/"), schema_log(spark, path)
    if not log:
        raise ValueError(f"no schema log in {path}")
    wanted, frames = reduce(merge_schemas, log.values()), []
    days = StructType.fromDDL(", ".join(f"{c} int" for c in PARTITION_COLUMNS))
    for version, own in log.items():
        if not path_exists(spark, f"{root}/version={version}"):
            continue  # its only load died
        frame = spark.read.schema(StructType([*own.fields, *days.fields])).option(
            "basePath", f"{root}/version={version}").parquet(f"{root}/version={version}")
        frame = each(frame) if each is not None else frame
        have = {f.name.lower(): f for f in own.fields}
        columns = []
        for f in wanted.fields:
            mine = have.get(f.name.lower())
            value = as_type(F.col(f"`{mine.name}`"), mine.dataType, f.dataType) if mine else F.lit(None).cast(f.dataType)
            columns.append(value.alias(f.name))
        frames.append(frame.select(*columns, *PARTITION_COLUMNS))
    if not frames:
        return spark.createDataFrame([], StructType([*wanted.fields, *days.fields]))
    return reduce(DataFrame.unionAll, frames)
