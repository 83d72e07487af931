"""Conform two feeds to one shape and stack them.

A :class:`FeedSpec` lists what each feed needs: renames of flat columns,
extraction of nested fields, ``"code - text"`` splits, array elements, constant
columns, typed nulls, drops and a composite id. :func:`conform` applies it as
one projection; :func:`conform_and_union` aligns types and unions by name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.scalar import array_item, split_item
from lakemart.operators.sets import union_by_name
from lakemart.sources.files import read_csv, read_json


@dataclass
class FeedSpec:
    renames: dict[str, str] = field(default_factory=dict)          # old -> new
    nested: dict[str, str] = field(default_factory=dict)           # new -> "a.b" path
    splits: dict[str, tuple[str, str, int]] = field(default_factory=dict)  # new -> (path, sep regex, index)
    array_items: dict[str, tuple[str, int]] = field(default_factory=dict)  # new -> (path, index)
    constants: dict[str, object] = field(default_factory=dict)
    typed_nulls: dict[str, str] = field(default_factory=dict)      # new -> type name
    drop: list[str] = field(default_factory=list)
    id_parts: list[str] = field(default_factory=list)              # joined by id_separator
    id_name: str = "id"
    id_separator: str = "_"
    columns: list[str] | None = None                                # final order (default: as built)


def composite_id(parts: list[str], separator: str = "_"):
    """``a_b_c`` from the named columns; null when any part is null."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(separator))
        cols.append(F.col(p).cast("string"))
    return F.concat(*cols)


def conform(df: DataFrame, spec: FeedSpec) -> DataFrame:
    out = df.withColumns({k: F.lit(v) for k, v in spec.constants.items()}) if spec.constants else df
    out = out.withColumnsRenamed({k: v for k, v in spec.renames.items() if k in out.columns})
    new_cols = {}
    new_cols.update({k: F.col(v) for k, v in spec.nested.items()})
    new_cols.update({k: split_item(path, sep, idx) for k, (path, sep, idx) in spec.splits.items()})
    new_cols.update({k: array_item(path, idx) for k, (path, idx) in spec.array_items.items()})
    new_cols.update({k: F.lit(None).cast(t) for k, t in spec.typed_nulls.items()})
    if new_cols:
        out = out.withColumns(new_cols)
    out = out.drop(*spec.drop)
    if spec.id_parts:
        out = out.withColumn(spec.id_name, composite_id(spec.id_parts, spec.id_separator))
    return out.select(*spec.columns) if spec.columns else out


def conform_and_union(left: DataFrame, left_spec: FeedSpec, right: DataFrame, right_spec: FeedSpec) -> DataFrame:
    return union_by_name(conform(left, left_spec), conform(right, right_spec))


def conform_files(spark: SparkSession, csv_path: str, csv_spec: FeedSpec, json_path: str,
                  json_spec: FeedSpec) -> DataFrame:
    """The flat feed from a headered CSV (types inferred), the nested one from JSON lines."""
    return conform_and_union(read_csv(spark, csv_path), csv_spec, read_json(spark, json_path), json_spec)
