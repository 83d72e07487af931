"""Projections (P1-P10): column subsets, drops, bulk renames, constants, typed
nulls, copies, text expressions, nested access and the vertical split of a
wide table.

Everything is a single ``select``/``withColumns`` so Catalyst folds the chain
into one projection and prunes unused columns down to the scan. The vertical
split decides its column lists on the driver from the schema only (metadata),
never from the data.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_many(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename several columns at once (unknown names are ignored, like
    ``withColumnRenamed``)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def copy_column(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))


def add_expression(df: DataFrame, name: str, sql_expr: str) -> DataFrame:
    """A column from SQL expression text, e.g. ``"(lcl + ucl) / 2"``."""
    return df.withColumn(name, F.expr(sql_expr))


# ------------------------------------------------------------- vertical split

def shuffled_halves(columns: list[str], id_columns: list[str], seed: int = 42) -> tuple[list[str], list[str]]:
    """Shuffle the non-id columns with ``random.seed(seed)`` and cut them in two:
    the first ``floor(n/2)`` go left, the rest right (the reference's rule, so
    the same seed gives the same split)."""
    others = [c for c in columns if c not in id_columns]
    rng = random.Random(seed)
    rng.shuffle(others)
    cut = len(others) // 2
    return others[:cut], others[cut:]


def vertical_split(df: DataFrame, id_columns: list[str], seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Two narrow tables that share the id columns; rejoining them on the ids
    gives the input back (when the ids are unique)."""
    left, right = shuffled_halves(df.columns, id_columns, seed)
    return df.select(*id_columns, *left), df.select(*id_columns, *right)


def split_by_groups(df: DataFrame, groups: list[list[str]]) -> list[DataFrame]:
    """Vertical split by named column groups (each group lists its id columns)."""
    missing = sorted({c for g in groups for c in g if c not in df.columns})
    if missing:
        raise ValueError(f"unknown columns in split groups: {missing}")
    return [df.select(*g) for g in groups]


def rejoin(parts: list[DataFrame], id_columns: list[str]) -> DataFrame:
    """Inner join of vertical parts on their shared id columns."""
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, on=id_columns, how="inner")
    return out
