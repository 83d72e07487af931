"""Derive columns on an amplified table.

The input is replicated (original + ``copies`` more), two limit columns are
renamed to short names, then the mode decides the transformation:

* ``noop``: nothing is added;
* ``col``: ``avg = (lcl + ucl) / 2`` from expression text, plus copies
  ``lcl2`` and ``ucl2``;
* ``full``: the ``col`` columns are added and dropped again (Catalyst removes
  them, so the plan equals ``noop``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakemart.operators.project import add_expression, copy_column, rename_many
from lakemart.operators.sets import replicate

MODES = ("noop", "col", "full")


def derive(df: DataFrame, mode: str, lcl: str = "lcl", ucl: str = "ucl") -> DataFrame:
    mode = mode.lower()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if mode == "noop":
        return df
    out = add_expression(df, "avg", f"({lcl} + {ucl}) / 2")
    out = copy_column(copy_column(out, lcl, "lcl2"), ucl, "ucl2")
    if mode == "full":
        out = out.drop("avg", "lcl2", "ucl2")
    return out


def amplified_derive(df: DataFrame, mode: str, copies: int = 60,
                     renames: dict[str, str] | None = None) -> DataFrame:
    """Replicate to ``copies + 1`` times the rows, rename, derive."""
    big = replicate(df, copies + 1)
    big = rename_many(big, renames or {"Lower Confidence Limit": "lcl", "Upper Confidence Limit": "ucl"})
    return derive(big, mode)
