"""Key join (J1), rank inside a group (W1), whole-table mean on every row (A1,
W2) and one row per key (A7).

Scale notes
-----------
* ``rank_within`` never puts a whole group in one task. One small aggregate
  (``percentile_approx`` per group) gives boundary values that cut each group
  into blocks; it is written once, so all branches of the plan see the same
  cuts. Equal values always fall in the same block. ``ranged`` first collapses
  rows to distinct (group, value) pairs with a count (map-side combine, so
  a value repeated a billion times becomes one row), writes them once, ranks the pairs inside
  their block (``rank_pairs``), adds the rows of earlier blocks and joins the ranks back: the input
  is read twice, and a tied value's join is split by AQE. ``window``
  ranks the rows themselves inside their block: one shuffle, for values that
  are near distinct (a tied value stays in one task).
* ``with_global_mean`` computes the mean as a scalar subquery (partial +
  final aggregate, run once, substituted as a value), instead of
  ``avg() OVER ()`` which moves every row into one partition.
* ``keep_one_per_key`` is ``row_number() = 1`` over a total order. Spark plans it
  with a partial group limit before the shuffle, so a hot key sends at most one
  row per map task across the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.aggregate import mean
from lakemart.session import cut_lineage


def join_on_key(left: DataFrame, right: DataFrame, key: str | list[str],
                how: str = "inner", drop_right: list[str] | None = None) -> DataFrame:
    """Equi-join on named key column(s); each key appears once in the output.

    ``drop_right`` columns are dropped from ``right`` first; a column that then still
    clashes with one of ``left`` (other than the keys) is an error. Null keys never match. The physical strategy is left to AQE (broadcast only when the
    runtime size of a side is under the broadcast threshold).
    """
    keys = [key] if isinstance(key, str) else list(key)
    right = right.drop(*(drop_right or []))
    clash = [c for c in right.columns if c in left.columns and c not in keys]
    if clash:
        raise ValueError(f"columns on both sides: {clash}; name them in drop_right")
    return left.join(right, on=keys, how=how)


def _order(col: str, descending: bool) -> Column:
    return F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_last()


RANK_BLOCKS = 64  # value ranges that each group is cut into


def _block(value: str, bounds: str, descending: bool) -> Column:
    """Number of a row's block in its group: how many boundary values come before its value."""
    low = F.size(F.filter(F.col(bounds), lambda b: b < F.col(value)))
    high = F.size(F.filter(F.col(bounds), lambda b: b > F.col(value)))
    return F.when(F.col(value).isNull(), F.lit(1 << 30)).otherwise(high if descending else low)


def rank_within(df: DataFrame, group: str, value: str, out: str = "rank",
                descending: bool = True, method: str = "ranged",
                blocks: int = RANK_BLOCKS, dense: bool = False) -> DataFrame:
    """``rank()`` (gaps after ties) of a numeric ``value`` inside ``group``.

    ``descending`` orders high first with nulls last (Spark's default for DESC);
    otherwise low first, nulls last. ``method`` is ``"ranged"`` (splits tied values, too)
    or ``"window"``. With ``dense`` equal values count once (no gaps). The boundary
    values are computed when this is called.
    """
    if method not in ("ranged", "window"):
        raise ValueError(f"unknown rank method {method!r}")
    if dense and method == "window":
        raise ValueError("dense ranks need method='ranged'")
    if method == "ranged":
        # written once: the boundaries, the blocks and the ranks all read the pairs
        pairs = cut_lineage(df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n")), "rank-pairs")
        return with_ranks(df, rank_pairs(pairs, group, value, "_n", out, descending, blocks, dense), group, value, out)
    cuts = [i / blocks for i in range(1, blocks)] or [0.5]
    bounds = cut_lineage(df.groupBy(F.col(group).alias("_bg")).agg(
        F.array_distinct(F.percentile_approx(value, cuts, 10 * blocks)).alias("_bounds")), "rank-bounds")
    rows = (df.join(bounds, df[group].eqNullSafe(bounds["_bg"])).drop("_bg")
            .withColumn("_blk", _block(value, "_bounds", descending)).drop("_bounds"))
    off = _block_offsets(rows, group, F.lit(1))
    inside = rows.withColumn("_in", F.rank().over(Window.partitionBy(group, "_blk").orderBy(_order(value, descending))))
    placed = inside.join(off, inside[group].eqNullSafe(off["_g"]) & (inside["_blk"] == off["_b"]))
    return placed.withColumn(out, (F.col("_off") + F.col("_in")).cast("int")).select(*df.columns, out)


def rank_pairs(pairs: DataFrame, group: str, value: str, count: str, out: str = "rank", descending: bool = True,
               blocks: int = RANK_BLOCKS, dense: bool = False) -> DataFrame:
    """``(group, value, rank)`` of distinct (group, value) pairs that stand for ``count`` rows each, as ``rank()`` over those rows.

    ``pairs`` is read several times, so it should be a table. The boundary values are computed when this is called."""
    order, cuts = _order(value, descending), [i / blocks for i in range(1, blocks)] or [0.5]
    # groups * blocks numbers; AQE decides from their size how they are joined
    bounds = cut_lineage(pairs.groupBy(F.col(group).alias("_bg")).agg(
        F.array_distinct(F.percentile_approx(value, cuts, 10 * blocks)).alias("_bounds")), "rank-bounds")
    weight = F.lit(1) if dense else F.col(count)
    placed = (pairs.select(group, value, count).join(bounds, pairs[group].eqNullSafe(bounds["_bg"])).drop("_bg")
              .withColumn("_blk", _block(value, "_bounds", descending)).drop("_bounds"))
    off = _block_offsets(placed, group, weight)
    before = Window.partitionBy(group, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_in", F.coalesce(F.sum(weight).over(before), F.lit(0)))
    return (inside.join(off, inside[group].eqNullSafe(off["_g"]) & (inside["_blk"] == off["_b"]))
            .select(F.col(group), F.col(value), (F.col("_off") + F.col("_in") + F.lit(1)).cast("int").alias(out)))


def _block_offsets(frame: DataFrame, group: str, weight: Column) -> DataFrame:
    """For each block of a group the weight of the group's earlier blocks."""
    per_block = frame.groupBy(group, "_blk").agg(F.sum(weight).alias("_blk_n"))
    before = Window.partitionBy(group).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    return per_block.select(F.col(group).alias("_g"), F.col("_blk").alias("_b"),
                            F.coalesce(F.sum("_blk_n").over(before), F.lit(0)).alias("_off"))


def with_ranks(df: DataFrame, ranks: DataFrame, group: str, value: str, out: str = "rank") -> DataFrame:
    """The rows of ``df`` with the rank of their (group, value) pair; nulls are values."""
    ranks = ranks.select(F.col(group).alias("_rg"), F.col(value).alias("_rv"), out)
    cond = df[group].eqNullSafe(ranks["_rg"]) & df[value].eqNullSafe(ranks["_rv"])
    return df.join(ranks, cond, "inner").drop("_rg", "_rv")


def with_global_mean(df: DataFrame, column: str, out: str, source: DataFrame | None = None,
                     exact_scale: int | None = None) -> DataFrame:
    """Add the mean of ``column`` over the whole frame to every row (nulls skipped).

    ``source`` (default ``df``) is the frame the mean is taken over; pass the
    cheapest frame holding the same rows. The mean is a scalar subquery:
    partial aggregates per task, one final merge of one row per task, and the
    single value is then used by every row; no join, no window.
    ``exact_scale`` sums in DECIMAL (see :func:`lakemart.functions.aggregate.mean`).
    """
    value = (source if source is not None else df).select(mean(column, exact_scale))
    return df.withColumn(out, value.scalar())


def sort_spec(spec: str) -> tuple[str, Column]:
    """``"name"`` / ``"name asc"`` (nulls first) or ``"name desc"`` (nulls last),
    Spark's defaults for each direction."""
    parts = spec.split()
    name = parts[0]
    if len(parts) > 1 and parts[1].lower() == "desc":
        return name, F.col(name).desc_nulls_last()
    return name, F.col(name).asc_nulls_first()


def total_order(df: DataFrame, key: list[str], first: list[str]) -> list[Column]:
    """The ``first`` sort specs followed by every other column ascending, so the
    order is total and the chosen row never depends on file or task order."""
    specs = [sort_spec(s) for s in first]
    named = {n for n, _ in specs}
    rest = [F.col(c).asc_nulls_first() for c in df.columns
            if c not in key and c not in named and _orderable(df, c)]
    return [c for _, c in specs] + rest


def _orderable(df: DataFrame, column: str) -> bool:
    from pyspark.sql.types import MapType
    return not isinstance(df.schema[column].dataType, MapType)


def keep_one_per_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """One row per key: the first row under ``order`` (sort specs such as
    ``"last_purchase_date desc"``), ties broken by all remaining columns."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))
