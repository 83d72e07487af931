"""First rows, page reads and row counts over a mart.

A page is 1-based; ``page_size`` is 1..``page_size_max`` (default 50, at most 200). The slice is
``[(page-1)*size, min(start+size, total))``; a page past the end has no items
but still reports the true total.

Two physical forms for a page:
* ``page``: ``ORDER BY key OFFSET start LIMIT size``. Spark plans it as a
  per-task top-(start+size) followed by one merge, fine for the first pages.
* ``page_by_row_no``: the mart stores a dense ``row_no`` in key order (built by
  :func:`number_rows` without any single-partition step) in directories of
  ``ROW_BLOCK`` rows, so any page is a range filter that opens one or two
  directories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import cut_lineage, shuffle_partitions

PAGE_SIZE_DEFAULT = 50
PAGE_SIZE_MAX = 200
ROW_BLOCK = 1_000_000


def check_page(page: int, page_size: int, page_size_max: int = PAGE_SIZE_MAX) -> int:
    """Validate a request and return the 0-based start row."""
    if not isinstance(page, int) or page < 1:
        raise ValueError(f"page must be an integer >= 1, got {page!r}")
    if not isinstance(page_size, int) or not 1 <= page_size <= page_size_max:
        raise ValueError(f"page_size must be an integer in 1..{page_size_max}, got {page_size!r}")
    return (page - 1) * page_size


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def first_n(df: DataFrame, n: int, order: str | list[str]) -> DataFrame:
    """The first ``n`` rows in key order (a top-k: each task keeps n rows)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in _keys(order)]).limit(n)


def page(df: DataFrame, page_no: int, page_size: int = PAGE_SIZE_DEFAULT,
         key: str | list[str] = "user_id", page_size_max: int = PAGE_SIZE_MAX) -> DataFrame:
    """Rows of one page in key order."""
    start = check_page(page_no, page_size, page_size_max)
    ordered = df.orderBy(*[F.col(c).asc_nulls_first() for c in _keys(key)])
    return ordered.offset(start).limit(page_size) if start else ordered.limit(page_size)


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``total`` (BIGINT)."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def page_summary(df: DataFrame, page_no: int, page_size: int = PAGE_SIZE_DEFAULT,
                 page_size_max: int = PAGE_SIZE_MAX, total: Column | None = None) -> DataFrame:
    """One row: page, page_size, total, n_items (0 past the end). ``total`` is an
    aggregate over ``df``, its row count unless given (a stored total, say)."""
    start = check_page(page_no, page_size, page_size_max)
    total = F.count(F.lit(1)) if total is None else total
    return df.agg(
        F.lit(page_no).cast("int").alias("page"),
        F.lit(page_size).cast("int").alias("page_size"),
        total.alias("total"),
        F.greatest(F.lit(0), F.least(F.lit(page_size), total - F.lit(start))).cast("bigint").alias("n_items"),
    )


def past_end_summary(df: DataFrame, page_size: int = PAGE_SIZE_DEFAULT, beyond: int = 2) -> DataFrame:
    """:func:`page_summary` for page ``total // page_size + beyond``, a page past
    the last one (no items, the true total). The page number comes from the
    same aggregate as the total, so the input is read once."""
    check_page(1, page_size)
    total = F.count(F.lit(1))
    page_no = F.floor(total / F.lit(page_size)) + F.lit(beyond)
    return df.agg(
        page_no.cast("int").alias("page"),
        F.lit(page_size).cast("int").alias("page_size"),
        total.alias("total"),
        F.greatest(F.lit(0), F.least(F.lit(page_size), total - (page_no - 1) * F.lit(page_size)))
         .cast("bigint").alias("n_items"),
    )


def number_rows(df: DataFrame, key: str | list[str], out: str = "row_no") -> DataFrame:
    """Add a dense 1-based ``row_no`` in key order, without a global window.

    Rows are range-partitioned on the key (then the remaining columns, so equal
    keys may span ranges) and sorted inside each range; a row's
    number is the row count of all earlier ranges plus its position in its own
    range. The per-range counts are one row per partition (a bounded broadcast).
    Ties on the key are ordered by the remaining columns so numbering is stable
    across re-runs and task retries.
    """
    keys = _keys(key)
    nparts = shuffle_partitions(df.sparkSession)
    order = [F.col(k).asc_nulls_first() for k in keys] + \
            [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    # ranges cut the total order, not just the key: a key held by a third of
    # the rows is spread over several ranges instead of filling one task
    ranged = (df.repartitionByRange(nparts, *order)
                .sortWithinPartitions(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()))
    # position inside the partition: the id is (partition << 33) + position
    # written once: the counts and the rows must see the same ranges
    ranged = cut_lineage(
        ranged.withColumn("_pos", F.col("_pos") - F.shiftleft(F.col("_pid").cast("bigint"), 33)), "row-ranges")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        F.col("_pid").alias("_opid"),
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    numbered = ranged.join(F.broadcast(offsets), ranged["_pid"] == offsets["_opid"])
    return numbered.select(*df.columns, (F.col("_off") + F.col("_pos") + F.lit(1)).alias(out))


def page_by_row_no(df: DataFrame, page_no: int, page_size: int = PAGE_SIZE_DEFAULT,
                   row_no: str = "row_no", page_size_max: int = PAGE_SIZE_MAX) -> DataFrame:
    """A page of a mart that carries ``row_no``: a pushed-down range filter, on the
    directories first where the mart has ``row_block``."""
    start = check_page(page_no, page_size, page_size_max)
    picked = df.filter((F.col(row_no) > start) & (F.col(row_no) <= start + page_size))
    if "row_block" in df.columns:
        first, last = start // ROW_BLOCK, (start + page_size - 1) // ROW_BLOCK
        picked = picked.filter(F.col("row_block").between(first, last))
    return picked.orderBy(row_no).drop(row_no, "row_block")
