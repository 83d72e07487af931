"""Serving layer over the returns mart (G4) and its age report.

A request names a page and a size; the answer is a one-row summary (page,
page_size, total, n_items) and the page's rows in key order. When the mart
carries row numbers the rows come from a range filter on them (only the page's
directories are opened) and the total is the stored one; otherwise they come
from an ordered offset/limit and a count. Nothing but the page's rows ever
leaves Spark.

The report is computed over the *whole* mart, not over one fetched page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.paging import PAGE_SIZE_DEFAULT, PAGE_SIZE_MAX, page, page_by_row_no, page_summary
from lakemart.operators.report import age_bucket_means, age_histogram
from lakemart.plans.gold import stored_total


def serve_page(spark: SparkSession, mart_path: str, page_no: int = 1,
               page_size: int = PAGE_SIZE_DEFAULT, key: str = "user_id",
               page_size_max: int = PAGE_SIZE_MAX) -> tuple[DataFrame, DataFrame]:
    mart = spark.read.parquet(mart_path)
    if "row_block" in mart.columns:
        items = page_by_row_no(mart, page_no, page_size, page_size_max=page_size_max)
        summary = page_summary(stored_total(spark, mart_path), page_no, page_size, page_size_max, F.max("total"))
    else:
        items = page(mart, page_no, page_size, key, page_size_max)
        summary = page_summary(mart, page_no, page_size, page_size_max)
    return summary, items


def page_response(spark: SparkSession, mart_path: str, page_no: int = 1,
                  page_size: int = PAGE_SIZE_DEFAULT, key: str = "user_id",
                  page_size_max: int = PAGE_SIZE_MAX) -> dict:
    """The API answer: ``{"page", "page_size", "total", "items": [row dicts]}``.

    Only the summary row and at most ``page_size`` item rows are collected to the driver.
    """
    summary, items = serve_page(spark, mart_path, page_no, page_size, key, page_size_max)
    head = summary.first()
    return {"page": head["page"], "page_size": head["page_size"], "total": head["total"],
            "items": [r.asDict() for r in items.collect()]}


def age_report(mart: DataFrame, exact_scales: dict[str, int] | None = None) -> dict[str, DataFrame]:
    means = age_bucket_means(mart, ["income_level", "return_rate"], exact_scales=exact_scales)
    return {
        "age_histogram": age_histogram(mart),
        "income_by_age_bucket": means.select("age_bucket", "mean_income_level"),
        "return_rate_by_age_bucket": means.select("age_bucket", "mean_return_rate"),
    }
