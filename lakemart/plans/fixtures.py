"""The two shopper feeds, derived from the driver's TPC-H-style tables.

``profile`` plays the first feed (demographics, one row per customer) and
``activity`` the second (behaviour, one row per ordering customer). Both are
built from one per-customer aggregate of ``orders`` so the orders scan and its
shuffle by customer are shared; ``lineitem`` is reduced to one row per order
before it meets ``orders`` (pre-aggregation: the join then moves
orders-sized data, not lineitem-sized data).

The SQL text of the same two views is in :mod:`lakemart.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import cut_lineage
from lakemart.sources.files import read_table_file


def line_returns(spark: SparkSession, base: str) -> DataFrame:
    """Per order: number of lines and of returned (``R``) lines."""
    li = read_table_file(spark, base, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_returned"),
    )


def customer_orders(spark: SparkSession, base: str) -> DataFrame:
    """Per ordering customer: last order date, exact mean order value, first
    priority and share of returned lines (null when no order has lines)."""
    orders = read_table_file(spark, base, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    lines = line_returns(spark, base)
    joined = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
    return joined.groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("last_order"),
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
         / F.count(F.lit(1))).alias("average_order_value"),
        F.min("o_orderpriority").alias("preferred_payment_method"),
        (F.sum("n_returned").cast("double") / F.sum("n_lines")).alias("return_rate"),
    )


def profile(spark: SparkSession, base: str, per_customer: DataFrame | None = None,
            with_email: bool = False) -> DataFrame:
    """user_id, age, country, gender, income_level, last_purchase_date
    (+ email when ``with_email``).

    age runs 0..125 and some countries are null so every validation rule has
    rows on both sides of it. The optional email is an address with ``@`` for
    most customers, the bare name (no ``@``) for small positive balances and
    null for negative balances.
    """
    cust = read_table_file(spark, base, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table_file(spark, base, "nation").select("n_nationkey", "n_name")
    last = (per_customer if per_customer is not None else customer_orders(spark, base)).select(
        "o_custkey", "last_order")
    j = (cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"], "left")
             .join(last, last["o_custkey"] == cust["c_custkey"], "left"))
    cols = [
        F.col("c_custkey").alias("user_id"),
        (F.col("c_custkey") % 126).cast("int").alias("age"),
        F.when(F.col("c_custkey") % 97 == 0, F.lit(None).cast("string"))
         .otherwise(F.lower("n_name")).alias("country"),
        F.col("c_mktsegment").alias("gender"),
        F.col("c_acctbal").alias("income_level"),
        F.col("last_order").cast("date").alias("last_purchase_date"),
    ]
    if with_email:
        cols.append(F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
                     .when(F.col("c_acctbal") < 1000, F.col("c_name"))
                     .otherwise(F.lower(F.regexp_replace("c_name", "#", "@"))).alias("email"))
    return j.select(*cols)


def activity(spark: SparkSession, base: str, per_customer: DataFrame | None = None) -> DataFrame:
    """user_id, average_order_value, preferred_payment_method, return_rate."""
    pc = per_customer if per_customer is not None else customer_orders(spark, base)
    return pc.select(
        F.col("o_custkey").alias("user_id"), "average_order_value",
        "preferred_payment_method", "return_rate")


def shared_customer_orders(spark: SparkSession, base: str) -> DataFrame:
    """:func:`customer_orders` for use by both feeds.

    Each feed keeps different columns of it, so column pruning would turn the one
    aggregate into two different plans (two scans of orders, two shuffles)
    that exchange reuse cannot merge. It is written once to the shared
    checkpoint folder and both feeds scan that customer-sized table."""
    return cut_lineage(customer_orders(spark, base), "per-customer")


def shopper_feeds(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """(profile, activity) sharing one per-customer aggregate."""
    pc = shared_customer_orders(spark, base)
    return profile(spark, base, pc), activity(spark, base, pc)
