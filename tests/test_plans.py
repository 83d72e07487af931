"""Physical plan checks: the scale properties the operators promise."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakemart.operators.enrich import keep_one_per_key, with_global_mean
from lakemart.operators.sets import replicate
from lakemart.sources.files import read_table_file


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_filters_reach_the_scan(spark):
    from lakemart.operators.rules import validate
    from lakemart.plans import fixtures as fx
    from lakemart.plans.silver import join_feeds
    info, act = fx.shopper_feeds(spark, SF_SMALL)
    p = plan(validate(join_feeds(info, act)))
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in p


def test_global_mean_moves_one_row_not_all_rows(spark):
    df = read_table_file(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_quantity")
    out = with_global_mean(df, "l_quantity", "m")
    out.collect()  # subquery plans are filled in at execution
    p = plan(out)
    assert "Subquery" in p and "partial_avg" in p
    assert "Window" not in p and "Join" not in p


def test_dedup_limits_each_key_before_the_shuffle(spark):
    orders = read_table_file(spark, SF_SMALL, "orders")
    p = plan(keep_one_per_key(orders, "o_custkey", ["o_orderdate desc"]))
    assert "WindowGroupLimit" in p
    # the partial group limit sits below the exchange
    assert p.index("Exchange") < p.rindex("WindowGroupLimit")


def test_replicate_is_one_scan(spark):
    orders = read_table_file(spark, SF_SMALL, "orders")
    p = plan(replicate(orders, 61))
    assert "Union" not in p and "Join" not in p and "Exchange" not in p
    assert "Generate" in p and p.count("FileScan") == 1


def test_projection_is_pruned_at_the_scan(spark):
    li = read_table_file(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_tax")
    p = plan(li.filter(F.col("l_tax") > 0.05))
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in p
    assert "GreaterThan(l_tax,0.05)" in p


def test_rank_has_no_single_partition_exchange(spark):
    from lakemart.plans import fixtures as fx
    from lakemart.plans.silver import ranked_rows
    info, act = fx.shopper_feeds(spark, SF_SMALL)
    _, ranked = ranked_rows(info, act, rank_method="ranged")
    p = plan(ranked)
    assert "spark_partition_id" not in p
    assert "SinglePartition" not in p


def test_bronze_day_range_prunes_partitions(spark, tmp_path):
    from lakemart.sources.files import date_range, read_parquet
    from lakemart.sources.sinks import write_partitioned
    rows = [(i, 2024, 1, 1 + i % 10) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, year int, month int, day int")
    out = str(tmp_path / "bronze")
    write_partitioned(df, out, mode="overwrite")
    picked = read_parquet(spark, out, where=date_range("2024-01-03", "2024-01-04"))
    assert picked.count() == 20
    assert "PartitionFilters: [isnotnull(year" in plan(picked)


def test_feeds_share_one_per_customer_aggregate(spark):
    from lakemart.plans import fixtures as fx
    from lakemart.plans.silver import join_feeds
    p = plan(join_feeds(*fx.shopper_feeds(spark, SF_SMALL)))
    # orders work happened once, in the write of the per-customer table; both
    # feeds scan that table instead of aggregating orders again
    assert "orders.parquet" not in p
    assert p.count("per-customer") >= 2


def test_rank_moves_the_data_four_times_at_most(spark):
    from lakemart.operators.enrich import rank_within
    from lakemart.session import scoped_conf
    df = read_table_file(spark, SF_SMALL, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        big = [line for line in plan(rank_within(df, "o_orderpriority", "o_totalprice", "r")).splitlines()
               if " Exchange hashpartitioning" in line]
    # pairs, pairs by block, both sides of the join back; the join with the boundary values
    # moves the pairs once more only where those are too many to broadcast, block totals are tiny
    keys = [line.split("hashpartitioning(")[1].split(")")[0] for line in big]
    assert sum("o_totalprice" in k or "_rv" in k for k in keys) <= 3
    assert not any("spark_partition_id" in line for line in big)


def test_page_reads_only_its_directories(spark, tmp_path):
    from lakemart.operators.paging import page_by_row_no
    from lakemart.plans.gold import build_returns
    silver = spark.range(300).selectExpr("id AS user_id", "1 AS age", "1.0D AS income_level", "0.5D AS return_rate")
    mart = build_returns(spark, silver, str(tmp_path / "mart"), database=None)
    picked = page_by_row_no(mart, 2, 50)
    assert [r["user_id"] for r in picked.collect()] == list(range(50, 100))
    assert "PartitionFilters: [isnotnull(row_block" in plan(picked)
