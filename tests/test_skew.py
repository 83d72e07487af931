"""Hot keys: a group, a day or a word holding a large share of all rows is
split across tasks or combined before the shuffle, never sent whole to one task."""

import os

from pyspark.sql import functions as F

from lakemart.operators.enrich import _block, rank_within
from lakemart.session import scoped_conf
from lakemart.sources.sinks import write_partitioned


def test_hot_group_is_cut_into_several_rank_blocks(spark):
    # one country with 90% of the rows and all-distinct values
    rows = [("hot", float(i)) for i in range(9000)] + [(f"c{i % 9}", float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "country string, v double")
    cuts = df.filter("country = 'hot'").agg(F.percentile_approx("v", [i / 16 for i in range(1, 16)], 160).alias("b"))
    blocks = (df.filter("country = 'hot'").crossJoin(cuts).withColumn("_blk", _block("v", "b", True))
                .groupBy("_blk").count().collect())
    assert len(blocks) >= 8                         # the hot group spans many blocks
    assert max(r["count"] for r in blocks) < 3000   # and none holds most of it
    ranked = rank_within(df, "country", "v", "r", method="ranged", blocks=16)
    hot = ranked.filter("country = 'hot'").agg(F.min("r"), F.max("r"), F.countDistinct("r")).first()
    assert tuple(hot) == (1, 9000, 9000)


def test_hot_value_becomes_one_pair(spark):
    # one value holds 90% of the rows: it is counted, not moved row by row, and ranks as a tie
    from pyspark.sql import Window
    df = spark.createDataFrame([("c", 5.0)] * 9000 + [("c", float(i)) for i in range(1000)], "country string, v double")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("country").orderBy(F.col("v").desc())))
    for method in ("ranged", "window"):
        got = rank_within(df, "country", "v", "r", method=method, blocks=16)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_day_is_split_across_files(spark, tmp_path):
    rows = [(i, 2024, 1, 1) for i in range(20000)] + [(i, 2024, 1, 2 + i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, year int, month int, day int").repartition(8)
    out = str(tmp_path / "days")
    with scoped_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}):
        write_partitioned(df, out, mode="overwrite")
    hot_files = [f for f in os.listdir(os.path.join(out, "year=2024", "month=1", "day=1")) if f.endswith(".parquet")]
    assert len(hot_files) > 1
    assert spark.read.parquet(out).count() == 20500


def test_hot_word_is_combined_before_the_shuffle(spark):
    from lakemart.operators.text import word_count
    docs = spark.createDataFrame([("the " * 500 + f"w{i}",) for i in range(200)], "text string")
    wc = word_count(docs, "text")
    plan = wc._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert {r["word"]: r["n"] for r in wc.collect()}["the"] == 100000


def test_hot_key_is_spread_over_row_number_ranges(spark):
    from pyspark.sql import Window

    from lakemart.operators.paging import number_rows
    # one key holds 90% of the rows; the rest are unique keys
    rows = [(7, i) for i in range(9000)] + [(100 + i, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, v long")
    numbered = number_rows(df, "k")
    spread = (numbered.filter("k = 7").withColumn("_p", F.spark_partition_id())
                      .groupBy("_p").count().collect())
    assert len(spread) > 1                          # the hot key spans several tasks
    want = df.withColumn("row_no", F.row_number().over(Window.orderBy("k", "v")))
    assert numbered.exceptAll(want).count() == 0 and want.exceptAll(numbered).count() == 0


def test_range_blocks_stay_consistent_without_exchange_reuse(spark):
    from pyspark.sql import Window

    from lakemart.operators.paging import number_rows
    rows = [("hot", float(i % 3000)) for i in range(9000)] + [(f"c{i % 9}", float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "country string, v double")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("country").orderBy(F.col("v").desc())))
    with scoped_conf(spark, {"spark.sql.exchange.reuse": "false"}):
        ranked = rank_within(df, "country", "v", "r", method="ranged", blocks=16)
        assert ranked.exceptAll(want).count() == 0 and want.exceptAll(ranked).count() == 0
        numbered = number_rows(df, "country")
        assert sorted(r["row_no"] for r in numbered.collect()) == list(range(1, 10001))


def test_hot_join_key_is_split_by_adaptive_skew_join(spark):
    from lakemart.operators.enrich import join_on_key
    left = spark.createDataFrame([(1, i) for i in range(20000)] + [(k, k) for k in range(2, 2000)],
                                 "user_id long, a long").repartition(8)
    right = spark.createDataFrame([(k, k * 10) for k in range(1, 2000)], "user_id long, b long")
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
                             "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        joined = join_on_key(left, right, "user_id")
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 21998
    assert {r["b"] for r in rows if r["user_id"] == 1} == {10}
    assert "skew=true" in plan
