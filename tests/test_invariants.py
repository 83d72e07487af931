
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakemart.operators.enrich import rank_within
from lakemart.operators.paging import number_rows, page, page_by_row_no
from lakemart.operators.project import rejoin, shuffled_halves, vertical_split
from lakemart.operators.sets import replicate, union_by_name
from lakemart.sources.files import read_table_file


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_split_then_rejoin_equals_input(spark):
    orders = read_table_file(spark, SF_SMALL, "orders")
    left, right = vertical_split(orders, ["o_orderkey"], seed=42)
    assert set(left.columns) & set(right.columns) == {"o_orderkey"}
    assert _sorted(rejoin([left, right], ["o_orderkey"]).select(*orders.columns)) == _sorted(orders)


def test_split_matches_python_shuffle_rule():
    cols = ["user_id", "last_purchase_date"] + [f"c{i}" for i in range(9)]
    others = [c for c in cols if c not in ("user_id", "last_purchase_date")]
    random.seed(42)
    random.shuffle(others)
    assert shuffled_halves(cols, ["user_id", "last_purchase_date"], 42) == (others[:4], others[4:])


def test_skew_safe_rank_equals_plain_rank_under_a_hot_group(spark):
    # one group holds most rows, with heavy ties and nulls
    rows = [("hot", float(i % 37) if i % 11 else None) for i in range(3000)]
    rows += [(f"g{i % 7}", float(i % 5)) for i in range(300)] + [(None, 1.0), (None, None)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("id", F.monotonically_increasing_id())
    for desc in (True, False):
        a = rank_within(df, "g", "v", "r", descending=desc, method="ranged", blocks=16).select("id", "r")
        b = rank_within(df, "g", "v", "r", descending=desc, method="window").select("id", "r")
        assert _sorted(a) == _sorted(b)


def test_pages_concatenated_equal_the_ordered_mart(spark):
    df = read_table_file(spark, SF_SMALL, "customer").select("c_custkey", "c_acctbal")
    n = df.count()
    size = 37
    got = []
    for p in range(1, n // size + 2):
        got += [r["c_custkey"] for r in page(df, p, size, "c_custkey").collect()]
    assert got == sorted(r["c_custkey"] for r in df.collect())


def test_row_numbers_are_dense_and_page_by_row_no_equals_page(spark):
    df = read_table_file(spark, SF_SMALL, "customer").select("c_custkey", "c_name").repartition(5)
    numbered = number_rows(df, "c_custkey")
    rows = sorted((r["row_no"], r["c_custkey"]) for r in numbered.collect())
    assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
    assert [r[1] for r in rows] == sorted(r[1] for r in rows)
    for p in (1, 2, 4):
        assert [tuple(r) for r in page_by_row_no(numbered, p, 40).collect()] == \
               [tuple(r) for r in page(df, p, 40, "c_custkey").collect()]


def test_replicate_multiplies_every_group(spark):
    orders = read_table_file(spark, SF_SMALL, "orders")
    base = {r["o_orderpriority"]: r["n"] for r in
            orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).collect()}
    rep = {r["o_orderpriority"]: r["n"] for r in
           replicate(orders, 61).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert rep == {k: v * 61 for k, v in base.items()}


def test_union_by_name_aligns_types(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k bigint")
    c = spark.createDataFrame([("z", "3a")], "v string, k string")
    ab = union_by_name(a, b)
    assert dict(ab.dtypes)["k"] == "bigint" and _sorted(ab) == [(1, "x"), (2, "y")]
    ac = union_by_name(a, c)
    assert dict(ac.dtypes)["k"] == "string" and _sorted(ac) == [("1", "x"), ("3a", "z")]


def test_stream_rerun_adds_nothing(spark, tmp_path):
    from lakemart.streaming.bronze_stream import stream_bronze
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.csv").write_text("user_id,last_purchase_date\n1,2024-01-05\n2,2024-01-06\n")
    out, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    schema = "user_id bigint, last_purchase_date string"
    stream_bronze(spark, str(feed), out, ckpt, schema)
    stream_bronze(spark, str(feed), out, ckpt, schema)
    assert spark.read.parquet(out).count() == 2
    (feed / "b.csv").write_text("user_id,last_purchase_date\n3,2024-01-06\n")
    stream_bronze(spark, str(feed), out, ckpt, schema)
    assert sorted(r["user_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]
