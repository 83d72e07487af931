"""Hand-made edge rows (FIXTURES.md §C), one test per trap."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.functions.scalar import array_item, split_item
from lakemart.operators.enrich import keep_one_per_key, rank_within, with_global_mean
from lakemart.operators.paging import page, page_summary
from lakemart.operators.rules import validate
from lakemart.plans.bronze import add_date_partitions
from lakemart.plans.silver import DEDUP_ORDER, join_feeds, silver_transform

INFO_SCHEMA = "user_id bigint, age int, country string, gender string, income_level double, last_purchase_date date"
ACT_SCHEMA = "user_id bigint, average_order_value double, preferred_payment_method string, return_rate double"


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_validation_bounds_and_nulls(spark):
    rows = [
        (1, None, "us", 1.0), (2, 0, "us", 1.0), (3, 1, "us", 1.0), (4, 119, "us", 1.0),
        (5, 120, "us", 1.0), (6, -1, "us", 1.0), (7, 30, "us", None), (8, 30, "us", 0.0),
        (9, 30, "us", -0.01), (10, 30, None, 1.0), (11, 30, "", 1.0), (12, 30, " us", 1.0),
        (None, 30, "us", 1.0),
    ]
    df = spark.createDataFrame(rows, "user_id bigint, age int, country string, income_level double")
    kept = sorted(r["user_id"] for r in validate(df).collect())
    assert kept == [3, 4, 8, 11, 12]


def test_validation_on_text_numbers_does_not_fail(spark):
    df = spark.createDataFrame([(1, "30", "us", "12.5"), (2, "x", "us", "1"), (3, "40", "us", "abc")],
                               "user_id bigint, age string, country string, income_level string")
    assert [r["user_id"] for r in validate(df).collect()] == [1]


@pytest.mark.parametrize("method", ["ranged", "window"])
def test_rank_ties_gaps_and_nulls_last(spark, method):
    df = spark.createDataFrame(
        [(1, "fr", 10.0), (2, "fr", 10.0), (3, "fr", 5.0), (4, "fr", None), (5, "de", 1.0)],
        "user_id bigint, country string, average_order_value double")
    out = rank_within(df, "country", "average_order_value", "r", method=method)
    assert _rows(out, "user_id", "r") == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 1)]


@pytest.mark.parametrize("method", ["ranged", "window"])
def test_raw_country_ranked_apart_then_title_cased(spark, method):
    info = spark.createDataFrame(
        [(1, 30, "france", "m", 1.0, dt.date(2024, 1, 1)), (2, 30, "FRANCE", "f", 2.0, dt.date(2024, 1, 2))],
        INFO_SCHEMA)
    act = spark.createDataFrame([(1, 5.0, "CARD", 0.1), (2, 9.0, "Cash", 0.2)], ACT_SCHEMA)
    out = silver_transform(info, act, rank_method=method, materialize=False)
    assert _rows(out, "user_id", "country", "rank_in_country", "preferred_payment_method") == [
        (1, "France", 1, "card"), (2, "France", 1, "cash")]


def test_duplicates_multiply_then_dedup_keeps_one(spark):
    info = spark.createDataFrame(
        [(1, 30, "fr", "m", 10.0, dt.date(2024, 1, 1)), (1, 30, "fr", "m", 10.0, dt.date(2024, 3, 1)),
         (2, 40, "fr", "f", 20.0, dt.date(2024, 1, 1))], INFO_SCHEMA)
    act = spark.createDataFrame([(1, 5.0, "a", 0.1), (1, 7.0, "b", 0.2), (2, 6.0, "c", 0.3)], ACT_SCHEMA)
    assert join_feeds(info, act).filter("user_id = 1").count() == 4
    out = silver_transform(info, act, materialize=False)
    got = {r["user_id"]: r for r in out.collect()}
    assert len(got) == 2
    # the rank and the mean saw all five joined rows
    # user 1's 7.0 appears twice (1, 1), then user 2's 6.0 (3), then 5.0 twice (4, 4)
    assert got[2]["rank_in_country"] == 3
    assert got[2]["avg_global_income"] == pytest.approx((10 * 4 + 20) / 5)
    # user 1 keeps its latest purchase, then the best rank
    assert got[1]["last_purchase_date"] == dt.date(2024, 3, 1)
    assert got[1]["rank_in_country"] == 1


def test_dedup_is_deterministic_under_any_input_order(spark):
    rows = [(1, dt.date(2024, 1, 1), 5), (1, dt.date(2024, 1, 1), 3), (1, None, 1), (2, None, 9)]
    schema = "k bigint, d date, v int"
    a = keep_one_per_key(spark.createDataFrame(rows, schema), "k", ["d desc"])
    b = keep_one_per_key(spark.createDataFrame(rows[::-1], schema).repartition(3), "k", ["d desc"])
    assert _rows(a, "k", "d", "v") == _rows(b, "k", "d", "v") == [(1, dt.date(2024, 1, 1), 3), (2, None, 9)]


def test_bad_dates_give_null_partitions(spark, tmp_path):
    df = spark.createDataFrame([("2024-02-30",), ("",), (None,), ("2024-02-29",)], "last_purchase_date string")
    out = add_date_partitions(df, "last_purchase_date")
    assert _rows(out.fillna({"last_purchase_date": "-"}), "last_purchase_date", "year", "month", "day") == sorted([
        ("2024-02-30", None, None, None), ("", None, None, None), ("-", None, None, None),
        ("2024-02-29", 2024, 2, 29)], key=lambda r: r[0])


def test_same_day_loaded_twice_doubles(spark, tmp_path):
    from lakemart.plans.bronze import load_bronze
    src = tmp_path / "feed.csv"
    src.write_text("user_id,last_purchase_date\n1,2024-01-05\n2,2024-01-05\n3,2024-02-30\n")
    out = str(tmp_path / "bronze")
    load_bronze(spark, str(src), out)
    load_bronze(spark, str(src), out)
    back = spark.read.parquet(out)
    counts = {(r["year"], r["month"], r["day"]): r["n"] for r in
              back.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {(2024, 1, 5): 4, (None, None, None): 2}


def test_dynamic_overwrite_replaces_only_loaded_days(spark, tmp_path):
    from lakemart.plans.bronze import load_bronze
    a = tmp_path / "a.csv"
    a.write_text("user_id,last_purchase_date\n1,2024-01-05\n2,2024-01-06\n")
    b = tmp_path / "b.csv"
    b.write_text("user_id,last_purchase_date\n3,2024-01-06\n")
    out = str(tmp_path / "bronze")
    load_bronze(spark, str(a), out)
    load_bronze(spark, str(b), out, replace_days=True)
    assert sorted(r["user_id"] for r in spark.read.parquet(out).collect()) == [1, 3]


def test_email_rule_only_when_column_exists(spark):
    base = [(1, 30, "us", 1.0), (2, 30, "us", 1.0), (3, 30, "us", 1.0)]
    no_email = spark.createDataFrame(base, "user_id bigint, age int, country string, income_level double")
    assert validate(no_email).count() == 3
    with_email = spark.createDataFrame([r + (e,) for r, e in zip(base, [None, "a@b", "ab"])],
                                       "user_id bigint, age int, country string, income_level double, email string")
    assert [r["user_id"] for r in validate(with_email).collect()] == [2]


def test_page_bounds(spark):
    df = spark.range(1, 8).withColumnRenamed("id", "user_id")  # 7 rows
    assert [r["user_id"] for r in page(df, 1, 3).collect()] == [1, 2, 3]
    assert [r["user_id"] for r in page(df, 3, 3).collect()] == [7]
    assert page(df, 4, 3).count() == 0
    s = page_summary(df, 4, 3).first()
    assert (s["page"], s["page_size"], s["total"], s["n_items"]) == (4, 3, 7, 0)
    assert page_summary(df, 3, 3).first()["n_items"] == 1
    for bad in [(0, 3), (1, 0), (1, 201)]:
        with pytest.raises(ValueError):
            page(df, *bad)


def test_split_and_array_items_never_fail(spark):
    df = spark.createDataFrame(
        [(None, None), ("4", []), ("1 - Restaurant", [1.5]), ("1 - A - B", [1.5, 2.5])],
        "t string, geo array<double>")
    out = df.select(split_item("t", " - ", 1).alias("kind"), array_item("geo", 0).alias("x"),
                    array_item("geo", 1).alias("y")).collect()
    assert [(r.kind, r.x, r.y) for r in out] == [
        (None, None, None), (None, None, None), ("Restaurant", 1.5, None), ("A", 1.5, 2.5)]


def test_global_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0)], "k int, v double")
    assert {r["m"] for r in with_global_mean(df, "v", "m").collect()} == {3.0}


def test_dedup_order_spec():
    assert DEDUP_ORDER == ["last_purchase_date desc", "rank_in_country"]
