"""Layers kept over several loads: what they read and write, and odd cases."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

from conftest import SF_SMALL
from test_plans import plan

from lakemart.functions.types import common_type, merge_schemas
from lakemart.plans import fixtures as fx
from lakemart.plans import silver as sv


# ------------------------------------------------ drifting columns

def test_common_types():
    assert common_type(IntegerType(), LongType()) == LongType()
    assert common_type(IntegerType(), DoubleType()) == DoubleType()
    assert common_type(IntegerType(), DecimalType(5, 2)) == DecimalType(12, 2)
    assert common_type(LongType(), DecimalType(38, 30)) == DoubleType()
    assert common_type(DateType(), TimestampType()) == TimestampType()
    assert common_type(IntegerType(), StringType()) == StringType()
    inner = StructType([StructField("a", IntegerType())]), StructType([StructField("A", DoubleType()), StructField("b", StringType())])
    merged = merge_schemas(StructType([StructField("s", ArrayType(inner[0]))]), StructType([StructField("S", ArrayType(inner[1]))]))
    assert merged.simpleString() == "struct<s:array<struct<a:double,b:string>>>"


def test_nested_columns_drift(spark, tmp_path):
    from lakemart.sources.evolving import append_evolving, merged_schema, read_evolving
    path = str(tmp_path / "nested")
    day = ", 2024 AS year, 1 AS month, 2 AS day"
    append_evolving(spark.sql("SELECT 1 AS id, named_struct('a', 1) AS s, array(named_struct('x', 1)) AS l, 7 AS v" + day), path)
    append_evolving(spark.sql("SELECT named_struct('b', 'new', 'a', 2.5D) AS s, 2L AS ID, CAST(NULL AS ARRAY<STRUCT<x: BIGINT>>) AS l, 'text' AS v" + day), path)
    assert append_evolving(spark.sql("SELECT 7 AS v, 3 AS id, named_struct('a', 3) AS s, array(named_struct('x', 4)) AS l" + day), path) == 1
    assert merged_schema(spark, path).simpleString() == "struct<id:bigint,s:struct<a:double,b:string>,l:array<struct<x:bigint>>,v:string>"
    rows = {r["id"]: r.asDict(recursive=True) for r in read_evolving(spark, path).collect()}
    assert rows[1]["s"] == {"a": 1.0, "b": None} and rows[1]["l"] == [{"x": 1}] and rows[1]["v"] == "7"
    assert rows[2]["s"] == {"a": 2.5, "b": "new"} and rows[2]["l"] is None and rows[2]["v"] == "text"
    assert rows[3]["s"]["a"] == 3.0


def test_drifting_days_are_pruned_and_replaced(spark, tmp_path):
    from lakemart.sources.evolving import append_evolving, read_evolving
    from lakemart.sources.files import date_range
    path = str(tmp_path / "days")
    for d, extra in ((1, ""), (2, ", 5 AS more"), (3, "")):
        append_evolving(spark.sql(f"SELECT {d} AS id{extra}, 2024 AS year, 1 AS month, {d} AS day"), path)
    picked = read_evolving(spark, path).filter(date_range("2024-01-02", "2024-01-03")).filter("id > 0")
    assert plan(picked).count("PartitionFilters: [isnotnull(year") == 2 and "GreaterThan(id,0)" in plan(picked)
    assert {(r["id"], r["more"]) for r in picked.collect()} == {(2, 5), (3, None)}
    append_evolving(spark.sql("SELECT 30 AS id, 2024 AS year, 1 AS month, 3 AS day"), path, replace_days=True)
    assert {r["id"] for r in read_evolving(spark, path).collect()} == {1, 2, 30}


def test_silver_reads_a_drifting_bronze(spark, tmp_path):
    from lakemart.sources.evolving import append_evolving
    info, act, out = (str(tmp_path / n) for n in ("info", "act", "silver"))
    row = "AS age, 'fr' AS country, 'f' AS gender, 10.0D AS income_level, DATE '2024-01-0{0}' AS last_purchase_date, 2024 AS year, 1 AS month, {0} AS day"
    append_evolving(spark.sql("SELECT 1L AS user_id, 30 " + row.format(1)), info)
    append_evolving(spark.sql("SELECT 2L AS user_id, 30.5D " + row.format(2)), info)
    spark.createDataFrame([(i, float(i), "x", 0.1) for i in (1, 2)],
                          "user_id long, average_order_value double, preferred_payment_method string, return_rate double").write.parquet(act)
    assert {r["user_id"]: r["age"] for r in sv.build_silver(spark, info, act, out).collect()} == {1: 30.0, 2: 30.5}


# ------------------------------------------------ silver by increments

INFO = "user_id long, age int, country string, gender string, income_level double, last_purchase_date date, year int, month int, day int"
ACT = ("user_id long, average_order_value double, preferred_payment_method string, return_rate double, last_purchase_date date, "
       "year int, month int, day int")


def day_feeds(spark, tmp_path, rows):
    """Bronze feeds of ``(user, day, country, order value, age)``; day None: no date."""
    from lakemart.sources.sinks import write_partitioned
    info, act = str(tmp_path / "info"), str(tmp_path / "act")
    date = lambda d: (dt.date(2024, 1, d), 2024, 1, d) if d else (None, None, None, None)
    write_partitioned(spark.createDataFrame([(u, a, c, "f", 10.0 * u, *date(d)) for u, d, c, v, a in rows], INFO), info, mode="overwrite")
    write_partitioned(spark.createDataFrame([(u, v, "Card", 0.1, *date(d)) for u, d, c, v, a in rows], ACT), act, mode="overwrite")
    return info, act


ROWS = [(1, 1, "fr", 5.0, 30), (2, 1, "fr", None, 30), (3, 1, "de", 7.0, 30), (4, 2, "fr", 9.0, 30), (5, 2, "it", 1.0, 30),
        (6, 3, "fr", 6.0, 30), (7, 3, "de", 2.0, 0), (1, 3, "es", 1.0, 30), (8, None, "es", 3.0, 30)]


def silver_rows(frame):
    return sorted((r["user_id"], r["country"], r["rank_in_country"], r["avg_global_income"]) for r in frame.collect())


def test_increments_read_their_days_alone(spark, tmp_path, monkeypatch):
    from lakemart.plans import silver_state as ss
    info, act = day_feeds(spark, tmp_path, ROWS)
    state = str(tmp_path / "state")
    ss.update_days(spark, info, act, state, end="2024-01-02", undated=False)
    read = []
    original = ss.joined_days

    def watched(left, right, key="user_id"):
        joined = original(left, right, key)
        read.append(plan(joined))
        return joined
    monkeypatch.setattr(ss, "joined_days", watched)
    ss.update_days(spark, info, act, state, start="2024-01-03")
    # the range filters the directories of both feeds, and no row filter holds it
    filters = re.findall(r"PartitionFilters: \[(.*?), PushedFilters", read[0])
    assert len(filters) >= 2 and all("make_date(year" in f and ">= 2024" in f for f in filters)
    # each day has its own activity, so one load of all days gives the same
    whole = str(tmp_path / "whole")
    ss.update_days(spark, info, act, whole, undated=False)
    got = silver_rows(ss.silver_from_state(spark, state))
    assert got == silver_rows(ss.silver_from_state(spark, whole))
    # user 1's latest day counts, but its first day's value still has its place among the French ones
    assert [g[:3] for g in got] == [(1, "Es", 1), (2, "Fr", 4), (3, "De", 1), (4, "Fr", 1), (5, "It", 1), (6, "Fr", 2)]


def test_increments_equal_the_full_build(spark, tmp_path):
    from lakemart.plans import silver_state as ss
    rows = [r for r in ROWS if r[:2] != (1, 3)]  # each user on one day
    info, act = day_feeds(spark, tmp_path, rows)
    state = str(tmp_path / "state")
    for start, end in ((None, "2024-01-01"), ("2024-01-03", None), ("2024-01-02", "2024-01-02"), ("2024-01-03", None)):
        ss.update_days(spark, info, act, state, start, end)
    full = sv.silver_transform(spark.read.parquet(info), spark.read.parquet(act), income_scale=2)
    assert silver_rows(ss.silver_from_state(spark, state)) == silver_rows(full)


def test_a_day_loaded_again_loses_its_old_rows(spark, tmp_path):
    from lakemart.plans import silver_state as ss
    state = str(tmp_path / "state")
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    ss.update_days(spark, *day_feeds(spark, tmp_path / "a", ROWS), state)
    # the second delivery of day 2 holds no valid row
    changed = [(u, d, c, v, 0 if d == 2 else a) for u, d, c, v, a in ROWS]
    ss.update_days(spark, *day_feeds(spark, tmp_path / "b", changed), state, start="2024-01-02", end="2024-01-02")
    assert {r["user_id"] for r in ss.silver_from_state(spark, state).collect()} == {1, 2, 3, 6, 8}


def test_changed_days_are_published(spark, tmp_path):
    from lakemart.plans import silver_state as ss
    info, act = day_feeds(spark, tmp_path, ROWS)
    state, out = str(tmp_path / "state"), str(tmp_path / "silver")
    ss.update_days(spark, info, act, state, end="2024-01-02", undated=False)
    ss.publish_days(spark, state, out)
    before = {d: {f for f in spark.read.parquet(out).inputFiles() if f"day={d}/" in f} for d in (1, 2)}
    ss.update_days(spark, info, act, state, start="2024-01-03")
    changed = {(r["year"], r["month"], r["day"]): r["n_rows"] for r in ss.changed_days(spark, state, start="2024-01-03").collect()}
    # user 1 came again and French values below 6 moved; on day 2 the only French value is higher
    assert changed == {(2024, 1, 1): 2}
    published = ss.publish_days(spark, state, out, start="2024-01-03")
    assert {f for f in published.inputFiles() if "day=2/" in f} == before[2]
    assert not {f for f in published.inputFiles() if "day=1/" in f} & before[1]
    want = {(r["user_id"], r["rank_in_country"]) for r in ss.silver_from_state(spark, state).collect()}
    assert {(r["user_id"], r["rank_in_country"]) for r in published.collect()} == want


# ------------------------------------------------ the latest row of each key

def test_untouched_buckets_keep_their_files(spark, tmp_path):
    from lakemart.plans.latest import read_latest, upsert
    path, schema = str(tmp_path / "latest"), "user_id long, day date, v string"
    first = spark.createDataFrame([(i, dt.date(2024, 1, 1), "old") for i in range(200)] + [(None, dt.date(2024, 1, 1), "none")], schema)
    assert upsert(first, path, "user_id", ["day desc"], buckets=8) == list(range(8))
    before = set(read_latest(spark, path).inputFiles())
    late = spark.createDataFrame([(5, dt.date(2024, 1, 2), "new"), (5, dt.date(2024, 1, 3), "newest"), (7, dt.date(2023, 1, 1), "late")], schema)
    touched = upsert(late, path, "user_id", ["day desc"])
    after = set(read_latest(spark, path).inputFiles())
    assert 1 <= len(touched) <= 2 and len(before - after) == len(touched) == len(after - before)
    rows = {r["user_id"]: r["v"] for r in read_latest(spark, path).collect()}
    assert rows == {**{i: "old" for i in range(200)}, 5: "newest", None: "none"}
    assert upsert(late.limit(0), path, "user_id", ["day desc"]) == [] and set(read_latest(spark, path).inputFiles()) == after


def test_a_load_that_dies_leaves_the_last_version(spark, tmp_path, monkeypatch):
    from lakemart.plans import latest
    path, schema = str(tmp_path / "latest"), "user_id long, v int"
    latest.upsert(spark.createDataFrame([(1, 1), (2, 1)], schema), path, "user_id", ["v desc"], buckets=2)

    def dies(*args):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(latest.versioned, "commit", dies)
        with pytest.raises(RuntimeError):
            latest.upsert(spark.createDataFrame([(1, 2)], schema), path, "user_id", ["v desc"])
    assert {tuple(r) for r in latest.read_latest(spark, path).collect()} == {(1, 1), (2, 1)}
    latest.upsert(spark.createDataFrame([(1, 3)], schema), path, "user_id", ["v desc"])
    assert {tuple(r) for r in latest.read_latest(spark, path).collect()} == {(1, 3), (2, 1)}


# ------------------------------------------------ bucketed join

def test_bucketed_join_moves_nothing(spark):
    from lakemart.kept_queries import q_user_join_bucketed
    from lakemart.session import scoped_conf
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        joined = q_user_join_bucketed(spark, SF_SMALL)
        p = plan(joined)
        assert "Exchange" not in p and "SortMergeJoin" in p and p.count("Bucketed: true") == 2
        assert joined.count() == 150


# ------------------------------------------------ rejects

def test_rejects_are_routed_in_one_pass(spark, tmp_path):
    from lakemart.operators.rules import failed_mask, route, shopper_rules, validate
    rows = [(1, 30, 5.0, "fr", "a@b"), (None, 0, -1.0, None, "none"), (2, None, 5.0, "fr", "a@b"), (3, 30, 5.0, "fr", None), (4, 200, 5.0, None, "a@b")]
    df = spark.createDataFrame(rows, "user_id long, age int, income_level double, country string, email string")
    routed = route(df, str(tmp_path / "routed"))
    assert sorted(map(tuple, routed.accepted.collect())) == sorted(map(tuple, validate(df).collect())) == [rows[0]]
    assert routed.accepted.columns == df.columns
    reasons = {r["user_id"]: r["reasons"] for r in routed.rejected.collect()}
    assert reasons == {None: ["age_range", "key_present", "income_non_negative", "country_present", "email_has_at"],
                       2: ["age_range"], 3: ["email_has_at"], 4: ["age_range", "country_present"]}
    assert routed.counts == {"rows": 5, "accepted": 1, "rejected": 4, "failed_age_range": 3, "failed_key_present": 1,
                             "failed_income_non_negative": 1, "failed_country_present": 2, "failed_email_has_at": 2}
    joined = sv.join_feeds(*fx.shopper_feeds(spark, SF_SMALL))
    masked = joined.withColumn("failed", failed_mask(joined, shopper_rules()))
    assert plan(masked).count("customer.parquet") == 1
    empty = route(df.limit(0), str(tmp_path / "none"))
    assert empty.counts["rows"] == 0 and empty.accepted.count() == empty.rejected.count() == 0


# ------------------------------------------------ page index

def test_appends_touch_their_ranges_and_pages_open_theirs(spark, tmp_path):
    from lakemart.plans.page_index import append_rows, indexed_page, page_after, total_rows
    path = str(tmp_path / "mart")
    mart = lambda ids: spark.createDataFrame([(i, i * 2) for i in ids], "user_id long, v long")
    append_rows(mart(range(0, 1000, 2)), path, range_rows=100)
    keys = list(range(0, 1000, 2))
    before = set(indexed_page(spark, path, 1, 200).inputFiles()) | set(indexed_page(spark, path, 3, 200).inputFiles())
    assert append_rows(mart(range(301, 311, 2)), path, range_rows=100) and total_rows(spark, path) == 505
    keys = sorted(keys + list(range(301, 311, 2)))
    for page_no, size in ((1, 50), (4, 50), (11, 50), (3, 17), (2, 200), (12, 50)):
        got = indexed_page(spark, path, page_no, size)
        assert [r["user_id"] for r in got.collect()] == keys[(page_no - 1) * size:page_no * size]
        assert len({f.split("/part=")[1].split("/")[0] for f in got.inputFiles()}) <= -(-size // 100) + 1
    for key in (-5, 0, 99, 300, 303, 998, 2000):
        got = page_after(spark, path, key, 30)
        assert [r["user_id"] for r in got.collect()] == [k for k in keys if k > key][:30]
    after = set(indexed_page(spark, path, 1, 200).inputFiles()) | set(indexed_page(spark, path, 3, 200).inputFiles())
    assert len(before & after) >= len(before) - 1  # one part was replaced
    append_rows(mart([*range(1, 600, 2), *range(-50, 0)]), path, range_rows=100)  # parts that grow are cut
    keys = sorted(keys + [*range(1, 600, 2), *range(-50, 0)])
    assert [r["user_id"] for r in indexed_page(spark, path, 2, 200).collect()] == keys[200:400]
    assert [r["user_id"] for r in indexed_page(spark, path, 5, 200).collect()] == keys[800:1000]


def test_rows_of_one_key_stay_together(spark, tmp_path):
    from lakemart.plans.page_index import append_rows, indexed_page, page_after
    path = str(tmp_path / "mart")
    rows = [(k, n) for k in ("a", "b", "c") for n in range(40)]
    append_rows(spark.createDataFrame(rows[::2], "user_id string, v int"), path, range_rows=15)
    append_rows(spark.createDataFrame(rows[1::2], "user_id string, v int"), path, range_rows=15)
    got = [tuple(r) for p in (1, 2, 3, 4) for r in indexed_page(spark, path, p, 30).collect()]
    assert got == rows
    assert [tuple(r) for r in page_after(spark, path, "a", 50).collect()] == rows[40:90]


def test_small_ranges_share_files(spark, tmp_path, monkeypatch):
    from lakemart.plans import page_index as pi
    path = str(tmp_path / "mart")
    monkeypatch.setattr(pi, "PART_ROWS", 1000, raising=False)
    mart = lambda ids: spark.createDataFrame([(i, i * 2) for i in ids], "user_id long, v long").coalesce(1)
    files = lambda: len(list(tmp_path.glob("mart/parts/load=*/part=*/*.parquet")))
    keys = list(range(0, 8000, 2))
    pi.append_rows(mart(keys), path, range_rows=5)
    assert len(pi._entries(spark, path)) == 800 and files() == 4
    # a few ranges of one part are replaced; the others stay where they are, beside rows that no longer count
    for more in ([2001, 2003, 2041], [-3, 9001], list(range(2000, 2100))):
        before = {(e["load"], e["_range"]) for e in pi._entries(spark, path)}
        replaced = pi.append_rows(mart(more), path, range_rows=5)
        keys = sorted(keys + more)
        after = {(e["load"], e["_range"]) for e in pi._entries(spark, path)}
        assert {r for _, r in before - after} == set(replaced) and len(replaced) <= 12
        assert not {r for _, r in after - before} & {r for _, r in before}  # a number is never given twice
        assert pi.total_rows(spark, path) == len(keys)
    assert files() == 7
    for page_no, size in ((1, 50), (21, 50), (6, 200), (22, 50), (len(keys) // 200 + 1, 200)):
        assert [r["user_id"] for r in pi.indexed_page(spark, path, page_no, size).collect()] == keys[(page_no - 1) * size:page_no * size]
    for key in (-9, -3, 1999, 2041, 2099, 7990, 9001):
        assert [(r["user_id"], r["v"]) for r in pi.page_after(spark, path, key, 60).collect()] == [(k, 2 * k) for k in keys if k > key][:60]


@pytest.mark.parametrize("kind, keys", [
    ("string", ["", "a", "a\u0000b", "a\"b", "a,b", "a\\b", "Z", "\u00e9", "\uffff", "\U0001f600", "\n", "[]", "null"]),
    ("double", [-1e308, -0.1, 0.0, 5e-324, 0.1 + 0.2, 1e22, 2.0 ** 53 + 2]),
    ("float", [-3.4028234663852886e+38, 0.10000000149011612, 1.5]),
    ("long", [-2 ** 63, -1, 0, 2 ** 53 + 1, 2 ** 63 - 1]), ("short", [-2 ** 15, 7, 2 ** 15 - 1])])
def test_limits_of_each_kind_hold_their_rows(spark, tmp_path, kind, keys):
    from lakemart.plans import page_index as pi
    path = str(tmp_path / "mart")
    rows = lambda n: spark.createDataFrame([(k, n) for k in keys], f"user_id {kind}, v int")
    for n in range(3):
        pi.append_rows(rows(n), path, range_rows=1)
    assert [(e["low"], e["high"], e["n_rows"]) for e in pi._entries(spark, path)] == [(k, k, 3) for k in sorted(keys)]
    assert [tuple(r) for r in pi.indexed_page(spark, path, 1, 200).collect()] == [(k, n) for k in sorted(keys) for n in range(3)]


def test_a_mart_with_a_part_for_each_range_takes_appends(spark, tmp_path):
    import json
    from lakemart.plans import page_index as pi
    path, load = str(tmp_path / "mart"), "0123456789ab"
    old = spark.createDataFrame([(i, i, i // 10) for i in range(0, 60, 2)], "user_id long, v long, part int")
    pi.versioned.write_parts(old, path, load)
    pi.versioned.commit(spark, path, [{"part": p, "load": load, "n_rows": 5, "low": str(10 * p), "high": str(10 * p + 8), "key": "user_id",
                                       "schema": json.dumps(old.drop("part").schema.jsonValue())} for p in range(6)],
                        "part int, load string, n_rows long, low string, high string, key string, schema string")
    assert [r["user_id"] for r in pi.page_after(spark, path, 19, 7).collect()] == [20, 22, 24, 26, 28, 30, 32]
    added = spark.createDataFrame([(i, i) for i in (21, 23, 41)], "user_id long, v long")
    assert pi.append_rows(added, path, range_rows=5) == [2, 4]
    assert [r["user_id"] for r in pi.indexed_page(spark, path, 1, 50).collect()] == sorted([*range(0, 60, 2), 21, 23, 41])
    assert [r["user_id"] for r in pi.page_after(spark, path, 38, 4).collect()] == [40, 41, 42, 44]


# ------------------------------------------------ text of changing or declared shape, footers

def test_variants_of_bad_documents(spark, tmp_path):
    from lakemart.sources.files import read_json_variant
    (tmp_path / "docs.json").write_text('{"a": {"b": 1}}\n{"a": [7, 8]}\nno json\n{"a": {"b": "x"}, "c": null}\n\n')
    got = read_json_variant(spark, str(tmp_path / "docs.json"), {"b": ("$.a.b", "int"), "second": ("$.a[1]", "int"), "c": ("$.c", "string")})
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, None, None), (None, 8, None), (None, None, None), (None, None, None), (None, None, None)], key=str)


def test_delimited_fields(spark, tmp_path):
    from lakemart.sources.files import read_delimited
    (tmp_path / "t.txt").write_text('1|"a|b"|x\n2|a\\|b|\\N\n3\n\n5|\\\\|y|z|w\n6||\n')
    got = [tuple(r) for r in read_delimited(spark, str(tmp_path / "t.txt"), "i INT, s STRING, c CHAR(3)", sep="|", escape="\\").collect()]
    assert got == [(1, '"a', 'b" '), (2, "a|b", None), (3, None, None), (None, None, None), (5, "\\", "y  "), (6, "", "   ")]
    plain = [tuple(r) for r in read_delimited(spark, str(tmp_path / "t.txt"), "i INT, s STRING", sep="|").collect()]
    assert plain[1] == (2, "a\\") and plain[4] == (5, "\\\\")


def test_the_count_comes_from_the_footers(spark, tmp_path):
    from lakemart.session import scoped_conf
    from lakemart.sources.files import footer_count, footer_count_plan
    path = str(tmp_path / "rows")
    spark.range(1000).repartition(3).write.parquet(path)
    with scoped_conf(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}):
        assert "PushedAggregation: [COUNT(*)]" in plan(footer_count_plan(spark, path))
    assert footer_count(spark, path).first()["total"] == 1000
