"""The layer jobs end to end through the command line, on files."""

import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakemart.__main__ import main
from lakemart.plans import fixtures as fx


def test_bronze_silver_gold_page_report(spark, tmp_path, capsys):
    pc = fx.customer_orders(spark, SF_SMALL)
    info = fx.profile(spark, SF_SMALL, pc)
    act = fx.activity(spark, SF_SMALL, pc).join(
        pc.select(F.col("o_custkey").alias("user_id"), F.col("last_order").cast("date").alias("last_purchase_date")),
        "user_id")
    feeds = {}
    for name, df in (("user_info1", info), ("user_info2", act)):
        path = str(tmp_path / f"{name}.csv")
        df.write.option("header", "true").csv(path)
        feeds[name] = path
    raw, silver, returns = str(tmp_path / "raw"), str(tmp_path / "silver"), str(tmp_path / "returns")

    assert main(["bronze", "--source", f"user_info1={feeds['user_info1']}",
                 "--source", f"user_info2={feeds['user_info2']}", "--out", raw]) == 0
    bronze1 = spark.read.parquet(f"{raw}/user_info1")
    assert {"year", "month", "day"} <= set(bronze1.columns)
    assert bronze1.count() == info.count()

    assert main(["silver", "--info", f"{raw}/user_info1", "--activity", f"{raw}/user_info2", "--out", silver]) == 0
    s = spark.read.parquet(silver)
    assert s.count() > 0
    assert s.groupBy("user_id").count().filter("count > 1").count() == 0

    gold_args = ["gold", "--silver", silver, "--returns", returns, "--database", "gold_cli",
                 "--database-location", str(tmp_path / "gold_cli.db"),
                 "--segmentation-path", str(tmp_path / "customer_segmentation")]
    assert main(gold_args) == 0
    assert main(gold_args) == 0  # re-runnable
    assert spark.table("gold_cli.customer_segmentation").count() == s.count()
    assert spark.table("gold_cli.predictive_returns").count() == s.count()

    capsys.readouterr()
    assert main(["page", "--mart", returns, "--page", "2", "--page-size", "5"]) == 0
    resp = json.loads(capsys.readouterr().out)
    assert resp["page"] == 2 and resp["page_size"] == 5 and resp["total"] == s.count()
    expected = [r["user_id"] for r in s.orderBy("user_id").select("user_id").collect()][5:10]
    assert [it["user_id"] for it in resp["items"]] == expected

    assert main(["report", "--mart", returns]) == 0
    report = json.loads(capsys.readouterr().out)
    assert sum(r["n"] for r in report["age_histogram"]) == s.filter("age is not null").count()


def test_wordcount_job(spark, tmp_path, capsys):
    src = tmp_path / "input"
    src.mkdir()
    (src / "a.txt").write_text("the cat\tthe  hat\n\nThe end\r\nthe\f")
    out = str(tmp_path / "output")
    assert main(["wordcount", "--input", str(src), "--output", out]) == 0
    lines = sorted(p.read_text() for p in (tmp_path / "output").glob("part-*"))
    got = dict(line.split("\t") for chunk in lines for line in chunk.splitlines() if line)
    assert got == {"the": "3", "cat": "1", "hat": "1", "The": "1", "end": "1"}


def test_split_job_keeps_both_ids(spark, tmp_path):
    src = tmp_path / "wide.csv"
    src.write_text("user_id,day,a,b,c\n1,2024-01-01,x,1,\n2,2024-01-02,\"y,z\",2,q\n")
    left, right = str(tmp_path / "left"), str(tmp_path / "right")
    assert main(["split", "--input", str(src), "--left", left, "--right", right, "--id", "user_id", "--id", "day"]) == 0
    halves = [spark.read.option("header", "true").csv(p) for p in (left, right)]
    assert all(h.columns[:2] == ["user_id", "day"] for h in halves)
    back = halves[0].join(halves[1], ["user_id", "day"]).select("user_id", "day", "a", "b", "c").orderBy("user_id")
    assert [tuple(r) for r in back.collect()] == [("1", "2024-01-01", "x", "1", None), ("2", "2024-01-02", "y,z", "2", "q")]


def test_a_range_of_days_leaves_the_others(spark, tmp_path):
    import datetime as dt

    from lakemart.plans.silver import build_silver
    from lakemart.sources.sinks import write_partitioned
    rows = [(i, 30, "fr", "f", 10.0, dt.date(2024, 1, i), 2024, 1, i) for i in (1, 2, 3)]
    info, act, out = (str(tmp_path / n) for n in ("info", "act", "silver"))
    write_partitioned(spark.createDataFrame(rows, "user_id long, age int, country string, gender string, income_level double, "
                                                  "last_purchase_date date, year int, month int, day int"), info)
    spark.createDataFrame([(i, float(i), "x", 0.1) for i in (1, 2, 3)],
                          "user_id long, average_order_value double, preferred_payment_method string, return_rate double"
                          ).write.parquet(act)
    first = {r["user_id"]: r["rank_in_country"] for r in build_silver(spark, info, act, out).collect()}
    again = {r["user_id"]: r["rank_in_country"] for r in build_silver(spark, info, act, out, start="2024-01-02", end="2024-01-02").collect()}
    assert first == again == {1: 3, 2: 2, 3: 1}


def test_output_may_not_lie_in_an_input(spark, tmp_path):
    import pytest

    from lakemart.plans.silver import build_silver
    with pytest.raises(ValueError):
        build_silver(spark, str(tmp_path / "in"), str(tmp_path / "act"), "file:" + str(tmp_path / "in" / "silver"))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest

    from lakemart import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Spark:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Spark())


def test_dedup_first_leaves_no_gaps(spark):
    import datetime as dt

    from lakemart.plans.silver import silver_transform
    info = spark.createDataFrame([(1, 30, "fr", "f", 1.0, dt.date(2024, 1, 1)), (1, 30, "fr", "f", 1.0, dt.date(2024, 1, 2)),
                                  (2, 30, "fr", "m", 2.0, dt.date(2024, 1, 1))],
                                 "user_id long, age int, country string, gender string, income_level double, last_purchase_date date")
    act = spark.createDataFrame([(1, 9.0, "a", 0.1), (2, 5.0, "b", 0.2)],
                                "user_id long, average_order_value double, preferred_payment_method string, return_rate double")
    ranks = [{r["user_id"]: r["rank_in_country"] for r in silver_transform(info, act, dedup_first=d).collect()} for d in (False, True)]
    assert ranks == [{1: 1, 2: 3}, {1: 1, 2: 2}]


def test_quotes_can_be_turned_off(spark, tmp_path):
    import uuid

    from lakemart.sources.files import declare_csv_table
    (tmp_path / "a.csv").write_text('1,"x,y"\n')
    on, off = (declare_csv_table(spark, f"quoted_{uuid.uuid4().hex[:8]}", "a INT, b STRING", str(tmp_path), quote=q).first()
               for q in (None, ""))
    assert on["b"] == "x,y" and off["b"] == '"x'
