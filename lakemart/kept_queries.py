"""Queries of the layers that are kept over several loads: drifting columns, silver by increments, upserts,
bucketed joins, routed rejects, an index that takes appends; and of the readers of changing or declared text."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.oracle import with_fixtures
from lakemart.plans import fixtures as fx
from lakemart.plans import silver as sv
from lakemart.registry import JOINED_SQL, ORACLE, SILVER_COLUMNS, query, returns_frame, staged_bronze
from lakemart.session import scratch_path
from lakemart.sources.files import read_table_file
from lakemart.sources.sinks import write_csv

# ------------------------------------------------ a feed whose columns change

DRIFT_FEEDS_SQL = """
WITH old_feed AS (
  SELECT CAST(c_custkey AS INTEGER) AS user_id, CAST(c_custkey % 126 AS DOUBLE) AS age, CASE WHEN c_custkey % 97 <> 0 THEN c_mktsegment END AS country,
         c_acctbal AS income_level, CAST(NULL AS VARCHAR) AS email, DATE '2024-01-01' + CAST(c_custkey % 5 AS INTEGER) AS last_purchase_date
  FROM customer WHERE c_custkey % 3 <> 0),
new_feed AS (
  SELECT CAST(c_custkey AS INTEGER) AS user_id, c_custkey % 126 + 0.5 AS age, CASE WHEN c_custkey % 97 <> 0 THEN c_mktsegment END AS country,
         c_acctbal AS income_level, CASE WHEN c_acctbal < 1000 THEN c_name ELSE lower(c_name) || '@example.org' END AS email,
         DATE '2024-01-01' + CAST(c_custkey % 7 AS INTEGER) AS last_purchase_date
  FROM customer WHERE c_custkey % 3 = 0),
"""
DRIFT_ROWS = ("user_id, CAST(age AS DOUBLE) AS age, country, income_level, email, last_purchase_date, CAST(year(last_purchase_date) AS INTEGER) AS year, "
              "CAST(month(last_purchase_date) AS INTEGER) AS month, CAST(day(last_purchase_date) AS INTEGER) AS day")


def drifting_feeds(spark: SparkSession, base: str) -> tuple[str, str]:
    """Two CSV feeds: whole ages and no email; fractional ages, an email, the columns in another order."""
    c = read_table_file(spark, base, "customer")
    country = F.when(F.col("c_custkey") % 97 != 0, F.col("c_mktsegment")).alias("country")
    age = (F.col("c_custkey") % 126).cast("int")

    def day(n: int):
        return F.expr(f"date_add(DATE '2024-01-01', CAST(c_custkey % {n} AS INT))").alias("last_purchase_date")
    email = F.when(F.col("c_acctbal") < 1000, F.col("c_name")).otherwise(F.concat(F.lower("c_name"), F.lit("@example.org")))
    old = c.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("user_id"), age.alias("age"), country,
                                                F.col("c_acctbal").alias("income_level"), day(5))
    new = c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("user_id"), email.alias("email"), (age + F.lit(0.5)).alias("age"),
                                               F.col("c_acctbal").alias("income_level"), country, day(7))
    paths = scratch_path(spark, "drift-old"), scratch_path(spark, "drift-new")
    for df, path in zip((old, new), paths, strict=True):
        write_csv(df, path, header=True)
    return paths


def drifted_bronze(spark: SparkSession, feeds: tuple[str, str]) -> str:
    from lakemart.plans.bronze import load_bronze
    out = scratch_path(spark, "bronze-drift")
    for feed in feeds:
        load_bronze(spark, feed, out, evolving=True)
    return out


@query("bronze_schema_drift", DRIFT_FEEDS_SQL + "both_feeds AS (SELECT * FROM old_feed UNION ALL SELECT * FROM new_feed) "
       f"SELECT o.load_order, {DRIFT_ROWS} FROM both_feeds CROSS JOIN (SELECT unnest(['old first', 'new first']) AS load_order) o")
def q_bronze_schema_drift(spark: SparkSession, base: str) -> DataFrame:
    """Two loads, the second with a new column and a wider type, read as one dataset; in both orders of loading."""
    from lakemart.plans.bronze import read_bronze
    feeds = drifting_feeds(spark, base)
    first = read_bronze(spark, drifted_bronze(spark, feeds)).withColumn("load_order", F.lit("old first"))
    second = read_bronze(spark, drifted_bronze(spark, feeds[::-1])).withColumn("load_order", F.lit("new first"))
    return first.unionByName(second)


@query("bronze_drift_validated", DRIFT_FEEDS_SQL + f"""valid_rows AS (
  SELECT * FROM old_feed WHERE age > 0 AND age < 120 AND income_level >= 0 AND country IS NOT NULL
  UNION ALL
  SELECT * FROM new_feed WHERE age > 0 AND age < 120 AND income_level >= 0 AND country IS NOT NULL AND contains(email, '@'))
SELECT {DRIFT_ROWS} FROM valid_rows""")
def q_bronze_drift_validated(spark: SparkSession, base: str) -> DataFrame:
    """The rules on a drifting dataset: the email rule holds for the days that came with an email column."""
    from lakemart.operators.rules import validate
    from lakemart.sources.evolving import read_evolving
    return read_evolving(spark, drifted_bronze(spark, drifting_feeds(spark, base)), each=validate)


# ------------------------------------------------ silver by increments

LAST_OLD_DAY = "2001-02-15"


@query("silver_incremental", ORACLE["silver"])
def q_silver_incremental(spark: SparkSession, base: str) -> DataFrame:
    """Silver from a state that was brought up to date in three loads of some days each, one of them twice."""
    from lakemart.plans.silver_state import silver_from_state, update_days
    bronze, state = staged_bronze(spark, base), scratch_path(spark, "silver-state")
    update_days(spark, *bronze, state, end="2000-06-30")
    for start, end in (("2001-02-16", None), ("2000-07-01", LAST_OLD_DAY), ("2001-02-16", None)):
        update_days(spark, *bronze, state, start=start, end=end)
    return silver_from_state(spark, state).select(*SILVER_COLUMNS)


@query("silver_changed_days", with_fixtures(f"""
SELECT CAST(year(last_purchase_date) AS INTEGER) AS year, CAST(month(last_purchase_date) AS INTEGER) AS month,
       CAST(day(last_purchase_date) AS INTEGER) AS day, count(*) AS n_rows
FROM valid v
WHERE last_purchase_date <= DATE '{LAST_OLD_DAY}' AND EXISTS (
  SELECT 1 FROM valid n WHERE n.last_purchase_date > DATE '{LAST_OLD_DAY}' AND n.country = v.country
    AND (n.average_order_value > v.average_order_value OR v.average_order_value IS NULL AND n.average_order_value IS NOT NULL))
GROUP BY 1, 2, 3"""))
def q_silver_changed_days(spark: SparkSession, base: str) -> DataFrame:
    """The earlier days whose rows get other ranks by the days since then."""
    from lakemart.plans.silver_state import changed_days, update_days
    bronze, state = staged_bronze(spark, base), scratch_path(spark, "silver-state")
    update_days(spark, *bronze, state)
    return changed_days(spark, state, start="2001-02-16")


# ------------------------------------------------ the latest row of each key, kept

@query("upsert_users", ORACLE["dedup_user"])
def q_upsert_users(spark: SparkSession, base: str) -> DataFrame:
    """Orders in two loads, the later half first: one row for each user, the latest."""
    from lakemart.plans.latest import read_latest, upsert
    orders = read_table_file(spark, base, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").cast("date").alias("last_purchase_date"),
        "o_orderkey", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "latest-users")
    for half in (F.col("last_purchase_date") >= F.lit("1995-06-01"), F.col("last_purchase_date") < F.lit("1995-06-01")):
        upsert(orders.filter(half), path, "user_id", ["last_purchase_date desc"], buckets=16)
    return read_latest(spark, path)


# ------------------------------------------------ join without a shuffle

@query("user_join_bucketed", with_fixtures(JOINED_SQL.format("joined")))
def q_user_join_bucketed(spark: SparkSession, base: str) -> DataFrame:
    """Both feeds stored in buckets by user and sorted, then joined where they lie."""
    from lakemart.sources.sinks import save_bucketed
    info, act = fx.shopper_feeds(spark, base)
    sides = []
    for name, df in (("info", info), ("activity", act)):
        table = f"bucketed_{name}_{uuid.uuid4().hex[:8]}"
        save_bucketed(df, table, "user_id", 8, scratch_path(spark, f"bucketed-{name}"))
        sides.append(spark.table(table))
    return sv.join_feeds(*sides)


# ------------------------------------------------ rejected rows with their reasons

@query("validate_rejects", with_fixtures("""
, judged AS (
  SELECT CASE WHEN age > 0 AND age < 120 THEN 0 ELSE 1 END + CASE WHEN user_id IS NOT NULL THEN 0 ELSE 2 END
         + CASE WHEN income_level >= 0 THEN 0 ELSE 4 END + CASE WHEN country IS NOT NULL THEN 0 ELSE 8 END AS failed
  FROM joined)
SELECT 'combination' AS kind,
       array_to_string(list_filter([CASE WHEN failed & 1 > 0 THEN 'age_range' END, CASE WHEN failed & 2 > 0 THEN 'key_present' END,
                                    CASE WHEN failed & 4 > 0 THEN 'income_non_negative' END,
                                    CASE WHEN failed & 8 > 0 THEN 'country_present' END], lambda x: x IS NOT NULL), '+') AS name, count(*) AS n
FROM judged WHERE failed > 0 GROUP BY failed
UNION ALL SELECT 'rule', 'age_range', count(*) FILTER (failed & 1 > 0) FROM judged
UNION ALL SELECT 'rule', 'key_present', count(*) FILTER (failed & 2 > 0) FROM judged
UNION ALL SELECT 'rule', 'income_non_negative', count(*) FILTER (failed & 4 > 0) FROM judged
UNION ALL SELECT 'rule', 'country_present', count(*) FILTER (failed & 8 > 0) FROM judged
UNION ALL SELECT 'rule', 'email_has_at', CAST(0 AS BIGINT)
UNION ALL SELECT 'outcome', 'accepted', count(*) FILTER (failed = 0) FROM judged
UNION ALL SELECT 'outcome', 'rejected', count(*) FILTER (failed > 0) FROM judged
UNION ALL SELECT 'outcome', 'rows', count(*) FROM judged"""))
def q_validate_rejects(spark: SparkSession, base: str) -> DataFrame:
    """Rows routed by the rules in one pass: counts by outcome, by rule, and by combination of failed rules."""
    from lakemart.operators.rules import route
    routed = route(sv.join_feeds(*fx.shopper_feeds(spark, base)), scratch_path(spark, "routed"))
    counts = [("rule", k.removeprefix("failed_"), v) if k.startswith("failed_") else ("outcome", k, v) for k, v in routed.counts.items()]
    combined = routed.rejected.groupBy("failed", "reasons").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("combination").alias("kind"), F.array_join("reasons", "+").alias("name"), "n")
    return combined.unionByName(spark.createDataFrame(counts, "kind string, name string, n long"))


# ------------------------------------------------ a page index that takes appends

def appended_mart(spark: SparkSession, base: str) -> str:
    """The returns mart in two loads: two thirds of the users, then the rest, which fall between them."""
    from lakemart.plans.page_index import append_rows
    mart, path = returns_frame(spark, base), scratch_path(spark, "indexed-returns")
    for part in (F.col("user_id") % 3 != 0, F.col("user_id") % 3 == 0):
        append_rows(mart.filter(part), path, "user_id", range_rows=200)
    return path


@query("page_after_append", ORACLE["page"])
def q_page_after_append(spark: SparkSession, base: str) -> DataFrame:
    from lakemart.plans.page_index import indexed_page
    return indexed_page(spark, appended_mart(spark, base), 3, 50)


@query("page_after_key", with_fixtures("SELECT user_id, age, income_level, return_rate FROM silver WHERE user_id > 75 ORDER BY user_id LIMIT 50"))
def q_page_after_key(spark: SparkSession, base: str) -> DataFrame:
    from lakemart.plans.page_index import page_after
    return page_after(spark, appended_mart(spark, base), 75, 50)


@query("mart_total_from_footers", with_fixtures("SELECT count(*) AS total FROM silver"))
def q_mart_total_from_footers(spark: SparkSession, base: str) -> DataFrame:
    """The mart's row count from its files' footers (A5)."""
    from lakemart.sources.files import footer_count
    path = scratch_path(spark, "returns-counted")
    returns_frame(spark, base).write.parquet(path)
    return footer_count(spark, path)


# ------------------------------------------------ text of changing or declared shape

@query("json_variant_scan", """
SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS INTEGER) AS state,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END AS balance,
       CASE WHEN s_suppkey % 3 <> 0 OR s_acctbal < 0 THEN NULL ELSE CAST(s_nationkey AS DOUBLE) END AS geo_y
FROM supplier""")
def q_json_variant_scan(spark: SparkSession, base: str) -> DataFrame:
    """Documents of two shapes in one feed, nested ones and flat ones, read by path without inference."""
    from lakemart.registry import supplier_documents
    from lakemart.sources.files import read_json_variant
    from lakemart.sources.sinks import write_text
    nested = supplier_documents(spark, base).filter("recordid % 3 = 0").select(F.to_json(F.struct("fields", "recordid")).alias("value"))
    s = read_table_file(spark, base, "supplier").filter("s_suppkey % 3 <> 0")
    flat = s.select(F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("state"),
                                       F.col("s_acctbal").alias("balance"))).alias("value"))
    path = scratch_path(spark, "two-shapes")
    write_text(nested.unionByName(flat), path)
    columns = {"nested_id": ("$.fields.id", "long"), "flat_id": ("$.id", "long"), "nested_name": ("$.fields.premise_name", "string"),
               "flat_name": ("$.name", "string"), "nested_state": ("$.fields.premise_state", "int"), "flat_state": ("$.state", "int"),
               "balance": ("$.balance", "double"), "geo_y": ("$.fields.geolocation[1]", "double")}
    docs = read_json_variant(spark, path, columns)
    return docs.select(*[F.coalesce(f"nested_{c}", f"flat_{c}").alias(c) for c in ("id", "name", "state")], "balance", "geo_y")


@query("declared_delimited_table", """
SELECT CAST(NULL AS BIGINT) AS c_custkey, '"c_name"' AS c_name, rpad('c_mktsegm', 9, ' ') AS segment, CAST(NULL AS DOUBLE) AS c_acctbal
UNION ALL
SELECT c_custkey,
       CASE c_custkey % 4 WHEN 0 THEN '"' || c_name WHEN 1 THEN c_name || ',escaped' ELSE c_name END,
       CASE c_custkey % 4 WHEN 0 THEN rpad('quoted"', 9, ' ') WHEN 3 THEN NULL ELSE rpad(substr(c_mktsegment, 1, 9), 9, ' ') END,
       CASE WHEN c_custkey % 4 = 1 THEN c_acctbal WHEN c_custkey % 4 = 2 THEN NULL END
FROM customer""")
def q_declared_delimited_table(spark: SparkSession, base: str) -> DataFrame:
    """Delimited text as a declared table means it (S3): a quoted separator cuts, an escaped one does not, ``\\N`` is null, a
    short line ends in nulls, a long one is cut, the header is a row."""
    from lakemart.sources.files import read_delimited
    from lakemart.sources.sinks import write_text
    kind, cells = F.col("c_custkey") % 4, [F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment"), F.col("c_acctbal").cast("string")]
    line = (F.when(kind == 0, F.concat_ws(",", cells[0], F.concat(F.lit('"'), cells[1], F.lit(',quoted"')), cells[2]))  # text for a number
            .when(kind == 1, F.concat_ws(",", cells[0], F.concat(cells[1], F.lit("\\,escaped")), cells[2], cells[3], F.lit("more")))
            .when(kind == 2, F.concat_ws(",", *cells[:3]))
            .otherwise(F.concat_ws(",", cells[0], cells[1], F.lit("\\N"), F.lit("\\N"))))
    path = scratch_path(spark, "delimited")
    head = spark.createDataFrame([('c_custkey,"c_name",c_mktsegment,c_acctbal',)], "value string")
    write_text(read_table_file(spark, base, "customer").select(line.alias("value")).unionByName(head), path)
    return read_delimited(spark, path, "c_custkey BIGINT, c_name STRING, segment CHAR(9), c_acctbal DOUBLE", escape="\\")
