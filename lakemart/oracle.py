"""SQL text shared by the DuckDB oracle statements.

The fixture views are written once here and prefixed to every statement that
needs them, so each oracle is one self-contained ANSI query over the driver's
tables. Parity rules: money means come from an exact DECIMAL sum divided once
in double (identical on both engines); other means are rounded to 4 places, ranks and
date parts are INTEGER, counts BIGINT, ``||`` (null-propagating) instead of
``concat``, and title case is spelled out as split / capitalise / join.
"""

from __future__ import annotations

FIXTURE_CTES = """
last_order AS (SELECT o_custkey, max(o_orderdate) AS lp FROM orders GROUP BY o_custkey),
profile AS (
  SELECT c_custkey AS user_id,
         CAST(c_custkey % 126 AS INTEGER) AS age,
         CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE lower(n_name) END AS country,
         c_mktsegment AS gender,
         c_acctbal AS income_level,
         CAST(lp AS DATE) AS last_purchase_date
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN last_order ON o_custkey = c_custkey),
ord AS (
  SELECT o_custkey,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS average_order_value,
         min(o_orderpriority) AS preferred_payment_method
  FROM orders GROUP BY o_custkey),
ret AS (
  SELECT o_custkey AS ret_custkey,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS return_rate
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey),
activity AS (
  SELECT o_custkey AS user_id, average_order_value, preferred_payment_method, return_rate
  FROM ord LEFT JOIN ret ON ret_custkey = o_custkey),
joined AS (
  SELECT p.user_id, p.age, p.country, p.gender, p.income_level, p.last_purchase_date,
         a.average_order_value, a.preferred_payment_method, a.return_rate
  FROM profile p JOIN activity a ON p.user_id = a.user_id),
valid AS (
  SELECT * FROM joined
  WHERE age > 0 AND age < 120 AND user_id IS NOT NULL AND income_level >= 0 AND country IS NOT NULL),
ranked AS (
  SELECT *, CAST(rank() OVER (PARTITION BY country ORDER BY average_order_value DESC NULLS LAST) AS INTEGER)
            AS rank_in_country
  FROM valid),
silver AS (
  SELECT user_id, age,
         array_to_string(list_transform(string_split(country, ' '),
                         lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS country,
         gender, income_level, last_purchase_date,
         CAST(year(last_purchase_date) AS INTEGER) AS year,
         CAST(month(last_purchase_date) AS INTEGER) AS month,
         CAST(day(last_purchase_date) AS INTEGER) AS day,
         average_order_value, lower(preferred_payment_method) AS preferred_payment_method,
         return_rate, rank_in_country, avg_global_income
  FROM (SELECT *, CAST(sum(CAST(income_level AS DECIMAL(18,2))) OVER () AS DOUBLE) / count(income_level) OVER () AS avg_global_income,
               row_number() OVER (PARTITION BY user_id
                                  ORDER BY last_purchase_date DESC NULLS LAST, rank_in_country,
                                           age NULLS FIRST, country NULLS FIRST, gender NULLS FIRST,
                                           income_level NULLS FIRST, average_order_value NULLS FIRST,
                                           preferred_payment_method NULLS FIRST, return_rate NULLS FIRST) AS rn
        FROM ranked) t
  WHERE rn = 1)
"""


def with_fixtures(body: str) -> str:
    """Prefix the fixture views to a statement."""
    return "WITH " + FIXTURE_CTES.strip() + "\n" + body.strip()
