"""Word count.

Tokens are maximal runs of characters other than space, tab, newline, carriage
return and form feed; case is kept. The whole text of every row is split (no
prefix), exploded and counted; the count is a hash aggregate with a map-side
partial step, so a very frequent word is combined inside each task before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the separator set of the classic whitespace tokenizer
# (space, tab, newline, carriage return, form feed).
WHITESPACE = "[ \\t\\n\\r\\f]+"


def tokens(df: DataFrame, column: str) -> DataFrame:
    """One row per token in column ``word``."""
    words = df.select(F.explode(F.split(F.col(column), WHITESPACE, -1)).alias("word"))
    return words.filter(F.col("word") != "")


def word_count(df: DataFrame, column: str = "text") -> DataFrame:
    """(word, n) over every token of every row."""
    return tokens(df, column).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
