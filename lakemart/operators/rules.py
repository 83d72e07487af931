"""Row validation (F1-F6): one conjunctive predicate built from named rules.

A row survives only when the whole predicate is TRUE; a null anywhere drops it,
exactly like SQL ``WHERE``. Rules that name a column the frame does not have are
decided at plan time from the schema (the email rule is the reference case):
the rule is left out, it never fails the job.

The predicate is a single ``filter`` so Catalyst can push the parts that touch
only scan columns into the Parquet reader and below the join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from lakemart.functions.scalar import as_number


@dataclass(frozen=True)
class Rule:
    name: str
    columns: tuple[str, ...]
    build: Callable[[DataFrame], Column]
    optional: bool = False  # skip (instead of failing) when a column is absent

    def applies_to(self, df: DataFrame) -> bool:
        return all(c in df.columns for c in self.columns)


def between_exclusive(column: str, low: float, high: float, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_range", (column,),
                lambda df: (as_number(column, df.schema[column].dataType) > low)
                & (as_number(column, df.schema[column].dataType) < high))


def at_least(column: str, low: float, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_min", (column,),
                lambda df: as_number(column, df.schema[column].dataType) >= low)


def required(column: str, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_present", (column,), lambda df: F.col(column).isNotNull())


def contains(column: str, needle: str, optional: bool = True, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_contains", (column,),
                lambda df: F.col(column).contains(needle), optional=optional)


def shopper_rules(key: str = "user_id") -> list[Rule]:
    """The silver rule set: age in (0, 120), key present, income >= 0,
    country present, and ``@`` in the email only when an email column exists."""
    return [
        between_exclusive("age", 0, 120, "age_range"),
        required(key, "key_present"),
        at_least("income_level", 0, "income_non_negative"),
        required("country", "country_present"),
        contains("email", "@", optional=True, name="email_has_at"),
    ]


def predicate(df: DataFrame, rules: list[Rule]) -> Column | None:
    """Fold the applicable rules with AND; None when no rule applies."""
    parts = []
    for rule in rules:
        if rule.applies_to(df):
            parts.append(rule.build(df))
        elif not rule.optional:
            missing = [c for c in rule.columns if c not in df.columns]
            raise ValueError(f"rule {rule.name!r} needs missing column(s) {missing}")
    if not parts:
        return None
    return reduce(lambda a, b: a & b, parts)


def failed_mask(df: DataFrame, rules: list[Rule]) -> Column:
    """A bit for each rule of the list, set where the rule is false or null; a rule that is left out never fails."""
    predicate(df, rules)  # a missing column that is not optional is an error here, too
    bits = [F.when(F.coalesce(rule.build(df), F.lit(False)), F.lit(0)).otherwise(F.lit(1 << i))
            for i, rule in enumerate(rules) if rule.applies_to(df)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0)).cast("int")


def failed_names(mask: str | Column, rules: list[Rule]) -> Column:
    """The names of the rules whose bits are set, in the order of the list."""
    mask = F.col(mask) if isinstance(mask, str) else mask
    return F.filter(F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(r.name)) for i, r in enumerate(rules)]),
                    lambda name: name.isNotNull())


@dataclass(frozen=True)
class Routed:
    """Accepted rows (the columns of the input), rejected ones (with ``failed``, the mask, and ``reasons``, the rules' names),
    and ``counts``: rows in all, accepted, rejected, and failed by rule."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def route(df: DataFrame, path: str, rules: list[Rule] | None = None) -> Routed:
    """Write the rows of ``df`` to ``path`` by whether every rule holds, in one pass over it.

    All rules are decided for every row and kept as a bit mask (an int: 30 rules at most), so a row that fails
    several names them all. The counts are observed while the rows are written; nothing is read twice. The two
    outputs are the directories ``accepted=true`` and ``accepted=false``."""
    rules = rules if rules is not None else shopper_rules()
    if len(rules) > 30:
        raise ValueError("at most 30 rules fit the mask")
    seen = Observation()
    masked = df.withColumn("failed", failed_mask(df, rules))
    fails = [F.count_if(F.col("failed").bitwiseAND(F.lit(1 << i)) != 0).alias(f"failed_{r.name}") for i, r in enumerate(rules)]
    ok = F.col("failed") == 0
    masked = masked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("accepted"),
                            F.count_if(~ok).alias("rejected"), *fails)
    masked.withColumn("accepted", ok).write.mode("overwrite").partitionBy("accepted").parquet(path)
    schema = StructType([*[StructField(f.name, f.dataType) for f in df.schema.fields], StructField("failed", IntegerType()),
                         StructField("accepted", BooleanType())])
    back = df.sparkSession.read.schema(schema).parquet(path)
    return Routed(back.filter("accepted").drop("failed", "accepted"),
                  back.filter("NOT accepted").drop("accepted").withColumn("reasons", failed_names("failed", rules)), seen.get)


def validate(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Keep the rows for which every applicable rule is true."""
    cond = predicate(df, rules if rules is not None else shopper_rules())
    return df if cond is None else df.filter(cond)

