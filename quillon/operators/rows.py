"""Operators on rows: duplicates, versions, rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.shared import Scratch


def ranked_duplicates(df: DataFrame, columns: list[str], order: list[Column], name: str = "dup_rank") -> DataFrame:
    """Number equal rows; 1 is the one to keep."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*columns).orderBy(*order)))


def keep_first(df: DataFrame, columns: list[str], order: list[Column]) -> DataFrame:
    return ranked_duplicates(df, columns, order).filter("dup_rank = 1").drop("dup_rank")


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last version of each key: order says which comes first."""
    return ranked_duplicates(df, key, order, "_v").filter("_v = 1").drop("_v")


def last_by(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is the greatest by order, nulls lowest; of rows that are equal by order any.

    An aggregate: every task keeps one row a key before anything is shuffled, so no key's rows meet, however many."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    by = df.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)]).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return by.select("_row.*")


def sums_before(df: DataFrame, order: list[str], n: str, name: str, scratch: Scratch) -> DataFrame:
    """For each row, the sum of n over all rows before it; order must tell rows apart.

    Two levels: rows are dealt to tasks by ranges of the order and written, the tasks' sums (a row a task) are added up, and
    each range adds up its own rows from there. No task sees all rows."""
    dealt = scratch.put(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy("_range").agg(F.sum(n).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    own = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn(name, F.coalesce(F.sum(n).over(own), F.lit(0))).join(F.broadcast(ranges), "_range").withColumn(name, F.col(name) + F.col("_from")).drop("_range", "_from")


def fenced(c: Column) -> Column:
    """The same value, worked out once: a filter on it stays above the projection that makes it, where the optimizer
    would otherwise repeat the whole expression in the filter and in all that it infers from it."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


@dataclass(frozen=True)
class Rule:
    """A data-quality rule. severity: error, exclude, exclude_country, corrected or warn."""

    id: str
    severity: str
    text: str


def broken(rules: list[tuple[str, Column]]) -> Column:
    """The ids of the rules that a row breaks, in their order; a rule that is null doesn't hold."""
    return F.array_compact(F.array(*[F.when(p, F.lit(i)) for i, p in rules]))


def rule_counts(catalogue: DataFrame, events: DataFrame) -> DataFrame:
    """Every rule of the catalogue in order, with its hits, 0 where there are none."""
    n = events.groupBy("rule_id").agg(F.count("*").alias("hits"))
    return catalogue.join(n, "rule_id", "left").withColumn("hits", F.coalesce("hits", F.lit(0)))


def duplicated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """One row for each key that stands more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
