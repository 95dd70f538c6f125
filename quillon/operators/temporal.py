"""Operators on time: as-of joins, gaps, months at risk, monthly balances, rolling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONTH = "interval 1 month"


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_at: str, right_at: str, tie: list[Column] | None = None) -> DataFrame:
    """Left join with the last row of right that is not later, by key.

    Both sides are stacked and sorted by key and time, right before left at one time; each left row takes the last
    right row before it. That is one shuffle and one sort, whatever number of rows a key has on both sides. Of right
    rows at one time the last by tie counts. Null keys and null times match nothing."""
    own = [c for c in right.columns if c not in on]
    keys = [f"_k{i}" for i in range(len(on))]
    ties = [f"_t{i}" for i in range(len(tie or []))]
    shape_l, shape_r = F.struct(*[F.col(f"`{c}`") for c in left.columns]), F.struct(*[F.col(f"`{c}`") for c in own])
    a = left.select(*[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)], F.col(left_at).alias("_at"), F.lit(1).alias("_side"), shape_l.alias("_l"))
    b = right.select(*[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)], F.col(right_at).alias("_at"), F.lit(0).alias("_side"), shape_r.alias("_r"), *[t.alias(n) for t, n in zip(tie or [], ties, strict=True)])
    b = b.dropna(subset=[*keys, "_at"])
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_at"), "_side", *ties).rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_m", F.last("_r", ignorenulls=True).over(order))
    return both.filter("_side = 1").select("_l.*", *[F.col(f"_m.`{c}`").alias(c) for c in own])


def missing_periods(at: Column, following: Column, months: Column) -> Column:
    """The period starts between one and the next, at a step of so many months; none where the next follows at once."""
    steps = F.floor(((F.year(following) - F.year(at)) * 12 + F.month(following) - F.month(at)) / months).cast("int") - 1
    return F.when(steps > 0, F.transform(F.sequence(F.lit(1), steps), lambda i: F.add_months(at, i * months))).otherwise(F.array().cast("array<date>"))


def gaps(df: DataFrame, key: list[str], at: str, months: str) -> DataFrame:
    """Periods between a key's first and last that have no row, found from each row's next; key columns may be null."""
    following = F.lead(at).over(Window.partitionBy(*key).orderBy(at))
    own = df.select(*key, at, months, following.alias("_next"))
    return own.select(*key, F.explode(missing_periods(F.col(at), F.col("_next"), F.col(months))).alias("expected_start"))


def months_at_risk(spells: DataFrame, start: str, end: str, last_month: Column) -> DataFrame:
    """A row for each spell and month that begins after start and not after end: linear, without a range join."""
    first = F.add_months(F.trunc(start, "month"), 1)
    last = F.least(F.coalesce(F.trunc(end, "month"), last_month), last_month)
    return spells.filter(first <= last).withColumn("month_start", F.explode(F.sequence(first, last, F.expr(MONTH))))


def monthly_balance(moves: DataFrame, key: list[str], at: str, change: str, flows: list[str], last: Column, together: bool = False) -> DataFrame:
    """Dense months by key, up to last: the running sum of change, and each month's own sum of every flow.

    moves has month starts in `at`. Months run from the key's first move, or from the first of all keys (together).
    Moves are summed before anything meets, so a key's months (a few hundred) are all that is gathered."""
    sums = [change, *flows]
    by = moves.groupBy(*key, at).agg(*[F.sum(c).alias(c) for c in sums])
    rows = by.groupBy(*key).agg(F.min(at).alias("_a"), F.map_from_entries(F.collect_list(F.struct(at, F.struct(*sums)))).alias("_m"))
    if together:
        rows = rows.withColumn("_a", F.min("_a").over(Window.partitionBy()))  # a row a key
    dense = rows.filter(F.col("_a") <= last).select(*key, "_m", F.explode(F.sequence("_a", last, F.expr(MONTH))).alias(at))
    flat = dense.select(*key, at, *[F.coalesce(F.try_element_at("_m", F.col(at))[c], F.lit(0)).alias(c) for c in sums])
    before = Window.partitionBy(*key).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return flat.withColumn(change, F.sum(change).over(before))


def trailing(key: list[str], at: str, rows: int = 12):
    return Window.partitionBy(*key).orderBy(at).rowsBetween(1 - rows, 0)
