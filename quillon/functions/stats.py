"""Statistics as columns and small solvers."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Z = 1.96
Z_EXACT = 1.959963984540054


def wilson(k: Column, n: Column, upper: bool) -> Column:
    """A bound of the Wilson interval of k in n; null unless n > 0 and 0 <= k <= n."""
    p, z2 = k / n, Z * Z
    half = Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    centre = p + z2 / (2 * n)
    return F.when((n > 0) & (k >= 0) & (k <= n), (centre + half if upper else centre - half) / (1 + z2 / n))


#: Steps of p-values that are ranked apart: even ones, and one for each halving below the first.
BINS = 4096


def p_bin(p: Column) -> Column:
    """A number that rises with p, one of a few thousand."""
    return F.when(p * BINS >= 1, F.floor(p * BINS)).when(p > 0, -F.ceil(-F.log2(p))).otherwise(-2000).cast("int")


def benjamini_hochberg(df: DataFrame, p: str = "p_value", q: str = "q_value") -> DataFrame:
    """Add q-values of the rows that have a p-value: the least of p * m / rank over this and all larger p.

    Equal p-values are counted first and ranked once. Ranks and minima are taken bin by bin; what stands in lower and
    higher bins is added from a table of a row a bin, the only one that a single task sees."""
    tests = df.filter(F.col(p).isNotNull())
    by = tests.groupBy(F.col(p).alias("_p")).agg(F.count("*").alias("_n")).withColumn("_b", p_bin(F.col("_p")))
    bins = by.groupBy("_b").agg(F.sum("_n").alias("_s"))
    lower = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("_b", F.coalesce(F.sum("_s").over(lower), F.lit(0)).alias("_o"), F.sum("_s").over(Window.partitionBy()).alias("_t"))
    rank = F.col("_o") + F.sum("_n").over(Window.partitionBy("_b").orderBy("_p"))
    raw = by.join(F.broadcast(bins), "_b").withColumn("_q", F.col("_p") * F.col("_t") / rank)
    higher = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    least = raw.groupBy("_b").agg(F.min("_q").alias("_l")).select("_b", F.min("_l").over(higher).alias("_l"))
    down = F.min("_q").over(Window.partitionBy("_b").orderBy(F.desc("_p")))
    found = raw.join(F.broadcast(least), "_b").select("_p", F.least(F.lit(1.0), down, "_l").alias(q))  # least() passes over nulls
    ranked = tests.join(found, F.col(p) == F.col("_p")).drop("_p")
    return ranked.unionByName(df.filter(F.col(p).isNull()).withColumn(q, F.lit(None).cast("double")))


#: Below it the tail of the normal law comes from a series, beyond it from a continued fraction, both of so many terms.
NEAR, TERMS = 2.2, 80


def two_sided(z: Column) -> Column:
    """How likely a standard normal value is at least as far from 0 as z; to about twelve digits."""
    x = F.abs(z) / math.sqrt(2)
    near = F.least(x, F.lit(NEAR))
    start = F.struct(near.alias("term"), near.alias("sum"))

    def more(a: Column, k: Column) -> Column:
        term = a["term"] * 2 * near * near / (2 * k + 1)
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    series = 1 - 2 / math.sqrt(math.pi) * F.exp(-near * near) * F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, more, lambda a: a["sum"])
    far = F.greatest(x, F.lit(NEAR))
    fraction = F.aggregate(F.sequence(F.lit(TERMS), F.lit(1)), far, lambda a, k: far + k / 2 / a)
    return F.when(x < NEAR, series).when(x >= NEAR, F.exp(-far * far) / math.sqrt(math.pi) / fraction)  # null has no tail


def six_digits(x: Column) -> Column:
    """Rounded to six significant digits."""
    return F.when(x.isNotNull(), F.format_string("%.5e", x)).cast("double")


class ModelFailed(ValueError):
    """A fit without a usable result."""


def clustered_logit(x: np.ndarray, n: np.ndarray, events: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and cluster-robust covariance of a logistic regression over cells.

    A cell has one row of x, n persons and their events, and is a cluster; persons' rows are never needed, as both
    results depend on a cell's sums alone."""
    if np.linalg.matrix_rank(x) < x.shape[1]:
        raise ModelFailed("columns depend on each other")
    b = np.zeros(x.shape[1])
    for _ in range(100):
        eta = x @ b
        if np.abs(eta).max() > 30:
            raise ModelFailed("events are separated")
        mu = 1 / (1 + np.exp(-eta))
        hessian = (x * (n * mu * (1 - mu))[:, None]).T @ x
        step = np.linalg.solve(hessian, x.T @ (events - n * mu))
        b = b + step
        if np.abs(step).max() < 1e-12:
            break
    else:
        raise ModelFailed("no convergence")
    mu = 1 / (1 + np.exp(-(x @ b)))
    bread = np.linalg.inv((x * (n * mu * (1 - mu))[:, None]).T @ x)
    s = x * (events - n * mu)[:, None]
    g, rows, k = len(n), float(n.sum()), x.shape[1]
    if g < 2 or rows <= k:
        raise ModelFailed("too few clusters")
    return b, bread @ (s.T @ s) @ bread * (g / (g - 1)) * ((rows - 1) / (rows - k))
