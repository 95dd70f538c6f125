"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash. Sizes are summed by source and hash bucket; the bucket in which a source's budget
runs out is the only one that is refined, by the next bits of the hash, until it holds one hash. What remains is a
threshold for each source, so choosing documents is a filter: nothing is sorted and no document is moved."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.common import NOT_SPACE, join_small, shielded, stored, table, unshielded

BITS, LEVEL = 60, 12
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2


def hashed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """Add m_size (words), m_hash (60 bits of id and text) and m_key (the source; null has a key of its own)."""
    t = F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("\n"), t))
    return docs.withColumns({
        "m_size": F.regexp_count(t, F.lit(NOT_SPACE + "+")).cast("long"),
        "m_hash": F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long"),
        "m_key": F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")),
    })


def targets(sizes: DataFrame) -> DataFrame:
    """m_key, m_source_size, m_target: one row a source.

    Weights go by the code-point order of the names, null last. The level at which sources stop at MOST times their
    size is found from running sums over the sources in the order in which they stop, all in integers. The window
    holds one row a source, not a row a document."""
    by = sizes.groupBy("m_key").agg(F.sum("m_size").alias("s"))
    rank = Window.orderBy(F.col("m_key") == "n", "m_key")
    stop = Window.orderBy("x", "k")
    every = Window.partitionBy()
    by = by.withColumn("k", F.row_number().over(rank))
    by = by.withColumn("w", F.when(F.col("k") % 3 == 1, WEIGHTS[0]).when(F.col("k") % 3 == 2, WEIGHTS[1]).otherwise(WEIGHTS[2]).cast("long"))
    by = by.withColumn("x", F.col("s") * (F.lit(10) / F.col("w")).cast("long"))
    before = stop.rowsBetween(Window.unboundedPreceding, -1)
    by = by.withColumns({
        "rest": 3 * F.sum("s").over(every) - F.coalesce(F.sum(4 * F.col("s")).over(before), F.lit(0)),
        "w_rest": F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)),
    })
    by = by.withColumn("free", F.col("rest") * F.col("w") <= 4 * F.col("s") * F.col("w_rest"))
    first = F.min(F.when(F.col("free"), F.struct("x", "k", "rest", "w_rest"))).over(every)
    by = by.withColumn("f", first)
    share = (F.col("f.rest") * F.col("w")).cast("double") / (2 * F.col("f.w_rest")).cast("double")
    return by.select("m_key", F.col("s").alias("m_source_size"), F.when(F.col("free"), share).otherwise((MOST * F.col("s")).cast("double")).alias("m_target"))


def thresholds(sizes: DataFrame) -> DataFrame:
    """m_key, m_source_size, m_target, m_all (each document is taken once at least), m_below (hashes below it once more).

    sizes: m_key, m_hash, m_size; it is read once a level and should be stored."""
    plan = targets(sizes)
    plan = plan.withColumn("m_all", (F.col("m_target") >= F.col("m_source_size")) & (F.col("m_source_size") > 0))
    plan = plan.withColumn("budget", F.col("m_target") - F.when(F.col("m_all"), F.col("m_source_size")).otherwise(0))
    # a budget that is not reached takes every hash
    state = plan.withColumns({"prefix": F.lit(0).cast("long"), "before": F.lit(0).cast("long"), "cell": F.col("m_source_size"), "open": F.col("budget") < F.col("m_source_size")})
    shift = BITS
    state = stored(state, "mix")
    while shift:
        old, shift = shift, shift - LEVEL
        inside = join_small(sizes, state.filter("open").select("m_key", "prefix", "before", "budget"), ["m_key"]).filter(F.shiftright("m_hash", old) == F.col("prefix"))
        cells = inside.groupBy("m_key", F.shiftright("m_hash", shift).alias("bucket")).agg(F.sum("m_size").alias("sum"), F.count("*").alias("n"), F.first("before").alias("start"), F.first("budget").alias("limit"))
        order = Window.partitionBy("m_key").orderBy("bucket")  # at most 2 ** LEVEL rows a source
        cells = cells.withColumn("end", F.col("start") + F.sum("sum").over(order))
        hit = cells.filter((F.col("end") > F.col("limit")) & (F.col("end") - F.col("sum") <= F.col("limit")))
        hit = hit.select("m_key", F.col("bucket").alias("to"), (F.col("end") - F.col("sum")).alias("from"), F.col("sum").alias("sum"), "n")
        state = join_small(state.drop("n"), hit, ["m_key"], how="left")
        state = state.select("m_key", "m_source_size", "m_target", "m_all", "budget", F.coalesce("to", "prefix").alias("prefix"), F.coalesce("from", "before").alias("before"), F.coalesce("sum", "cell").alias("cell"), "open", F.coalesce("n", F.lit(0)).alias("n"))
        state = stored(state, "mix")
        if (state.agg(F.max(F.when(F.col("open"), F.col("n")))).first()[0] or 0) <= 1:
            break
    # the last cell is taken where that brings the sum nearer to the budget
    take = 2 * F.col("before") + F.col("cell") <= 2 * F.col("budget")
    below = F.when(~F.col("open"), F.lit(1 << BITS)).otherwise(F.shiftleft(F.col("prefix") + take.cast("long"), shift))
    return state.select("m_key", "m_source_size", "m_target", "m_all", below.alias("m_below"))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """Add m_size, m_source_size, m_target, m_copies (0, 1 or 2) and m_taken (words, copies counted) to every row.

    Null texts have no words; null sources are a source of their own, last in order; null ids hash as empty. Rows
    that share id and text share a hash and are taken together; of equal sources the order is that of their names, so
    there are no ties. With no words at all every target is 0. An empty table gives an empty one. Other columns stay,
    whatever their names; those named like an added one are replaced."""
    own, hidden = shielded(docs, text, doc_id, source)
    own = hashed(own, text, doc_id, source)
    plan = thresholds(stored(own.select("m_key", "m_hash", "m_size"), "sizes"))
    return unshielded(applied(own, plan), hidden)


def applied(own: DataFrame, plan: DataFrame) -> DataFrame:
    out = join_small(own, plan, ["m_key"])
    out = out.withColumn("m_copies", F.col("m_all").cast("int") + (F.col("m_hash") < F.col("m_below")).cast("int"))
    return out.withColumn("m_taken", F.col("m_copies") * F.col("m_size")).drop("m_key", "m_hash", "m_all", "m_below")


def mixed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The rows of the mix: those taken twice stand twice; the columns are those of docs, whatever their names."""
    own, hidden = shielded(docs, text, doc_id, source)
    out = mix(own, text, doc_id, source)
    out = out.withColumn("m_n", F.explode(F.sequence(F.lit(1), F.greatest("m_copies", F.lit(1))))).filter("m_copies > 0").select(own.columns)
    return unshielded(out, hidden)


def query(spark, sf_dir: str) -> DataFrame:
    """op2: what the mix takes of every document."""
    own = stored(hashed(table(spark, sf_dir, "documents")).select("doc_id", "m_key", "m_hash", "m_size"), "sizes")
    out = applied(own, thresholds(own))
    return out.select("doc_id", F.col("m_size").alias("size"), F.col("m_source_size").alias("source_size"), F.col("m_target").alias("target"), F.col("m_taken").alias("taken"))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
w AS (SELECT *, CASE k % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS w, s * CASE k % 3 WHEN 1 THEN 2 WHEN 2 THEN 5 ELSE 10 END AS x FROM s),
r AS (SELECT *, 3 * sum(s) OVER () - coalesce(sum(4 * s) OVER (ORDER BY x, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY x, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_rest FROM w),
f AS (SELECT rest, w_rest FROM r WHERE rest * w <= 4 * s * w_rest ORDER BY x, k LIMIT 1),
t AS (SELECT r.source, r.s, CASE WHEN r.rest * r.w <= 4 * r.s * r.w_rest THEN (f.rest * r.w)::DOUBLE / (2 * f.w_rest)::DOUBLE ELSE (2 * r.s)::DOUBLE END AS target
      FROM r LEFT JOIN f ON true),
b AS (SELECT *, target >= s AND s > 0 AS every, target - CASE WHEN target >= s AND s > 0 THEN s ELSE 0 END AS budget FROM t),
c AS (SELECT source, h, sum(size)::BIGINT AS cell FROM d GROUP BY source, h),
e AS (SELECT *, (sum(cell) OVER (PARTITION BY source ORDER BY h))::BIGINT AS upto FROM c)
SELECT d.doc_id, d.size, b.s AS source_size, b.target,
       (d.size * (every::INT + (budget >= s OR 2 * upto - cell <= 2 * budget)::INT))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN e ON d.source IS NOT DISTINCT FROM e.source AND d.h = e.h
"""
