"""Quality rules: a threshold table compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import NOT_SPACE, SPACE, shielded, unshielded, words_of

# Frequent function words of the languages the rules cover.
STOP_WORDS = (
    "the of and to in is that it was for on are as with his they at be this from have or by had not but what all were when "
    "der die das und ist nicht den von zu mit sich des auf dem ein eine im es wie auch "
    "le la les de des et en un une du que qui dans pour pas sur au est ce il elle ou par avec "
    "el los las y un una que en por con no para su al lo como se del"
).split()


@dataclass(frozen=True)
class Rule:
    """One row of the threshold table: the document fails when the metric is outside its bounds."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None


#: Ratios are compared as metric >= least and metric <= most; a null metric (no words) fails nothing.
RULES = (
    Rule("short_words", "mean_word_chars", least=1.5),
    Rule("long_words", "mean_word_chars", most=25.0),
    Rule("symbols", "symbols_per_word", most=0.1),
    Rule("stop_words", "stop_word_ratio", least=0.01),
    Rule("dup_lines", "dup_line_ratio", most=0.5),
    Rule("ellipsis_lines", "ellipsis_line_ratio", most=0.3),
    Rule("bullet_lines", "bullet_line_ratio", most=0.9),
)

#: A position takes the low 30 bits of a sort key, a prefix of its window's hash the rest.
POSITION_BITS = 30


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts that the rules need, prefixed with q_.

    Null text counts as empty; every count is 0 then. Words are runs of characters other than ASCII white space.
    Repeated words: windows of three words are hashed and sorted as single longs (prefix of the hash, position);
    neighbours with one prefix are compared by their words, and the union of the equal windows is counted, so the
    work is n log n for any text. Columns named q_ are this function's own; apply_rules() keeps callers' out of it."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumns({
        "q_words": words_of(F.col(text)),
        "q_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_SPACE)),
        "q_word_chars": F.length(F.regexp_replace(t, SPACE + "+", "")).cast("long"),
        "q_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
    })
    w = F.col("q_words")
    mask = F.lit((1 << POSITION_BITS) - 1).cast("long")
    key = lambda i: F.shiftleft(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), POSITION_BITS).bitwiseOR(i.cast("long"))
    df = df.withColumns({
        "q_n_words": F.size(w).cast("long"),
        "q_n_lines": F.size("q_lines").cast("long"),
        "q_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
        "q_ellipsis_lines": F.size(F.filter("q_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long"),
        "q_bullet_lines": F.size(F.filter("q_lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•][\x20\x09-\x0D]"))).cast("long"),
        "q_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long"),
        "q_keys": F.sort_array(F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), key)).otherwise(F.array().cast("array<bigint>"))),
    })
    k = F.col("q_keys")
    prefix = lambda x: F.shiftright(x, POSITION_BITS)
    df = df.withColumn("q_close", F.filter(k, lambda x, i: (prefix(x) == prefix(F.get(k, i + 1))) | (prefix(x) == prefix(F.get(k, i - 1)))))
    window = lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    df = df.withColumn("q_exact", F.sort_array(F.transform(F.transform("q_close", lambda x: x.bitwiseAND(mask).cast("int")), lambda i: F.struct(window(i).alias("w"), i.alias("i")))))
    e = F.col("q_exact")
    twice = F.filter(e, lambda x, i: (x["w"] == F.get(e, i + 1)["w"]) | (x["w"] == F.get(e, i - 1)["w"]))
    df = df.withColumn("q_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    at = F.col("q_at")
    covered = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
    df = df.withColumn("q_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x))
    return df.drop("q_words", "q_lines", "q_keys", "q_close", "q_exact", "q_at")


def metrics() -> dict[str, Column]:
    over = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return {
        "mean_word_chars": over("q_word_chars", "q_n_words"),
        "symbols_per_word": over("q_symbols", "q_n_words"),
        "stop_word_ratio": over("q_stop_words", "q_n_words"),
        "dup_line_ratio": over("q_dup_lines", "q_n_lines"),
        "ellipsis_line_ratio": over("q_ellipsis_lines", "q_n_lines"),
        "bullet_line_ratio": over("q_bullet_lines", "q_n_lines"),
    }


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules a document fails, as one expression."""
    m = metrics()
    failed = []
    for r in rules:
        if r.least is not None:
            failed.append(F.when(m[r.metric] < r.least, F.lit(r.name)))
        if r.most is not None:
            failed.append(F.when(m[r.metric] > r.most, F.lit(r.name)))
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def base_failed() -> Column:
    return (F.col("q_n_words") < 50) | (100 * F.col("q_repeat_words") > 50 * F.col("q_n_words"))


def apply_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Judge every row; adds the q_ counts, q_base_failed, q_failed (names of failed rules) and q_kept.

    Null and empty texts have no words and fail by length. An empty table gives an empty table; repeated rows are
    each judged; other columns pass through, whatever their names; those named like an added one are replaced."""
    df, hidden = shielded(df, text)
    judged = with_counts(df, text).withColumns({"q_base_failed": base_failed(), "q_failed": compiled(rules)})
    # the row number is a fence: a filter on q_kept that were pushed below the counts would repeat their expressions
    judged = judged.withColumn("q_kept", ~F.col("q_base_failed") & (F.size("q_failed") == 0) & (F.monotonically_increasing_id() >= 0))
    return unshielded(judged, hidden)


def query(spark, sf_dir: str) -> DataFrame:
    """op6: counts and verdict of every document."""
    from quillon.llm.common import table

    q = apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return q.select(
        "doc_id", F.col("q_n_words").alias("n_words"), F.col("q_word_chars").alias("word_chars"), F.col("q_symbols").alias("n_symbols"),
        F.col("q_dup_lines").alias("n_dup_lines"), F.col("q_repeat_words").alias("n_repeat_words"),
        F.col("q_base_failed").alias("base_failed"), F.col("q_kept").alias("kept"),
    )


_IN = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
g2 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g2 WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             len(list_filter(ws, lambda x: lower(x) IN ({_IN})))::BIGINT AS n_stop,
             len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$')))::BIGINT AS n_ell,
             len(list_filter(ls, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•][\\x20\\x09-\\x0D]')))::BIGINT AS n_bul
      FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 1.5 AND 25.0 AND n_symbols / n_words <= 0.1 AND n_stop / n_words >= 0.01
       AND n_dup_lines / n_lines <= 0.5 AND n_ell / n_lines <= 0.3 AND n_bul / n_lines <= 0.9 AS kept
FROM b
"""
