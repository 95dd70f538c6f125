"""Chat formatting with relational operators and built-in expressions only.

Layout of a conversation: every block of adjacent turns with one role is

    <s>ROLE[INST]TEXT[TURN]TEXT...</s>

Control strings inside roles and texts are escaped: a backslash is doubled, and a control string gets one backslash
after its first character. As all other runs of backslashes are even, this can be undone without loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import stored, table

OPEN, SEP, TURN, CLOSE = "<s>", "[INST]", "[TURN]", "</s>"
# The marks of this template, and others that a model may take for marks.
CONTROL = (OPEN, CLOSE, SEP, "[/INST]", TURN, "<<SYS>>", "<</SYS>>")


def escaped(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescaped(text: Column) -> Column:
    out = text
    for c in reversed(CONTROL):
        out = F.replace(out, F.lit(c[0] + "\\" + c[1:]), F.lit(c))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conv_id: conv_id, formatted.

    Turns are sorted by (turn, role, text), nulls first, so ties and repeated rows have one order; null roles and
    texts count as empty. A null conv_id is a conversation of its own. An empty table gives an empty one; other
    columns are dropped. A conversation's turns meet in one row, as its string does; copies of a conversation have
    ids of their own and so never meet."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    by = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    t = F.col("turns")
    marked = F.transform(
        t,
        lambda x, i: F.concat(
            F.when((i > 0) & (F.get(t, i - 1)["role"] == x["role"]), F.lit(TURN))
            .when(i > 0, F.concat(F.lit(CLOSE + OPEN), escaped(x["role"]), F.lit(SEP)))
            .otherwise(F.concat(F.lit(OPEN), escaped(x["role"]), F.lit(SEP))),
            escaped(x["text"]),
        ),
    )
    return by.select("conv_id", F.concat(F.array_join(marked, ""), F.lit(CLOSE)).alias("formatted"))


def parse_chats(formatted: DataFrame) -> DataFrame:
    """The turns of formatted conversations, as an array of (role, text) in `turns`; other columns stay."""
    blocks = F.filter(F.split("formatted", CLOSE), lambda b: b != "")
    body = lambda b: F.split(F.substring(b, len(OPEN) + 1, 1 << 30), r"\[INST\]", 2)

    def turns(b: Column) -> Column:
        role = unescaped(F.get(body(b), 0))
        return F.transform(F.split(F.get(body(b), 1), r"\[TURN\]"), lambda x: F.struct(role.alias("role"), unescaped(x).alias("text")))

    return formatted.withColumn("turns", F.flatten(F.transform(blocks, turns)))


def loss_text(turns: Column) -> Column:
    """All text that the loss covers: what the assistant said."""
    return F.array_join(F.transform(F.filter(turns, lambda x: x["role"] == "assistant"), lambda x: x["text"]), "")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: digests of the conversations, as read back from what was written."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    back = parse_chats(stored(format_chats(rows.unionByName(more)), "chats"))
    t = F.col("turns")
    whole = F.array_join(F.transform(t, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    back = back.withColumn("loss", loss_text(t))
    return back.select(
        "conv_id", F.size(t).cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_escaped(x: str) -> str:
    out = f"replace({x}, '\\', '\\\\')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


ORACLE_SQL = f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k FROM c),
p AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (sum(length({_sql_escaped('text')}) + CASE WHEN k > 1 AND before = role THEN {len(TURN)}
            ELSE length({_sql_escaped('role')}) + {len(OPEN) + len(SEP)} END
            + CASE WHEN k > 1 AND before <> role THEN {len(CLOSE)} ELSE 0 END) + {len(CLOSE)})::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""
