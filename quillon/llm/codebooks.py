"""Vector compression by codebooks of parts, learned by Lloyd's rounds that are kept up by differences.

A vector is cut into parts; each part's position has a codebook, and a vector's code is the number of the nearest entry for
each part. Assignments are written to the shared folder after every round, beside those of the round before; a round sends
only what changed: each task adds up the parts that came to an entry and takes off those that left it, and these few sums
are added to the running ones. All is in whole numbers, so sums kept up by differences equal sums made anew."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm.common import hand_back, join_small, shielded, stored, table, unshielded, unstore
from quillon.llm.vectors import SCALE, matrix, whole, width

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Rows whose distances are in memory at once: 64 distances each.
ROWS = 8192

Book = list[np.ndarray]  #: for each part its entries, a row each


def cuts(n: int, parts: int) -> list[tuple[int, int]]:
    """Where the parts of n components lie; equal ones if they can be."""
    return [(n * i // parts, n * (i + 1) // parts) for i in range(parts)]


def nearest(x: np.ndarray, book: Book, at: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """For each row its entries (ties: the lower number) and the squared distances to them, by part."""
    code, error = np.zeros((len(x), len(at)), np.int32), np.zeros((len(x), len(at)), np.int64)
    for i, (a, b) in enumerate(at):
        own, c = x[:, a:b].astype(np.float64), book[i].astype(np.float64)
        far = (c * c).sum(1) - 2 * own @ c.T  # whole numbers below 2^53: exact
        best = far.argmin(1)
        code[:, i], error[:, i] = best, far[np.arange(len(x)), best] + (own * own).sum(1)
    return code, error


def _assigned(book, n: int, parts: int, held: list[str]):
    """mapInArrow: the last assignment of each row becomes its old one, the nearest entries its new one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = cuts(n, parts)
        for big in batches:
            for start in range(0, big.num_rows, ROWS):
                b = big.slice(start, ROWS)
                code, error = nearest(matrix(b.column("_v"), n), book.value, at)
                listed = pa.FixedSizeListArray.from_arrays(pa.array(code.ravel()), parts).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in held], b.column("_v"), b.column("_new"), listed, pa.array(error.sum(1))], [*held, "_v", "_old", "_new", "_error"])
        hand_back()

    return run


def _moved(n: int, parts: int, entries: int):
    """mapInArrow: a task's plus and minus sums of the parts whose entry changed: (entry, component, sum, count), by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = cuts(n, parts)
        sums, counts = [np.zeros((entries, b - a), np.int64) for a, b in at], np.zeros((parts, entries), np.int64)
        for batch in batches:
            x, new = matrix(batch.column("_v"), n).astype(np.int64), matrix(batch.column("_new"), parts)
            old = matrix(batch.column("_old").fill_null(pa.scalar([-1] * parts, pa.list_(pa.int32()))), parts)
            for i, (a, b) in enumerate(at):
                moved = np.flatnonzero(old[:, i] != new[:, i])
                for sign, to in ((1, new[moved, i]), (-1, old[moved, i])):
                    known = to >= 0  # in the first round parts come from nowhere
                    np.add.at(sums[i], to[known], sign * x[moved[known], a:b])
                    np.add.at(counts[i], to[known], sign)
        rows = [(i, e, counts[i][e], sums[i][e]) for i in range(parts) for e in range(entries) if counts[i][e] or sums[i][e].any()]
        yield pa.RecordBatch.from_pydict({"part": pa.array([r[0] for r in rows], pa.int32()), "entry": pa.array([r[1] for r in rows], pa.int32()), "n": pa.array([r[2] for r in rows], pa.int64()), "sums": pa.array([r[3].tolist() for r in rows], pa.list_(pa.int64()))})
        hand_back()

    return run


def _added(df: DataFrame) -> DataFrame:
    """Sums of the same entry added up, component by component."""
    flat = df.select("part", "entry", "n", F.posexplode_outer("sums").alias("at", "x"))
    return flat.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))


def learn(vectors: DataFrame, key: str, n: int, held: list[str], parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Book, DataFrame]:
    """The codebooks, and the rows with _new (entries) and _error under them. vectors: held columns, _v of n components, stored."""
    spark, at = vectors.sparkSession, cuts(n, parts)
    first = vectors.filter(F.col(key).isNotNull()).orderBy(key, "_v").select("_v").limit(entries).collect()
    start = np.array([r["_v"] for r in first], np.int64).reshape(len(first), n)
    book = [start[:, a:b] for a, b in at]
    entries = len(first)
    fields = [vectors.schema[c] for c in held]
    codes = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("_old", "_new")]
    schema = T.StructType([*fields, vectors.schema["_v"], *codes, T.StructField("_error", T.LongType())])
    rows = vectors.select(*held, "_v", F.lit(None).cast("array<int>").alias("_new"))
    sums, last = None, None
    for _ in range(rounds if entries else 0):
        sent = spark.sparkContext.broadcast(book)
        rows = stored(rows.select(*held, "_v", "_new").mapInArrow(_assigned(sent, n, parts, held), schema), "assigned")
        sent.destroy()
        if last is not None:
            unstore(last)
        last = rows
        changes = _added(rows.select("_v", "_old", "_new").mapInArrow(_moved(n, parts, entries), "part int, entry int, n long, sums array<long>"))
        both = changes if sums is None else sums.unionByName(changes).groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        new = stored(both, "sums")  # parts x entries x components of a part, whatever the input
        if sums is not None:
            unstore(sums)
        sums, book = new, [b.copy() for b in book]
        for r in sums.filter("n > 0 AND at IS NOT NULL").collect():
            book[r["part"]][r["entry"], r["at"]] = r["x"] // r["n"]
    if sums is not None:
        unstore(sums)
    out = rows.select(*held, "_v", "_new").mapInArrow(_assigned(spark.sparkContext.broadcast(book), n, parts, held), schema)
    return book, out


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Book]:
    """The rows of vectors with c_code (0-based entries by part) and c_error (squared distance), and the codebooks.

    Codebooks start as the parts of the vectors with the least ids (fewer vectors than entries: as many entries). Left out
    are rows whose vector is null or holds null or non-finite components, and those of another length than that of the
    row with the least id. Ties go to the lower entry; entries that nothing is nearest to stay. Rows without an id are
    compressed and learned from, but don't start a codebook; if there are only such rows, none is returned. Repeated rows
    each count. A length that parts do not divide is cut as evenly as it can be. Other columns stay, whatever their names.
    An empty table gives an empty one and codebooks without entries."""
    df, hidden = shielded(vectors, key)
    own = next((h for h, c in hidden.items() if c == vector), key)
    clean = whole(df, own, "_v")
    n = width(clean, key, "_v")
    held = df.columns
    clean = stored(clean.filter(F.size("_v") == n).select(*held, "_v"), "vectors")
    book, rows = learn(clean, key, n, held, parts, entries, rounds)
    if not len(book[0]):
        rows = clean.limit(0).select(*held, F.array().cast("array<int>").alias("_new"), F.lit(0).cast("long").alias("_error"))
    return unshielded(rows.select(*held, F.col("_new").alias("c_code"), F.col("_error").alias("c_error")), hidden), book


def query(spark, sf_dir: str) -> DataFrame:
    """op11: codes and errors of every sound vector of embeddings."""
    out, book = compress(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    out = stored(out.drop("embedding"), "codes")
    digest = hashlib.sha256(",".join(str(x) for part in book for entry in part.tolist() for x in entry).encode()).hexdigest()
    keyed = out.select("*", F.col("label").isNull().alias("_none"), F.coalesce("label", F.lit(0)).alias("_label"))
    sums = keyed.groupBy("_none", "_label").agg(F.sum("c_error").alias("label_error"))
    return join_small(keyed, sums, ["_none", "_label"]).select(
        "vec_id", F.array_join(F.transform("c_code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
        F.col("c_error").alias("error"), "label_error", F.lit(digest).alias("codebooks_sha256"),
    )


def _oracle() -> str:
    """The same by definition: every round assigns all parts anew and averages all of them anew."""
    book = lambda k: f"b{k}(part, entry, pos, c)"
    assigned = lambda k: f"""
        d{k} AS (SELECT vec_id, p.part, b.entry, sum((p.x - b.c) * (p.x - b.c))::BIGINT AS d FROM p JOIN b{k} b USING (part, pos) GROUP BY ALL),
        a{k} AS (SELECT vec_id, part, d, entry FROM d{k} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)"""  # noqa: E731
    moved = lambda k: f"""
        {book(k + 1)} AS (SELECT b.part, b.entry, b.pos, coalesce(m.c, b.c) FROM b{k} b LEFT JOIN
            (SELECT a.part, a.entry, p.pos, floor(sum(p.x) / count(*))::BIGINT AS c FROM a{k} a JOIN p USING (vec_id, part) GROUP BY ALL) m USING (part, entry, pos))"""  # noqa: E731
    return f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, i // (len(v) // {PARTS}) AS part, i % (len(v) // {PARTS}) AS pos, v[i + 1] AS x FROM (SELECT vec_id, v, unnest(range(len(v))) AS i FROM e)),
s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM e ORDER BY vec_id LIMIT {ENTRIES}),
{book(0)} AS (SELECT part, entry, pos, x FROM p JOIN s USING (vec_id)),
{",".join(f"{assigned(k)},{moved(k)}" for k in range(ROUNDS))},
{assigned(ROUNDS)},
r AS (SELECT vec_id, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b{ROUNDS}) AS codebooks_sha256
FROM r JOIN e USING (vec_id)
"""


ORACLE_SQL = _oracle()
