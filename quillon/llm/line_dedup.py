"""Dropping lines that many documents share, with two Bloom filters before anything is shuffled.

Every task marks the bits of its lines' hashes once and, at a second sight, twice. The tasks' marks meet by slices of
the filters: a bit that two tasks have marked is marked twice. A line whose bits are all marked twice is suspected of
repeating; only such lines are shuffled, by their 128-bit digests, to count documents exactly and to choose the
document that keeps them. The filters can only err towards suspicion, so the result doesn't depend on their size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import hand_back, hot_of, join_hot, shielded, stored, table, unshielded, unstore
from quillon.llm.repeats import repeat_filter, size_for, suspected

SPACES = b" \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 20, 3
#: Keys to drop that are broadcast at most (24 bytes each); more are joined by document instead.
MOST_KEYS = 200_000
LEAST_ID = -(1 << 63)


def keys_of(text: bytes | None) -> list[bytes | None]:
    """Digest of each line's key, None for lines that are too short to drop."""
    out = []
    for line in (text or b"").split(b"\n"):
        key = line.strip(SPACES)
        if len(key) < LEAST_CHARS or (len(key) < 4 * LEAST_CHARS and not key.isascii() and len(key.decode()) < LEAST_CHARS):
            out.append(None)
        else:
            out.append(xxhash.xxh3_128_digest(key.lower()))
    return out


def hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)


def line_hashes(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    for text in b.column(0).to_pylist():
        yield hashes(list({k for k in keys_of(text) if k}))


def suspects(twice, bits: int):
    """mapInArrow over (id, text): the keys that may repeat, once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = np.frombuffer(twice.value, np.uint8)
        for b in batches:
            ids, keys = [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ks = list({k for k in keys_of(text) if k})
                if ks:
                    hit = suspected(f, hashes(ks), bits)
                    keys += [k for k, h in zip(ks, hit.tolist(), strict=True) if h]
                    ids += [i] * (len(keys) - len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["id", "key"])
        hand_back()

    return run


def filtered(text: bytes | None, own: int, last: dict[bytes, int]) -> tuple[int, int, bytes]:
    """Lines, lines dropped, and the text that stays."""
    t = text or b""
    lines = t.split(b"\n")
    kept = [x for x, k in zip(lines, keys_of(t), strict=True) if k is None or last.get(k, own) == own]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def drop_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", most_keys: int = MOST_KEYS, bits: int | None = None) -> DataFrame:
    """The rows of docs with l_lines (before), l_dropped and l_text (what stays).

    Null text is one empty line. A null id counts as the smallest id. Rows that share an id are one document, so a
    line in both isn't shared by them. Keys are compared by 128-bit digests. An empty table gives an empty one; the
    columns of docs stay, whatever their names; those named like an added one are replaced. Texts of any length are
    read line by line, whole."""
    spark = docs.sparkSession
    docs, hidden = shielded(docs, text, doc_id)
    own = F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST_ID))
    slim = docs.select(own.alias("id"), F.col(text).cast("binary").alias("text"))
    lines = 0
    if bits is None:
        lines = docs.select(F.coalesce(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1), F.lit(0))).first()[0]
        bits = size_for(lines)
    twice = spark.sparkContext.broadcast(repeat_filter(slim.select("text"), line_hashes, bits, lines))
    pairs = stored(slim.mapInArrow(suspects(twice, bits), "id long, key binary"), "suspects").distinct()
    twice.destroy()
    shared = pairs.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("last")).filter(F.col("n") >= LEAST_DOCS)
    shared = stored(shared, "shared-lines")
    columns, n_columns, at = docs.select(*docs.columns, own.alias("l_id")), len(docs.columns), docs.columns.index(text)
    if (n := shared.count()) <= most_keys:
        keys = spark.sparkContext.broadcast({bytes(k): v for k, v in shared.select("key", "last").collect()} if n else {})
        unstore(pairs)
        unstore(shared)
        return unshielded(columns.mapInArrow(_by_map(keys, n_columns, at), _schema(docs)), hidden)
    # more keys than may be broadcast: each document gets those of its own; lines that very many hold meet by broadcast
    hot = stored(hot_of(shared, "key", "n"), "hot")
    drops = join_hot(pairs, shared.select("key", "last"), "key", hot=hot).filter("id < last").groupBy("id").agg(F.collect_list("key").alias("l_keys")).withColumnRenamed("id", "l_id")
    out = columns.join(drops, "l_id", "left").select(*docs.columns, "l_id", "l_keys")
    return unshielded(out.mapInArrow(_by_list(n_columns, at), _schema(docs)), hidden)


def _schema(docs: DataFrame):
    from pyspark.sql import types as T

    return T.StructType([*docs.schema.fields, T.StructField("l_lines", T.LongType()), T.StructField("l_dropped", T.LongType()), T.StructField("l_text", T.StringType())])


def _result(b: pa.RecordBatch, n: int, rows: list[tuple]) -> pa.RecordBatch:
    more = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64()))] + [pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays([*b.columns[:n], *more], [*b.schema.names[:n], "l_lines", "l_dropped", "l_text"])


def _texts(b: pa.RecordBatch, at: int) -> list[bytes | None]:
    """The texts of a batch as the bytes that they are kept in."""
    c = b.column(at)
    return c.cast(pa.large_binary() if pa.types.is_large_string(c.type) else pa.binary()).to_pylist()


def _by_map(keys, n: int, at: int):
    """mapInArrow over n columns, the text among them, and the id: lines dropped by the keys that all tasks have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _result(b, n, [filtered(t, i, keys.value) for i, t in zip(b.column(n).to_pylist(), _texts(b, at), strict=True)])

    return run


def _by_list(n: int, at: int):
    """mapInArrow over n columns, the text among them, the id and the keys that the document loses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = zip(b.column(n).to_pylist(), _texts(b, at), b.column(n + 1).to_pylist(), strict=True)
            yield _result(b, n, [filtered(t, i, dict.fromkeys(map(bytes, ks or ()), None)) for i, t, ks in cols])

    return run


def query(spark, sf_dir: str) -> DataFrame:
    """op4: lines dropped from every document, and a digest of what stays."""
    out = drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("l_lines").alias("n_lines"), F.col("l_dropped").alias("n_dropped"), F.sha2("l_text", 256).alias("kept_sha256"))


_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE_SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(trim(line, {_CHARS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {LEAST_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}),
j AS (SELECT k.*, coalesce(s.last <> k.doc_id, false) AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
