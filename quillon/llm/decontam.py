"""Benchmark decontamination with suffix arrays over shards of the training text.

Every task cuts its documents into shards and sorts each shard's word suffixes (those that begin with words of the
benchmark; no other can match) by their first ten words. Every suffix of every benchmark item is then searched in it
by bisection, all suffixes at once. Matches give the words hit, the items and the longest verbatim match."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm.common import hand_back, shielded, stored, table, unshielded, unstore

WINDOW = 10
SHARD_WORDS = 1_000_000
#: Words of the benchmark that are broadcast at once; a larger one is searched in blocks, one pass each.
BLOCK_WORDS = 1_000_000
#: Bytes of words: letters (A-Z as a-z), digits and all beyond ASCII; the rest are spaces.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


class Queries:
    """The suffixes of a block of items as packed keys: `per` word numbers a 64-bit key, `depth` keys."""

    def __init__(self, items: list[tuple[int | None, bytes | None]]):
        self.vocab: dict[bytes, int] = {}
        rows = []
        for item, text in items:
            numbers = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            length = min(WINDOW, len(numbers))
            rows += [(tuple(numbers[i : i + length]), item, i) for i in range(len(numbers) - length + 1) if length]
        self.bits = max(1, len(self.vocab).bit_length())
        self.per = 64 // self.bits
        self.depth = -(-WINDOW // self.per)
        distinct = sorted({r[0] for r in rows})
        where = {w: i for i, w in enumerate(distinct)}
        self.length = np.array([len(w) for w in distinct], np.int64)
        self.least = int(self.length.min()) if len(distinct) else 0
        low, high = np.zeros((len(distinct), WINDOW), np.uint64), np.full((len(distinct), WINDOW), (1 << self.bits) - 1, np.uint64)
        for i, w in enumerate(distinct):
            low[i, : len(w)] = high[i, : len(w)] = w
        self.low, self.high = self.packed(low, 0), self.packed(high, (1 << self.bits) - 1)
        of = sorted((where[w], item, at) for w, item, at in rows if item is not None)
        self.of_window = np.array([x[0] for x in of], np.int64)
        self.of_item = np.array([x[1] for x in of], np.int64)
        self.of_at = np.array([x[2] for x in of], np.int64)

    def packed(self, words: np.ndarray, fill: int) -> list[np.ndarray]:
        out = []
        for k in range(self.depth):
            key = np.zeros(len(words), np.uint64)
            for j in range(k * self.per, (k + 1) * self.per):
                key = (key << np.uint64(self.bits)) | (words[:, j] if j < WINDOW else np.uint64(fill))
            out.append(key)
        return out


def bound(sorted_keys: list[np.ndarray], query: list[np.ndarray], above: bool) -> np.ndarray:
    """For each query the first place whose keys are not below it (above: are above it)."""
    lo = np.zeros(len(query[0]), np.int64)
    hi = np.full(len(query[0]), len(sorted_keys[0]), np.int64)
    while (open_ := lo < hi).any():
        mid = np.where(open_, (lo + hi) >> 1, 0)
        less, same = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for k, q in zip(sorted_keys, query, strict=True):
            x = k[mid]
            less |= same & (x < q)
            same &= x == q
        right = less | same if above else less
        lo, hi = np.where(open_ & right, mid + 1, lo), np.where(open_ & ~right, mid, hi)
    return lo


def matches(q: Queries, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and windows of all occurrences; numbers: the shard's words, 0 for others and between documents."""
    padded = np.concatenate([numbers, np.zeros(WINDOW, np.int64)]).astype(np.uint64)
    starts = numbers > 0
    for j in range(1, min(q.least, WINDOW)):
        starts &= padded[j : j + len(numbers)] > 0
    at = np.flatnonzero(starts)
    none = np.zeros(0, np.int64)
    if not len(at) or not len(q.length):
        return none, none
    keys = q.packed(np.stack([padded[at + j] for j in range(WINDOW)], axis=1), 0)
    order = np.lexsort(keys[::-1])
    suffixes, keys = at[order], [k[order] for k in keys]  # the suffix array of the shard
    lo, hi = bound(keys, q.low, False), bound(keys, q.high, True)
    n = hi - lo
    window = np.repeat(np.arange(len(n)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return suffixes[place], window


def searched(q: Queries, texts: list[bytes | None]) -> list[tuple[int, list[tuple[int, int]], list[int], int]]:
    """For each text of a shard: words, ranges of words hit, items, the longest match in words."""
    parts, ends, end = [], [], 0
    for t in texts:
        ws = words_of(t)
        parts.append(np.fromiter(map(q.vocab.get, ws, repeat(0)), np.int64, len(ws)))
        parts.append(np.zeros(1, np.int64))
        end += len(ws) + 1
        ends.append(end)
    ends_ = np.array(ends, np.int64)
    starts = np.concatenate([[0], ends_[:-1]])
    at, window = matches(q, np.concatenate(parts) if parts else np.zeros(0, np.int64))
    out = [(int(e - s - 1), [], [], 0) for s, e in zip(starts, ends_, strict=True)]
    if not len(at):
        return out
    cover = np.zeros(end + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + q.length[window], -1)
    hit = np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)])
    edge = np.flatnonzero(np.diff(hit))
    for a, b in zip(edge[::2], edge[1::2], strict=True):
        d = int(np.searchsorted(ends_, a, "right"))
        out[d][1].append((int(a - starts[d]), int(b - starts[d])))
    first, last = np.searchsorted(q.of_window, window, "left"), np.searchsorted(q.of_window, window, "right")
    n = last - first
    use = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    place, length = np.repeat(at, n), np.repeat(q.length[window], n)
    item, diagonal = q.of_item[use], place - q.of_at[use]
    doc = np.searchsorted(ends_, place, "right")
    order = np.lexsort((place, diagonal, item, doc))
    place, length, item, diagonal, doc = (x[order] for x in (place, length, item, diagonal, doc))
    new = np.ones(len(place), bool)  # where a run of windows one word apart begins
    new[1:] = (np.diff(place) != 1) | (np.diff(diagonal) != 0) | (np.diff(item) != 0) | (np.diff(doc) != 0)
    run = np.flatnonzero(new)
    size = np.diff(np.append(run, len(place))) - 1 + length[run]
    for i in np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0)])) if len(doc) else []:
        out[doc[i]][2].append(int(item[i]))
    for d, s in zip(doc[run].tolist(), size.tolist(), strict=True):
        if s > out[d][3]:
            out[d] = (*out[d][:3], s)
    return out


FIELDS = "d_words long, d_hits array<struct<start:int,end:int>>, d_items array<long>, d_longest long"


def blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[Queries]:
    held, n, some = [], 0, False
    for r in benchmark.select(F.col(item_id).cast("long"), F.col(text).cast("binary")).toLocalIterator():
        held.append((r[0], bytes(r[1]) if r[1] is not None else None))
        n += len(held[-1][1] or b"") // 2 + 1
        if n >= BLOCK_WORDS:
            yield Queries(held)
            held, n, some = [], 0, True
    if held or not some:
        yield Queries(held)


def _pass(q, width: int):
    """mapInArrow: searches one block; the last columns are those of FIELDS, once a first pass has made them."""
    kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.int64()), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(width).to_pylist()
            rows, start, size = [], 0, 0
            for i, t in enumerate(texts):
                size += len(t or b"") // 5 + 1
                if size >= SHARD_WORDS or i == len(texts) - 1:
                    rows += searched(q.value, texts[start : i + 1])
                    start, size = i + 1, 0
            if b.num_columns > width + 1:
                rows = [merged(r, tuple(x)) for r, x in zip(rows, zip(*[b.column(width + 1 + j).to_pylist() for j in range(4)], strict=True), strict=True)]
            cols = [[r[0] for r in rows], [[{"start": a, "end": e} for a, e in r[1]] for r in rows], [r[2] for r in rows], [r[3] for r in rows]]
            more = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[: width + 1], *more], [*b.schema.names[: width + 1], "d_words", "d_hits", "d_items", "d_longest"])
        hand_back()

    return run


def merged(new: tuple, old: tuple) -> tuple:
    ranges = sorted([*new[1], *[(x["start"], x["end"]) for x in old[1]]])
    out: list[tuple[int, int]] = []
    for a, b in ranges:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return new[0], out, sorted({*new[2], *old[2]}), max(new[3], old[3])


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs with d_words, d_hits (ranges of words inside occurrences of a window), d_items (ids of items
    with an occurring window) and d_longest (words of the longest verbatim match).

    A window is ten words of an item; an item of fewer, but not none, is one window. Null texts have no words. Items
    with a null id hit words but aren't listed; items that share an id count once. Other columns stay, whatever their
    names; those named like an added one are replaced. Repeated rows get equal results; empty documents give an empty
    table, an empty benchmark hits nothing. A benchmark of several blocks is searched block by block: one is on the
    driver and on the workers at a time, and what a pass has found is stored before the next."""
    docs, hidden = shielded(docs, text)
    out = docs.withColumn("d_bytes", F.col(text).cast("binary"))
    schema = T.StructType([*docs.schema.fields, T.StructField("d_bytes", T.BinaryType()), *T._parse_datatype_string(FIELDS).fields])
    sc, held, before = docs.sparkSession.sparkContext, None, None
    for q in blocks(benchmark, item_id, item_text):
        if held is not None:
            last, out = before, stored(out, "overlaps")
            held.destroy()
            before = out
            if last is not None:
                unstore(last)
        held = sc.broadcast(q)
        del q
        out = out.mapInArrow(_pass(held, len(docs.columns)), schema)
    return unshielded(out.drop("d_bytes"), hidden)


def n_hit():
    return F.aggregate("d_hits", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])


def query(spark, sf_dir: str) -> DataFrame:
    """op7: benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = find_overlaps(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("d_items", lambda x: x.cast("string"))), ",")
    return out.select(
        "doc_id", F.col("d_words").alias("n_words"), n_hit().alias("n_hit"), F.size("d_items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (n_hit() > 0).alias("contaminated"),
    )


ORACLE_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[a-z0-9\\x{80}-\\x{10FFFF}]+') AS ws FROM
           (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\\x{80}-\\x{10FFFF}]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(list_slice(ws, i, i + least(10, len(ws)) - 1), ' ') AS k
       FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS k
       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, ns WHERE len(ws) >= n)),
m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (n, k)),
h AS (SELECT doc_id, count(DISTINCT j)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
