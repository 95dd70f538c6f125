"""Periodic runs of words by a harmonic grid.

A run of period p and four periods or more covers two neighbours of the grid 0, p, 2p, ... and goes on for over p words
behind them. So for each p the neighbours jp and (j + 1)p are asked how far the words that follow them agree, and how far
those before them do: a suffix array of the words and one of the reversed words answer that, by the least of their common
prefixes between two places, from a table of minima. All grids of a text hold n log n places; those whose next four words
differ can't begin a run and are left out before arrays are built, and texts that have no others need no arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm.common import hand_back, shielded, table, unshielded, words_of

#: A run has at least so many words, and so many periods.
LEAST, PERIODS = 6, 4
#: Words that any grid place of a run shares with its neighbour, at least.
GRAM = 4
#: Bytes of texts, words of arrays and places of the grid that are in memory at once (a longer text is alone).
BYTES, WORDS, PLACES = 1 << 20, 1 << 18, 1 << 20

Run = tuple[int, int, int]  #: start, length, period


class Suffixes:
    """Common prefixes of any two suffixes of x, whose last value stands nowhere else."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        order = np.argsort(x, kind="stable")
        levels = [_heads(x[order], np.zeros(n, np.int64), order, n)]
        open_ = np.arange(n)
        while True:  # classes of twice as many words; only suffixes that some other still equals are sorted again
            rank, k = levels[-1], 1 << (len(levels) - 1)
            open_ = open_[np.bincount(rank, minlength=n)[rank[open_]] > 1]
            if not len(open_):
                break
            behind = np.minimum(open_ + k, n - 1)  # equal ones never reach the end: its value is alone
            key = rank[open_].astype(np.int64) * n + rank[behind]
            order = np.argsort(key, kind="stable")
            open_ = open_[order]
            new = rank.copy()
            new[open_] = _heads(key[order], rank[open_].astype(np.int64), None, n)
            levels.append(new)
        self.rank = levels.pop()
        array = np.empty(n, np.int64)
        array[self.rank] = np.arange(n)
        self.minima = [self._common(array, levels)]
        while (step := 1 << (len(self.minima) - 1)) * 2 < n:
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-step], last[step:]))

    @staticmethod
    def _common(array: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of neighbours in the suffix array, from the classes of 1, 2, 4, ... words."""
        a, b = array[:-1].copy(), array[1:].copy()
        out = np.zeros(len(a), np.int32)
        for k in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(levels[k][a] == levels[k][b])
            out[same] += 1 << k
            a[same] += 1 << k
            b[same] += 1 << k
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of places i and j, never the same, how many words agree from there on."""
        r, s = self.rank[i].astype(np.int64), self.rank[j].astype(np.int64)
        lo, hi = np.minimum(r, s), np.maximum(r, s)
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1  # the greatest power of two that is not above
        out = np.empty(len(lo), np.int64)
        for level in np.unique(k):
            at = np.flatnonzero(k == level)
            m = self.minima[level]
            out[at] = np.minimum(m[lo[at]], m[hi[at] - (1 << level)])
        return out


def _heads(keys: np.ndarray, old: np.ndarray, order: np.ndarray | None, n: int) -> np.ndarray:
    """For sorted keys the place of the first equal one, counted from where its old class begins; by order, if given."""
    at = np.arange(len(keys))
    first = np.maximum.accumulate(np.where(np.append(True, keys[1:] != keys[:-1]), at, 0))
    begins = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), at, 0))
    heads = (old + first - begins).astype(np.int32)
    if order is None:
        return heads
    out = np.empty(n, np.int32)
    out[order] = heads
    return out


def grid(grams: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of the grids' places whose next GRAM words seem to equal those a period on.

    grams: a hash of the words from each place; starts and sizes of the texts, in words."""
    most = np.where(sizes >= LEAST, sizes // PERIODS, 0)
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    n = (sizes[text] - GRAM) // period  # places that have a neighbour
    ends = np.cumsum(n)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PLACES, "right")))
        own, p = n[at:to], period[at:to]
        j = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        step = np.repeat(p, own)
        place = j * step + np.repeat(starts[text[at:to]], own)
        same = np.flatnonzero(grams[place] == grams[place + step])
        yield np.repeat(text[at:to], own)[same], place[same], step[same]
        at = to


def runs_in(texts: list[list[bytes]], text: np.ndarray, place: np.ndarray, period: np.ndarray) -> list[list[Run]]:
    """The runs of each text that its grid places (words into it) lie in, by start, then period."""
    known: dict[bytes, int] = {}
    starts, parts, at = [], [np.array([-1])], 1
    for i, words in enumerate(texts):  # a value of its own before, between and after texts: nothing agrees across them
        starts.append(at)
        parts += [np.array([known.setdefault(w, len(known)) for w in words], np.int64), np.array([-2 - i])]
        at += len(words) + 1
    x = np.concatenate(parts)
    i = np.array(starts, np.int64)[text] + place
    after = Suffixes(x).common(i, i + period)
    before = Suffixes(x[::-1].copy()).common(len(x) - i, len(x) - i - period)
    start, length = place - before, before + period + after
    full = np.flatnonzero(length >= np.maximum(LEAST, PERIODS * period))
    found = np.unique(np.stack([text[full], start[full], length[full], period[full]], axis=1), axis=0)
    out: list[list[Run]] = [[] for _ in texts]
    last = None
    for t, s, n, p in found.tolist():  # of equal stretches the first has the smallest period
        if (t, s, n) != last:
            out[t].append((s, n, p))
            last = (t, s, n)
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in out]


def find(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each text of words."""
    sizes = np.array([len(w) for w in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    words = np.fromiter((hash(w) for t in texts for w in t), np.int64, int(sizes.sum())).view(np.uint64)
    grams = words.copy()  # equal words, equal hashes; what is equal by chance only falls out later
    for k in range(1, GRAM):
        grams[: max(0, len(words) - k)] += words[k:] * np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64))
    found = [np.concatenate(x) for x in zip(*grid(grams, starts, sizes), strict=True)] or [np.zeros(0, np.int64)] * 3
    out: list[list[Run]] = [[] for _ in texts]
    asked = np.unique(found[0])
    for some in np.split(asked, np.flatnonzero(np.diff(np.cumsum(sizes[asked]) // WORDS)) + 1) if len(asked) else []:
        own = np.flatnonzero((found[0] >= some[0]) & (found[0] <= some[-1]))
        text, place, period = (x[own] for x in found)
        for t, r in zip(some, runs_in([texts[t] for t in some], np.searchsorted(some, text), place - starts[text], period), strict=True):
            out[t] = r
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words of a text without what repeats a run's first period, joined by spaces."""
    if runs:
        keep = np.ones(len(words), bool)
        for s, n, p in runs:
            keep[s + p : s + n] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


RUNS = "array<struct<start:long,length:long,period:long>>"


def _found(column: str, held: list[str]):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def some(b: pa.RecordBatch, texts: list[bytes | None]) -> pa.RecordBatch:
        words = [(t or b"").split() for t in texts]  # bytes split at ASCII white space
        runs = find(words)
        listed = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs]
        short = [collapsed(w, r).decode() for w, r in zip(words, runs, strict=True)]
        more = [pa.array([len(w) for w in words], pa.int64()), pa.array(listed, kind), pa.array(short, pa.string())]
        return pa.RecordBatch.from_arrays([*[b.column(c) for c in held], *more], [*held, "r_words", "r_runs", "r_collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start = size = 0
            texts: list[bytes | None] = []
            for i, t in enumerate(b.column(column)):
                texts.append(t.as_py())
                size += len(texts[-1] or b"")
                if size >= BYTES or i == b.num_rows - 1:
                    yield some(b.slice(start, len(texts)), texts)
                    start, size, texts = i + 1, 0, []
        hand_back()

    return run


def find_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows of docs, or of the columns to keep, with r_words (words of the text), r_runs (its runs by start, then period)
    and r_collapsed (its words, joined by spaces, without those that any run contains after its first period).

    Words are what ASCII white space parts. A run is a stretch with smallest period q of at least six words and four
    periods that no neighbouring word extends. Null and empty texts have no words, no runs and an empty r_collapsed. Texts
    are taken whole, however long; nothing is shuffled. Repeated rows get equal results, an empty table gives an empty
    one. Other columns stay, whatever their names; those named like an added one are replaced."""
    docs, hidden = shielded(docs, text)
    held = [c for c in docs.columns if keep is None or hidden.get(c, c) in keep]
    schema = T.StructType([*[docs.schema[c] for c in held], *T.StructType.fromDDL(f"r_words long, r_runs {RUNS}, r_collapsed string").fields])
    out = docs.select(*held, F.col(text).cast("binary").alias("r_bytes")).mapInArrow(_found("r_bytes", held), schema)
    return unshielded(out, {h: c for h, c in hidden.items() if h in held})


def query(spark, sf_dir: str) -> DataFrame:
    """op12: runs of every document, one in ten of which is made periodic from some word on, by its id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("1")))  # a document without an id is left as it is: 1's remainder isn't 0
    docs = docs.withColumn("h", h).withColumn("g", F.floor(F.col("h") / 10)).withColumn("w", F.when(F.col("h") % 10 == 0, words_of(F.col("text"))))
    docs = docs.withColumn("n", F.when(F.size("w") > 0, F.size("w"))).withColumn("a", F.col("g") % F.col("n")).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    own = F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    made = docs.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(own, " ")).otherwise(F.col("text")).alias("text"))
    runs = find_runs(made, keep=["doc_id"])
    best = F.aggregate("r_runs", F.get("r_runs", F.lit(0)), lambda a, r: F.when(r["length"] > a["length"], r).otherwise(a))  # by start and period: the first of the longest
    lines = F.transform("r_runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return runs.withColumn("best", best).select(
        "doc_id", F.size("r_runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("r_collapsed", 256).alias("collapsed_sha256"),
    )


#: Runs as islands of five-word sequences that stand again a period on (a run has at least five such matches);
#: of equal stretches the smallest period counts. crc32 bit by bit.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: xor(r >> 1, (r & 1) * 3988292384)))) AS h FROM documents),
g AS (SELECT *, (h // 10) % len(w) AS a, 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS p FROM d),
t AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN list_transform(range(len(w)), lambda i: w[(CASE WHEN i < a THEN i ELSE a + (i - a) % p END) + 1]) ELSE w END AS w FROM g),
x AS (SELECT doc_id, len(w) AS n, i, hash(w[i + 1 : i + 5]) AS k FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM t)),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM x JOIN x y ON x.doc_id = y.doc_id AND x.k = y.k AND y.i > x.i AND (y.i - x.i) * 4 <= x.n),
l AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m) GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM l WHERE length >= greatest(6, 4 * q) GROUP BY ALL),
s AS (SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(start, length, period), (-length, start, period)) AS best,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS said FROM r GROUP BY doc_id),
o AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT doc_id, list(i) AS gone FROM o GROUP BY doc_id),
c AS (SELECT doc_id, array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(len(w))), lambda z: NOT list_contains(gone, z[2])), lambda z: z[1]) END, ' ') AS kept
      FROM t LEFT JOIN k USING (doc_id))
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.period::BIGINT AS period,
       (1000 * best.length // best.period)::BIGINT AS exponent_milli, sha256(coalesce(said, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM c LEFT JOIN s USING (doc_id)
"""
