"""Language-model scores from a log-frequency Bloom filter.

Counts of one- and two-word sequences are quantised on a log scale of two steps a doubling (1, 2, 3, 4, 6, 8, 12, ...),
rounded down. A sequence whose count is on step q is put into one Bloom filter q times, under the levels 1 to q. Workers
read a count back by probing level after level until one is missing.

The probability of a word is (count + 1) / (N + V + 1), that of a word after another (pair + PRIOR * probability of the
word) / (context + PRIOR). Counts of words and pairs are the lower ends of their steps and that of the context is the
upper end of its step, so that the probabilities of all words after any context sum to no more than 1 but for what the
filter misreads. The filter's slices are sized by the levels put in. A
small filter is broadcast. Beyond, texts are packed in chunks, and the distinct sequences of each chunk are sent to their
slices, read there and sent back: slices grow in number, not in size, and the error rate is the same at any size."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm.common import hand_back, release, shielded, stored, table, unshielded
from quillon.llm.shingles import HASHES, scrambled, words_of

PROBES = 4
#: Bits of a slice of the filter for each level put in, at any size; about 0.2 % of what was never seen is read as seen.
BITS_A_LEVEL, LEAST_BITS = 16, 64
#: Training tokens up to which the filter is broadcast: 32 MB, two levels a token.
MOST_TOKENS = 8_000_000
#: Slices, a power of two: the least, and the sequences of all texts that one takes, about.
SLICES, SLICE_SEQUENCES = 64, 1 << 22
#: Bytes of text in a chunk, about; a longer text is a chunk of its own.
CHUNK = 1 << 22
#: Weight of the one-word distribution in a two-word one, in words.
PRIOR = 64.0
#: Words whose exact counts are broadcast (16 bytes each), the most frequent; the others are joined.
MOST_WORDS = 1_000_000
END = b"\n"  # no word holds white space
_PAIR = np.uint64(0x9FB21C651E98DF25)
KEY_BITS = 48


def is_training(doc_id: Column) -> Column:
    """Whether crc32 of the id as text, modulo 7, is not 2; a null id is hashed as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 != 2


def tokens(text: bytes | None) -> np.ndarray:
    """Hashes of the words and the end."""
    return HASHES.of([*words_of(text), END])


def pairs(h: np.ndarray) -> np.ndarray:
    """Hashes of each token with the one before it; the end stands before the first."""
    before = np.concatenate([h[-1:], h[:-1]])
    return scrambled(before * _PAIR + h)


def _encoded(chunk: int, key: np.ndarray, n: np.ndarray, slices: int) -> pa.RecordBatch:
    """Sorted keys with their counts, by slice, as gaps and counts."""
    width = np.uint64(KEY_BITS - slices.bit_length() + 1)
    cut = np.searchsorted(key, np.arange(slices, dtype=np.uint64) << width)
    cut = np.append(cut, len(key))
    rows = []
    for k in range(slices):
        own, times = key[cut[k] : cut[k + 1]], n[cut[k] : cut[k + 1]]
        if len(own):
            gaps = np.diff(own, prepend=np.uint64(k) << width)
            low, high = (gaps & np.uint64(0xFFFFFFFF)).astype("<u4"), (gaps >> np.uint64(32)).astype("<u2")
            more = np.flatnonzero(times != 1)
            # bytes of one rank stand together, so that those that are mostly zero compress
            planes = low.view(np.uint8).reshape(-1, 4).T.tobytes()
            rows.append((k, chunk, planes, high.tobytes() if high.any() else b"", more.astype("<u4").tobytes(), times[more].astype("<u4").tobytes()))
    kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["slice", "chunk", "low", "high", "at", "times"])


def _gathered(most: int = 1_500_000):
    """mapInArrow over texts: counts of sequences in this task, by slice of their hash."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        return _encoded(0, *np.unique(np.concatenate(held) >> np.uint64(64 - KEY_BITS), return_counts=True), SLICES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for t in b.column(0).to_pylist():
                h = tokens(t)
                held += [scrambled(h), pairs(h)]
                n += 2 * len(h)
                if n > most:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)
        hand_back()

    return run


GATHERED = "slice int, chunk long, low binary, high binary, at binary, times binary"


def _keys(low: bytes, high: bytes, first: np.uint64) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(low, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.uint64)
    if high:
        gaps |= np.frombuffer(high, "<u2").astype(np.uint64) << np.uint64(32)
    return np.cumsum(gaps) + first


def _counts(batches: Iterator[pa.RecordBatch], first: np.uint64, kept: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Summed counts of the slice that starts at this key; what has come is merged whenever it has doubled. Chunks and
    their keys are added to kept as they came."""
    keys, counts, held, n, limit = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0, 1 << 21

    def summed() -> tuple[np.ndarray, np.ndarray]:
        key = np.concatenate([keys, *[x[0] for x in held]])
        n = np.concatenate([counts, *[x[1] for x in held]])
        order = np.argsort(key)
        key, n = key[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return key[first], np.add.reduceat(n, first) if len(key) else n

    for b in batches:
        for chunk, low, high, at, times in zip(*[b.column(i).to_pylist() for i in range(1, 6)], strict=True):
            own = _keys(low, high, first)
            c = np.ones(len(own), np.int64)
            c[np.frombuffer(at, "<u4")] = np.frombuffer(times, "<u4")
            own, c = (own[c > 0], c[c > 0]) if times else (own, c)
            held.append((own, c))
            n += len(own)
            if kept is not None:
                kept.append((chunk, low, high))
        if n > limit:
            keys, counts = summed()
            held, n, limit = [], 0, max(1 << 21, len(keys))
    return summed() if held else (keys, counts)


def levels(counts: np.ndarray) -> np.ndarray:
    """The step of a count of 1 or more: no count is on a step above itself, so levels are never more than occurrences."""
    counts = np.asarray(counts, np.int64)
    doubling = np.frexp(counts.astype(np.float64))[1].astype(np.int64) - 1
    return np.maximum(2 * doubling + (2 * counts >= 3 << doubling), 1)


def places(keys: np.ndarray, level: np.ndarray | int, size: np.ndarray | int) -> np.ndarray:
    """PROBES places of (key, level) in the key's slice of so many bits; keys have KEY_BITS bits, slices are their first."""
    h = scrambled(keys * np.uint64(2) + np.uint64(1) + np.asarray(level).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    half, size = np.uint64(32), np.asarray(size).astype(np.uint64)
    step = (h << half) | (h >> half) | np.uint64(1)
    return np.stack([((h + np.uint64(i) * step) >> half) * size >> half for i in range(PROBES)], axis=1).astype(np.int64)


def filled(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """A slice of the filter with these keys; its size follows from the levels put in."""
    top = levels(counts) if len(counts) else np.zeros(0, np.int64)
    part = np.zeros(max(LEAST_BITS, -(-BITS_A_LEVEL * int(top.sum()) // 8) * 8), bool)
    for level in range(1, int(top.max(initial=0)) + 1):
        stay = top >= level
        keys, top = keys[stay], top[stay]
        part[places(keys, level, len(part)).ravel()] = True
    return np.packbits(part, bitorder="little").tobytes()


def levels_in(f: np.ndarray, keys: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Levels of keys read from the bytes of slices, each with its slice's bits and where they start."""
    out, alive, level = np.zeros(len(keys), np.uint8), np.arange(len(keys)), 1
    while len(alive):
        p = places(keys[alive], level, size[alive]) + at[alive][:, None]
        alive = alive[((f[p >> 3] >> (p & 7)) & 1).astype(bool).all(axis=1)]
        out[alive] = level
        level += 1
        if level > 64:  # more than any count reaches: a slice without an empty bit
            break
    return out


#: The least and the largest count on each step; no step, no count.
LEAST = np.array([0, 1, *[2 ** (i // 2) if i % 2 == 0 else 3 * 2 ** (i // 2 - 1) for i in range(2, 67)]], np.float64)
LARGEST = np.append(LEAST[1:] - 1, LEAST[-1])


def _filled(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """applyInArrow for one slice: its part of the filter."""
    k = key[0].as_py()
    part = filled(*_counts(batches, np.uint64(k << (KEY_BITS - 6))))
    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.binary())], ["slice", "bits"])


def _answered(slices: int):
    """applyInArrow for one slice: its part of the filter is filled, then read for the keys of each chunk."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, kept = key[0].as_py(), []
        first = np.uint64(k << (KEY_BITS - slices.bit_length() + 1))
        f = np.frombuffer(filled(*_counts(batches, first, kept)), np.uint8)
        for chunk, low, high in kept:
            own = _keys(low, high, first)
            found = levels_in(f, own, np.full(len(own), 8 * len(f)), np.zeros(len(own), np.int64))
            kinds = (pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((chunk, k, found.tobytes()), kinds, strict=True)], ["s_chunk", "slice", "levels"])
        hand_back()

    return run


class Model:
    """The filter; reads quantised counts back."""

    def __init__(self, parts: list[bytes], total: int, distinct: int):
        self.data, self.total, self.distinct = b"".join(parts), total, distinct
        self.size = np.array([8 * len(x) for x in parts])
        self.start = np.cumsum(self.size) - self.size

    def read(self, hashes: np.ndarray) -> np.ndarray:
        """The steps of counts, 0 for what was never seen."""
        keys = hashes >> np.uint64(64 - KEY_BITS)
        k = (keys >> np.uint64(KEY_BITS - 6)).astype(np.int64)
        return levels_in(np.frombuffer(self.data, np.uint8), keys, self.size[k], self.start[k])

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        key, at = np.unique(sequences(texts), return_inverse=True)
        return log_scores(texts, self.read(key)[at], self.total, self.distinct)


def sequences(texts: list[np.ndarray]) -> np.ndarray:
    """Hashes of all words of texts, then of all pairs."""
    return np.concatenate([*map(scrambled, texts), *map(pairs, texts)]) if texts else np.zeros(0, np.uint64)


def log_scores(texts: list[np.ndarray], steps: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """log10 probability of each text: a two-word distribution smoothed by the one-word distribution, itself by one.
    Steps are those of sequences()."""
    size = np.array([len(x) for x in texts])
    start = np.cumsum(size) - size
    word, pair = steps[: len(steps) // 2], steps[len(steps) // 2 :]
    one = (LEAST[word] + 1) / (total + distinct + 1)
    before = np.empty(len(word), word.dtype)
    before[1:] = word[:-1]
    before[start] = word[start + size - 1]  # the end stands before the first word
    context = LARGEST[before]
    seen = np.minimum(LEAST[pair], np.minimum(context, LARGEST[word]))  # a pair is no more frequent than its words
    return np.add.reduceat(np.log10((seen + PRIOR * one) / (context + PRIOR)), start)


def build(training: DataFrame, total: int, distinct: int) -> Model:
    """training: one column of texts as binary."""
    parts = [filled(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * SLICES
    for k, part in training.mapInArrow(_gathered(), GATHERED).groupBy("slice").applyInArrow(_filled, "slice int, bits binary").collect():  # the filter
        parts[k] = bytes(part)
    return Model(parts, total, distinct)


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token hashes and their counts in this task."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    held, n = [], 0
    for b in batches:
        for t in b.column(0).to_pylist():
            held.append(tokens(t))
            n += len(held[-1])
            if n > 4_000_000:
                yield flush(held)
                held, n = [], 0
    if held:
        yield flush(held)
    hand_back()


def _columns(hs: list[np.ndarray], scores: np.ndarray, known: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
    """For each text: tokens, known tokens, the sum of log10(c + 1) over broadcast words, the model's score, other words."""
    cols: list[list] = [[], [], [], scores.tolist(), []]
    logs = np.log10(counts + 1.0)
    for h in hs:
        s = h.astype(np.int64)
        at = np.minimum(np.searchsorted(known, s), max(len(known) - 1, 0))
        hit = known[at] == s if len(known) else np.zeros(len(s), bool)
        cols[0].append(len(s))
        cols[1].append(int(hit.sum()))
        cols[2].append(float(logs[at[hit]].sum()) if len(known) else 0.0)
        cols[4].append(s[~hit])
    return [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64())), strict=True)]


ADDED = ["s_tokens", "s_known", "s_logs", "s_score", "s_rest"]


def _scored(model, words, n: int):
    """mapInArrow: rows with ADDED in the place of the text, column n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for i in range(0, len(big), 256):
                b = big.slice(i, 256)
                hs = [tokens(t) for t in b.column(n).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:n], *_columns(hs, model.value.scores(hs), *words.value)], [*b.schema.names[:n], *ADDED])

    return run


def _packed(n: int, most: int):
    """mapInArrow: rows in chunks of about `most` bytes of text (column n), each chunk compressed in one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                for b in held:
                    w.write_batch(b)
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary())], ["s_chunk", "s_rows"])

        for b in batches:
            sizes, start = pc.fill_null(pc.binary_length(b.column(n)), 0).to_numpy(zero_copy_only=False), 0
            for i, x in enumerate(sizes.tolist()):
                if size and size + x > most:
                    if i > start:
                        held.append(b.slice(start, i - start))
                    yield flush()
                    chunk, held, size, start = chunk + 1, [], 0, i
                size += x + 64  # a row without text counts too
            if len(b) > start:
                held.append(b.slice(start))
        if held:
            yield flush()

    return run


def _unpacked(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def _asked(n: int, slices: int):
    """mapInArrow over chunks: their distinct sequences by slice, with their counts in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, rows in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = _unpacked(rows.as_py())
                train = t.column(n + 1).to_pylist()
                hs = [tokens(x) for x in t.column(n).to_pylist()]
                key, times = np.unique(sequences(hs) >> np.uint64(64 - KEY_BITS), return_counts=True)
                held, less = np.unique(sequences([h for h, x in zip(hs, train, strict=True) if not x]) >> np.uint64(64 - KEY_BITS), return_counts=True)
                times[np.searchsorted(key, held)] -= less
                yield _encoded(chunk, key, times, slices)
        hand_back()

    return run


def _scored_chunk(words, n: int, total: int, distinct: int):
    """Cogrouped by chunk: the packed rows, and the levels of their sorted distinct sequences by slice."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        by = right.sort_by("slice").column("levels").to_pylist()
        steps = np.frombuffer(b"".join(by), np.uint8)
        for rows in left.column("s_rows"):
            t = _unpacked(rows.as_py())
            hs = [tokens(x) for x in t.column(n).to_pylist()]
            key, at = np.unique(sequences(hs) >> np.uint64(64 - KEY_BITS), return_inverse=True)
            if len(key) != len(steps):
                raise ValueError(f"{len(steps)} levels for {len(key)} sequences of a chunk")
            more = _columns(hs, log_scores(hs, steps[at], total, distinct), *words.value)
            out.append(pa.Table.from_arrays([*t.columns[:n], *more], [*t.schema.names[:n], *ADDED]))
        hand_back()
        return pa.concat_tables(out)

    return run


def score_texts(docs: DataFrame, most_words: int = MOST_WORDS, most_tokens: int = MOST_TOKENS) -> DataFrame:
    """The rows of docs (doc_id, text, others) without text, with s_held_out, s_tokens, s_known, s_train_tokens,
    s_base and s_score.

    Null texts are empty: one end token. Null ids train. Words are told apart by 64-bit hashes. Exact counts of the
    most frequent words are broadcast up to most_words; all other words of a text are joined with their counts, so
    the base score is exact for any vocabulary. The filter is broadcast up to most_tokens; beyond, sequences are joined
    with its slices. With no training text N and V are 0. Other columns stay, whatever their
    names; those named like an added one are replaced. Repeated rows are each scored alike; an empty table gives an
    empty one."""
    spark = docs.sparkSession
    docs, hidden = shielded(docs, "doc_id", "text")
    training = docs.filter(is_training(F.col("doc_id"))).select(F.col("text").cast("binary").alias("text"))
    vocabulary = stored(training.mapInArrow(_vocabulary, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "words")
    distinct, total = vocabulary.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    names = [c for c in docs.columns if c != "text"]
    own = docs.select(*names, F.col("text").cast("binary").alias("s_text"))
    if total <= most_tokens:
        model = spark.sparkContext.broadcast(build(training, total, distinct))
    else:
        slices = max(SLICES, 1 << (2 * total // SLICE_SEQUENCES).bit_length())
        packed = stored(own.withColumn("s_train", is_training(F.col("doc_id"))).mapInArrow(_packed(len(names), CHUNK), "s_chunk long, s_rows binary"), "chunks")
        asked = packed.mapInArrow(_asked(len(names), slices), GATHERED)
        answers = stored(asked.groupBy("slice").applyInArrow(_answered(slices), "s_chunk long, slice int, levels binary"), "levels")
    release(spark)
    frequent, rest = vocabulary, None
    if distinct > most_words:  # a count that no more than most_words words reach
        at = F.floor(F.log2("n") * 8)
        by = vocabulary.groupBy(at.alias("k")).count().orderBy(F.desc("k")).collect()  # 8 rows for each doubling
        least, held = math.inf, 0
        for r in by:
            held += r["count"]
            if held > most_words:
                break
            least = r["k"]
        frequent, rest = vocabulary.filter(at >= least), vocabulary.filter(at < least)
    found = frequent.toArrow()  # most_words rows at most
    h, n = found.column("h").to_numpy(), found.column("n").to_numpy()
    order = np.argsort(h)
    words = spark.sparkContext.broadcast((h[order], n[order]))
    fields = [docs.schema[c] for c in names]
    schema = T.StructType([*fields, *T._parse_datatype_string("s_tokens long, s_known long, s_logs double, s_score double, s_rest array<long>").fields])
    if total <= most_tokens:
        out = own.mapInArrow(_scored(model, words, len(names)), schema)
    else:
        out = packed.groupBy("s_chunk").cogroup(answers.groupBy("s_chunk")).applyInArrow(_scored_chunk(words, len(names), total, distinct), schema)
    if rest is not None:
        # results depend on a row's id and its other words alone, so equal rows share one sum
        key = F.xxhash64("doc_id", "s_rest")
        out = stored(out.withColumn("s_key", key), "scored")
        each = out.dropDuplicates(["s_key"]).select("s_key", F.explode("s_rest").alias("h"))
        sums = each.join(rest, "h").groupBy("s_key").agg(F.count("*").alias("k"), F.sum(F.log10(F.col("n") + 1.0)).alias("l"))
        out = out.join(sums, "s_key", "left").withColumns({"s_known": F.col("s_known") + F.coalesce("k", F.lit(0)), "s_logs": F.col("s_logs") + F.coalesce("l", F.lit(0.0))}).drop("s_key", "k", "l")
    floor = math.log10(total + distinct + 1)
    out = out.withColumns({
        "s_held_out": ~is_training(F.col("doc_id")),
        "s_train_tokens": F.lit(total).cast("long"),
        "s_base": F.col("s_logs") - F.col("s_tokens") * F.lit(floor),
    })
    return unshielded(out.drop("s_rest", "s_logs"), hidden)


def query(spark, sf_dir: str) -> DataFrame:
    """op5: scores of every document."""
    out = score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", F.col("s_held_out").alias("held_out"), F.col("s_tokens").alias("n_tokens"), F.col("s_known").alias("n_known"),
        F.col("s_train_tokens").alias("train_tokens"), F.col("s_base").alias("base_score"), F.col("s_score").alias("score"),
    )
