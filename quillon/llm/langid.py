"""Language identification in two steps: the family first, then the language within it.

Both steps are linear support vector machines, one against one, over hashed two- and three-byte sequences of letters;
with very many families each is told from all others together, so that machines grow with their number, not its square.
They are fitted by dual coordinate descent on the driver, on a sample whose size is a parameter."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm.common import shielded, table, unshielded

# Families of languages by code; a language that isn't listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
BUCKETS = 4096
#: Rows that are fitted on, about, and rows of each language at least, about, where it has them.
MOST_ROWS, LEAST_ROWS = 2000, 20
#: Families that are told apart one against one; more are told apart one against the rest.
MOST_PAIRED = 100
PIECE = 1 << 20
_LETTER = re.compile(rb"[A-Za-z]")
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def is_training(doc_id: Column) -> Column:
    """Whether crc32 of the id as text, modulo 4, is not 2; a null id is hashed as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 != 2


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(_LETTER.search(text)) or (not text.isascii() and any(c.isalpha() for c in text.decode()))


def vector(text: bytes) -> np.ndarray:
    """Shares of the hashed sequences in the whole text, which is read in pieces."""
    out = np.zeros(BUCKETS)
    for i in range(0, len(text), PIECE):
        b = np.frombuffer(text[max(0, i - 2) : i + PIECE].translate(_FOLD), np.uint8).astype(np.uint32)
        two = b[1:] << 8 | b[:-1]
        three = two[1:] << 8 | b[:-2]
        for x in (two, three):
            out += np.bincount((x * np.uint32(2654435761)) >> np.uint32(20), minlength=BUCKETS)
    return out / max(out.sum(), 1)


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 20) -> np.ndarray:
    """Weights of a linear support vector machine; y is 1 or -1. Dual coordinate descent in a fixed order."""
    a, w = np.zeros(len(y)), np.zeros(x.shape[1])
    norm = (x * x).sum(axis=1) + 1e-12
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(y)):
            step = min(max(a[i] - (y[i] * (x[i] @ w) - 1) / norm[i], 0.0), cost) - a[i]
            if step:
                a[i] += step
                w += step * y[i] * x[i]
    return w


def fit_rest(x: np.ndarray, label: np.ndarray, among: list[str], cost: float = 1.0, rounds: int = 20) -> np.ndarray:
    """Weights of a machine for each of among against all others; the same descent for all at once."""
    a, w = np.zeros((len(x), len(among)), np.float32), np.zeros((len(among), x.shape[1]), np.float32)
    norm = (x * x).sum(axis=1) + 1e-12
    own = np.searchsorted(among, label)
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            y = np.full(len(among), -1.0, np.float32)
            y[own[i]] = 1.0
            step = np.clip(a[i] - (y * (w @ x[i]) - 1) / norm[i], 0.0, cost) - a[i]
            at = np.flatnonzero(step)
            a[i, at] += step[at]
            w[at] += (step[at] * y[at])[:, None] * x[i]
    return w


class Model:
    """Families, languages and the machines between each two of either, or for each family if there are very many."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        family = np.array([FAMILY.get(c, c) for c in langs])
        lang = np.array(langs)
        self.families = sorted(set(family.tolist()))
        scale, mean = (1 / (x.std(axis=0) + 1e-4), x.mean(axis=0)) if len(x) else (np.ones(BUCKETS), np.zeros(BUCKETS))
        z = np.ones((len(x), BUCKETS + 1), np.float32)
        np.multiply(x - mean, scale, out=z[:, :-1])
        z /= np.float32(np.sqrt(BUCKETS))
        self.of = {f: [c for c in self.langs if FAMILY.get(c, c) == f] for f in self.families}
        paired = len(self.families) <= MOST_PAIRED
        self.rest = None
        if not paired:
            w = fit_rest(z, family, self.families) / np.sqrt(BUCKETS)
            self.rest = np.column_stack([w[:, :-1] * scale, w[:, -1] - (w[:, :-1] * scale) @ mean])
        self.pairs = [(*p, family) for p in combinations(self.families, 2) if paired] + [(*p, lang) for f in self.families for p in combinations(self.of[f], 2)]
        rows = []
        for a, b, label in self.pairs:
            use = (label == a) | (label == b)
            w = fit_svm(z[use], np.where(label[use] == a, 1.0, -1.0)) / np.sqrt(BUCKETS)
            rows.append(np.append(w[:-1] * scale, w[-1] - (w[:-1] * scale) @ mean))
        self.weights = np.array(rows).reshape(len(rows), BUCKETS + 1)
        self.pairs = [(a, b) for a, b, _ in self.pairs]

    def _best(self, among: list[str], margin: dict[tuple[str, str], float]) -> tuple[str, float]:
        """The winner of most duels (the larger margins decide ties) and the chance its closest duel gives it."""
        duels = {c: [margin[c, d] if (c, d) in margin else -margin[d, c] for d in among if d != c] for c in among}
        best = max(among, key=lambda c: (sum(m > 0 for m in duels[c]), sum(duels[c]), c))
        return best, 1 / (1 + float(np.exp(-4 * np.clip(min(duels[best], default=5.0), -10, 10))))

    def _first(self, x: np.ndarray) -> tuple[str, float]:
        """The family whose machine gives the most; its closest duel is with the next."""
        m = self.rest[:, :-1] @ x + self.rest[:, -1]
        second, best = np.argsort(m, kind="stable")[-2:]
        return self.families[best], 1 / (1 + float(np.exp(-4 * np.clip(m[best] - m[second], -10, 10))))

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        x = vector(text)
        margin = dict(zip(self.pairs, (self.weights[:, :-1] @ x + self.weights[:, -1]).tolist(), strict=True))
        if self.rest is None:
            family, p = self._best(self.families, margin)
        else:
            family, p = self._first(x)
        lang, q = self._best(self.of[family], margin)
        return lang, p * q


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(c, vector(t).astype("<f4").tobytes()) for c, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if has_letter(t)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["lang", "x"])


def fit(docs: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """Fit on training rows of docs (doc_id, text, lang) with a language; of each as many, chosen by hash.

    Every language is learned, of LEAST_ROWS rows or what it has at the least."""
    rows = docs.select("doc_id", "text", "lang").filter(is_training(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").count()
    each = max(most_rows / max(counts.count(), 1), LEAST_ROWS)
    shares = counts.select("lang", (F.least(F.lit(1.0), F.lit(each) / F.col("count")) * (1 << 30)).cast("long").alias("_share"))
    # a row a language
    chosen = rows.join(F.broadcast(shares), "lang").filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.col("_share"))
    got = chosen.select("lang", F.col("text").cast("binary")).mapInArrow(_vectors, "lang string, x binary").toArrow()  # about most_rows rows of 16 kB
    langs = got.column("lang").to_pylist()
    x = np.array([np.frombuffer(v, "<f4") for v in got.column("x").to_pylist()], np.float32).reshape(len(langs), BUCKETS)
    del got
    order = np.lexsort((x @ np.arange(BUCKETS), np.array(langs, dtype=str))) if langs else []  # the same whatever order rows come in
    return Model(x[order], [langs[i] for i in order])


def _predicted(model, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [model.value.predict(t) for t in b.column(n).to_pylist()]
            more = [pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], *more], [*b.schema.names[:n], "i_lang", "i_score"])

    return run


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of docs without their text, with i_lang and i_score (0 to 1).

    Only the text is looked at, all of it. A null text, or one without a letter, is `und` with score 0; so is every
    text if nothing could be learned; where machines are even, the sum of margins and then the later code decides.
    Other columns stay, whatever their names; those named like an added one are replaced. Repeated rows get equal
    results; an empty table gives an empty one."""
    docs, hidden = shielded(docs, text)
    names = [*hidden]
    own = docs.select(*names, F.col(text).cast("binary").alias("i_bytes"))
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField("i_lang", T.StringType()), T.StructField("i_score", T.DoubleType())])
    return unshielded(own.mapInArrow(_predicted(docs.sparkSession.sparkContext.broadcast(model), len(names)), schema), hidden)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", (~is_training(F.col("doc_id"))).alias("held_out"), F.col("i_lang").alias("lang_pred"), F.col("i_score").alias("score"))
