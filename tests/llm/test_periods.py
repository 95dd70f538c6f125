"""Periodic runs against their definition, tried place by place."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillon.llm import periods

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        same = [w[i] == w[i + q] for i in range(len(w) - q)]
        at = 0
        for equal, g in itertools.groupby(same):
            n = len(list(g))
            if equal and n + q >= max(6, 4 * q):
                found.setdefault((at, n + q), q)
            at += n
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, t):
    w = WORD.findall(t or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def row(doc_id, w):
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(x for i, x in enumerate(w) if i not in gone)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), min_size=1, max_size=6))
def test_runs_of_few_words(texts):
    assert periods.find(texts) == [brute_runs(t) for t in texts]


@pytest.mark.parametrize("words, places", [(1 << 18, 1 << 20), (50, 7)])
def test_runs_in_periodic_texts(monkeypatch, words, places):
    """Runs in runs, beside each other and overlapping, whatever the size of the parts that are worked on."""
    monkeypatch.setattr(periods, "WORDS", words)
    monkeypatch.setattr(periods, "PLACES", places)
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(40):
        t = []
        for _ in range(rng.integers(1, 5)):
            base = rng.integers(0, rng.integers(1, 9), rng.integers(1, 12)).tolist()
            if rng.random() < 0.3:
                base = base * 5 + [77]
            t += (base * 12)[: rng.integers(1, 9 * len(base))]
        texts.append([b"w%d" % x for x in t])
    texts += [[b"x"] * n for n in (0, 1, 5, 6, 7, 400)]
    assert periods.find(texts) == [brute_runs(t) for t in texts]


def test_common_prefixes():
    rng = np.random.default_rng(2)
    x = np.append(rng.integers(0, 2, 300), 9)
    i, j = (v.ravel() for v in np.meshgrid(np.arange(301), np.arange(301)))
    i, j = i[i != j], j[i != j]
    want = [next(k for k in range(302) if x[min(a + k, 300)] != x[min(b + k, 300)] or max(a, b) + k >= 300) for a, b in zip(i, j)]
    assert periods.Suffixes(x).common(i, j).tolist() == want


def test_runs_query_equals_brute_force(spark, tmp_path):
    said = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak"
    texts = [None, "", " \n\t ", "one", "a b c d e f", "a a a a a", "a a a a a a", "x " * 3000, "\n".join([said] * 7), f"{said} " * 3 + "a b " * 9 + said, "é😀 漢字 " * 9, "A a A a A a A a", "a b " * 8, "a\x1fb c\x0bd " * 5]
    rows = [(i * 20 + k, t) for i in range(15) for k, t in enumerate(texts)] + [(3, texts[8]), (None, "a b " * 9), (-5, said)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.withColumn("r_runs", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, periods.query(spark, str(tmp_path)).collect()), key=repr)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None) > 10
    assert got == sorted((row(i, WORD.findall(t) if i is None else planted(i, t)) for i, t in rows), key=repr)


def test_runs_keep_callers_columns(spark):
    df = spark.createDataFrame([(1, "a b " * 9, "x", 2), (None, None, None, None)], "id long, body string, R_RUNS string, r_bytes int")
    out = periods.find_runs(df, "body")
    assert out.columns == ["id", "body", "r_bytes", "r_words", "r_runs", "r_collapsed"]
    r = out.filter("id = 1").first()
    assert (r["r_words"], [tuple(x) for x in r["r_runs"]], r["r_collapsed"], r["r_bytes"]) == (18, [(0, 18, 2)], "a b", 2)
    assert out.filter("id IS NULL").first()["r_words"] == 0 and periods.find_runs(df.limit(0), "body").count() == 0
    long = spark.createDataFrame([(1, " ".join(f"w{i % 70_000}" for i in range(300_000)))], "id long, body string")
    assert [tuple(x) for x in periods.find_runs(long, "body", keep=["id"]).first()["r_runs"]] == [(0, 300_000, 70_000)]
