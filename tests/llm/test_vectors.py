"""Codes of vectors and exact search against definitions by brute force, edge cases included."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import codebooks, exact_top
from quillon.llm.vectors import MOST, whole

NAN, INF = float("nan"), float("inf")


def table(spark, rows, more=""):
    return spark.createDataFrame(rows, f"vec_id long, label int, embedding array<float>{more}")


def drawn(n, d=32, seed=1, spread=0.15):
    """Vectors around three centres, with exact copies among them."""
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (3, d))[rng.integers(0, 3, n)] + rng.normal(0, spread, (n, d))
    x[n // 2 : n // 2 + n // 8] = x[0]
    return [(i, int(i % 4) if i % 5 else None, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]


def ints(rows):
    return {i: [int(np.floor(np.float64(np.float32(v)) * 256)) for v in x] for i, _, x in rows}


# codes
def brute_codes(rows, parts=16, entries=64, rounds=2):
    v = ints(rows)
    n = len(next(iter(v.values())))
    at = codebooks.cuts(n, parts)
    book = [[v[i][a:b] for i in sorted(v)[:entries]] for a, b in at]
    near = lambda x, c: min((sum((p - q) ** 2 for p, q in zip(x, e)), k) for k, e in enumerate(c))
    for _ in range(rounds):
        for k, (a, b) in enumerate(at):
            held = {}
            for x in v.values():
                held.setdefault(near(x[a:b], book[k])[1], []).append(x[a:b])
            book[k] = [[sum(c) // len(held[e]) for c in zip(*held[e])] if e in held else old for e, old in enumerate(book[k])]
    return {i: [near(x[a:b], book[k]) for k, (a, b) in enumerate(at)] for i, x in v.items()}, book


@pytest.mark.parametrize("n, d", [(300, 32), (10, 32), (120, 20)])
def test_codes_equal_the_definition(spark, n, d):
    """Many vectors, fewer than entries, and a length that the parts don't divide."""
    rows = drawn(n, d)
    out, book = codebooks.compress(table(spark, rows).repartition(5))
    want, books = brute_codes(rows)
    got = {r["vec_id"]: r for r in out.collect()}
    assert [b.tolist() for b in book] == books and got.keys() == want.keys()
    for i, near in want.items():
        assert got[i]["c_code"] == [k for _, k in near] and got[i]["c_error"] == sum(x for x, _ in near)


def test_only_changes_are_sent(spark):
    """Sums kept up by differences are those made anew, and a round without changes sends nothing."""
    n, parts, entries = 4, 2, 3
    rows = [([1, 2, 3, 4], None, [0, 1]), ([5, 6, 7, 8], [0, 1], [2, 1]), ([9, 9, 9, 9], [1, 1], [1, 1])]
    df = spark.createDataFrame(rows, "_v array<int>, _old array<int>, _new array<int>").coalesce(1)
    sent = {(r["part"], r["entry"]): (r["n"], r["sums"]) for r in df.mapInArrow(codebooks._moved(n, parts, entries), "part int, entry int, n long, sums array<long>").collect()}
    assert sent == {(0, 0): (0, [1 - 5, 2 - 6]), (0, 2): (1, [5, 6]), (1, 1): (1, [3, 4])}
    still = df.select("_v", F.col("_new").alias("_old"), "_new")
    assert still.mapInArrow(codebooks._moved(n, parts, entries), "part int, entry int, n long, sums array<long>").count() == 0


def test_codes_of_odd_rows(spark, tmp_path):
    rows = drawn(80)
    odd = [(900, 1, None), (901, 1, [1.0] * 31 + [NAN]), (902, 1, [INF] + [0.0] * 31), (903, 2, [None] + [0.0] * 31), (904, 2, [1.0] * 7), (905, 3, []), (-9, 3, None), rows[3], (None, 7, rows[4][2])]
    out, _ = codebooks.compress(table(spark, [(*r, "x", 1) for r in rows + odd], ", c_code string, `_V` int"))
    got = out.collect()
    assert out.columns == ["vec_id", "label", "embedding", "_V", "c_code", "c_error"] and len(got) == 82
    assert sum(r["vec_id"] == 3 for r in got) == 2 and len({str(r["c_code"]) for r in got if r["vec_id"] == 3}) == 1
    assert sum(r["vec_id"] is None for r in got) == 1
    for some in ([], odd[:4]):
        out, book = codebooks.compress(table(spark, some))
        assert out.count() == 0 and all(len(b) == 0 for b in book)
    table(spark, rows + odd[:4]).write.parquet(f"{tmp_path}/embeddings.parquet")
    found, (want, books) = codebooks.query(spark, str(tmp_path)).collect(), brute_codes(rows)
    error = {i: sum(x for x, _ in near) for i, near in want.items()}
    label = {i: k for i, k, _ in rows}
    assert {r["codebooks_sha256"] for r in found} == {hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()}
    for r in found:
        assert r["code"] == "".join(f"{k:02x}" for _, k in want[r["vec_id"]])
        assert r["label_error"] == sum(error[i] for i in error if label[i] == label[r["vec_id"]])


def test_components_are_held_to_a_size(spark):
    rows = [(1, None, [3e38, -3e38, 0.0, -0.001, 1.0])]
    assert whole(table(spark, rows), "embedding", "v").first()["v"] == [MOST, -MOST, 0, -1, 256]


# search
def brute_top(rows, asked, k):
    v = ints(rows)
    out = {}
    for q in asked:
        score = sorted((-sum(a * b for a, b in zip(v[q], x)), i) for i, x in v.items() if i != q)
        out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(score[:k])]
    return out


@pytest.mark.parametrize("n, d, shard, leaf, block", [(700, 32, 16_384, 128, 4096), (700, 8, 100, 8, 3), (3, 8, 16_384, 128, 4096), (260, 1, 64, 4, 100)])
def test_top_equals_brute_force(spark, monkeypatch, n, d, shard, leaf, block):
    monkeypatch.setattr(exact_top, "SHARD_ROWS", shard)
    monkeypatch.setattr(exact_top, "BLOCK_QUERIES", block)
    rows = drawn(n, d)
    df = table(spark, rows).repartition(3)
    got = {}
    for r in exact_top.top(df, df.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {q: sorted(x) for q, x in got.items()} == brute_top(rows, [i for i in range(n) if i % 50 == 0], 5)


def test_trees_prune_and_lose_nothing():
    """Small leaves, a bound from elsewhere, ties at the kth place, boxes that hold their points."""
    rng = np.random.default_rng(3)
    points = rng.integers(-20, 20, (2000, 3)).astype(np.int32)
    ids = rng.permutation(2000).astype(np.int64)
    i, p, low, high = exact_top.grown(ids, points, 16)
    nodes, left = exact_top.shape(2000, 16)
    for (a, b), lo, hi in zip(nodes, low, high):
        assert (p[a:b].min(0) == lo).all() and (p[a:b].max(0) == hi).all()
    queries = rng.integers(-20, 20, (40, 3)).astype(np.int32)
    own, want = np.full(40, -1, np.int64), []
    for q in queries:
        want.append(sorted(zip((-(points.astype(np.int64) @ q)).tolist(), ids.tolist()))[:5])
    for floor in (np.full(40, -np.inf), np.array([-w[-1][0] for w in want], float)):
        s = exact_top.Search(own, queries, floor, 5)
        s.walk(i, p, low, high, 16)
        assert [sorted((-x, -j) for x, j in b) for b in s.best] == want
        assert s.leaves < 40 * sum(not x for x in left) / 4  # most leaves are never looked into
    first = exact_top.Search(own, queries, np.full(40, -np.inf), 5)
    first.walk(i, p, low, high, 16, most_leaves=1)
    assert first.leaves == 40 and all(first.kth[q] <= -want[q][-1][0] for q in range(40))


def test_top_of_odd_rows(spark):
    rows = drawn(60, 8)
    odd = [(900, 1, None), (950, 1, [1.0] * 7 + [NAN]), (1000, 1, [INF] + [9.0] * 7), (1050, 2, [None] + [9.0] * 7), (1100, 2, [9.0] * 7), (1150, 3, []), (None, 3, [9.0] * 8), (1200, 4, rows[7][2]), (1200, 4, rows[7][2])]
    df = table(spark, rows + odd)
    got = exact_top.top(df.withColumn("_k", F.lit("x")), df.filter("vec_id % 50 = 0 OR vec_id IS NULL")).collect()
    assert {r["query_id"] for r in got} == {0, 50, 1200} and not {r["vec_id"] for r in got} & {900, 950, 1000, 1050, 1100, 1150, None}
    own = [(r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 1200]
    assert sorted(own) == sorted(2 * brute_top(rows + odd[-1:], [1200], 5)[1200])  # repeated queries are each answered, never with themselves
    first = [(r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 0]
    twice = sorted([(-sum(a * b for a, b in zip(ints(rows)[0], x)), i) for i, x in ints(rows).items() if i] + 2 * [(-sum(a * b for a, b in zip(ints(rows)[0], ints(rows)[7])), 1200)])[:5]
    assert sorted(first) == [(k + 1, i, -s) for k, (s, i) in enumerate(twice)]
    none = table(spark, [])
    assert exact_top.top(none, df).count() == exact_top.top(df, none).count() == exact_top.top(none, none).count() == 0
    assert exact_top.top(table(spark, rows[:1]), table(spark, rows[:1])).count() == 0
