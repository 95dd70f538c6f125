"""The operators against brute force, on edge cases and on copies of one small table."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql.classic.dataframe import DataFrame as DF
from pyspark.sql import functions as F

from quillon.llm import chat, common, decontam, graph, langid, line_dedup, lm_score, mixing, ngram_join, pii, quality, repeats, shingles, token_files, wavelet

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SAID = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank"
EDGE = [None, "", " \n\t ", "one", "a b c d", "a b c d e", SAID, SAID, SAID.upper(), "x " * 3000, "\n".join([SAID] * 5), "é😀 ñandú übung 漢字 ok"]


def docs(spark, texts=EDGE, **more):
    rows = [(i, t, "src", "en", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    return df.withColumns(more) if more else df


def empty(spark):
    return docs(spark).filter("doc_id < 0")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# quality rules
def brute_quality(t):
    w = WORD.findall(t or "")
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {j for i, k in enumerate(zip(w, w[1:], w[2:])) if seen[k] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit)


def test_quality_counts_and_fence(spark):
    texts = [*EDGE, "a b c a b c a", "# $ % x", "l1 w\nl1 w\n\nl2"]
    got = by_id(quality.apply_rules(docs(spark, texts).withColumn("q_n_words", F.lit("clash"))))
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["q_n_words"], r["q_word_chars"], r["q_symbols"], r["q_dup_lines"], r["q_repeat_words"]) == brute_quality(t)
    assert quality.apply_rules(docs(spark)).filter("q_kept").count() == 0 and quality.apply_rules(empty(spark)).count() == 0


# personal data
def brute_pii(t):
    luhn = lambda d: sum(x if i % 2 == 0 else 2 * x - 9 * (2 * x > 9) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    tests = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15)]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p, ok in tests for m in re.finditer(p, t or "") if ok(m.group()))


def test_pii_base_spans_stay_and_others_are_added(spark, tmp_path):
    texts = [*EDGE, "a@b.c%d@e.f x@y 1.2.3.4.5.6.7.8 1.2.3 4.5.6.7 999.1.1.1 00000255.1.1.1 😀 j@k.l", "mail bob [at] mail [dot] com. call (415) 555-2671, 4111 1111 1111 1111 4242424242424242 +49 30 1234567 +1",
             " ".join(f"u{i}@h{i}.org 10.0.0.{i % 256}" for i in range(900)), "9" * 5000, "a." * 5000 + "@" + "b." * 5000]
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = by_id(pii.query(spark, str(tmp_path)))
    for i, t in enumerate(texts):
        want = brute_pii(t)
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert {*want.split(",")} - {""} <= {*got[i]["spans"].split(",")}
        if i != len(EDGE) + 1:
            assert got[i]["spans"] == want
    assert "email:5:28" in got[len(EDGE) + 1]["spans"]  # written with words for its signs
    assert pii.find_pii(empty(spark)).count() == 0


def test_pii_added_spans_are_right(spark):
    """Precision and recall of what the method adds, by kind, among look-alikes."""
    from planted import Plant

    texts, wanted = Plant(11).texts(60)
    got = by_id(pii.find_pii(docs(spark, texts), keep=["doc_id"]))
    for kind in pii.KINDS:
        found = {(i, s["start"], s["end"]) for i, r in got.items() for s in r[f"p_{kind}"] if not s["base"]}
        want = {(i, a, e) for i, w in enumerate(wanted) for k, a, e in w if k == kind}
        assert len(found & want) >= 0.9 * len(want) and len(found & want) >= 0.9 * len(found), (kind, len(found), len(want), len(found & want))


# mixing
def test_mixing_thresholds_and_hot_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEVEL", 6)
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    rows = mixing.mix(df).collect()
    taken, target, size = collections.Counter(), {}, collections.Counter()
    for r in rows:
        assert r["m_taken"] in (0, r["m_size"], 2 * r["m_size"])
        taken[r["source"]] += r["m_taken"]
        size[r["source"]] += r["m_size"]
        target[r["source"]] = r["m_target"]
    assert all(abs(taken[s] - target[s]) <= 50 and target[s] <= 2 * size[s] for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    again = {r["doc_id"]: r["m_taken"] for r in mixing.mix(df.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["m_taken"] for r in rows}
    assert mixing.mixed(df).count() == sum(r["m_copies"] for r in rows)
    assert mixing.mix(empty(spark)).count() == 0 and {r["m_target"] for r in mixing.mix(docs(spark, [None, ""])).collect()} == {0.0}


def test_small_joins_are_salted_beyond_the_bound(spark):
    big, small = spark.range(1000).select((F.col("id") % 3).alias("k"), "id"), spark.range(2).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    assert common.join_small(big, small, ["k"], most_rows=1).count() == common.join_small(big, small, ["k"]).count() == 667
    assert common.join_small(big, small, ["k"], most_rows=1, how="left").count() == 1000


# near copies
def brute_components(texts):
    sets = []
    for t in texts:
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in WORD.findall(t or "")]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    least = list(range(len(texts)))
    for _ in texts:
        for a, b in itertools.combinations(range(len(texts)), 2):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                least[a] = least[b] = min(least[a], least[b])
    return {i: (len(s), least[i]) for i, s in enumerate(sets)}


def near(n=60, seed=5):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        base = [f"w{x}" for x in rng.integers(0, 400, rng.integers(4, 90))]
        out.append(" ".join(base))
        for _ in range(int(rng.integers(0, 4))):
            cut = list(base)
            for _ in range(int(rng.integers(0, 4))):
                cut[int(rng.integers(0, len(cut)))] = f"v{rng.integers(0, 9)}"
            out.append(" ".join([*cut, *[f"t{k}"] * int(rng.integers(0, 6))]))
    return out


@pytest.mark.parametrize("seed, block", [(5, 8192), (6, 2)])
def test_jaccard_components(spark, seed, block):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [*EDGE, *near(seed=seed), *[passage + f" own{i} " * (i % 30) for i in range(40)]]
    got = by_id(ngram_join.group_similar(docs(spark, texts).select("doc_id", "text"), block))
    want = brute_components(texts)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    if seed == 5:
        kept = {r["doc_id"] for r in ngram_join.one_of_each(docs(spark, texts).unionByName(docs(spark, texts))).collect()}
        assert kept == {i for i, (_, c) in want.items() if c == i}
        assert ngram_join.group_similar(empty(spark)).count() == 0


def test_prefix_bounds_hold_for_all_sizes():
    """Similar sets' samples must share a token inside both prefixes, whatever the sizes."""
    for n in range(1, 260):
        for m in range(n, n * 5 // 4 + 1):
            need = -(-4 * (n + m) // 9)
            if need <= n:
                common_ = min(ngram_join.sample(n) - n + need, ngram_join.sample(m) - m + need)
                assert common_ >= 1 and ngram_join.sample(n) - common_ < ngram_join.prefix(n) and ngram_join.sample(m) - common_ < ngram_join.prefix(m)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 200)]
    v = spark.range(300).select(F.col("id").alias("v"))
    got = {r["v"]: r["label"] for r in graph.components(v, spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 if i <= 60 else 100 if 100 <= i < 200 else i for i in range(300)}


def test_components_read_links_again_only_between_what_has_not_met(spark, monkeypatch):
    """Links that all rounds together join with vertices: a few times the links, not links times rounds."""
    rng = np.random.default_rng(3)
    order = rng.permutation(3000).tolist()
    path = list(zip(order[:2000], order[1:2000]))  # a long way in no order
    near = [(a, b) for b in range(2000, 3000) for a in rng.integers(2000, 2020, 5).tolist() if a < b]
    near = [(order[a], order[b]) for a, b in near]  # near copies: many links each
    v = common.stored(spark.range(3000).select(F.col("id").alias("v")), "v")
    links = common.stored(spark.createDataFrame(path + near, "a long, b long"), "links")
    joined, real = [], DF.join
    monkeypatch.setattr(DF, "join", lambda self, *x, **k: joined.append(real(self, *x, **k)) or joined[-1])
    monkeypatch.setattr(graph, "unstore", lambda df: None)
    got = {r["v"]: r["label"] for r in graph.components(v, links).collect()}
    rows = sum(j.count() for j in joined if "b" in j.columns)
    monkeypatch.undo()
    first, rest = min(order[:2000]), min(order[2000:])
    assert got == {x: first if i < 2000 else rest for i, x in enumerate(order)}
    assert rows <= 4 * len(path + near)


@pytest.mark.parametrize("last_links", [0, 40, 4096])
def test_last_links_are_followed_in_one_task(spark, monkeypatch, last_links):
    """The last links take one job, whatever the rounds they would need; the labels are the same."""
    rng = np.random.default_rng(4)
    order = rng.permutation(400).tolist()
    links = list(zip(order[:199], order[1:200])) + [(order[200], x) for x in order[201:300]] + [(order[i], order[i]) for i in range(300, 310)]
    want, names, real = {x: x for x in range(-1, 400)}, [], graph.stored
    for x in order[:200]:
        want[x] = min(order[:200])
    for x in order[200:300]:
        want[x] = min(order[200:300])
    v, links = spark.range(-1, 400).select(F.col("id").alias("v")), spark.createDataFrame(links, "a long, b long")
    monkeypatch.setattr(graph, "stored", lambda df, name: names.append(name) or real(df, name))
    assert {r["v"]: r["label"] for r in graph.components(v, links, last_links=last_links).collect()} == want
    assert names == ["edges", "ends", "labels"] if last_links == 4096 else names.count("hooks") > 0
    none = links.filter("a = b")
    assert graph.components(v, none, last_links=last_links).filter("v <> label").count() == 0


def test_jaccard_components_without_broadcast(spark, monkeypatch):
    """Beyond MOST_IDS classes nothing that grows with them is broadcast, also where a group is split by further orders."""
    texts = [*EDGE, *near(seed=7), *[" ".join(f"p{i}" for i in range(60)) + f" own{i} " * (i % 30) for i in range(40)]]
    monkeypatch.setattr(ngram_join, "LEAST_BLOCK", 8)
    monkeypatch.setattr(ngram_join, "MOST_IDS", 0)
    sent = []
    monkeypatch.setattr(ngram_join.F, "broadcast", lambda df, real=F.broadcast: sent.append(df.columns) or real(df))
    kept = {r["doc_id"] for r in ngram_join.one_of_each(docs(spark, texts)).collect()}
    monkeypatch.undo()
    assert kept == {i for i, (_, c) in brute_components(texts).items() if c == i}
    assert not [c for c in sent if {"cls", "_id", "doc_id"} & {*c}]


# lines
def brute_lines(texts, ids):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    held = collections.defaultdict(set)
    for i, t in zip(ids, texts):
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                held[key(x)].add(i)
    out = {}
    for i, t in zip(ids, texts):
        lines = (t or "").split("\n")
        out[i] = (len(lines), "\n".join(x for x in lines if len(held.get(key(x), ())) < 3 or max(held[key(x)]) == i))
    return out


@pytest.mark.parametrize("most_keys, bits", [(1000, None), (0, None), (1000, 20)])
def test_lines_shared_by_three(spark, most_keys, bits):
    shared, short = "This line stands in many documents.", "é" * 19
    texts = [*EDGE, *[f"own line number {i} of its document\n {shared}\t\n{short}\n{shared.upper()}" for i in range(9)], "twice in two documents only, so it stays\n" + "é" * 20, "twice in two documents only, so it stays\n" + "é" * 20, "é" * 20]
    got = by_id(line_dedup.drop_lines(docs(spark, texts).withColumn("l_id", F.lit("clash")), most_keys=most_keys, bits=bits))
    assert {i: (r["l_lines"], r["l_text"]) for i, r in got.items()} == brute_lines(texts, range(len(texts)))
    assert line_dedup.drop_lines(empty(spark)).count() == 0


def test_lines_meet_keys_with_one_copy_of_each_text(spark):
    """Beyond the keys that may be broadcast, an exchange holds the text once, not also as bytes."""
    df = docs(spark, [f"this line is shared by all of them\nown line of number {i}" for i in range(9)])
    plan = line_dedup.drop_lines(df, most_keys=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and plan.count("cast(text") == 0 and "l_bytes" not in plan


def test_twice_seen_filter_has_no_false_negative():
    rng, bits = np.random.default_rng(2), 20
    tasks = [rng.integers(0, 1 << 63, (500, 2)).astype(np.uint64) for _ in range(3)]
    tasks[2][:50] = tasks[0][:50]
    import pyarrow as pa

    parts = [b for t in tasks for b in repeats.marks(lambda _, t=t: iter([t]), bits)(iter([None]))]
    slices = collections.defaultdict(list)
    for b in parts:
        for i, k in enumerate(b.column(0).to_pylist()):
            slices[k].append(b.slice(i, 1))
    data = bytearray(1 << (bits - 3))
    for k, bs in slices.items():
        out = next(repeats.merged(bits)((pa.scalar(k),), iter(bs))).column(1).to_pylist()[0]
        data[k << (bits - 9) : (k + 1) << (bits - 9)] = out
    f = np.frombuffer(data, np.uint8)
    assert repeats.suspected(f, tasks[0][:50], bits).all() and repeats.suspected(f, tasks[1], bits).mean() < 0.05


# language model
def test_lm_base_scores_are_exact_for_any_vocabulary(spark):
    texts = [*EDGE, *near(40)]
    toks = [[*WORD.findall((t or "").lower()), "\n"] for t in texts]
    train = [k for i, k in enumerate(toks) if zlib.crc32(str(i).encode()) % 7 != 2]
    c = collections.Counter(x for k in train for x in k)
    n, v = sum(c.values()), len(c)
    for most in (10**6, 40):
        got = by_id(lm_score.score_texts(docs(spark, texts).select("doc_id", "text"), most_words=most))
        for i, k in enumerate(toks):
            if texts[i] is None or texts[i].isascii():
                r = got[i]
                assert (r["s_tokens"], r["s_known"], r["s_train_tokens"]) == (len(k), sum(c[x] > 0 for x in k), n)
                assert r["s_base"] == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in k))
    assert lm_score.score_texts(empty(spark).select("doc_id", "text")).count() == 0


def test_lm_steps_of_counts():
    c = np.arange(1, 5000)
    step = lm_score.levels(c)
    assert (lm_score.LEAST[step] <= c).all() and (c <= lm_score.LARGEST[step]).all() and (step <= c).all() and (np.diff(step) >= 0).all()
    assert lm_score.LEAST[step[:8]].tolist() == [1, 2, 3, 4, 4, 6, 6, 8] and (lm_score.LARGEST[step] < 1.5 * c + 1).all()


def test_lm_filter_reads_steps_back_and_learns(spark):
    texts = ["a b c d"] * 64 + ["e f"] * 5 + ["z y"]
    m = lm_score.build(docs(spark, texts).select(F.col("text").cast("binary")), 400, 9)
    h = lm_score.tokens(b"a b e z q")
    assert lm_score.LEAST[m.read(shingles.scrambled(h))].tolist() == [64, 64, 4, 1, 0, 64]
    assert lm_score.LEAST[m.read(lm_score.pairs(lm_score.tokens(b"z y")))].tolist() == [1, 1, 1]
    good, odd, once, never = m.scores([lm_score.tokens(t) for t in (b"a b c d", b"d c b a", b"z y", b"q r")])
    assert good > odd + 3 and once > never


def brute_lm(train, texts):
    """The model with exact counts, rounded to steps as the filter keeps them."""
    one, two = collections.Counter(x for t in train for x in t), collections.Counter(p for t in train for p in zip([t[-1], *t], t))
    n, v = sum(one.values()), len(one)
    low = lambda c: lm_score.LEAST[lm_score.levels(np.array([c]))[0]] if c else 0.0
    high = lambda c: lm_score.LARGEST[lm_score.levels(np.array([c]))[0]] if c else 0.0
    p1 = lambda x: (low(one[x]) + 1) / (n + v + 1)
    p2 = lambda u, x: (low(two[u, x]) + lm_score.PRIOR * p1(x)) / (high(one[u]) + lm_score.PRIOR)
    for u in [*list(one)[:50], "never"]:  # what is left of 1 is for words never seen
        assert sum(p2(u, x) for x in one) <= 1
    return [sum(math.log10(p2(u, x)) for u, x in zip([t[-1], *t], t)) for t in texts]


def test_lm_scores_equal_brute_force_and_beat_the_base(spark):
    from quillon.llm.common import table

    df = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = sorted((r["doc_id"], [*(w.decode("utf-8") for w in (r["text"] or "").encode().lower().split()), "\n"]) for r in df.collect())
    want = dict(zip([i for i, _ in rows], brute_lm([t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2], [t for _, t in rows]), strict=True))
    got = by_id(lm_score.score_texts(df))
    off = np.array([abs(got[i]["s_score"] - want[i]) / got[i]["s_tokens"] for i in want])
    assert np.median(off) < 1e-4 and off.max() < 0.1  # the filter takes about one sequence in 500 for one it has seen
    held = [r for r in got.values() if r["s_held_out"]]
    tokens = sum(r["s_tokens"] for r in held)
    assert sum(r["s_score"] for r in held) / tokens > sum(r["s_base"] for r in held) / tokens + 0.05


@pytest.mark.parametrize("chunk, sequences", [(1 << 22, 1 << 22), (300, 1 << 22), (300, 16)])
def test_lm_scores_are_the_same_by_broadcast_and_by_slices(spark, monkeypatch, chunk, sequences):
    df = docs(spark, [*EDGE, *near(40)]).select("doc_id", "text", "source")
    want = by_id(lm_score.score_texts(df))
    monkeypatch.setattr(lm_score, "CHUNK", chunk)
    monkeypatch.setattr(lm_score, "SLICE_SEQUENCES", sequences)
    got = by_id(lm_score.score_texts(df, most_words=40, most_tokens=0))
    assert got.keys() == want.keys()
    for i, r in got.items():
        a, b = r.asDict(), want[i].asDict()
        assert a.pop("s_base") == pytest.approx(b.pop("s_base"))
        # other slices misread other sequences, which near copies share
        assert a.pop("s_score") == pytest.approx(b.pop("s_score"), rel=1e-9 if sequences > 16 else 0.05)
        assert a == b


@pytest.mark.parametrize("slices", [64, 1024])
def test_lm_slices_answer_for_each_chunk(slices):
    import pyarrow as pa

    key = np.unique(shingles.scrambled(np.arange(60_000, dtype=np.uint64)) >> np.uint64(64 - lm_score.KEY_BITS))
    rng = np.random.default_rng(1)
    chunks = [(key[use], rng.integers(0, 5, use.sum())) for use in (rng.random(len(key)) < 0.5 for _ in range(3))]
    exact = np.zeros(len(key), np.int64)
    for own, n in chunks:
        exact[np.searchsorted(key, own)] += n
    rows = pa.Table.from_batches([lm_score._encoded(c, *x, slices) for c, x in enumerate(chunks)])
    got = {c: {} for c in range(3)}
    for k in range(slices):
        part = rows.filter(pa.array(np.array(rows["slice"]) == k))
        for b in lm_score._answered(slices)((pa.scalar(k),), iter(part.to_batches())):
            got[b["s_chunk"][0].as_py()][k] = np.frombuffer(b["levels"][0].as_py(), np.uint8)
    for c, (own, _) in enumerate(chunks):
        read, n = np.concatenate([v for _, v in sorted(got[c].items())]), exact[np.searchsorted(key, own)]
        want = np.where(n > 0, lm_score.levels(np.maximum(n, 1)), 0)
        assert len(read) == len(own) and (read >= want).all() and (read == want).mean() > 0.99


def test_lm_filter_errs_alike_at_any_size():
    key = lambda lo, n: shingles.scrambled(np.arange(lo, lo + n, dtype=np.uint64)) >> np.uint64(64 - lm_score.KEY_BITS)
    for n in (1_000, 50_000, 400_000):
        f = np.frombuffer(lm_score.filled(key(0, n), np.arange(n) % 3 + 1), np.uint8)
        read = lambda k: lm_score.levels_in(f, k, np.full(len(k), 8 * len(f)), np.zeros(len(k), np.int64))  # noqa: E731, B023
        assert (read(key(0, n)) >= np.array([1, 2, 3])[np.arange(n) % 3]).all()
        assert (read(key(10**9, 50_000)) > 0).mean() < 0.005


# decontamination
def brute_overlap(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        x = words(t)
        n = min(10, len(x))
        for p in {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if n else ():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) == p:
                    hit |= set(range(i, i + n))
                    ids |= {item} - {None}
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("block, shard", [(10**6, 10**6), (12, 10)])
def test_overlaps_with_a_benchmark(spark, monkeypatch, block, shard):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block)
    monkeypatch.setattr(decontam, "SHARD_WORDS", shard)
    items = [(1, SAID), (2, SAID + " and more words follow here"), (3, "ok"), (4, None), (5, "..."), (None, "seven wise owls"), (11, "a b c d"), (1, "naïve café")]
    texts = [*EDGE, "Seven-Wise OWLS! " + SAID[:60], SAID + " " + SAID, "0 a b c d 0 ok", "NAïVE café"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = by_id(decontam.find_overlaps(docs(spark, texts).withColumn("d_hits", F.lit(1)), bench).withColumn("n", decontam.n_hit()))
    for i, t in enumerate(texts):
        assert (got[i]["d_words"], got[i]["n"], sorted(got[i]["d_items"])) == brute_overlap(t, items), t
    assert got[6]["d_longest"] == len(SAID.split())
    assert decontam.find_overlaps(docs(spark), bench.filter("false")).filter("size(d_hits) > 0").count() == 0 == decontam.find_overlaps(empty(spark), bench).count()


# token files
def test_tokens_round_trip(spark):
    from tokenizers import Tokenizer

    k = Tokenizer.from_file(token_files.TOKENIZER)
    texts = [*EDGE, "a  b", "a   b\n\nc \n d", " lead", "trail ", "a\tb\xa0c", "<|endoftext|> a<|endoftext|>", "it's he's, don't. ...,. x.,y", ".", "a.", "\x01 b", "1,2. 3. 漢字.", "\x1c a"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (None, "none first")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*k.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    uri = common.shared_path(spark, "test-tokens")
    got = token_files.read_tokens(spark, uri, token_files.write_tokens(df, uri, file_tokens=50))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    assert token_files.tokenized(df.filter("doc_id < 0")).count() == 0


def test_cutting_changes_no_id():
    import pyarrow as pa
    import public_tokenizers

    bits = ["'s", "'ll", "don't", " ", " ", "  ", "\n", "\n\n", "\t", "\xa0", "\x85", "\r\n", "\u2003", "\u3000", "a", "B", "word", "é", "ñandú", "é.", "×", "漢字", "😀", "\u0301", "٣", "1", "23", ".", ",", "...",
            "<|endoftext|>", "<|", "|>", "\x1c", "\x00", "\x0b", "“q”", "I'm", "'", '"', "-", "_", "ß.", "\u200b", "\ufeff"]
    rng = np.random.default_rng(4)
    texts = ["".join(bits[i] for i in rng.integers(0, len(bits), rng.integers(0, 14))) for _ in range(60_000)] + [None, "", " ".join(map(str, rng.integers(0, 10**6, 300_000)))]
    e = token_files.Encoder(token_files.TOKENIZER)
    assert e.cuttable
    for i in range(0, len(texts), 9001):
        part = texts[i : i + 9001]
        got, n = e.encode(pa.array(part))
        want = [[*x.ids, 0] for x in e.tokenizer.encode_batch_fast([t or "" for t in part], add_special_tokens=False)]
        assert n.tolist() == list(map(len, want)) and got.tolist() == list(itertools.chain(*want))
    other = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))  # another pre-tokenizer: whole texts
    got, n = other.encode(pa.array(texts[:500]))
    assert not other.cuttable and got.tolist() == list(itertools.chain(*[[*other.tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts[:500]]))


@pytest.mark.parametrize("ids", [np.random.default_rng(1).integers(0, 300, 3000), np.random.default_rng(2).zipf(1.3, 3000) % 60_000, np.full(3000, 7), np.arange(3000)])
def test_wavelet_queries(ids):
    a = ids.astype(np.uint16)
    data = wavelet.to_bytes(a, np.array([1000, 2000]), [None, 7])
    header, names, lengths, m = wavelet.from_bytes(data)
    assert (m.ids() == a).all() and names == [None, 7] and lengths.tolist() == [1000, 2000]
    for i, c in zip(range(0, 3000, 61), a[::61].tolist()):
        where = np.flatnonzero(a == c)
        assert m.access(i) == a[i] and m.rank(c, i) == (a[:i] == c).sum() and m.count(c) == len(where) and m.select(c, len(where) - 1) == where[-1]
    with pytest.raises(IndexError):
        m.select(65_000, 0)
    f = wavelet.TokenFile(data)
    c = int(a[-1])
    assert f.token(1, 1999) == c and f.count_in(c, 0) == (a[:1000] == c).sum() and f.occurrence(c, f.matrix.count(c) - 1) == (1, 1999)


def test_wavelet_code_lengths_are_the_best():
    import heapq

    counts = np.sort(np.random.default_rng(3).zipf(1.4, 200))
    heap = [(int(c), i, 0) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        (a, _, _), (b, i, _) = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, (a + b, i, 0))
    lengths = wavelet.code_lengths(counts)
    assert (counts * lengths).sum() == total and (lengths[:-1] >= lengths[1:]).all() and (0.5**lengths).sum() == 1
    assert wavelet.WaveletMatrix.of(np.zeros(0, np.uint16)).ids().tolist() == []


# languages
def test_language_families(spark):
    say = {"en": "the house of the old man and his dog", "de": "das alte Haus und der Hund von dem Mann", "fr": "la vieille maison de la rue et le chien", "es": "la casa vieja de la calle y el perro"}
    rows = [(i * 10 + k, " ".join(np.random.default_rng(i).permutation(t.split())), c) for i in range(60) for k, (c, t) in enumerate(say.items())]
    df = spark.createDataFrame([*rows, (9001, None, "en"), (9002, "123 !!", "en"), (9003, "the dog", None)], "doc_id long, text string, lang string")
    got = by_id(langid.identify(df.select("doc_id", "text"), langid.fit(df)))
    assert sum(got[i]["i_lang"] == c for i, _, c in rows) / len(rows) > 0.97
    assert (got[9001]["i_lang"], got[9002]["i_lang"], got[9003]["i_lang"]) == ("und", "und", "en") and all(0 <= r["i_score"] <= 1 for r in got.values())
    none = langid.fit(df.filter("lang is null"))
    assert {r["i_lang"] for r in langid.identify(df.select("doc_id", "text"), none).collect()} == {"und"}
    assert langid.identify(empty(spark), none).count() == 0


def test_languages_of_held_out_documents(spark):
    from quillon.llm.common import table

    at = "/root/testdata/sf0.01"
    told = {r["doc_id"]: r for r in table(spark, at, "documents").select("doc_id", "lang", "text").collect()}
    got = [r for r in langid.query(spark, at).collect() if r["held_out"] and told[r["doc_id"]]["lang"]]
    right = [r["lang_pred"] == told[r["doc_id"]]["lang"] for r in got if r["lang_pred"] != "und"]
    assert len(right) > 150 and sum(right) / len(right) > 0.97 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(not re.search(r"[^\W\d_]", told[r["doc_id"]]["text"] or "") for r in got if r["lang_pred"] == "und")


def test_rare_languages_are_learned(spark):
    word = lambda k: [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + (k * 7 + j * 5) % 26)}" * 2 for j in range(6)]
    n = lambda k: 30 if k < 120 else 4
    rows = [(k * 100 + i, " ".join(np.random.default_rng(i).permutation(word(k))), f"x{k:03}") for k in range(130) for i in range(n(k))]
    df = spark.createDataFrame([*rows, *[(90001 + i, SAID, "en") for i in range(8)], *[(91001 + i, "het oude huis van de man", "nl") for i in range(8)]], "doc_id long, text string, lang string")
    m = langid.fit(df)
    assert m.langs == sorted({r[2] for r in rows} | {"en", "nl"})
    assert m.predict(SAID.encode())[0] == "en" and m.predict(b"het oude huis van de man")[0] == "nl"
    got = [m.predict(t.encode()) for _, t, _ in rows[-40:]]
    assert sum(g[0] == c for g, (_, _, c) in zip(got, rows[-40:], strict=True)) > 36 and all(0 <= g[1] <= 1 for g in got)


# chats
def test_chats_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<\\s>", "<\\\\/s>", "[TURN]", "\\[TURN]\\", "<s>", "<<SYS>>x<</SYS>>", "", None, "a\nb"]
    rows = [(1, i, r, t) for i, (t, r) in enumerate(itertools.product(nasty, ("user", "user", "assistant", None, "odd</s>[INST]\nrole")))]
    rows += [(2, None, "user", "first"), (2, 5, "user", "b"), (2, 5, "user", "a"), (None, 1, "assistant", "alone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: [tuple(x) for x in r["turns"]] for r in chat.parse_chats(chat.format_chats(df)).collect()}
    order = lambda c: [(r or "", t or "") for _, n, r, t in sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))]
    assert got == {c: order(c) for c in (1, 2, None)}
    assert chat.format_chats(df.filter("false")).count() == 0


# all of them: callers' columns, repeated rows, very long texts
def bench(spark):
    return spark.createDataFrame([(1, SAID)], "item_id long, text string")


OPERATORS = {
    "pii": (lambda d: pii.find_pii(d), {"p_email", "p_ip", "p_card", "p_phone"}),
    "mix": (lambda d: mixing.mix(d), {"m_size", "m_source_size", "m_target", "m_copies", "m_taken"}),
    "mixed": (lambda d: mixing.mixed(d), set()),
    "jaccard": (lambda d: ngram_join.one_of_each(d), set()),
    "lines": (lambda d: line_dedup.drop_lines(d), {"l_lines", "l_dropped", "l_text"}),
    "lm": (lambda d: lm_score.score_texts(d, most_words=3), {"s_tokens", "s_known", "s_score", "s_held_out", "s_train_tokens", "s_base"}),
    "quality": (lambda d: quality.apply_rules(d), {"q_kept", "q_failed", "q_base_failed", "q_n_words"}),
    "overlaps": (lambda d: decontam.find_overlaps(d, bench(d.sparkSession)), {"d_words", "d_hits", "d_items", "d_longest"}),
    "language": (lambda d: langid.identify(d, langid.fit(d)), {"i_lang", "i_score"}),
}
CLASHES = ["c_email", "c_taken", "g_ip", "P_Email", "m_key", "m_all", "M_target", "m_below", "m_n", "l_id", "l_keys", "L_Text", "k", "h", "l", "n", "s_key", "s_other", "s_rest", "i_bytes", "d_bytes", "q_at", "q_failed", "id", "cls", "v", "label", "_x0", "_salt", "_share", "a.dot", "least", "first"]


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_of_callers_stay_whatever_their_names(spark, name):
    run, own = OPERATORS[name]
    d = docs(spark, EDGE)
    for c in CLASHES:
        d = d.withColumn(c, F.concat(F.lit(c), F.col("doc_id").cast("string")))
    out = run(d)
    lower = [c.lower() for c in out.columns]
    assert len(set(lower)) == len(lower) and own <= set(out.columns)
    mine = [c for c in CLASHES if c.lower() not in {x.lower() for x in own}]
    rows = out.select("doc_id", *[F.col(f"`{c}`") for c in mine]).collect()
    assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in mine)
    assert run(d.filter("doc_id < 0")).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows_null_ids_and_very_long_texts(spark, name):
    run, own = OPERATORS[name]
    rng = np.random.default_rng(8)
    long = " ".join(f"w{x}" for x in rng.integers(0, 50_000, 320_000)) + " me@example.com " + SAID + "\n" + "x" * 100_000
    assert len(long) > 2_000_000
    rows = [(1, SAID), (1, SAID), (2, long), (2, long), (None, SAID), (None, None), (4, "")]
    d = spark.createDataFrame([(i, t, "src" if i else None, "en", None) for i, t in rows], "doc_id long, text string, source string, lang string, n_chars long")
    got = run(d).collect()
    if name == "jaccard":
        assert sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in got) == [(0, 0), (0, len(SAID)), (1, len(SAID)), (2, len(long)), (4, 0)]
    elif name == "mixed":
        assert {r["text"] for r in got} <= {t for _, t in rows}
    else:
        assert len(got) == len(rows)
        twice = [tuple(r[c] for c in sorted(own)) for r in got if r["doc_id"] == 2]
        assert len(twice) == 2 and twice[0] == twice[1]
        r = next(r for r in got if r["doc_id"] == 2)
        words = len(long.split())
        want = {"pii": lambda: r["p_email"][0]["start"] == long.index("me@"), "mix": lambda: r["m_size"] == words, "lines": lambda: r["l_lines"] == 2, "lm": lambda: r["s_tokens"] == words + 1,
                "quality": lambda: r["q_n_words"] == words, "overlaps": lambda: r["d_longest"] == len(SAID.split()), "language": lambda: r["i_lang"] == "en"}
        assert want[name]()


def test_chats_with_repeated_rows_and_long_texts(spark):
    long = "</s>\\[INST]" * 180_000
    rows = [(1, 0, "user", long, "x"), (1, 0, "user", long, "x"), (1, 1, "assistant", "ok", "x"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").withColumn("turns", F.lit(1))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.parse_chats(chat.format_chats(df)).collect()}
    assert got == {1: [("user", long), ("user", long), ("assistant", "ok")], None: [("", "")]}


def test_sweep_deletes_what_was_stored(spark):
    import os

    before = common.written()
    a, b = common.stored(spark.range(3).toDF("v"), "swept"), common.stored(spark.range(0).toDF("v"), "kept")
    paths = sorted(common.written() - before)
    common.sweep(spark, before, b)
    assert [os.path.exists(p.split("://", 1)[-1]) for p in paths] == ["kept" in p.rsplit("/", 1)[-1] for p in paths] and b.count() == 0
    common.unstore(b)
    assert common.written() == before and a is not None


def test_hot_keys_meet_by_broadcast(spark):
    big = common.stored(spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.col("id")).when(F.col("id") % 2 == 0, -1).alias("k"), "id"), "big")
    small = common.stored(spark.range(-1, 4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x")), "small")
    assert [r["k"] for r in common.hot_keys(big, "k").collect()] == [-1]
    for how in ("inner", "left"):
        rows = lambda df: sorted(map(repr, df.select("k", "id", "x").collect()))
        assert rows(common.join_hot(big, small, "k", how)) == rows(big.join(small, "k", how))


# pipeline
def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline

    clean = [" ".join(f"the word{(i * 37 + j * 11) % 997} of" for j in range(30)) for i in range(6)]
    d = docs(spark, [*EDGE, *clean, clean[0], None]).withColumn("extra", F.lit(1))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        d = common.stored(stage(spark, d, "/root/testdata/sf0.001"), f"test-stage-{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert d.columns == corpus_pipeline.COLUMNS
        if k == 1:
            assert {r["doc_id"] for r in d.collect()} == set(range(len(EDGE), len(EDGE) + 6))
    assert d.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and d.count() > 0


def test_pipeline_equals_sql_and_the_tokenizer(spark):
    """The whole run against the stages' SQL one after the other, and whole texts through the library."""
    import corpus_pipeline
    import duckdb
    from tokenizers import Tokenizer

    at = "/root/testdata/sf0.001"
    got = sorted(map(tuple, corpus_pipeline.run(spark, at).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents AS SELECT * FROM '{at}/documents.parquet'")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{at}/benchmark.parquet'")
    for sql, kept in ((quality.ORACLE_SQL, "kept"), (ngram_join.ORACLE_SQL, "component_id = doc_id"), (decontam.ORACLE_SQL, "NOT contaminated")):
        con.execute(f"CREATE TABLE judged AS {sql}")
        con.execute(f"CREATE OR REPLACE TABLE documents AS SELECT d.* FROM documents d JOIN judged j USING (doc_id) WHERE {kept}")
        con.execute("DROP TABLE judged")
    con.execute(f"CREATE TABLE judged AS {mixing.ORACLE_SQL}")
    rows = con.execute("SELECT d.doc_id, d.text, j.taken // greatest(j.size, 1) FROM documents d JOIN judged j USING (doc_id) ORDER BY doc_id").fetchall()
    k, want, start = Tokenizer.from_file(token_files.TOKENIZER), [], 0
    for i, t, copies in rows:
        ids = [*k.encode(t, add_special_tokens=False).ids, 0]
        for _ in range(copies):
            want.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    assert got == want and len(want) > 20


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_pipeline_of_empty_and_null_rows(spark, tmp_path, rows):
    import corpus_pipeline

    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    bench(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
