"""Operators on small tables, against results worked out by hand."""

import math
from dataclasses import replace
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.functions.calendar import iso_date, month_end_after, period_start
from quillon.functions.stats import benjamini_hochberg, clustered_logit, six_digits, two_sided, wilson
from quillon.operators.rows import duplicated_keys, keep_first, latest
from quillon.operators.slices import sliced
from quillon.operators.temporal import asof_join, gaps, monthly_balance, months_at_risk

D = date.fromisoformat


def test_wilson_known_values_and_undefined(spark):
    df = spark.createDataFrame([(5.0, 10.0), (1.0, 0.1667), (0.0, 0.0), (11.0, 10.0)], "k double, n double")
    rows = df.select(F.round(wilson(F.col("k"), F.col("n"), False), 4), F.round(wilson(F.col("k"), F.col("n"), True), 4)).collect()
    assert [tuple(r) for r in rows] == [(0.2366, 0.7634), (None, None), (None, None), (None, None)]


def test_asof_boundaries_ties_and_no_match(spark):
    left = spark.createDataFrame([("a", D("2020-01-01")), ("a", D("2020-02-01")), ("b", D("2020-01-01")), (None, D("2020-01-01"))], "k string, at date")
    right = spark.createDataFrame([("a", D("2020-01-01"), 1), ("a", D("2020-01-01"), 2), ("a", D("2020-01-31"), 3), ("b", D("2020-01-02"), 4)], "k string, since date, v int")
    got = asof_join(left, right, ["k"], "at", "since", [F.col("v")])
    assert {(r["k"], r["at"], r["v"]) for r in got.collect()} == {("a", D("2020-01-01"), 2), ("a", D("2020-02-01"), 3), ("b", D("2020-01-01"), None), (None, D("2020-01-01"), None)}
    plan = got.select("*")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange ") == 1  # stacked and sorted once, whatever a key holds
    late = asof_join(left.withColumn("at", F.lit(None).cast("date")), right, ["k"], "at", "since")
    assert {r["v"] for r in late.collect()} == {None}
    many = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") * 2).alias("at"))
    since = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") * 2 + 1).alias("since"), "id")
    assert asof_join(many, since, ["k"], "at", "since").filter("id is null and at > 0 or since <> at - 1").count() == 0


def test_gaps_keep_null_keys_and_steps(spark):
    rows = [("m", None, D("2024-01-01"), 1), ("m", None, D("2024-03-01"), 1), ("q", "FIN", D("2024-01-01"), 3), ("q", "FIN", D("2024-10-01"), 3)]
    df = spark.createDataFrame(rows, "i string, r string, at date, k int")
    assert {tuple(r) for r in gaps(df, ["i", "r"], "at", "k").collect()} == {("m", None, D("2024-02-01")), ("q", "FIN", D("2024-04-01")), ("q", "FIN", D("2024-07-01"))}


def test_months_at_risk_and_headcount(spark):
    spells = spark.createDataFrame([("x", D("2023-01-01"), D("2023-03-15")), ("y", D("2023-02-10"), None), ("z", D("2023-03-31"), D("2023-03-31"))], "k string, a date, b date")
    got = {(r["k"], r["month_start"]) for r in months_at_risk(spells, "a", "b", F.lit(D("2023-04-01"))).collect()}
    assert got == {("x", D("2023-02-01")), ("x", D("2023-03-01")), ("y", D("2023-03-01")), ("y", D("2023-04-01"))}
    moves = spark.createDataFrame([("s", D("2023-01-01"), 1, 0), ("s", D("2023-03-01"), -1, 1), ("s", D("2023-02-01"), 1, 0), ("t", D("2023-03-01"), 1, 0), ("t", D("2023-03-01"), -1, 2)], "s string, m date, d int, x int")
    rows = {(r["s"], r["m"].month): (r["d"], r["x"]) for r in monthly_balance(moves, ["s"], "m", "d", ["x"], F.lit(D("2023-04-01")), together=True).collect()}
    assert rows == {("s", 1): (1, 0), ("s", 2): (2, 0), ("s", 3): (1, 1), ("s", 4): (1, 0), ("t", 1): (0, 0), ("t", 2): (0, 0), ("t", 3): (0, 2), ("t", 4): (0, 0)}
    assert monthly_balance(moves, ["s"], "m", "d", ["x"], F.lit(D("2023-04-01"))).filter("s = 't'").count() == 2
    assert monthly_balance(moves.filter("false"), ["s"], "m", "d", ["x"], F.lit(D("2023-04-01")), together=True).count() == 0


def test_duplicates_versions_and_keys(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 3), (1, "b", 4), (2, None, 1)], "k int, v string, n int")
    assert {tuple(r) for r in keep_first(df, ["k", "v"], [F.col("n")]).collect()} == {(1, "a", 3), (1, "b", 4), (2, None, 1)}
    assert {tuple(r) for r in latest(df, ["k"], [F.desc("n")]).collect()} == {(1, "a", 5), (2, None, 1)}
    assert [tuple(r) for r in duplicated_keys(df, ["k", "v"]).collect()] == [(1, "a", 2)]


def test_slices_name_totals_and_hide_the_unassigned(spark):
    df = spark.createDataFrame([("c", "s"), ("c", None), ("(unassigned)", "s")], "country_key string, segment_value string").withColumn("g", F.lit(1))
    got = {(r["country_code"], r["segment_value"], r["n"]) for r in sliced(df, ["g"], [F.count("*").alias("n")]).collect()}
    assert got == {("ALL", "All", 3), ("ALL", "s", 2), ("ALL", None, 1), ("c", "All", 2), ("c", "s", 1), ("c", None, 1)}


def test_dates_and_periods(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024",), ("2024-01",), ("2024-1-5",), ("x",)], "t string")
    assert [r[0] for r in df.select(iso_date(F.col("t"))).collect()] == [None, None, None, D("2024-01-05"), None]
    p = spark.createDataFrame([("M", "2024-02"), ("Q", "2024-Q4"), ("A", "2024"), ("M", "2024-13"), ("Q", "2024-Q5")], "f string, p string")
    assert [r[0] for r in p.select(period_start(F.col("f"), F.col("p"))).collect()] == [D("2024-02-01"), D("2024-10-01"), D("2024-01-01"), None, None]
    assert spark.range(1).select(month_end_after(F.lit(D("2023-12-01")), 2)).first()[0] == D("2024-02-29")


def test_q_values(spark):
    df = spark.createDataFrame([(1, 0.01), (2, 0.04), (3, 0.03), (4, None)], "i int, p_value double")
    assert {r["i"]: r["q_value"] and round(r["q_value"], 6) for r in benjamini_hochberg(df).collect()} == {1: 0.03, 2: 0.04, 3: 0.04, 4: None}


def test_q_values_of_many_tests_with_ties(spark):
    rng = np.random.default_rng(5)
    p = [*rng.random(400).round(2).tolist(), *(10.0 ** -rng.integers(3, 40, 100)).tolist(), 0.0, 0.0, 1.0, None]
    got = {r["i"]: r["q_value"] for r in benjamini_hochberg(spark.createDataFrame(list(enumerate(p)), "i int, p_value double")).collect()}
    known = [x for x in p if x is not None]
    for i, x in enumerate(p):
        want = None if x is None else min(1.0, *[y * len(known) / sum(z <= y for z in known) for y in known if y >= x])
        assert got[i] == (None if want is None else pytest.approx(want))


def test_logit_of_cells_equals_logit_of_persons():
    rng = np.random.default_rng(3)
    n, x = rng.integers(5, 30, 60), np.column_stack([np.ones(60), rng.normal(size=60)])
    events = rng.binomial(n, 1 / (1 + np.exp(-(-1 + 0.5 * x[:, 1]))))
    b, cov = clustered_logit(x, n.astype(float), events.astype(float))
    rows = np.repeat(x, n, axis=0)
    y = np.concatenate([np.r_[np.ones(e), np.zeros(k - e)] for k, e in zip(n, events)])
    c = np.zeros(2)
    for _ in range(50):
        mu = 1 / (1 + np.exp(-rows @ c))
        c += np.linalg.solve((rows * (mu * (1 - mu))[:, None]).T @ rows, rows.T @ (y - mu))
    mu = 1 / (1 + np.exp(-rows @ c))
    bread = np.linalg.inv((rows * (mu * (1 - mu))[:, None]).T @ rows)
    cell = np.repeat(np.arange(60), n)
    sums = np.array([((y - mu)[cell == i, None] * rows[cell == i]).sum(axis=0) for i in range(60)])
    want = bread @ (sums.T @ sums) @ bread * (60 / 59) * ((len(y) - 1) / (len(y) - 2))
    assert np.allclose(b, c) and np.allclose(cov, want, rtol=1e-8)


def refit(cells, start, within):
    """Slope and its error by Newton's steps over persons' rows, countries as dummies; cells: country, month, n, events, value."""
    names = sorted({c for c, *_ in cells})
    means = {c: np.mean([x[4] for x in cells if x[0] == c]) for c in names}
    unit = np.std([x[4] - means[x[0]] for x in cells], ddof=1)
    row = lambda c, m, v: [1.0, v / unit, *([(m.year - start.year) * 12 + m.month - start.month, *[float(c == o) for o in names[1:]]] if within else [])]
    x = np.array([row(c, m, v) for c, m, n, _, v in cells for _ in range(n)])
    y = np.array([float(i < e) for _, _, n, e, _ in cells for i in range(n)])
    cell = np.repeat(np.arange(len(cells)), [c[2] for c in cells])
    b = np.zeros(x.shape[1])
    for _ in range(25):
        mu = 1 / (1 + np.exp(-x @ b))
        bread = np.linalg.inv((x * (mu * (1 - mu))[:, None]).T @ x)
        b = b + bread @ x.T @ (y - mu)
    score = np.zeros((len(cells), x.shape[1]))
    np.add.at(score, cell, (y - mu)[:, None] * x)
    g = len(cells)
    return b[1], np.sqrt((bread @ (score.T @ score) @ bread)[1, 1] * g / (g - 1) * (len(y) - 1) / (len(y) - x.shape[1])), unit


def fitted(spark, pairs, start=D("2021-01-01")):
    """pairs: indicator -> cells; the results by indicator and model."""
    from quillon import adapters
    from quillon.plans.association import fit_associations

    rows = [("NEW_HIRE_6M", i, *c) for i, cells in pairs.items() for c in cells]
    df = spark.createDataFrame(rows, "objective_id string, indicator_id string, country_code string, as_of_date date, n long, events long, value double")
    return {(r["indicator_id"], r["model"]): r for r in fit_associations(df, replace(adapters.SETTINGS, reporting_start=start)).collect()}


def drawn_cells(rng, countries="ABC", months=12, n=(8, 30), effect=0.0, level=0.0, of_level=0.0):
    days = [date(2021 + m // 12, m % 12 + 1, 1) for m in range(months)]
    out = []
    for k, c in enumerate(countries):
        for m in days:
            size, v = int(rng.integers(*n)), float(rng.normal())
            out.append((c, m, size, int(rng.binomial(size, 1 / (1 + np.exp(1.2 - effect * v - of_level * k)))), v + level * k))
    return out


def test_many_models_at_once_equal_fits_of_persons(spark):
    """Dummies, trend, scaling, clustered errors, p- and q-values, each against persons' rows."""
    rng = np.random.default_rng(4)
    pairs = {f"i{k}": drawn_cells(rng, "ABCD"[: 2 + k % 3], 6 + k % 5, effect=k / 20) for k in range(25)}
    got = fitted(spark, pairs)
    assert len(got) == 50
    for i, cells in pairs.items():
        for model in ("naive", "within_country"):
            b, error, unit = refit(cells, D("2021-01-01"), model != "naive")
            r = got[i, model]
            assert (r["n_obs"], r["n_events"], r["n_clusters"], r["note"]) == (sum(c[2] for c in cells), sum(c[3] for c in cells), len(cells), "")
            want = [np.exp(b), np.exp(b - 1.959963984540054 * error), np.exp(b + 1.959963984540054 * error), math.erfc(abs(b / error) / math.sqrt(2)), unit]
            assert [r[c] for c in ("odds_ratio", "ci_low", "ci_high", "p_value", "signal_sd_within")] == [pytest.approx(w, rel=6e-6) for w in want]
    tests = [r for r in got.values() if r["model"] == "within_country"]
    for r in tests:
        q = min(1.0, *[x["p_value"] * len(tests) / sum(y["p_value"] <= x["p_value"] for y in tests) for x in tests if x["p_value"] >= r["p_value"]])
        assert r["q_value"] == pytest.approx(q, rel=6e-6)
    assert all(r["q_value"] is None for r in got.values() if r["model"] == "naive")


def test_models_find_effects_and_are_not_fooled_by_countries(spark):
    """A real effect, none, one that only countries have, and models that can't be fitted."""
    rng = np.random.default_rng(7)
    day = D("2021-01-01")
    pairs = {
        "real": drawn_cells(rng, "ABCDEF", 48, (40, 41), effect=0.5), "none": drawn_cells(rng, "ABCDEF", 48, (40, 41)),
        "countries": drawn_cells(rng, "ABCDEF", 48, (40, 41), level=2.0, of_level=0.3),
        "flat": [(c, m, n, e, float(ord(c))) for c, m, n, e, _ in drawn_cells(rng)], "quiet": [(c, m, n, 0, v) for c, m, n, _, v in drawn_cells(rng)],
        "apart": [(c, m, n, n if v > 0 else 0, v) for c, m, n, _, v in drawn_cells(rng)], "empty": [("A", day, 5, 1, None)], "few": [("A", day, 5, 1, 0.5), ("B", day, 5, 2, 0.7)],
        "trend": [(c, m, n, e, float(m.year * 12 + m.month)) for c, m, n, e, _ in drawn_cells(rng)], "all": [(c, m, n, n, v) for c, m, n, _, v in drawn_cells(rng)],
    }
    got = fitted(spark, pairs)
    real, none, naive, within = got["real", "within_country"], got["none", "within_country"], got["countries", "naive"], got["countries", "within_country"]
    assert real["odds_ratio"] > 1.3 and real["p_value"] < 0.001 and none["ci_low"] < 1 < none["ci_high"]
    assert naive["p_value"] < 0.001 and within["ci_low"] < 1 < within["ci_high"] and within["n_clusters"] == 288
    note = {k: r["note"] for k, r in got.items()}
    assert note["flat", "naive"] == note["few", "within_country"] == "no within-country variation" and note["quiet", "naive"] == note["empty", "naive"] == "no events"
    assert "separated" in note["apart", "naive"] and "separated" in note["all", "within_country"] and "depend" in note["trend", "within_country"] and note["trend", "naive"] == ""
    for (i, _), r in got.items():
        assert (r["odds_ratio"] is None) == (r["note"] != "") == (r["p_value"] is None) and (r["n_clusters"] == 0) == (r["note"] in ("no events", "no within-country variation"))
        assert (i, r["n_obs"]) != ("empty", 5)


def test_a_country_without_events_says_nothing_of_the_slope(spark):
    rng = np.random.default_rng(9)
    cells = drawn_cells(rng, "ABC", 20)
    more = cells + [("D", m, n, 0, v) for _, m, n, _, v in drawn_cells(rng, "D", 20)]
    got = fitted(spark, {"three": cells, "four": more})
    three, four = got["three", "within_country"], got["four", "within_country"]
    scale = four["signal_sd_within"] / three["signal_sd_within"]
    assert math.log(four["odds_ratio"]) == pytest.approx(math.log(three["odds_ratio"]) * scale, rel=1e-4) and four["n_clusters"] == 80


def test_tails_of_the_normal_law(spark):
    z = [0.0, 1e-9, 0.3, -1.96, 3.1, 3.2, 5.0, -8.5, 20.0, 38.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in z], "z double").coalesce(1).select(two_sided(F.col("z"))).collect()]
    assert got == [pytest.approx(math.erfc(abs(x) / math.sqrt(2)), rel=1e-11) for x in z]
    assert spark.range(1).select(two_sided(F.lit(None).cast('double'))).first()[0] is None
    rounded = spark.createDataFrame([(123456.7,), (0.000123456789,), (None,), (-2.0,)], "x double").coalesce(1).select(six_digits(F.col("x"))).collect()
    assert [r[0] for r in rounded] == [123457.0, 0.000123457, None, -2.0]
