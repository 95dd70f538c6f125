"""Curation, retention, signals and associations on small tables worked out by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quillon.config import ConfigError, Objective, Settings, standard
from quillon.plans import association, external, profile, retention, signals, workforce

D = date.fromisoformat
S = standard()
BASE = dict(employee_id="E", country_code="GR", business_unit="Sales", job_family="J", career_level="Manager", employment_type="Permanent", hire_date="2022-01-10",
            termination_date="", termination_type="", regretted_exit="", source_system="HCM_A", record_updated_at="2025-01-01")


def raw(spark, *changes):
    rows = [tuple((BASE | c)[k] for k in workforce.COLUMNS) + (i + 2,) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in workforce.COLUMNS) + ", source_row long")


def test_curation_of_one_defect_a_row(spark):
    left = dict(termination_date="2025-03-01", termination_type="Voluntary")
    w = workforce.curate(raw(spark, dict(employee_id="dup"), dict(employee_id="dup"), dict(employee_id="alias", country_code="EL"), dict(employee_id="none", country_code=" "),
        dict(employee_id="odd", country_code="XX"), dict(employee_id="lead", career_level="Sr Mgmt"), dict(employee_id="nohire", hire_date=""), dict(employee_id="early", termination_date="2021-01-01", termination_type="Voluntary", regretted_exit="true"),
        dict(employee_id="bad", hire_date="2022"), dict(employee_id="later", termination_date="2026-05-01", termination_type="Voluntary", regretted_exit="true"), dict(employee_id="unk", **left), dict(employee_id="reg", regretted_exit="TRUE", **left),
        dict(employee_id="new", record_updated_at="2025-01-01"), dict(employee_id="new", record_updated_at="2025-06-01", source_system="HCM_B"), dict(employee_id="eoc", termination_date="2025-03-01", termination_type="End of Contract", regretted_exit="true")), S)
    e = {r["employee_id"]: r for r in w.employees.collect()}
    assert len(e) == 13 and e["dup"]["quality_rules"] == [] and e["dup"]["is_measurable"] and e["dup"]["in_country_scope"]
    assert e["alias"]["country_code"] == "GR" and e["alias"]["quality_rules"] == ["WF_COUNTRY_ALIAS"]
    assert [e[k]["is_measurable"] and not e[k]["in_country_scope"] for k in ("none", "odd")] == [True, True]
    assert e["lead"]["career_level"] == "Senior Leader"
    assert [e[k]["is_measurable"] for k in ("nohire", "early", "bad")] == [False, False, False]
    assert e["later"]["exit_date"] is None and e["later"]["regretted_status"] == "not_applicable" and e["later"]["is_measurable"]
    assert [e[k]["regretted_status"] for k in ("unk", "reg", "eoc")] == ["unknown", "regretted", "not_applicable"]
    assert e["new"]["source_system"] == "HCM_B"
    counts = {r["rule_id"]: r["hits"] for r in workforce.counts(spark, w.events).collect()}
    assert counts["WF_EXACT_DUPLICATE"] == counts["WF_ID_SUPERSEDED"] == counts["WF_EOC_ON_PERMANENT"] == 1 and counts["EX_PERIOD_GAP"] == 0 and len(counts) == 23


def test_profile_of_raw_rows(spark):
    rows = raw(spark, {}, {}, dict(career_level="Sr Mgmt"), dict(employee_id="a", country_code=""), dict(employee_id="b", country_code="EL", hire_date="2020-05-01"), dict(employee_id="c", hire_date=""),
        dict(employee_id="d", termination_date="2021-01-01"), dict(employee_id="e", termination_type="Voluntary"), dict(employee_id="f", termination_date="2026-03-01", termination_type="End of Contract", regretted_exit="true"))
    n = {r["check"]: r["n"] for r in profile.profile(rows, S).orderBy("position").collect()}
    assert [*n.values()] == [9, 1, 7, 1, 1, 1, 1, 1, 0, 1, 1, 1, 1, 1, 1, 1, 1] and len(n) == 17
    assert {r["n"] for r in profile.profile(rows.filter("false"), S).collect()} == {0}


def test_retention_boundaries(spark):
    people = [dict(employee_id="a", hire_date="2023-01-10", termination_date="2023-07-10"), dict(employee_id="b", hire_date="2023-01-10", termination_date="2023-07-09"),
              dict(employee_id="c", hire_date="2023-01-31"), dict(employee_id="d", hire_date="2020-06-15", termination_date="2023-05-20", regretted_exit="true"), dict(employee_id="e", hire_date="2025-08-01")]
    people = [p | (dict(termination_type="Voluntary") if p.get("termination_date") else {}) for p in people]
    m = retention.objective_measures(workforce.curate(raw(spark, *people), S).employees, S)
    own = m.filter("objective_id = 'NEW_HIRE_6M' and country_code = 'ALL' and segment_value = 'All'")
    month = own.filter("grain = 'month' and period_start = '2023-01-01'").first()
    assert (month["numerator"], month["denominator"], month["status"]) == (2, 3.0, "insufficient_sample")
    assert own.filter("grain = 'month' and period_start = '2025-08-01'").first()["status"] == "pending"
    t = m.filter("objective_id = 'REGRETTED_TURNOVER_12M' and variant = 'main' and grain = 'year' and period_start = '2023-01-01' and country_code = 'ALL' and segment_value = 'All'").first()
    assert t["numerator"] == 1 and t["denominator"] == pytest.approx((4 * 4 + 3 * 2 + 1 * 6) / 12)
    assert m.filter("denominator <= 0 and rate is not null").count() == 0


def test_month_counts_are_the_sums_of_person_months(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    people = []
    for i in range(300):
        hired = D("2020-01-01").toordinal() + int(rng.integers(0, 2100))
        gone = hired + int(rng.integers(0, 700)) if rng.random() < 0.6 else None
        exit_date = date.fromordinal(gone) if gone and gone <= S.as_of.toordinal() else None
        people.append((f"E{i}", ["GR", "IT"][i % 2], ["Sales", "Digital"][i % 3 % 2], date.fromordinal(hired), exit_date, ["regretted", "unknown", "not_regretted"][i % 3] if exit_date else "not_applicable"))
    emp = spark.createDataFrame(people, "employee_id string, country_key string, segment_value string, hire_date date, exit_date date, regretted_status string").filter(F.col("hire_date") <= F.lit(S.as_of))
    key = ["month_start", "country_key", "segment_value"]
    want = retention.person_months(emp, S).groupBy(*key).agg(F.count("*"), F.count_if("exits_in_month"), F.count_if("regretted_exit"), F.count_if("regretted_exit_upper"))
    got = retention.person_month_counts(emp, S).select(*key, "at_risk", "exits", "regretted", "regretted_upper")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 200
    heads = {(r["month_end"], r["country_key"], r["segment_value"]): r["headcount"] for r in retention.headcount(emp, S).collect()}
    for m, c, g in [*heads][::37]:
        assert heads[m, c, g] == sum(p[1] == c and p[2] == g and p[3] <= m and (p[4] is None or p[4] > m) for p in people)


def staged(spark, *rows):
    full = [(i, "eurostat", "d", f, g, p, r, v, s, None, "u", "t", "sha") for i, f, g, p, r, v, s in rows]
    return spark.createDataFrame(full, external.SCHEMA)


def test_external_periods_gaps_and_errors(spark):
    x = external.curate(staged(spark, ("unemployment_rate", "M", "EL", "2024-01", None, 1.0, None), ("unemployment_rate", "M", "EL", "2024-03", None, 2.0, "p"), ("unemployment_rate", "M", "EL", "2024-04", None, None, None),
        ("job_vacancy_rate", "Q", "IT", "2024-Q2", None, 3.0, None), ("job_vacancy_rate", "Q", "ZZ", "2024-Q2", None, 3.0, None), ("job_vacancy_rate", "Q", "IT", "2024-Q7", None, 3.0, None), ("job_vacancy_rate", "Q", "PL", "2024-Q1", "r", 3.0, "p"), ("job_vacancy_rate", "Q", "PL", "2024-Q1", "r", 4.0, None),
        ("job_vacancy_rate", "Q", "PL", "2024-Q4", "r", 4.0, None)), S)
    hits = {(r["rule_id"], r["geo"], r["source_period"]) for r in x.events.collect()}
    assert hits == {("EX_STATUS_FLAGGED", "EL", "2024-03"), ("EX_VALUE_MISSING", "EL", "2024-04"), ("EX_PERIOD_GAP", "EL", "2024-02-01"), ("EX_GEO_UNMAPPED", "ZZ", "2024-Q2"), ("EX_PERIOD_UNPARSEABLE", "IT", "2024-Q7"),
                    ("EX_GRAIN_DUPLICATE", "PL", "2024-Q1"), ("EX_STATUS_FLAGGED", "PL", "2024-Q1"), ("EX_PERIOD_GAP", "PL", "2024-04-01"), ("EX_PERIOD_GAP", "PL", "2024-07-01")}
    assert x.events.filter("rule_id = 'EX_GRAIN_DUPLICATE'").count() == 1
    assert {tuple(r["quality_rules"]) for r in x.observations.filter("country_code = 'PL' and source_period = '2024-Q1'").collect()} == {("EX_GRAIN_DUPLICATE", "EX_STATUS_FLAGGED")}
    c = {(r["country_code"], r["indicator_id"]): r for r in x.coverage.collect()}
    assert c["GR", "unemployment_rate"]["gaps"] == 1 and c["GR", "unemployment_rate"]["last_period_end"] == D("2024-03-31") and c["IT", "job_vacancy_rate"]["last_period_end"] == D("2024-06-30")
    assert workforce.gate_failures(workforce.counts(spark, x.events)) == ["EX_GEO_UNMAPPED", "EX_PERIOD_UNPARSEABLE", "EX_GRAIN_DUPLICATE"]


def test_signals_never_look_ahead(spark):
    x = external.curate(staged(spark, ("unemployment_rate", "M", "EL", "2022-11", None, 7.0, None), ("unemployment_rate", "M", "EL", "2022-12", None, 8.0, None), ("hicp_inflation_first_release", "M", "EL", "2022-12", "FLS", 1.0, None), ("hicp_inflation_first_release", "M", "EL", "2022-12", "FIN", 2.0, None)), S)
    a = signals.signal_asof(x.observations, S)
    assert a.filter("available_from > as_of_date").count() == 0
    at = {(r["indicator_id"], r["as_of_date"]): r["value"] for r in a.collect()}
    assert at["unemployment_rate", D("2023-02-01")] == 7.0 and at["unemployment_rate", D("2023-03-01")] == 7.0 and at["unemployment_rate", D("2023-04-01")] == 8.0
    assert at["hicp_inflation_first_release", D("2023-02-01")] == 2.0 and at["gdp_growth", D("2023-02-01")] is None


def test_association_finds_an_effect_and_reports_none(spark):
    import numpy as np

    rng, months = np.random.default_rng(1), [D(f"{y}-{m:02d}-01") for y in range(2021, 2025) for m in range(1, 13)]
    cells = []
    for c in "ABCDEF":
        for m in months:
            v = float(rng.normal())
            cells.append(("o", "i", c, m, 40, int(rng.binomial(40, 1 / (1 + np.exp(1.5 - 0.8 * v)))), v))
            cells.append(("o", "flat", c, m, 40, 3, float(ord(c))))
    df = spark.createDataFrame(cells, "objective_id string, indicator_id string, country_code string, as_of_date date, n long, events long, value double")
    got = {(r["indicator_id"], r["model"]): r for r in association.fit_associations(df, S).collect()}
    within = got["i", "within_country"]
    assert within["n_clusters"] == 288 and within["odds_ratio"] > 1.5 and within["p_value"] < 1e-6 and within["q_value"] == pytest.approx(within["p_value"], rel=1e-4)
    assert got["flat", "naive"]["note"] == "no within-country variation" and got["flat", "naive"]["p_value"] is None
    q = association.quarter_cells(df).filter("indicator_id = 'flat' and country_code = 'A'").first()
    assert (q["n"], q["events"], q["event_rate"]) == (120, 9, 0.075)


def test_settings_are_checked():
    with pytest.raises(ConfigError):
        Objective("x", "cohort", "at_least", 1.5, 6)
    with pytest.raises(ConfigError):
        Settings(D("2024-01-01"), D("2023-01-01"), (), level_aliases={"a": "b"})


def test_entry_lists_queries_with_their_sql():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "objective_measures" in e.queries()


def test_flagship_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).filter(F.col("status") == "met").limit(1).count() == 1


def test_lines_alike_but_for_quantity_are_numbered_alike_however_they_are_read(spark, tmp_path):
    """Equal order, line, date and flag: which of two lines is the later version mustn't hang on the order of rows in a file."""
    from quillon import adapters

    sf = "/root/testdata/sf0.001"
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").filter("l_orderkey < 40")
    twice = lines.unionByName(lines.withColumn("l_quantity", F.lit(1.0))).unionByName(lines.withColumn("l_quantity", F.lit(60.0)))
    got = []
    for name, order in (("up", F.asc("l_quantity")), ("down", F.desc("l_quantity"))):
        for t in ("nation", "region", "customer", "orders"):
            spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{tmp_path}/{name}/{t}.parquet")
        twice.coalesce(1).sortWithinPartitions(order).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
        got.append(sorted(map(str, workforce.curate(adapters.lifecycle(spark, f"{tmp_path}/{name}"), adapters.SETTINGS).employees.collect())))
    assert got[0] == got[1]
