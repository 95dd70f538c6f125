"""The engine's queries over star-schema tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon import adapters, serving
from quillon.adapters import SETTINGS as S
from quillon.functions.calendar import iso_date
from quillon.functions.calendar import period_months, period_start, month_end_after
from quillon.functions.sql import register
from quillon.functions.stats import benjamini_hochberg, wilson
from quillon.operators import rows, temporal
from quillon.plans import association, external, profile, retention, signals, workforce
from quillon.shared import Scratch
from quillon.sources import jsonstat

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def joined(c: str):
    return F.array_join(c, "|").alias(c)


def _workforce(spark: SparkSession, d: str) -> workforce.Workforce:
    return workforce.curate(adapters.lifecycle(spark, d), S)


def _scoped(spark: SparkSession, d: str) -> DataFrame:
    return retention.scoped(_workforce(spark, d).employees, S)


def _external(spark: SparkSession, d: str) -> external.External:
    return external.curate(adapters.series(spark, d), S)


def _measures(spark: SparkSession, d: str) -> DataFrame:
    return retention.objective_measures(_workforce(spark, d).employees, S)


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to nine digits, for comparing engines."""
    return df.withColumns({c: F.round(c, 9) for c, t in df.dtypes if t == "double"})


@query
def dedup_keep_first(spark, d):
    t = adapters.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rows.keep_first(t, ["l_orderkey", "l_linenumber"], [F.col("l_partkey"), F.col("l_suppkey")])


@query
def latest_version(spark, d):
    t = adapters.table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day"), "ts")
    return rows.latest(t, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query
def canonicalise_alias(spark, d):
    w = workforce.typed(workforce.last_versions(adapters.lifecycle(spark, d)), S)
    return w.groupBy("country_code_raw", "country_code", "career_level_raw", "career_level").agg(F.count("*").alias("n"))


@query
def quality_events(spark, d):
    return _workforce(spark, d).events


@query
def employees(spark, d):
    e = _workforce(spark, d).employees
    return e.withColumn("quality_rules", F.array_join("quality_rules", "|"))


@query
def rule_counts(spark, d):
    return workforce.counts(spark, _workforce(spark, d).events, _external(spark, d).events).select("position", "rule_id", "severity", "hits")


@query
def severity_flags(spark, d):
    return _workforce(spark, d).employees.groupBy("is_measurable", "in_country_scope", "regretted_status").agg(F.count("*").alias("n"))


@query
def category_unknown(spark, d):
    return _workforce(spark, d).events.filter("rule_id = 'WF_CATEGORY_UNKNOWN'").select("employee_id")


@query
def typed_dates(spark, d):
    """Dates from text of many kinds: whole dates are read, years and months alone are not."""
    o = adapters.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    kinds = F.array(F.date_format("day", "yyyy-MM-dd"), F.date_format("day", "yyyy-MM"), F.date_format("day", "yyyy"), F.date_format("day", "yyyy-MM-'99'"), F.lit("n/a"))
    t = o.select("o_orderkey", F.posexplode(kinds).alias("kind", "raw"))
    return t.select("o_orderkey", "kind", iso_date(F.col("raw")).alias("parsed"))


@query
def period_typing(spark, d):
    s = adapters.series(spark, d).select("frequency", "source_period").distinct().withColumn("period_start", period_start(F.col("frequency"), F.col("source_period")))
    return s.withColumn("period_end", month_end_after(F.col("period_start"), period_months(F.col("frequency")) - 1))


@query
def external_events(spark, d):
    return _external(spark, d).events


@query
def period_gaps(spark, d):
    return _external(spark, d).events.filter("rule_id = 'EX_PERIOD_GAP'").select("indicator_id", "geo", "source_period")


@query
def grain_duplicates(spark, d):
    return rows.duplicated_keys(adapters.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def external_observations(spark, d):
    return _external(spark, d).observations.withColumn("quality_rules", F.array_join("quality_rules", "|"))


@query
def series_coverage(spark, d):
    return _external(spark, d).coverage


@query
def cohort_members(spark, d):
    return retention.cohort_members(_scoped(spark, d), S)


@query
def cohort_monthly_slices(spark, d):
    return retention.cohort_monthly(retention.cohort_members(_scoped(spark, d), S))


@query
def cohort_measures(spark, d):
    return retention.cohort_measures(retention.cohort_monthly(retention.cohort_members(_scoped(spark, d), S)), S)


@query
def person_months(spark, d):
    return retention.person_month_counts(_scoped(spark, d), S)


@query
def headcount_month_end(spark, d):
    return retention.headcount(_scoped(spark, d), S)


@query
def turnover_ttm(spark, d):
    return _rounded(retention.turnover_monthly(_scoped(spark, d), S))


@query
def wilson_interval(spark, d):
    m = retention.cohort_monthly(retention.cohort_members(_scoped(spark, d), S)).select("numerator", "denominator").distinct()
    k, n = F.col("numerator").cast("double"), F.col("denominator").cast("double")
    return _rounded(m.select("numerator", "denominator", wilson(k, n, False).alias("ci_low"), wilson(k, n, True).alias("ci_high")))


@query
def wilson_in_sql(spark, d):
    """Intervals of pooled cohorts by a SQL text that calls the session's own functions."""
    register(spark)
    monthly = retention.cohort_monthly(retention.cohort_members(_scoped(spark, d), S))
    select = """SELECT objective_id, variant, country_code, sum(numerator) AS numerator, sum(denominator) AS denominator, wilson_low(sum(numerator), sum(denominator)) AS ci_low,
        wilson_high(sum(numerator), sum(denominator)) AS ci_high FROM {monthly} WHERE segment_value = 'All' GROUP BY objective_id, variant, country_code"""
    return _rounded(spark.sql(select, monthly=monthly))


@query
def objective_measures(spark, d):
    return _rounded(_measures(spark, d))


@query
def signal_values_lag(spark, d):
    return signals.signal_values(_external(spark, d).observations, S)


@query
def signal_asof(spark, d):
    return _asof(spark, d)


@query
def events_asof(spark, d):
    """For every purchase the last earlier or simultaneous event of the user of another kind."""
    e = adapters.table(spark, d, "events")
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", F.col("ts").alias("at"))
    right = e.filter("event_type <> 'purchase'").select("user_id", F.col("ts").alias("seen_at"), F.col("event_id").alias("seen_id"))
    return temporal.asof_join(left, right, ["user_id"], "at", "seen_at", [F.col("seen_id")]).select("event_id", "user_id", "seen_id")


def _once(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder, for plans that read a table more than once."""
    return Scratch(df.sparkSession, name).put(df)


def _asof(spark, d):
    return signals.signal_asof(_once(_external(spark, d).observations, "observations"), S)


def _cells(spark, d):
    emp = _once(_scoped(spark, d), "employees")
    return association.model_cells(retention.cohort_members(emp, S), retention.person_month_counts(emp, S), _asof(spark, d), S)


@query
def model_cells(spark, d):
    return _cells(spark, d)


@query
def association_cells(spark, d):
    return association.quarter_cells(_cells(spark, d))


@query
def association_logit(spark, d):
    return association.fit_associations(_cells(spark, d), S)


@query
def association_naive(spark, d):
    """The models without countries, whose two coefficients SQL can work out too."""
    r = association.fit_associations(_cells(spark, d), S).filter("model = 'naive'")
    return r.select("objective_id", "indicator_id", "n_obs", "n_events", "n_clusters", "signal_sd_within", "odds_ratio", "ci_low", "ci_high")


@query
def associations_of(spark, d):
    return serving.association_cells(association.quarter_cells(_cells(spark, d)), "NEW_HIRE_6M", "ship_lines")


@query
def bh_qvalues(spark, d):
    p = adapters.table(spark, d, "customer").select("c_custkey", (F.pmod(F.col("c_custkey") * 7919, F.lit(10007)) / 10007.0).alias("p_value"))
    return _rounded(benjamini_hochberg(p))


@query
def latest_status(spark, d):
    return serving.latest_status(_rounded(_measures(spark, d)), "ALL", "All", "quarter")


@query
def pooled_cohorts(spark, d):
    out = serving.pooled_cohorts(_rounded(_measures(spark, d)), S)
    return _rounded(out.withColumn("yearly_rates", F.array_join(F.transform("yearly_rates", lambda x: F.format_string("%.6f", x)), "|")))


@query
def yearly_turnover(spark, d):
    return serving.yearly_turnover(_rounded(_measures(spark, d)), "REGRETTED_TURNOVER_12M")


@query
def measures_slice(spark, d):
    return serving.measures(_rounded(_measures(spark, d)), "NEW_HIRE_6M", "EUROPE", "All", "quarter", "main")


@query
def signal_series(spark, d):
    return serving.signal_series(_asof(spark, d), "ship_lines", ["ASIA", "EUROPE"], S.reporting_start)


@query
def freshness(spark, d):
    x = _external(spark, d)
    return serving.freshness(x.coverage, x.observations)


@query
def workforce_counts(spark, d):
    return serving.workforce_counts(_workforce(spark, d).employees)


@query
def headlines(spark, d):
    return serving.headlines(_measures(spark, d))


@query
def verdicts(spark, d):
    return serving.verdicts(_rounded(_measures(spark, d))).groupBy("objective_id", "status", "verdict").agg(F.count("*").alias("n"))


@query
def findings_rollup(spark, d):
    """Tests by objective below the threshold, and the strongest of each."""
    p = adapters.table(spark, d, "part").select(F.col("p_brand").alias("objective_id"), F.col("p_name").alias("indicator_id"), F.col("p_partkey").alias("k"))
    tests = p.select("objective_id", F.concat_ws("-", "indicator_id", "k").alias("indicator_id"), F.lit("within_country").alias("model"), (F.pmod(F.col("k") * 7919, F.lit(10007)) / 10007.0).alias("p_value"))
    return _rounded(serving.findings(benjamini_hochberg(tests)))


@query
def union_exports(spark, d):
    e = adapters.table(spark, d, "events")
    kept = e.filter("event_type = 'click'").select("event_id", "user_id", F.lit("click").alias("origin"))
    more = e.filter("value > 50").select("event_id", "user_id", F.lit("large").alias("origin"))
    return kept.unionByName(more).orderBy(F.col("user_id").asc_nulls_first(), "event_id", "origin")


@query
def profile_counts(spark, d):
    """Value counts of the lifecycle columns, as a profile lists them."""
    r = adapters.lifecycle(spark, d)
    return r.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in ("country_code", "career_level", "termination_type", "regretted_exit")])).alias("x")).groupBy("x.field", "x.value").agg(F.count("*").alias("n"))


@query
def profile_checks(spark, d):
    return profile.profile(adapters.lifecycle(spark, d), S)


@query
def set_operations(spark, d):
    """Users who clicked or bought, those who did both, and those who clicked only."""
    e = adapters.table(spark, d, "events")
    clicked, bought = (e.filter(F.col("event_type") == kind).select("user_id") for kind in ("click", "purchase"))
    parts = {"either": clicked.union(bought).distinct(), "both": clicked.intersect(bought), "clicked only": clicked.subtract(bought)}
    named = [df.select("user_id", F.lit(name).alias("part")) for name, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query
def tenure_histogram(spark, d):
    e = _workforce(spark, d).employees.filter("exit_date is not null and is_measurable").withColumn("days", F.datediff("exit_date", "hire_date"))
    return e.filter("days between 175 and 190").groupBy("days").agg(F.count("*").alias("n"))


@query
def jsonstat_decode(spark, d):
    """A cube of months and flags for each supplier, written as the provider would and decoded."""
    lines = adapters.table(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_returnflag", "l_quantity")
    cells = jsonstat.decode_cube(jsonstat.cubes(jsonstat.demo_payloads(lines), "l_suppkey"), "l_suppkey")
    coords = F.array_join(F.transform(F.map_entries("dims"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    return cells.select("l_suppkey", "flat", coords.alias("coords"), "value", "status")
