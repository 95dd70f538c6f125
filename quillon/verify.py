"""Finished tables against a second computation by other means.

Employees and observations are taken as given; measures, what was known when, samples and models are worked out again from
them: cohorts by counting persons a year instead of summing months, head counts by laying out the months in which each person
was there instead of running sums, as-of values by a maximum over all earlier ones instead of a sorted walk, intervals as roots of
their equation, models with a column a country instead of swept sums."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.config import Settings
from quillon.functions.stats import Z, ModelFailed, clustered_logit
from quillon.operators.slices import ALL_COUNTRIES, ALL_SEGMENTS
from quillon.serving import laid_out

#: A check: what was compared, for what, the table's number, the second one, and whether they agree.
CHECK = "check string, of string, pipeline double, independent double, agrees boolean"
CLOSE = 1e-9


def _compared(rows: DataFrame, name: str, of: list[str], pairs: dict[str, tuple[str, str]], relative: float = CLOSE) -> DataFrame:
    """A check for each row and pair of columns; two nulls agree."""
    label = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in of])
    each = F.array(*[F.struct(F.lit(f"{name} {what}").alias("check"), F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")) for what, (a, b) in pairs.items()])
    out = rows.select(label.alias("of"), F.explode(each).alias("x")).select("x.check", "of", F.col("x.a").alias("pipeline"), F.col("x.b").alias("independent"))
    near = F.abs(F.col("pipeline") - F.col("independent")) <= relative * F.greatest(F.lit(1.0), F.abs("independent"))
    return out.withColumn("agrees", F.coalesce(near, F.col("pipeline").isNull() & F.col("independent").isNull()))


def _number(day: str) -> Column:
    return 12 * F.year(day) + F.month(day) - 1


def _people(employees: DataFrame, s: Settings) -> DataFrame:
    """Measurable persons, once for each slice that they count in."""
    places = F.when(F.col("in_country_scope"), F.array(F.lit(ALL_COUNTRIES), "country_code")).otherwise(F.array(F.lit(ALL_COUNTRIES)))
    rows = employees.filter("is_measurable").withColumn("_places", places).withColumn("_parts", F.array(F.lit(ALL_SEGMENTS), F.col(s.segment)))
    return rows.select("hire_date", "exit_date", "career_level", "regretted_status", F.explode("_places").alias("place"), "_parts").select("*", F.explode("_parts").alias("part")).drop("_parts")


def _left_early(months: Column) -> Column:
    """Month by month and day by day: before the same day, or the last of a shorter month, so many months on."""
    over = _number("exit_date") - _number("hire_date") - months
    day = F.least(F.dayofmonth("hire_date"), F.dayofmonth(F.last_day(F.make_date(((_number("hire_date") + months) / 12).cast("int"), (_number("hire_date") + months) % 12 + 1, F.lit(1)))))
    return F.coalesce((over < 0) | ((over == 0) & (F.dayofmonth("exit_date") < day)), F.lit(False))


def cohorts(employees: DataFrame, measures: DataFrame, s: Settings) -> DataFrame:
    """Hired and retained by year, for every variant, country and segment."""
    variants = employees.sparkSession.createDataFrame(s.variants, "objective_id string, variant string, months int, level string")
    people = _people(employees, s).filter(F.col("hire_date").between(F.lit(s.reporting_start), F.lit(s.effective_to or s.as_of)))
    rows = people.join(F.broadcast(variants), F.col("career_level") == F.col("level"))
    own = rows.groupBy("objective_id", "variant", F.year("hire_date").alias("year"), "place", "part").agg(F.count_if(~_left_early(F.col("months"))).alias("kept"), F.count("*").alias("hired"))
    table = measures.filter("grain = 'year'").join(variants.select("objective_id", "variant").distinct(), ["objective_id", "variant"])
    table = table.select("objective_id", "variant", F.year("period_start").alias("year"), F.col("country_code").alias("place"), F.col("segment_value").alias("part"), "numerator", "denominator")
    key = ["objective_id", "variant", "year", "place", "part"]
    own = own.withColumnsRenamed({k: f"_{k}" for k in key})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    both = table.join(own, same, "full").select(*[F.coalesce(k, f"_{k}").alias(k) for k in key], "numerator", "denominator", "kept", "hired")
    return _compared(both, "cohort", key, {"retained": ("numerator", "kept"), "hired": ("denominator", "hired")})


def turnover(employees: DataFrame, measures: DataFrame, s: Settings) -> DataFrame:
    """Regretted exits of a year and the mean of its twelve month ends' head counts."""
    ids = [o.id for o in s.objectives if o.measure == "turnover" and o.months == 12]
    table = measures.filter((F.col("grain") == "year") & F.col("objective_id").isin(ids) & F.col("segment_value").isNotNull())
    table = table.select("objective_id", "variant", F.year("period_start").alias("year"), F.col("country_code").alias("place"), F.col("segment_value").alias("part"), "numerator", "denominator")
    people = _people(employees, s)
    ends = F.sequence(_number("hire_date"), F.least(F.coalesce(_number("exit_date"), F.lit(12 * s.as_of.year + 11)), F.lit(12 * s.as_of.year + 11)))
    there = people.filter("hire_date <= coalesce(exit_date, hire_date)").select("place", "part", "exit_date", F.explode(ends).alias("n"))
    after = F.last_day(F.make_date((F.col("n") / 12).cast("int"), F.col("n") % 12 + 1, F.lit(1)))
    heads = there.filter(F.col("exit_date").isNull() | (F.col("exit_date") > after)).groupBy("place", "part", F.floor(F.col("n") / 12).alias("year")).agg((F.count("*") / 12).alias("heads"))
    gone = people.filter("exit_date is not null").groupBy("place", "part", F.year("exit_date").alias("year")).agg(F.count_if(F.col("regretted_status") == "regretted").alias("main"), F.count_if(F.col("regretted_status").isin("regretted", "unknown")).alias("upper"))
    both = table.join(heads, ["place", "part", "year"], "left").join(gone, ["place", "part", "year"], "left").fillna(0, ["heads", "main", "upper"])
    both = both.withColumn("exits", F.when(F.col("variant") == "main", F.col("main")).otherwise(F.col("upper")))
    return _compared(both, "turnover", ["variant", "year", "place", "part"], {"exits": ("numerator", "exits"), "head count": ("denominator", "heads")})


def intervals(measures: DataFrame) -> DataFrame:
    """Bounds of a rate as the roots of (rate - x)^2 = z^2 x (1 - x) / n; a check counts the rows of a year that agree."""
    n, p = F.col("denominator"), F.col("numerator") / F.col("denominator")
    a, b, c = 1 + Z * Z / n, -(2 * p + Z * Z / n), p * p
    root = F.sqrt(b * b - 4 * a * c)
    rows = measures.filter("ci_low is not null").withColumn("low", (-b - root) / (2 * a)).withColumn("high", (-b + root) / (2 * a))
    right = (F.abs(F.col("ci_low") - F.col("low")) < CLOSE) & (F.abs(F.col("ci_high") - F.col("high")) < CLOSE)
    by = rows.groupBy("objective_id", F.year("period_start").alias("year")).agg(F.count("*").alias("n"), F.count_if(right).alias("right"))
    return _compared(by, "intervals", ["objective_id", "year"], {"that agree": ("n", "right")})


def known(observations: DataFrame, asof: DataFrame, s: Settings) -> DataFrame:
    """As-of values as the maximum over all that were published by then; a check counts the rows of a signal that agree."""
    lags = observations.sparkSession.createDataFrame([(x.indicator_id, x.release, x.lag_days) for x in s.signals], "indicator_id string, release string, lag int")
    values = observations.join(F.broadcast(lags), "indicator_id").filter(F.col("release_code").eqNullSafe(F.col("release")))
    values = values.select("indicator_id", F.col("country_code").alias("place"), F.struct(F.date_add("period_end", F.col("lag")).alias("at"), "period_end", "value").alias("v"))
    met = (F.col("country_code") == F.col("place")) & (F.col("g.indicator_id") == F.col("o.indicator_id")) & (F.col("v.at") <= F.col("as_of_date"))
    best = asof.alias("g").join(values.alias("o"), met, "left").groupBy("g.indicator_id", "country_code", "as_of_date").agg(F.max("v").alias("v"), F.any_value("g.value").alias("value"), F.any_value("g.signal_period_end").alias("period_end"), F.any_value("g.available_from").alias("at"))
    right = F.col("value").eqNullSafe(F.col("v.value")) & F.col("period_end").eqNullSafe(F.col("v.period_end")) & F.coalesce(F.col("at") <= F.col("as_of_date"), F.lit(True))
    by = best.groupBy("indicator_id").agg(F.count("*").alias("n"), F.count_if(right).alias("right"))
    return _compared(by, "as-of values", ["indicator_id"], {"that agree": ("n", "right")})


def samples(employees: DataFrame, asof: DataFrame, s: Settings) -> DataFrame:
    """(objective, indicator, country, month, n, events, value), from persons: hires of cohorts that are over, and a row for
    each month that a person begins and could leave in."""
    people = employees.filter("is_measurable and in_country_scope").select("country_code", "career_level", "hire_date", "exit_date", "regretted_status")
    parts = []
    for o in s.objectives:
        if o.measure == "turnover":
            begun = F.expr(f"sequence(add_months(trunc(hire_date, 'month'), 1), least(coalesce(exit_date, date'{s.as_of}'), date'{s.as_of}'), interval 1 month)")
            rows = people.filter(F.add_months(F.trunc("hire_date", "month"), 1) <= F.least(F.coalesce("exit_date", F.lit(s.as_of)), F.lit(s.as_of))).select("*", F.explode(begun).alias("month")).filter(F.col("month") >= F.lit(s.reporting_start))
            event = F.coalesce((_number("exit_date") == _number("month")) & (F.col("regretted_status") == "regretted"), F.lit(False))
        else:
            levels = [level for i, variant, _, level in s.variants if i == o.id and variant == "main"]
            rows = people.filter(F.col("career_level").isin(levels) & F.col("hire_date").between(F.lit(s.reporting_start), F.lit(s.effective_to or s.as_of))).withColumn("month", F.trunc("hire_date", "month"))
            rows, event = rows.filter(F.add_months(F.last_day("month"), o.months) <= F.lit(s.as_of)), _left_early(F.lit(o.months))
        parts.append(rows.groupBy(F.lit(o.id).alias("objective_id"), "country_code", F.col("month").alias("as_of_date")).agg(F.count("*").alias("n"), F.count_if(event).alias("events")))
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return every.join(asof.filter("value is not null").select("indicator_id", "country_code", "as_of_date", "value"), ["country_code", "as_of_date"])


REFIT = "objective_id string, indicator_id string, model string, n long, e long, odds double, p double"


def refit(cells: pd.DataFrame, start: tuple[int, int]) -> pd.DataFrame:
    """Both models of one objective and signal over a column for each country; a few hundred cells."""
    c = cells.sort_values(["country_code", "as_of_date"])
    value, n, e = (c[k].to_numpy(float) for k in ("value", "n", "events"))
    off = (c["value"] - c.groupby("country_code")["value"].transform("mean")).to_numpy()
    unit = float(np.std(off, ddof=1)) if len(c) > 2 else 0.0
    months = np.array([12 * d.year + d.month for d in c["as_of_date"]], float) - (12 * start[0] + start[1])
    by = c.groupby("country_code")[["n", "events"]].transform("sum")
    mixed = ((by["events"] > 0) & (by["events"] < by["n"])).to_numpy()  # elsewhere a country's own level explains all
    factor = lambda g, rows, k: g / (g - 1) * (rows - 1) / (rows - k)
    out = []
    for model in ("naive", "within_country"):
        odds = p = None
        if unit > 0 and e.sum():
            told = mixed if model != "naive" else np.ones(len(c), bool)
            columns = [np.ones(told.sum()), value[told] / unit]
            if model != "naive":
                columns += [months[told], *pd.get_dummies(c["country_code"][told], drop_first=True, dtype=float).to_numpy().T]
            lost = c["country_code"].nunique() - c["country_code"][told].nunique() if model != "naive" else 0
            try:
                b, cov = clustered_logit(np.column_stack(columns), n[told], e[told])
                cov = cov * factor(len(c), n.sum(), len(columns) + lost) / factor(told.sum(), n[told].sum(), len(columns))
                odds, p = math.exp(b[1]), math.erfc(abs(b[1] / math.sqrt(cov[1, 1])) / math.sqrt(2))
            except (ModelFailed, np.linalg.LinAlgError, OverflowError, ValueError, ZeroDivisionError):
                pass
        out.append((c["objective_id"].iloc[0], c["indicator_id"].iloc[0], model, int(n.sum()), int(e.sum()), odds, p))
    return pd.DataFrame(out, columns=["objective_id", "indicator_id", "model", "n", "e", "odds", "p"])


def models(results: DataFrame, cells: DataFrame, s: Settings) -> DataFrame:
    """Persons, events, odds ratios and p-values of every model, and q-values by definition."""
    start = (s.reporting_start.year, s.reporting_start.month)
    own = cells.groupBy("objective_id", "indicator_id").applyInPandas(lambda c: refit(c, start), REFIT)  # a group: countries times months
    key = ["objective_id", "indicator_id", "model"]
    both = results.join(own, key, "left").fillna(0, ["n", "e"])
    fitted = both.filter("note = ''")
    tests = results.filter("model = 'within_country' and p_value is not null").select(F.col("p_value").alias("_p"))
    lower = tests.groupBy("_p").agg(F.count("*").alias("_n"))
    ranks = lower.alias("a").join(lower.alias("b"), F.col("b._p") <= F.col("a._p")).groupBy(F.col("a._p").alias("_p")).agg(F.sum("b._n").alias("_rank"))  # objectives times signals, squared
    ratio = ranks.join(tests.agg(F.count("*").alias("_m")), F.lit(True)).select("_p", (F.col("_p") * F.col("_m") / F.col("_rank")).alias("_x"))
    q = fitted.filter("model = 'within_country'").join(ratio, F.col("_p") >= F.col("p_value")).groupBy(*key).agg(F.any_value("q_value").alias("q_value"), F.least(F.lit(1.0), F.min("_x")).alias("q"))
    out = _compared(both, "model", key, {"persons": ("n_obs", "n"), "events": ("n_events", "e")})
    out = out.unionByName(_compared(fitted, "model", key, {"odds ratio": ("odds_ratio", "odds"), "p-value": ("p_value", "p")}, 1e-5))
    return out.unionByName(_compared(q, "model", key, {"q-value": ("q_value", "q")}, 1e-5))


def checks(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    """All checks of the tables under root, in one table of CHECK."""
    t = {n: laid_out(spark, root, n) for n in ("employees", "external_observations", "objective_measures", "signal_asof", "association_results")}
    parts = [
        cohorts(t["employees"], t["objective_measures"], s), turnover(t["employees"], t["objective_measures"], s), intervals(t["objective_measures"]),
        known(t["external_observations"], t["signal_asof"], s), models(t["association_results"], samples(t["employees"], t["signal_asof"], s), s),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
