"""Cohort retention, trailing turnover and the table of measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.config import Settings
from quillon.functions.calendar import month_end_after, trunc_to
from quillon.functions.stats import wilson
from quillon.operators.rows import fenced
from quillon.operators.slices import UNASSIGNED, sliced
from quillon.operators.temporal import monthly_balance, months_at_risk, trailing

GRAINS = ("month", "quarter", "year")


def scoped(employees: DataFrame, s: Settings) -> DataFrame:
    """Measurable employees with country_key (those of no country are unassigned) and segment_value."""
    key = F.when(F.col("in_country_scope"), F.col("country_code")).otherwise(UNASSIGNED)
    return employees.filter("is_measurable").withColumns({"country_key": key, "segment_value": F.col(s.segment)})


def anniversary(months: Column) -> Column:
    return F.add_months("hire_date", months)


def lost(months: Column) -> Column:
    """Whether a person left before so many months were over."""
    return F.coalesce(F.col("exit_date") < anniversary(months), F.lit(False))


def cohort_members(emp: DataFrame, s: Settings) -> DataFrame:
    """One row an eligible hire and objective variant. Leaving on the anniversary is not a loss."""
    spark = emp.sparkSession
    variants = F.broadcast(spark.createDataFrame(s.variants, "objective_id string, variant string, months int, career_level string"))
    hired = emp.filter((F.col("hire_date") >= F.lit(s.reporting_start)) & (F.col("hire_date") <= F.lit(s.effective_to or s.as_of)))
    out = hired.join(variants, "career_level").withColumn("cohort_month", F.trunc("hire_date", "month"))
    return out.select(
        "objective_id", "variant", "employee_id", "country_key", "segment_value", "cohort_month", "hire_date", "exit_date",
        anniversary(F.col("months")).alias("anniversary"), lost(F.col("months")).alias("lost"),
        (F.add_months(F.last_day("cohort_month"), F.col("months")) <= F.lit(s.as_of)).alias("cohort_mature"),
    )


def cohort_monthly(members: DataFrame) -> DataFrame:
    """Retained and hired by month, for every slice: one pass, partly summed before the shuffle."""
    kept = F.sum(F.when(F.col("lost"), 0).otherwise(1)).alias("numerator")
    return sliced(members, ["objective_id", "variant", "cohort_month"], [kept, F.count("*").alias("denominator"), F.bool_and("cohort_mature").alias("all_mature")])


def cohort_measures(monthly: DataFrame, s: Settings) -> DataFrame:
    """Months summed to quarters and years. A period is mature when its last day's hires could have their anniversary."""
    grain = F.explode(F.array(*[F.lit(g) for g in GRAINS])).alias("grain")
    rows = monthly.select("*", grain).withColumn("period_start", trunc_to(F.col("grain"), F.col("cohort_month")))
    by = rows.groupBy("objective_id", "variant", "grain", "period_start", "country_code", "segment_value").agg(F.sum("numerator").alias("numerator"), F.sum("denominator").cast("double").alias("denominator"))
    more = F.when(F.col("grain") == "month", 0).when(F.col("grain") == "quarter", 2).otherwise(11)
    by = by.withColumn("period_end", month_end_after(F.col("period_start"), more))
    months = F.lit(None).cast("int")
    for o in s.objectives:
        months = F.when(F.col("objective_id") == o.id, o.months).otherwise(months)
    return by.withColumn("is_mature", F.add_months("period_end", months) <= F.lit(s.as_of))


def person_months(emp: DataFrame, s: Settings) -> DataFrame:
    """Months in which an employee could leave: those that begin after hire and not after the exit."""
    rows = months_at_risk(emp, "hire_date", "exit_date", F.trunc(F.lit(s.as_of), "month"))
    gone = F.coalesce(F.col("exit_date") <= F.last_day("month_start"), F.lit(False))
    return rows.select(
        "employee_id", "country_key", "segment_value", "month_start", gone.alias("exits_in_month"),
        (gone & (F.col("regretted_status") == "regretted")).alias("regretted_exit"),
        (gone & F.col("regretted_status").isin("regretted", "unknown")).alias("regretted_exit_upper"),
    )


def person_month_counts(emp: DataFrame, s: Settings) -> DataFrame:
    """Persons at risk, exits, regretted and regretted_upper of every month, country and segment with persons at risk:
    the sums of person_months() without a row a person and month."""
    as_of = F.trunc(F.lit(s.as_of), "month")
    first, exit_month = F.add_months(F.trunc("hire_date", "month"), 1), F.trunc("exit_date", "month")
    last = F.least(F.coalesce(exit_month, as_of), as_of)
    state = F.col("regretted_status")
    here = (exit_month <= as_of).cast("int")
    move = lambda m, d, x, r, u: F.struct(m.alias("month_start"), d.alias("at_risk"), x.alias("exits"), r.alias("regretted"), u.alias("regretted_upper"))
    none, one = F.lit(0), F.lit(1)
    gone = F.when(exit_month.isNotNull(), move(exit_month, none, here, here * (state == "regretted").cast("int"), here * state.isin("regretted", "unknown").cast("int")))
    moves = F.array_compact(F.array(move(first, one, none, none, none), move(F.add_months(last, 1), -one, none, none, none), gone))
    key = ["country_key", "segment_value"]
    rows = emp.filter(first <= last).select(*key, F.explode(moves).alias("m")).select(*key, "m.*")
    return monthly_balance(rows, key, "month_start", "at_risk", ["exits", "regretted", "regretted_upper"], as_of).filter("at_risk > 0")


def _moves() -> Column:
    """A person's hire and exit as changes of the head count, by month; an exit that is open has no month."""
    state = F.col("regretted_status")
    move = lambda m, d, r, u: F.struct(F.trunc(m, "month").alias("m"), d.alias("headcount"), r.alias("regretted"), u.alias("regretted_upper"))
    none, one = F.lit(0), F.lit(1)
    return F.array(move("hire_date", one, none, none), move("exit_date", -one, (state == "regretted").cast("int"), state.isin("regretted", "unknown").cast("int")))


def headcount(emp: DataFrame, s: Settings) -> DataFrame:
    """headcount, regretted and regretted_upper of every month end, country and segment; zeros included.

    Hires add and exits take away. A null segment has rows of zeros only: it equals no segment."""
    return headcount_of(emp.select("country_key", "segment_value", F.explode(_moves()).alias("x")).select("country_key", "segment_value", "x.*"), s)


def headcount_of(moves: DataFrame, s: Settings) -> DataFrame:
    key, counts = ["country_key", "segment_value"], ["headcount", "regretted", "regretted_upper"]
    out = monthly_balance(moves.filter("m is not null"), key, "m", counts[0], counts[1:], F.trunc(F.lit(s.as_of), "month"), together=True)
    known = F.col("segment_value").isNotNull().cast("int")
    return out.select(F.last_day("m").alias("month_end"), *key, *[(F.col(c) * known).alias(c) for c in counts])


def turnover_monthly(emp: DataFrame, s: Settings, months: int = 12) -> DataFrame:
    return turnover_of(headcount(emp, s), months)


def turnover_of(heads: DataFrame, months: int) -> DataFrame:
    by = sliced(heads, ["month_end"], [F.sum(c).alias(c) for c in ("headcount", "regretted", "regretted_upper")])
    w = trailing(["country_code", "segment_value"], "month_end", months)
    return by.select(
        "month_end", "country_code", "segment_value", F.sum("regretted").over(w).alias("regretted_ttm"), F.sum("regretted_upper").over(w).alias("regretted_upper_ttm"),
        F.avg("headcount").over(w).alias("avg_headcount_ttm"), F.count("*").over(w).alias("months_in_window"),
    )


def turnover_measures(monthly: DataFrame, objective_id: str, s: Settings, months: int = 12) -> DataFrame:
    rows = monthly.filter((F.col("months_in_window") == months) & (F.col("month_end") >= F.lit(s.reporting_start)))
    rows = rows.select("*", F.explode(F.array(F.struct(F.lit("main").alias("variant"), F.col("regretted_ttm").alias("numerator")), F.struct(F.lit("upper_bound_unknown").alias("variant"), F.col("regretted_upper_ttm").alias("numerator")))).alias("v"))
    rows = rows.select("*", F.explode(F.array(*[F.lit(g) for g in GRAINS])).alias("grain"))
    m = F.month("month_end")
    rows = rows.filter((F.col("grain") == "month") | ((F.col("grain") == "quarter") & (m % 3 == 0)) | ((F.col("grain") == "year") & (m == 12)))
    return rows.select(
        F.lit(objective_id).alias("objective_id"), "v.variant", "grain", trunc_to(F.col("grain"), F.col("month_end")).alias("period_start"), F.col("month_end").alias("period_end"),
        "country_code", "segment_value", "v.numerator", F.col("avg_headcount_ttm").alias("denominator"), F.lit(True).alias("is_mature"),
    )


def judged(measures: DataFrame, s: Settings) -> DataFrame:
    """Rate, interval, status and confidence of every measure."""
    spark = measures.sparkSession
    goals = F.broadcast(spark.createDataFrame([(o.id, o.target, o.direction) for o in s.objectives], "objective_id string, target double, direction string"))
    m = measures.join(goals, "objective_id")
    k, n, mature = F.col("numerator").cast("double"), F.col("denominator"), F.col("is_mature")
    low, high, rate = wilson(k, n, False), wilson(k, n, True), F.when(n > 0, k / n)
    met = F.when(F.col("direction") == "at_least", rate >= F.col("target")).otherwise(rate <= F.col("target"))
    status = F.when(~mature, "pending").when(n < s.min_sample, "insufficient_sample").when(met, "met").otherwise("not_met")
    clear = F.coalesce(low > F.col("target"), F.lit(False)) | F.coalesce(high < F.col("target"), F.lit(False))
    confidence = F.when(~mature | (n < s.min_sample), F.lit(None)).when(clear, "clear").otherwise("within_uncertainty")
    return m.select(
        "objective_id", "variant", "grain", "period_start", "period_end", "country_code", "segment_value", "numerator", "denominator",
        F.when(mature, rate).alias("rate"), F.when(mature, low).alias("ci_low"), F.when(mature, high).alias("ci_high"),
        "target", "direction", status.alias("status"), confidence.alias("confidence"),
    )


def facts(emp: DataFrame, s: Settings) -> DataFrame:
    """All that measures need of persons, in one pass and one sum: a row for each cohort month and for each month's
    moves, by country and segment, packed in one column.

    Two plans read it; as it is packed, both read all of it, so that they share one exchange."""
    variant = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(v).alias("v"), F.lit(n).alias("n"), F.lit(level).alias("level")) for o, v, n, level in s.variants])
    hired = F.col("hire_date").between(F.lit(s.reporting_start), F.lit(s.effective_to or s.as_of))
    none = F.lit(None).cast("string")
    row = lambda o, v, m, a, b, c: F.struct(o.alias("o"), v.alias("v"), m.alias("m"), a.alias("a"), b.alias("b"), c.alias("c"))
    kept = lambda x: F.when(lost(x["n"]), 0).otherwise(1)
    members = F.transform(F.filter(variant, lambda x: hired & (x["level"] == F.col("career_level"))), lambda x: row(x["o"], x["v"], F.trunc("hire_date", "month"), kept(x), F.lit(1), F.lit(0)))
    moves = F.transform(_moves(), lambda x: row(none, none, x["m"], x["headcount"], x["regretted"], x["regretted_upper"]))
    key = ["o", "v", "m", "country_key", "segment_value"]
    rows = emp.select("country_key", "segment_value", F.explode(F.concat(members, moves) if s.variants else moves).alias("x")).select("country_key", "segment_value", "x.*")
    by = rows.filter("m is not null").groupBy(*key).agg(*[F.sum(c).alias(c) for c in "abc"])
    return by.select(fenced(F.struct(*by.columns)).alias("f")).repartition("f")


def objective_measures(employees: DataFrame, s: Settings) -> DataFrame:
    """All objectives in one table."""
    cols = ["objective_id", "variant", "grain", "period_start", "period_end", "country_code", "segment_value", "numerator", "denominator", "is_mature"]
    every = facts(scoped(employees, s), s)
    members = every.filter("f.o is not null").select(F.col("f.o").alias("objective_id"), F.col("f.v").alias("variant"), F.col("f.m").alias("cohort_month"), "f.country_key", "f.segment_value", "f.a", "f.b")
    cohorts = sliced(members, ["objective_id", "variant", "cohort_month"], [F.sum("a").alias("numerator"), F.sum("b").alias("denominator")])
    moves = every.filter("f.o is null").select("f.country_key", "f.segment_value", "f.m", F.col("f.a").alias("headcount"), F.col("f.b").alias("regretted"), F.col("f.c").alias("regretted_upper"))
    out = cohort_measures(cohorts, s).select(*cols)
    heads = headcount_of(moves, s)
    for o in s.objectives:
        if o.measure == "turnover":
            out = out.unionByName(turnover_measures(turnover_of(heads, o.months), o.id, s, o.months).select(*cols))
    return judged(out, s)
