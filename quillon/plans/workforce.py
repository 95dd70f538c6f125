"""Lifecycle rows to employees: duplicates, versions, canonical values, quality rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.config import Settings
from quillon.functions.calendar import iso_date
from quillon.operators.rows import Rule, broken, fenced, last_by, rule_counts

COLUMNS = (
    "employee_id", "country_code", "business_unit", "job_family", "career_level", "employment_type",
    "hire_date", "termination_date", "termination_type", "regretted_exit", "source_system", "record_updated_at",
)

#: The catalogue, in the order of reports.
RULES = (
    Rule("WF_EXACT_DUPLICATE", "corrected", "an equal row came before"),
    Rule("WF_ID_SUPERSEDED", "corrected", "a later version of the record counts"),
    Rule("WF_COUNTRY_ALIAS", "corrected", "country was written another way"),
    Rule("WF_COUNTRY_MISSING", "exclude_country", "no country"),
    Rule("WF_COUNTRY_UNKNOWN", "exclude_country", "country isn't known"),
    Rule("WF_CAREER_LEVEL_ALIAS", "corrected", "level was written another way"),
    Rule("WF_CATEGORY_UNKNOWN", "warn", "a category isn't among the allowed"),
    Rule("WF_DATE_UNPARSEABLE", "exclude", "a date isn't one"),
    Rule("WF_HIRE_DATE_MISSING", "exclude", "no hire date"),
    Rule("WF_HIRE_AFTER_AS_OF", "exclude", "hired after the as-of date"),
    Rule("WF_TERMINATION_BEFORE_HIRE", "exclude", "left before hire"),
    Rule("WF_TERMINATION_AFTER_AS_OF", "warn", "leaves after the as-of date: still active"),
    Rule("WF_TERMINATION_TYPE_MISSING", "warn", "left without a type"),
    Rule("WF_TYPE_WITHOUT_DATE", "warn", "a type of leaving without a date"),
    Rule("WF_REGRETTED_UNKNOWN", "warn", "left freely, regret not stated"),
    Rule("WF_REGRETTED_NOT_VOLUNTARY", "warn", "regretted, but didn't leave freely"),
    Rule("WF_EOC_ON_PERMANENT", "warn", "a permanent contract ended by its term"),
    Rule("EX_GEO_UNMAPPED", "error", "a place that maps to no country"),
    Rule("EX_PERIOD_UNPARSEABLE", "error", "a period that can't be read"),
    Rule("EX_GRAIN_DUPLICATE", "error", "two values for one key"),
    Rule("EX_VALUE_MISSING", "warn", "no value"),
    Rule("EX_PERIOD_GAP", "warn", "a period without a value inside a series"),
    Rule("EX_STATUS_FLAGGED", "warn", "the provider flagged the value"),
)


def catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, r.id, r.severity, r.text) for i, r in enumerate(RULES)], "position int, rule_id string, severity string, rule_text string")


def blank_to_null(c: str) -> Column:
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def mapped(c: Column, names: dict[str, str]) -> Column:
    """Look a value up in a small table of the settings; null where it isn't in it."""
    if not names:
        return F.lit(None).cast("string")
    return F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), c)


def firsts(raw: DataFrame) -> DataFrame:
    """Of equal rows the one with the least source_row, counted off in each task before anything is shuffled."""
    return raw.groupBy(*COLUMNS).agg(F.min("source_row").alias("source_row"))


def last_versions(raw: DataFrame) -> DataFrame:
    """The row of each id that counts: the first of its equal rows, with the latest date of a version (compared as text; none
    is earliest) and of those the greatest source_row.

    Both steps are aggregates that tasks begin on their own, so an id or a row that makes up much of the table reaches
    the task that finishes it as one row from every other."""
    return last_by(firsts(raw), ["employee_id"], ["record_updated_at", "source_row"])


def removed(raw: DataFrame) -> DataFrame:
    """(source_row, employee_id, rule_id) of all rows that don't count, and why.

    The numbers of all rows, of firsts and of last versions are laid over each other; the highest step that a number
    stands on says what became of its row."""
    number = lambda df, step: df.select("source_row", "employee_id", F.lit(step).alias("_step"))
    steps = number(raw, 0).unionByName(number(firsts(raw), 1)).unionByName(number(last_versions(raw), 2))
    last = steps.groupBy("source_row", "employee_id").agg(F.max("_step").alias("_step"))
    why = F.when(F.col("_step") == 0, "WF_EXACT_DUPLICATE").when(F.col("_step") == 1, "WF_ID_SUPERSEDED")
    return last.select("source_row", "employee_id", why.alias("rule_id")).filter("rule_id is not null")


def typed(current: DataFrame, s: Settings) -> DataFrame:
    out = current.select(
        "employee_id", "source_row",
        *[blank_to_null(c).alias(c) for c in ("business_unit", "job_family", "employment_type", "termination_type", "source_system")],
        blank_to_null("country_code").alias("country_code_raw"), blank_to_null("career_level").alias("career_level_raw"),
        blank_to_null("hire_date").alias("hire_date_raw"), blank_to_null("termination_date").alias("termination_date_raw"),
        F.lower(blank_to_null("regretted_exit")).alias("regretted_exit_raw"), iso_date(F.col("record_updated_at")).alias("record_updated_at"),
    )
    return out.withColumns({
        "country_code": mapped(F.col("country_code_raw"), s.country_names),
        "career_level": F.coalesce(mapped(F.col("career_level_raw"), s.level_aliases), F.col("career_level_raw")),
        "hire_date": iso_date(F.col("hire_date_raw")),
        "termination_date": iso_date(F.col("termination_date_raw")),
    })


def row_rules(s: Settings) -> list[tuple[str, Column]]:
    """Predicates over typed rows. A missing value breaks a rule only where the rule says so."""
    c, as_of = F.col, F.lit(s.as_of)
    among = lambda name: c(name).isin(list(s.allowed.get(name, ())))
    unknown = [c(n).isNull() | ~among(n) for n in ("business_unit", "career_level", "employment_type")]
    unknown += [c(n).isNotNull() & ~among(n) for n in ("source_system", "termination_type")]
    unknown += [c("regretted_exit_raw").isNotNull() & ~c("regretted_exit_raw").isin("true", "false")]
    any_unknown = unknown[0]
    for u in unknown[1:]:
        any_unknown = any_unknown | u
    return [
        ("WF_COUNTRY_ALIAS", c("country_code") != c("country_code_raw")),
        ("WF_COUNTRY_MISSING", c("country_code_raw").isNull()),
        ("WF_COUNTRY_UNKNOWN", c("country_code_raw").isNotNull() & c("country_code").isNull()),
        ("WF_CAREER_LEVEL_ALIAS", ~c("career_level").eqNullSafe(c("career_level_raw"))),
        ("WF_CATEGORY_UNKNOWN", any_unknown),
        ("WF_DATE_UNPARSEABLE", (c("hire_date_raw").isNotNull() & c("hire_date").isNull()) | (c("termination_date_raw").isNotNull() & c("termination_date").isNull())),
        ("WF_HIRE_DATE_MISSING", c("hire_date_raw").isNull()),
        ("WF_HIRE_AFTER_AS_OF", c("hire_date") > as_of),
        ("WF_TERMINATION_BEFORE_HIRE", c("termination_date") < c("hire_date")),
        ("WF_TERMINATION_AFTER_AS_OF", c("termination_date") > as_of),
        ("WF_TERMINATION_TYPE_MISSING", c("termination_date_raw").isNotNull() & c("termination_type").isNull()),
        ("WF_TYPE_WITHOUT_DATE", c("termination_date_raw").isNull() & c("termination_type").isNotNull()),
        ("WF_REGRETTED_UNKNOWN", (c("termination_type") == "Voluntary") & c("regretted_exit_raw").isNull()),
        ("WF_REGRETTED_NOT_VOLUNTARY", ~c("termination_type").eqNullSafe(F.lit("Voluntary")) & (c("regretted_exit_raw") == "true")),
        ("WF_EOC_ON_PERMANENT", (c("termination_type") == "End of Contract") & (c("employment_type") == "Permanent")),
    ]


@dataclass(frozen=True)
class Workforce:
    employees: DataFrame
    events: DataFrame


def curate(raw: DataFrame, s: Settings) -> Workforce:
    """Employees, one row an id, and the rule hits of all raw rows (source_row, employee_id, rule_id).

    Hits mark the surviving row only; those of removed rows say why they went. The rules of a surviving row are
    found in the same pass that types it, so employees need no join with the hits."""
    rules = row_rules(s)
    rows = typed(last_versions(raw), s)
    hits = rows.select("source_row", "employee_id", F.explode(broken(rules)).alias("rule_id"))
    return Workforce(_employees(rows, rules, s), removed(raw).unionByName(hits))


def _employees(rows: DataFrame, rules: list[tuple[str, Column]], s: Settings) -> DataFrame:
    severity = {r.id: r.severity for r in RULES}
    rows = rows.withColumn("quality_rules", fenced(F.array_sort(broken(rules))))
    has = lambda kind: F.arrays_overlap("quality_rules", F.array(*[F.lit(i) for i, _ in rules if severity[i] in kind]))
    exit_date = F.when(F.col("termination_date") <= F.lit(s.as_of), F.col("termination_date"))
    rows = rows.withColumn("exit_date", exit_date)
    regretted = (
        F.when(F.col("exit_date").isNull() | ~F.col("termination_type").eqNullSafe(F.lit("Voluntary")), "not_applicable")
        .when(F.col("regretted_exit_raw") == "true", "regretted").when(F.col("regretted_exit_raw") == "false", "not_regretted").otherwise("unknown")
    )
    measurable = ~has(("error", "exclude"))
    return rows.select(
        "employee_id", "country_code", "business_unit", "job_family", "career_level", "employment_type", "hire_date", "exit_date",
        F.when(F.col("exit_date").isNotNull(), F.col("termination_type")).alias("exit_type"), regretted.alias("regretted_status"),
        measurable.alias("is_measurable"), (measurable & ~has(("exclude_country",))).alias("in_country_scope"), "quality_rules",
        "country_code_raw", "career_level_raw", "hire_date_raw", "termination_date_raw", F.col("regretted_exit_raw").alias("regretted_exit_raw"),
        "source_system", "record_updated_at", "source_row",
    )


def counts(spark: SparkSession, *events: DataFrame) -> DataFrame:
    """Hits of every rule over all event tables, in the order of the catalogue."""
    every = events[0].select("rule_id")
    for e in events[1:]:
        every = every.unionByName(e.select("rule_id"))
    return rule_counts(catalogue(spark), every).orderBy("position")


def gate_failures(rule_counts_: DataFrame) -> list[str]:
    """Rules of severity error that were hit: a non-empty list stops the run."""
    return [r["rule_id"] for r in rule_counts_.filter("severity = 'error' and hits > 0").orderBy("position").collect()]
