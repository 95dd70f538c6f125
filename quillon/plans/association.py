"""Associations between outcomes and signals, over cells instead of persons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.config import Settings
from quillon.functions.stats import Z_EXACT, benjamini_hochberg, six_digits, two_sided
from quillon.operators.logit import grouped_logit
from quillon.operators.slices import UNASSIGNED
from quillon.shared import Scratch

# Columns of the results in their order, models, outcomes and notes, as readers of the table know them.
RESULT = (
    "objective_id string, indicator_id string, model string, outcome string, n_obs long, n_events long, n_clusters long, "
    "signal_sd_within double, odds_ratio double, ci_low double, ci_high double, p_value double, q_value double, note string"
)
NAIVE, WITHIN = "naive", "within_country"
OUTCOMES = {"cohort": "exit within {} months of hire", "turnover": "regretted exit in the month (per person-month at risk)"}
NO_EVENTS, NO_VARIATION, FAILED = "no events", "no within-country variation", "model failed: %s: %s"


def model_cells(members: DataFrame, month_counts: DataFrame, asof: DataFrame, s: Settings) -> DataFrame:
    """(objective, indicator, country, month): persons, events and the signal's value.

    Persons are summed before the signal is joined, so what is joined has a row a country and month."""
    hires = members.filter((F.col("variant") == "main") & F.col("cohort_mature") & (F.col("country_key") != UNASSIGNED))
    by = hires.groupBy("objective_id", F.col("country_key").alias("country_code"), F.col("cohort_month").alias("as_of_date")).agg(F.count("*").alias("n"), F.count_if("lost").alias("events"))
    for o in s.objectives:
        if o.measure == "turnover":
            at_risk = month_counts.filter((F.col("month_start") >= F.lit(s.reporting_start)) & (F.col("country_key") != UNASSIGNED))
            more = at_risk.groupBy(F.lit(o.id).alias("objective_id"), F.col("country_key").alias("country_code"), F.col("month_start").alias("as_of_date")).agg(F.sum("at_risk").alias("n"), F.sum("regretted").alias("events"))
            by = by.unionByName(more)
    known = asof.select("indicator_id", "country_code", "as_of_date", "value")
    return by.join(known, ["country_code", "as_of_date"]).select("objective_id", "indicator_id", "country_code", "as_of_date", "n", "events", "value")


def quarter_cells(cells: DataFrame) -> DataFrame:
    """Country and quarter: persons, events, the persons' mean signal and event rate."""
    rows = cells.filter("value is not null").withColumn("period_start", F.trunc("as_of_date", "quarter"))
    by = rows.groupBy("objective_id", "indicator_id", "country_code", "period_start").agg(F.sum("n").alias("n"), F.sum("events").alias("events"), F.sum(F.col("n") * F.col("value")).alias("_s"))
    return by.select("objective_id", "indicator_id", "country_code", "period_start", "n", "events", F.round(F.col("_s") / F.col("n"), 6).alias("signal_mean"), F.round(F.col("events") / F.col("n"), 6).alias("event_rate"))


PAIR = ["objective_id", "indicator_id"]


def pairs(cells: DataFrame, s: Settings) -> DataFrame:
    """A row for each objective and signal: persons, events and cells with a value, the signal's spread, and a note where
    nothing can be fitted.

    The spread is the sample deviation from countries' means, over cells."""
    known = F.col("value").isNotNull()
    by = cells.groupBy(*PAIR, "country_code").agg(F.sum(F.when(known, F.col("n"))).alias("n"), F.sum(F.when(known, F.col("events"))).alias("events"), F.count("value").alias("cells"), (F.var_pop("value") * F.count("value")).alias("off"))
    out = by.groupBy(*PAIR).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_obs"), F.coalesce(F.sum("events"), F.lit(0)).alias("n_events"), F.sum("cells").alias("cells"), F.sum("off").alias("off"))
    unit = F.when(F.col("cells") > 2, F.sqrt(F.col("off") / (F.col("cells") - 1)))
    usable = (unit > 0) & ~F.isnan(unit) & (unit < float("inf"))  # null is no spread
    texts = [F.lit(x) for o in s.objectives for x in (o.id, OUTCOMES[o.measure].format(o.months))]
    outcome = F.coalesce(F.element_at(F.create_map(*texts), F.col("objective_id")), F.lit("")) if texts else F.lit("")
    note = F.when(F.col("n_events") == 0, NO_EVENTS).when(~F.coalesce(usable, F.lit(False)), NO_VARIATION)
    return out.select(*PAIR, outcome.alias("outcome"), "n_obs", "n_events", "cells", unit.alias("unit"), note.alias("unfit"))


def designs(cells: DataFrame, of: DataFrame, s: Settings) -> DataFrame:
    """The cells of both models: naive has one group and no trend; within countries each has its own level, and all a trend
    by month. The signal is in units of its spread."""
    rows = cells.filter("value is not null").join(of.filter("unfit is null").select(*PAIR, "unit"), PAIR)
    month = 12 * F.year("as_of_date") + F.month("as_of_date") - (12 * s.reporting_start.year + s.reporting_start.month)
    models = [(NAIVE, F.lit(""), F.lit(0)), (WITHIN, F.col("country_code"), month)]
    each = F.array(*[F.struct(F.lit(m).alias("model"), g.alias("level"), t.alias("trend")) for m, g, t in models])
    return rows.select(*PAIR, "n", "events", (F.col("value") / F.col("unit")).alias("signal"), F.explode(each).alias("d")).select(*PAIR, "n", "events", "signal", "d.*")


def fit_associations(cells: DataFrame, s: Settings) -> DataFrame:
    """Odds ratios for every objective and signal: naive, and within countries with a trend.

    All models are fitted together in rounds of grouped sums; nothing of a model reaches the driver. What can't be
    fitted has nulls and a note. q-values are over the within-country tests."""
    scratch = Scratch(cells.sparkSession, "association")
    rows = scratch.put(cells.select(*PAIR, "country_code", "as_of_date", "n", "events", "value"))
    of = scratch.put(pairs(rows, s))
    fits = grouped_logit(designs(rows, of, s), [*PAIR, "model"], "level", "signal", "trend", "n", "events", scratch)
    error = F.sqrt("variance")
    tests = fits.select(
        *PAIR, "model", six_digits(F.exp("slope")).alias("odds_ratio"), six_digits(F.exp(F.col("slope") - Z_EXACT * error)).alias("ci_low"),
        six_digits(F.exp(F.col("slope") + Z_EXACT * error)).alias("ci_high"), six_digits(two_sided(F.col("slope") / error)).alias("p_value"), F.col("note").alias("_failed"),
    )
    tests = scratch.put(tests)
    ranked = benjamini_hochberg(tests.filter(F.col("model") == WITHIN).select(*PAIR, "model", "p_value")).drop("p_value")
    both = of.select("*", F.explode(F.array(F.lit(NAIVE), F.lit(WITHIN))).alias("model"))
    out = both.join(tests, [*PAIR, "model"], "left").join(ranked, [*PAIR, "model"], "left")
    fitted = F.col("unfit").isNull()
    failed = F.when(F.col("_failed") != "", F.format_string(FAILED, F.lit("ModelFailed"), F.col("_failed")))
    out = out.withColumns({
        "n_clusters": F.when(fitted, F.col("cells")).otherwise(0), "signal_sd_within": F.when(fitted, six_digits(F.col("unit"))),
        "q_value": six_digits(F.col("q_value")), "note": F.coalesce("unfit", failed, F.lit("")),
    })
    result = Scratch(cells.sparkSession, "associations").put(out.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(RESULT).fields]))
    scratch.drop()
    return result
