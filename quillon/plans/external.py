"""External series: typed periods, rule hits, canonical observations, coverage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.config import Settings
from quillon.functions.calendar import month_end_after, period_months, period_start
from quillon.operators.rows import broken
from quillon.operators.temporal import missing_periods

SCHEMA = (
    "indicator_id string, provider string, dataset string, frequency string, geo string, source_period string, release_code string, "
    "value double, status string, status_label string, source_updated string, fetched_at string, snapshot_sha256 string"
)
KEY = ["indicator_id", "geo", "source_period", "release_code"]


def geo_map(spark: SparkSession, s: Settings) -> DataFrame:
    return spark.createDataFrame([(p, g, c) for (p, g), c in s.geo_map.items()], "provider string, geo string, country_code string")


def indicators(spark: SparkSession, s: Settings) -> DataFrame:
    return spark.createDataFrame([(i, lens, unit) for i, (lens, _, unit, _) in s.indicators.items()], "indicator_id string, lens string, unit string")


def typed(staged: DataFrame, s: Settings) -> DataFrame:
    """Add country_code, period_start, period_months and period_end. The settings' tables are small and broadcast."""
    out = staged.join(F.broadcast(geo_map(staged.sparkSession, s)), ["provider", "geo"], "left")
    f = F.col("frequency")
    out = out.withColumns({"period_start": period_start(f, F.col("source_period")), "period_months": period_months(f)})
    return out.withColumn("period_end", month_end_after(F.col("period_start"), F.col("period_months") - 1))


def ruled(rows: DataFrame) -> DataFrame:
    """Add _rules (of the row), _copy (its number among rows of one key), _copies, _missing (period starts without a
    value that follow the row's) and quality_rules (of all rows with the row's key, sorted).

    One shuffle by series serves all windows, and everything else is read off these rows in one pass each."""
    valued = F.col("value").isNotNull() & F.col("period_start").isNotNull()
    found = [
        ("EX_GEO_UNMAPPED", F.col("country_code").isNull()),
        ("EX_PERIOD_UNPARSEABLE", F.col("period_start").isNull()),
        ("EX_VALUE_MISSING", F.col("value").isNull()),
        ("EX_STATUS_FLAGGED", F.col("value").isNotNull() & F.col("status").isNotNull()),
    ]
    key = Window.partitionBy(*KEY)
    following = F.lead("period_start").over(Window.partitionBy("indicator_id", "geo", "release_code", "_valued").orderBy("period_start"))
    out = rows.repartition("indicator_id", "geo", "release_code").withColumn("_valued", valued)
    out = out.withColumns({"_next": following, "_rules": broken(found), "_copy": F.row_number().over(key.orderBy("value")), "_copies": F.count("*").over(key)})
    missing = F.when(F.col("_valued"), missing_periods(F.col("period_start"), F.col("_next"), F.col("period_months"))).otherwise(F.array().cast("array<date>"))
    every = F.flatten(F.collect_list("_rules").over(key))
    double = F.when(F.col("_copies") > 1, F.array(F.lit("EX_GRAIN_DUPLICATE"))).otherwise(F.array().cast("array<string>"))
    out = out.withColumns({"_missing": missing, "quality_rules": F.array_sort(F.array_distinct(F.concat(every, double)))})
    return out.drop("_valued", "_next")


def rule_events(rows: DataFrame) -> DataFrame:
    """One row a hit of ruled() rows: indicator_id, geo, source_period, release_code, rule_id. A doubled key is one
    hit; a gap is named by the first day of the period that is missing."""
    hit = lambda period, rule: F.struct(period.alias("source_period"), rule.alias("rule_id"))
    own = F.transform("_rules", lambda r: hit(F.col("source_period"), r))
    double = F.when((F.col("_copies") > 1) & (F.col("_copy") == 1), F.array(hit(F.col("source_period"), F.lit("EX_GRAIN_DUPLICATE"))))
    gaps = F.transform("_missing", lambda d: hit(F.date_format(d, "yyyy-MM-dd"), F.lit("EX_PERIOD_GAP")))
    hits = F.flatten(F.array_compact(F.array(own, double, gaps)))
    return rows.select("indicator_id", "geo", "release_code", F.explode(hits).alias("h")).select("indicator_id", "geo", "h.source_period", "release_code", "h.rule_id")


@dataclass(frozen=True)
class External:
    observations: DataFrame
    coverage: DataFrame
    events: DataFrame


def curate(staged: DataFrame, s: Settings) -> External:
    """Canonical values with the rules they hit, and what each series covers; each is one pass over the staged rows."""
    rows = ruled(typed(staged, s))
    good = rows.filter("value is not null and country_code is not null and period_start is not null")
    good = good.join(F.broadcast(indicators(staged.sparkSession, s)), "indicator_id")
    observations = good.select(
        "indicator_id", "lens", "country_code", "frequency", "period_start", "period_end", "value", "unit", "status", "status_label", "release_code", "quality_rules",
        "provider", "dataset", F.col("geo").alias("source_geo"), "source_period", "source_updated", F.col("fetched_at").alias("loaded_at"), "snapshot_sha256",
    )
    return External(observations, coverage(good), rule_events(rows))


def coverage(good: DataFrame) -> DataFrame:
    """One row a series. Gaps are those of all geos of a country, whatever the frequency."""
    key = ["indicator_id", "lens", "country_code", "release_code", "frequency"]
    out = good.groupBy(*key).agg(
        F.min("period_start").alias("first_period_start"), F.max("period_end").alias("last_period_end"), F.count("*").alias("values_present"),
        F.sum(F.size("_missing")).alias("_g"), F.max("source_updated").alias("source_updated"), F.max("fetched_at").alias("loaded_at"),
    )
    places = Window.partitionBy("indicator_id", "country_code", "release_code")
    return out.select(*key, "first_period_start", "last_period_end", "values_present", F.sum("_g").over(places).alias("gaps"), "source_updated", "loaded_at")
