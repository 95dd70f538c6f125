"""What was known of the external series at the start of each month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.config import Settings
from quillon.operators.temporal import asof_join


def signal_values(observations: DataFrame, s: Settings) -> DataFrame:
    """Values of the configured signals and releases, with the day from which they can be known."""
    rows = observations.sparkSession.createDataFrame([(x.indicator_id, x.release, x.lag_days) for x in s.signals], "_i string, _r string, lag_days int")
    match = (F.col("indicator_id") == F.col("_i")) & F.col("release_code").eqNullSafe(F.col("_r"))
    out = observations.join(F.broadcast(rows), match)
    return out.select("indicator_id", "country_code", "frequency", "period_start", "period_end", "value", "status", "status_label", F.date_add("period_end", F.col("lag_days")).alias("available_from"))


def grid(observations: DataFrame, s: Settings) -> DataFrame:
    """Months times countries times signals, unfolded from the countries: all three are of config size."""
    months = F.sequence(F.lit(s.signal_grid_start or s.reporting_start), F.lit(s.as_of), F.expr("interval 1 month"))
    names = F.array(*[F.lit(x.indicator_id) for x in s.signals]) if s.signals else F.array().cast("array<string>")
    return observations.select("country_code").distinct().select("country_code", F.explode(months).alias("as_of_date")).select("*", F.explode(names).alias("indicator_id"))


def signal_asof(observations: DataFrame, s: Settings) -> DataFrame:
    """The last value known at each month start; a carried value keeps its own period, status and age."""
    found = asof_join(grid(observations, s), signal_values(observations, s), ["indicator_id", "country_code"], "as_of_date", "available_from", [F.col("period_end")])
    return found.select(
        "as_of_date", "country_code", "indicator_id", "value", F.col("frequency").alias("signal_frequency"), F.col("period_start").alias("signal_period_start"),
        F.col("period_end").alias("signal_period_end"), "available_from", F.datediff("as_of_date", "period_end").alias("signal_age_days"),
        F.col("status").alias("signal_status"), F.col("status_label").alias("signal_status_label"),
    )
