"""Aggregates over every combination of two slicing columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL_COUNTRIES, ALL_SEGMENTS, UNASSIGNED = "ALL", "All", "(unassigned)"


def sliced(df: DataFrame, fixed: list[str], aggregates: list[Column]) -> DataFrame:
    """Group by fixed and every subset of country_key and segment_value; totals are named ALL and All.

    Rows of no country count in totals, but are no slice."""
    keys = [*fixed, "country_key", "segment_value"]
    sets = [keys, [*fixed, "country_key"], [*fixed, "segment_value"], [*fixed]]
    out = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys]).agg(*aggregates, F.grouping("country_key").alias("_gc"), F.grouping("segment_value").alias("_gs"))
    out = out.withColumns({
        "country_code": F.when(F.col("_gc") == 1, ALL_COUNTRIES).otherwise(F.col("country_key")),
        "slice_segment": F.when(F.col("_gs") == 1, ALL_SEGMENTS).otherwise(F.col("segment_value")),
    })
    return out.filter(F.col("country_code") != UNASSIGNED).drop("_gc", "_gs", "country_key", "segment_value").withColumnRenamed("slice_segment", "segment_value")
