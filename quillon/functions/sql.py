"""Functions that SQL texts of a session can call."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quillon.functions.stats import Z

_HALF = f"{Z} * sqrt(k / n * (1 - k / n) / n + {Z * Z} / (4 * n * n))"
_CENTRE = f"k / n + {Z * Z} / (2 * n)"
#: Name to parameters and body; null unless n > 0 and 0 <= k <= n.
FUNCTIONS = {
    "wilson_low": ("k DOUBLE, n DOUBLE", f"CASE WHEN n > 0 AND k BETWEEN 0 AND n THEN ({_CENTRE} - {_HALF}) / (1 + {Z * Z} / n) END"),
    "wilson_high": ("k DOUBLE, n DOUBLE", f"CASE WHEN n > 0 AND k BETWEEN 0 AND n THEN ({_CENTRE} + {_HALF}) / (1 + {Z * Z} / n) END"),
}


def register(spark: SparkSession) -> None:
    """Make the functions known to a session; the optimizer puts their bodies where they are called."""
    for name, (parameters, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS DOUBLE RETURN {body}")
