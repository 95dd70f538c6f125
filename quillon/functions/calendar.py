"""Dates as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"


def iso_date(text: Column) -> Column:
    """A date from ISO text; null for anything else, years and months alone included."""
    return F.when(text.rlike(_ISO), text.try_cast("date"))


def month_end_after(start: Column, months: int | Column) -> Column:
    """Last day of the month that lies months after start."""
    return F.last_day(F.add_months(start, months))


def trunc_to(grain: Column, d: Column) -> Column:
    return F.when(grain == "month", F.trunc(d, "month")).when(grain == "quarter", F.trunc(d, "quarter")).otherwise(F.trunc(d, "year"))


def period_start(frequency: Column, period: Column) -> Column:
    """First day of a period written YYYY-MM, YYYY-Qn or YYYY; null where it isn't."""
    month = F.when(period.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(period, F.lit("-01")), "yyyy-MM-dd"))
    quarter = F.when(period.rlike(r"^\d{4}-Q[1-4]$"), F.make_date(F.left(period, F.lit(4)).cast("int"), F.right(period, F.lit(1)).cast("int") * 3 - 2, F.lit(1)))
    year = F.when(period.rlike(r"^\d{4}$"), F.make_date(F.when(period.rlike(r"^\d{4}$"), period).cast("int"), F.lit(1), F.lit(1)))
    return F.when(frequency == "M", month).when(frequency == "Q", quarter).when(frequency == "A", year)


def period_months(frequency: Column) -> Column:
    return F.when(frequency == "M", 1).when(frequency == "Q", 3).when(frequency == "A", 12)
