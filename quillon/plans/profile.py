"""What raw lifecycle rows look like before anything is decided about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.config import Settings
from quillon.functions.calendar import iso_date
from quillon.plans.workforce import COLUMNS


def checks(s: Settings) -> dict[str, Column]:
    """Defects of single rows, by name. Blank is empty text; dates that can't be read are none."""
    c, hired, left = F.col, iso_date(F.col("hire_date")), iso_date(F.col("termination_date"))
    blank = lambda name: c(name) == ""
    return {
        "country blank": blank("country_code"),
        "country by an alias": c("country_code").isin([*s.country_aliases]),
        "hire date blank": blank("hire_date"),
        "hired before the reporting start": hired < F.lit(s.reporting_start),
        "hired after the as-of date": hired > F.lit(s.as_of),
        "left before hire": left < hired,
        "left after the as-of date": left > F.lit(s.as_of),
        "left without a type": left.isNotNull() & blank("termination_type"),
        "type without a date of leaving": left.isNull() & ~blank("termination_type"),
        "left freely, regret blank": (c("termination_type") == "Voluntary") & blank("regretted_exit"),
        "regretted, not left freely": c("termination_type").isin("Involuntary", "End of Contract") & (c("regretted_exit") == "true"),
        "permanent contract ended by its term": (c("termination_type") == "End of Contract") & (c("employment_type") == "Permanent"),
        "level by an alias": c("career_level").isin([*s.level_aliases]),
    }


def profile(raw: DataFrame, s: Settings) -> DataFrame:
    """(position, check, n): rows, equal rows, ids, ids with differing rows, then the checks over distinct rows.

    Equal rows are counted, then ids summed, each begun in every task before it is shuffled: no id's rows meet."""
    found = checks(s)
    names = [f"_c{i}" for i in range(len(found))]
    distinct = raw.select(*COLUMNS).groupBy(*COLUMNS).agg(F.count("*").alias("_n"))
    flags = distinct.select("employee_id", "_n", *[F.coalesce(x, F.lit(False)).cast("int").alias(n) for n, x in zip(names, found.values(), strict=True)])
    ids = flags.groupBy("employee_id").agg(F.sum("_n").alias("_rows"), F.count("*").alias("_kinds"), *[F.sum(n).alias(n) for n in names])
    total = lambda x: F.coalesce(F.sum(x), F.lit(0))
    sums = {"rows": total("_rows"), "equal rows": total(F.col("_rows") - F.col("_kinds")), "ids": F.count("*"), "ids with differing rows": F.count_if(F.col("_kinds") > 1)}
    sums |= {name: total(n) for name, n in zip(found, names, strict=True)}
    one = ids.agg(*[x.cast("long").alias(f"_s{i}") for i, x in enumerate(sums.values())])
    listed = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(name).alias("check"), F.col(f"_s{i}").alias("n")) for i, name in enumerate(sums)])
    return one.select(F.explode(listed).alias("x")).select("x.*")


#: Fields whose values a profile counts, dates whose range it gives, and the days from hire to leaving that it tells apart.
FIELDS = ("country_code", "business_unit", "career_level", "employment_type", "termination_type", "regretted_exit", "source_system")
DATES = ("hire_date", "termination_date", "record_updated_at")
BOUNDARY = (175, 190)
#: Values of a field that the report in Markdown lists, the most frequent; the table has all.
LISTED = 50


def details(raw: DataFrame) -> DataFrame:
    """(part, field, value, n) over distinct rows: how often each value of a field stands, the first and the last of each date,
    and how many left on each day around half a year. Dates that can't be read are left out, blanks count as values."""
    distinct = raw.select(*COLUMNS).distinct()
    hired, left = iso_date(F.col("hire_date")), iso_date(F.col("termination_date"))
    entry = lambda part, field, value, held: F.when(held, F.struct(F.lit(part).alias("part"), F.lit(field).alias("field"), value.cast("string").alias("value")))
    days = F.datediff(left, hired)
    facts = [entry("values", c, F.col(c), F.lit(True)) for c in FIELDS] + [entry("boundary", "days", days, days.between(*BOUNDARY))]
    counts = distinct.select(F.explode(F.array_compact(F.array(*facts))).alias("x")).groupBy("x.part", "x.field", "x.value").agg(F.count("*").alias("n"))
    read = {c: iso_date(F.substring(c, 1, 10)) for c in DATES}
    ends = [f(x).alias(f"{name}_{c}") for c, x in read.items() for name, f in (("first", F.min), ("last", F.max))]
    dated = [F.count(x).alias(f"n_{c}") for c, x in read.items()]
    one = raw.select(*COLUMNS).distinct().agg(*ends, *dated)
    ranges = [F.struct(F.lit("range").alias("part"), F.concat(F.lit(f"{name} "), F.lit(c)).alias("field"), F.col(f"{name}_{c}").cast("string").alias("value"), F.col(f"n_{c}").alias("n")) for c in DATES for name in ("first", "last")]
    return counts.unionByName(one.select(F.explode(F.array(*ranges)).alias("x")).select("x.*"))


def report(checked: DataFrame, detailed: DataFrame, s: Settings) -> str:
    """Both tables in Markdown; of fields with many values the most frequent are listed, and how many more there are."""
    cell = lambda v: str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["# Profile of the lifecycle rows", "", f"As of {s.as_of}. Checks are over distinct rows, but for the first three.", "", "| check | n |", "|---|---|"]
    lines += [f"| {r['check']} | {r['n']} |" for r in checked.orderBy("position").collect()]
    rank = F.row_number().over(Window.partitionBy("part", "field").orderBy(F.desc("n"), "value"))
    top = detailed.withColumn("at", rank).withColumn("all", F.count("*").over(Window.partitionBy("part", "field"))).filter(F.col("at") <= LISTED)
    by: dict[tuple[str, str], list] = {}
    for r in top.collect():  # LISTED rows a field at most
        by.setdefault((r["part"], r["field"]), []).append(r)
    lines += ["", "# Ranges", "", *[f"* {c}: {by['range', f'first {c}'][0]['value']} to {by['range', f'last {c}'][0]['value']}" for c in DATES]]
    lines += ["", "# Days from hire to leaving, around half a year", "", "| days | left |", "|---|---|"]
    lines += [f"| {r['value']} | {r['n']} |" for r in sorted(by.get(("boundary", "days"), ()), key=lambda r: int(r["value"]))]
    for c in FIELDS:
        found = by.get(("values", c), [])
        lines += ["", f"# {c}", "", "| value | rows |", "|---|---|", *[f"| {cell(r['value']) or '(blank)'} | {r['n']} |" for r in sorted(found, key=lambda r: r["value"])]]
        if found and (more := found[0]["all"] - len(found)):
            lines.append(f"\n{more} more values are in the table.")
    return "\n".join(lines) + "\n"
