"""The whole run: curate, stop at errors, analyse, write tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon import serving
from quillon.config import Settings
from quillon.plans import association, external, retention, signals, workforce
from quillon.sources.files import csv_file, json_file
from quillon.sources.store import Files


class GateError(RuntimeError):
    """Rules of severity error were hit."""


def saved(df: DataFrame, root: str, name: str) -> DataFrame:
    """A finished table: later steps and readers use what is written. Some are laid out by what requests ask for, a file a folder."""
    by = serving.LAYOUT.get(name, ())
    rows = df.repartition(*by).sortWithinPartitions(*[c for c in ("country_code", "segment_value", "period_start", "as_of_date") if c in df.columns]) if by else df
    rows.write.mode("overwrite").partitionBy(*by).parquet(f"{root}/{name}")
    return serving.laid_out(df.sparkSession, root, name).select(df.columns)


def curate(spark: SparkSession, raw: DataFrame, staged: DataFrame, s: Settings, root: str) -> dict[str, DataFrame]:
    w, x = workforce.curate(raw, s), external.curate(saved(staged, root, "staged_series"), s)
    out = {
        "employees": saved(w.employees, root, "employees"),
        "workforce_events": saved(w.events, root, "workforce_events"),
        "external_observations": saved(x.observations, root, "external_observations"),
        "external_coverage": saved(x.coverage, root, "external_coverage"),
        "external_events": saved(x.events, root, "external_events"),
    }
    out["rule_counts"] = saved(workforce.counts(spark, out["workforce_events"], out["external_events"]), root, "rule_counts")
    return out


def gate(tables: dict[str, DataFrame]) -> None:
    if failed := workforce.gate_failures(tables["rule_counts"]):
        raise GateError(f"rules of severity error were hit: {', '.join(failed)}")


def analyse(spark: SparkSession, s: Settings, root: str) -> dict[str, DataFrame]:
    employees, observations = (spark.read.parquet(f"{root}/{t}") for t in ("employees", "external_observations"))
    emp = retention.scoped(employees, s)
    out = {"objective_measures": saved(retention.objective_measures(employees, s), root, "objective_measures"), "signal_asof": saved(signals.signal_asof(observations, s), root, "signal_asof")}
    cells = saved(association.model_cells(retention.cohort_members(emp, s), retention.person_month_counts(emp, s), out["signal_asof"], s), root, "model_cells")
    out["association_results"] = saved(association.fit_associations(cells, s), root, "association_results")
    out["association_cells"] = saved(association.quarter_cells(cells), root, "association_cells")
    return out


def origin(path: str) -> dict:
    """Name and hash of the lifecycle file, or of a folder's files in order of names; nothing where there is none."""
    files = Files()
    if not files.exists(path):
        return {"workforce_source": path}
    found = [f for f in files.files(path) if f.endswith(".csv")] if files.is_folder(path) else [path]
    return {"workforce_source": path.rstrip("/").rsplit("/", 1)[-1], "workforce_source_sha256": files.sha256(found)}


def counted(tables: dict[str, DataFrame]) -> dict:
    """Rows read (each is an employee or was removed), employees and values."""
    out = {}
    if "employees" in tables:
        n = serving.workforce_counts(tables["employees"]).first()
        removed = tables["workforce_events"].filter("rule_id in ('WF_EXACT_DUPLICATE', 'WF_ID_SUPERSEDED')").count()
        out = {"workforce_rows_read": n["employees"] + removed, "employees": n["employees"], "measurable": n["measurable"], "in_country_scope": n["in_country_scope"], "external_values": tables["external_observations"].count()}
    return out


#: Tables that are reported as CSV, and their order.
REPORTED = {
    "external_coverage": ["indicator_id", "country_code", F.asc_nulls_first, "release_code"],
    "objective_measures": ["objective_id", "variant", "grain", "country_code", F.asc_nulls_last, "segment_value", "period_start"],
    "signal_asof": ["indicator_id", "country_code", "as_of_date"],
    "association_results": ["objective_id", "indicator_id", "model"],
    "association_cells": ["objective_id", "indicator_id", "country_code", "period_start"],
}


def _order(names: list) -> list:
    """Column names; one behind a function is sorted by it."""
    return [names[i - 1](n) if i and callable(names[i - 1]) else n for i, n in enumerate(names) if not callable(n)]


def report(tables: dict[str, DataFrame], s: Settings, reports: str, source: dict | None = None) -> None:
    """What is there of: small tables as CSV, the quality report as JSON and Markdown, yearly rates as Markdown."""
    for name, order in REPORTED.items():
        if name in tables:
            csv_file(tables[name], f"{reports}/{name}.csv", _order(order))
    if "rule_counts" in tables:
        rules = serving.rows(tables["rule_counts"].orderBy("position"))
        facts = (source or {}) | counted(tables)
        listed = [{"rule_id": r["rule_id"], "domain": "workforce" if r["rule_id"].startswith("WF_") else "external", "severity": r["severity"], "description": r["rule_text"], "rows_affected": r["hits"]} for r in rules]
        json_file(f"{reports}/quality_report.json", facts | {"rules": listed})
        lines = ["# Data quality", "", *[f"* {k.replace('_', ' ')}: {v}" for k, v in facts.items()], "", "| rule | severity | hits | meaning |", "|---|---|---|---|"]
        lines += [f"| {r['rule_id']} | {r['severity']} | {r['hits']} | {r['rule_text']} |" for r in rules]
        Files().write(f"{reports}/quality_report.md", ("\n".join(lines) + "\n").encode())
    if "objective_measures" in tables:
        lines = ["# Yearly rates", "", "| objective | year | rate | target | status | confidence |", "|---|---|---|---|---|---|"]
        lines += [f"| {r['objective_id']} | {r['year']} | {r['rate']} | {r['target']} | {r['status']} | {r['confidence'] or ''} |" for r in serving.headlines(tables["objective_measures"]).collect()]
        lines += ["", "# Definitions", "", *[f"* {d['objective_id']}: {d['definition']}; goal: {d['goal']}" for d in serving.definitions(s)]]
        Files().write(f"{reports}/analysis_summary.md", ("\n".join(lines) + "\n").encode())


def run(spark: SparkSession, raw: DataFrame, staged: DataFrame, s: Settings, root: str, reports: str) -> dict[str, DataFrame]:
    """Curate and analyse; nothing is analysed when the gate fails, but the report is written."""
    tables = curate(spark, raw, staged, s, root)
    report(tables, s, reports)
    gate(tables)
    more = analyse(spark, s, root)
    report(more, s, reports)
    return tables | more
