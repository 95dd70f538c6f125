"""Command line. Exit codes: 0 done, 1 a gate or step failed, 2 wrong use or settings."""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial

from quillon import __version__, http_api, pipeline, serving, verify
from quillon.config import ConfigError, Settings, standard
from quillon.plans import profile
from quillon.runtime import LEVELS, Runtime, runtime
from quillon.session import session
from quillon.shared import Scratch
from quillon.sources import ingest as ingestion
from quillon.sources import settings as files
from quillon.sources.contract import CurateError, Indicator
from quillon.sources.files import SnapshotStore, csv_file, lifecycle_csv
from quillon.sources.http import fetch
from quillon.sources.store import Files

log = logging.getLogger("quillon")
STEPS = {
    "ingest": "fetch or replay the series",
    "curate": "lifecycle rows and series to checked tables",
    "analyse": "checked tables to measures and models",
    "run": "ingest, curate and analyse",
    "profile": "what the lifecycle rows look like before rules are applied",
    "verify": "work finished tables out again by other means; exit code 1 if any number differs",
    "health": "whether all tables are built",
    "serve": "answer questions over HTTP",
    "version": "the version",
}


#: What every log record has; anything else came with the call as a field.
_OWN = {*logging.makeLogRecord({}).__dict__, "message", "asctime", "taskName"}


def fields(record: logging.LogRecord) -> dict:
    """The fields given with a record, but for empty ones."""
    return {k: v for k, v in record.__dict__.items() if k not in _OWN and v is not None}


class TextLines(logging.Formatter):
    """One line a record: level, logger, message, and its fields as name=value."""

    def format(self, record: logging.LogRecord) -> str:
        return " ".join([super().format(record), *[f"{k}={v}" for k, v in fields(record).items()]])


class JsonLines(logging.Formatter):
    """One object a record: time, level, logger and message, its fields, and what was raised."""

    def format(self, record: logging.LogRecord) -> str:
        at = datetime.fromtimestamp(record.created, timezone.utc).isoformat(timespec="milliseconds")
        raised = {"raised": self.formatException(record.exc_info)} if record.exc_info else {}
        return json.dumps({"time": at, "level": record.levelname, "logger": record.name, "message": record.getMessage()} | raised | {k: v for k, v in fields(record).items() if k not in ("time", "level", "logger")}, default=str)


def logs(as_json: bool, level: str = "INFO") -> None:
    handler = logging.StreamHandler()
    handler.setFormatter(JsonLines() if as_json else TextLines("%(levelname)s %(name)s %(message)s"))
    logging.basicConfig(level=level, handlers=[handler], force=True)
    logging.getLogger("py4j").setLevel(logging.WARNING)


def parser(r: Runtime) -> argparse.ArgumentParser:
    """The options; what isn't given is as the environment says."""
    p = argparse.ArgumentParser(prog="quillon", description=__doc__)
    p.add_argument("step", choices=STEPS, help="; ".join(f"{k}: {v}" for k, v in STEPS.items()))
    p.add_argument("--config", default=r.config, help="folder of settings files (default: the standard settings)")
    p.add_argument("--lifecycle", help="CSV file or folder of lifecycle rows (default: what the settings name)")
    p.add_argument("--snapshots", default=r.folder("snapshots"), help="folder of stored payloads")
    p.add_argument("--tables", default=r.folder("tables"), help="folder of finished tables")
    p.add_argument("--reports", default=r.folder("reports"), help="folder of reports")
    p.add_argument("--only", action="append", metavar="INDICATOR", help="ingest this series alone; may be repeated")
    p.add_argument("--live", action="store_true", help="fetch instead of replaying snapshots")
    p.add_argument("--host", default="127.0.0.1")
    p.add_argument("--port", type=int, default=8000)
    p.add_argument("--json-logs", action="store_true")
    p.add_argument("--log-level", choices=LEVELS, default=r.log_level)
    return p


@dataclass(frozen=True)
class Job:
    args: argparse.Namespace
    settings: Settings
    indicators: tuple[Indicator, ...]
    lifecycle: str | None
    sources: dict
    runtime: Runtime = Runtime()

    def chosen(self) -> tuple[Indicator, ...]:
        only = self.args.only or [i.id for i in self.indicators]
        if odd := set(only) - {i.id for i in self.indicators}:
            raise ConfigError(f"no indicator {', '.join(sorted(odd))}")
        return tuple(i for i in self.indicators if i.id in only)


def job(a: argparse.Namespace, r: Runtime) -> Job:
    """The arguments with the settings that they name."""
    if a.config:
        d = files.load(a.config)
        out = Job(a, d.settings, d.indicators, a.lifecycle or d.lifecycle, ingestion.sources(d.base_urls), r)
    else:
        out = Job(a, standard(), ingestion.STANDARD, a.lifecycle, ingestion.sources({}), r)
    if a.step in ("curate", "profile", "run") and not out.lifecycle:
        raise ConfigError("--lifecycle is needed")
    out.chosen()
    return out


def ingested(spark, j: Job) -> bool:
    """Whether all series could be read; each run leaves a manifest of its own."""
    get = partial(fetch, tries=j.runtime.http_tries, timeout=j.runtime.http_timeout)
    outcomes = ingestion.ingest(spark, SnapshotStore(j.args.snapshots), j.chosen(), j.args.live, get, j.sources)
    run_id = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    ingestion.manifest(f"{j.args.reports}/runs/{run_id}.json", run_id, outcomes)
    for o in outcomes:
        if not o.ok:
            log.error("%s could not be read: %s", o.indicator_id, o.error, extra={"indicator": o.indicator_id})
    return all(o.ok for o in outcomes)


def curated(spark, j: Job) -> dict:
    """Tables of the rows and series at hand; the gate stops after the report is written."""
    staged, missing = ingestion.staged(spark, SnapshotStore(j.args.snapshots), j.indicators, j.sources)
    log.info("series missing: %s", missing or "none")
    scratch = Scratch(spark, "lifecycle")
    try:
        tables = pipeline.curate(spark, lifecycle_csv(spark, j.lifecycle, scratch), staged, j.settings, j.args.tables)
    finally:
        scratch.drop()
    pipeline.report(tables, j.settings, j.args.reports, pipeline.origin(j.lifecycle) | {"missing_indicators": missing})
    pipeline.gate(tables)
    return tables


def profiled(spark, j: Job) -> None:
    """What the lifecycle rows look like before rules are applied: two tables and a report."""
    scratch = Scratch(spark, "profile")
    try:
        raw = lifecycle_csv(spark, j.lifecycle, scratch)
        checked, detailed = scratch.put(profile.profile(raw, j.settings)), scratch.put(profile.details(raw))
        csv_file(checked, f"{j.args.reports}/profile_checks.csv", ["position"])
        csv_file(detailed, f"{j.args.reports}/profile_details.csv", ["part", "field", "value"])
        Files(spark).write(f"{j.args.reports}/data_profile.md", profile.report(checked, detailed, j.settings).encode())
    finally:
        scratch.drop()


def verified(spark, j: Job) -> bool:
    """Whether all checks agree; they are left as a CSV report."""
    if missing := serving.missing_tables(spark, j.args.tables):
        raise CurateError(f"not built: {', '.join(missing)}")
    found = pipeline.saved(verify.checks(spark, j.args.tables, j.settings), j.args.tables, "verification")
    csv_file(found, f"{j.args.reports}/verification.csv", ["check", "of"])
    wrong = found.filter("not agrees")
    for r in wrong.orderBy("check", "of").limit(20).collect():
        log.error("%s of %s: %s, but %s by other means", r["check"], r["of"], r["pipeline"], r["independent"])
    n, bad = found.count(), wrong.count()
    log.info("%s of %s checks agree", n - bad, n)
    return not bad


def done(spark, j: Job) -> bool:
    a, good = j.args, True
    if a.step == "health":
        state = serving.health(spark, a.tables)
        print(json.dumps(state))
        return state["status"] == "ok"
    if a.step == "verify":
        return verified(spark, j)
    if a.step == "profile":
        profiled(spark, j)
    if a.step == "serve":
        with http_api.server(serving.Service(spark, a.tables, j.settings), a.host, a.port) as s:
            log.info("listening on %s:%s", *s.server_address)
            s.serve_forever()
    if a.step in ("ingest", "run"):
        good = ingested(spark, j)
    tables = curated(spark, j) if a.step in ("curate", "run") else {}
    if a.step in ("analyse", "run"):
        pipeline.report(tables | pipeline.analyse(spark, j.settings, a.tables), j.settings, a.reports)
    return good


def main(args: list[str] | None = None) -> int:
    try:
        r = runtime(os.environ)
        a = parser(r).parse_args(args)
    except SystemExit as e:
        return int(e.code or 0)
    except ConfigError as e:
        log.error("%s", e)
        return 2
    logs(a.json_logs, a.log_level)
    if a.step == "version":
        print(__version__)
        return 0
    try:
        j = job(a, r)
    except ConfigError as e:
        log.error("%s", e)
        return 2
    try:
        return int(not done(session(), j))
    except (pipeline.GateError, CurateError) as e:
        log.error("%s", e)
        return 1
    except KeyboardInterrupt:
        return 0


if __name__ == "__main__":
    sys.exit(main())
