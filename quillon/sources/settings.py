"""Settings from a folder of YAML, TOML or JSON files and the objectives' CSV, instead of the standard ones."""

from __future__ import annotations

import csv
import json
import tomllib
from dataclasses import dataclass
from datetime import date
from pathlib import Path

from quillon.config import ConfigError, Objective, Settings, Signal
from quillon.sources.contract import Indicator

# Names of the files, their keys and the kinds of measures, as deployments write them.
ANALYSIS, COUNTRIES, WORKFORCE, SOURCES = "analysis", "countries", "workforce", "sources"
MEASURES = {"cohort_retention": "cohort", "trailing_regretted_turnover": "turnover"}
GRID_START = date(2020, 1, 1)


@dataclass(frozen=True)
class Deployment:
    """What a folder of settings fixes: the engine's settings, the series to read, and where the lifecycle file lies."""

    settings: Settings
    indicators: tuple[Indicator, ...]
    lifecycle: str | None
    base_urls: dict[str, str]


def read_any(folder: Path, name: str) -> dict:
    """The one file of this name, whatever its format."""
    for suffix, load in ((".toml", tomllib.loads), (".json", json.loads), (".yaml", _yaml), (".yml", _yaml)):
        path = folder / f"{name}{suffix}"
        if path.exists():
            try:
                found = load(path.read_text(encoding="utf-8"))
            except ValueError as e:
                raise ConfigError(f"{path.name}: {e}") from e
            if not isinstance(found, dict):
                raise ConfigError(f"{path.name}: no keys")
            return found
    raise ConfigError(f"no file {name} in {folder}")


def _yaml(text: str):
    try:
        import yaml
    except ImportError as e:
        raise ConfigError("YAML settings need the yaml package; TOML and JSON don't") from e
    try:
        return yaml.safe_load(text)
    except yaml.YAMLError as e:
        raise ValueError(str(e)) from e


def _taken(table: dict, where: str, *keys: str, also: tuple[str, ...] = ()) -> list:
    """The values of keys that must be there; a key that nothing reads is an error, not a silent default."""
    if missing := [k for k in keys if k not in table]:
        raise ConfigError(f"{where}: no {', '.join(missing)}")
    if odd := sorted(set(table) - set(keys) - set(also)):
        raise ConfigError(f"{where}: unknown {', '.join(odd)}")
    return [table[k] for k in keys]


def _day(text, where: str) -> date:
    try:
        return text if isinstance(text, date) else date.fromisoformat(text if len(text) > 7 else f"{text}-01")
    except (TypeError, ValueError) as e:
        raise ConfigError(f"{where}: {text!r} is no date") from e


def targets(path: Path) -> dict[str, dict]:
    """Direction, target and last day of every objective in the file."""
    if not path.exists():
        raise ConfigError(f"no file {path}")
    found: dict[str, dict] = {}
    with open(path, newline="", encoding="utf-8") as f:
        for n, row in enumerate(csv.DictReader(f), 2):
            where = f"{path.name}:{n}"
            key, unit = row.get("objective_id") or "", row.get("unit")
            first, last = row.get("effective_from") or None, row.get("effective_to") or None
            if not key or key in found:
                raise ConfigError(f"{where}: objective {key!r} is missing or repeats")
            if unit != "proportion":
                raise ConfigError(f"{where}: unit {unit}")
            if first and last and _day(last, where) < _day(first, where):
                raise ConfigError(f"{where}: ends before it begins")
            try:
                target = float(row.get("target_value") or "")
            except ValueError as e:
                raise ConfigError(f"{where}: target {row.get('target_value')!r}") from e
            found[key] = {"direction": row.get("direction"), "target": target, "until": _day(last, where) if last else None}
    return found


def objectives(table: dict, known: dict[str, dict]) -> tuple[Objective, ...]:
    """The configured objectives, in order of ids, with the targets of the file; both must name the same."""
    if set(table) != set(known):
        raise ConfigError(f"objectives in only one place: {', '.join(sorted(set(table) ^ set(known)))}")
    out = []
    for key in sorted(table):
        measure, months = _taken(table[key], key, "measure", "months", also=("levels", "sensitivity_levels"))
        if measure not in MEASURES:
            raise ConfigError(f"{key}: unknown measure {measure}")
        levels = {k: tuple(table[key][k]) if table[key].get(k) else None for k in ("levels", "sensitivity_levels")}
        out.append(Objective(id=key, measure=MEASURES[measure], months=int(months), direction=known[key]["direction"], target=known[key]["target"], **levels))
    return tuple(out)


def load(folder: str, root: str | None = None) -> Deployment:
    """Read and check all four files. Paths inside them are relative to root (default: the folder's parent)."""
    at = Path(folder)
    base = Path(root) if root else at.parent
    analysis, workforce, sources = read_any(at, ANALYSIS), read_any(at, WORKFORCE), read_any(at, SOURCES)
    (countries,) = _taken(read_any(at, COUNTRIES), COUNTRIES, "countries")
    file, start, least, goals, segment, signals = _taken(analysis, ANALYSIS, "objectives_file", "reporting_start", "min_sample", "objectives", "segment", "signals")
    as_of, allowed = _taken(workforce, WORKFORCE, "as_of_date", "allowed", also=("source_file", "career_level_aliases"))
    providers, history, series = _taken(sources, SOURCES, "providers", "history_start", "indicators")
    known = targets(base / file)
    last = [x["until"] for x in known.values() if x["until"]]
    spelled = {}
    for c in countries:
        for alias in c.get("aliases") or ():
            if spelled.setdefault(alias, c["code"]) != c["code"]:
                raise ConfigError(f"{COUNTRIES}: {alias} stands for two countries")
    indicators, described = [], {}
    for x in series:
        name, provider, dataset, lens, title, frequency, unit, filters = _taken(x, f"{SOURCES}: {x.get('id')}", "id", "provider", "dataset", "lens", "title", "frequency", "unit", "filters")
        if provider not in providers:
            raise ConfigError(f"{name}: unknown provider {provider}")
        if name in described:
            raise ConfigError(f"{name}: indicator repeats")
        released = any(s["indicator"] == name and s.get("release") for s in signals)
        geos = tuple(c[provider] for c in countries if c.get(provider))
        indicators.append(Indicator(name, provider, dataset, frequency, geos, {k: str(v) for k, v in filters.items()}, "release" if released else None, str(history)))
        described[name] = (lens, title, unit, frequency)
    if odd := [s["indicator"] for s in signals if s["indicator"] not in described]:
        raise ConfigError(f"{ANALYSIS}: signals of no indicator: {', '.join(odd)}")
    now = _day(as_of, WORKFORCE)
    settings = Settings(
        as_of=now, reporting_start=_day(start, ANALYSIS), objectives=objectives(goals, known), signals=tuple(Signal(s["indicator"], int(s["lag_days"]), s.get("release")) for s in signals),
        effective_to=min(last) if last else now, min_sample=int(least), signal_grid_start=GRID_START, segment=segment, countries=tuple(sorted(c["code"] for c in countries)), country_aliases=spelled,
        level_aliases=dict(workforce.get("career_level_aliases") or {}), allowed={k: tuple(v) for k, v in allowed.items()},
        geo_map={(p, c[p]): c["code"] for p in providers for c in countries if c.get(p)}, indicators=described,
    )
    return Deployment(settings, tuple(indicators), str(base / workforce["source_file"]) if workforce.get("source_file") else None, {p: x["base_url"] for p, x in providers.items()})
