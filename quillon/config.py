"""Settings of the engine: what a deployment fixes, checked when it is made."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


class ConfigError(ValueError):
    """A setting that can't hold."""


@dataclass(frozen=True)
class Objective:
    """A target. measure: cohort (retention over months after hire) or turnover (trailing twelve months)."""

    id: str
    measure: str
    direction: str
    target: float
    months: int
    levels: tuple[str, ...] | None = None
    sensitivity_levels: tuple[str, ...] | None = None
    sensitivity_variant: str = "sensitivity_manager"

    def __post_init__(self) -> None:
        if self.measure not in ("cohort", "turnover"):
            raise ConfigError(f"{self.id}: unknown measure {self.measure}")
        if self.direction not in ("at_least", "at_most"):
            raise ConfigError(f"{self.id}: unknown direction {self.direction}")
        if not 0 < self.target < 1:
            raise ConfigError(f"{self.id}: target {self.target} is not between 0 and 1")


@dataclass(frozen=True)
class Signal:
    """An indicator usable from lag_days after the end of its period; release: which one, None where there is one only."""

    indicator_id: str
    lag_days: int
    release: str | None = None

    def __post_init__(self) -> None:
        if self.lag_days < 0:
            raise ConfigError(f"{self.indicator_id}: negative lag")


@dataclass(frozen=True)
class Settings:
    as_of: date
    reporting_start: date
    objectives: tuple[Objective, ...]
    signals: tuple[Signal, ...] = ()
    effective_to: date | None = None
    min_sample: int = 30
    signal_grid_start: date | None = None
    segment: str = "business_unit"
    countries: tuple[str, ...] = ()
    country_aliases: dict[str, str] = field(default_factory=dict)
    level_aliases: dict[str, str] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    #: (provider, geo) to country, and indicator to (lens, title, unit, frequency)
    geo_map: dict[tuple[str, str], str] = field(default_factory=dict)
    indicators: dict[str, tuple[str, str, str, str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        ids = [o.id for o in self.objectives]
        if len(set(ids)) < len(ids):
            raise ConfigError("objective ids repeat")
        if len({s.indicator_id for s in self.signals}) < len(self.signals):
            raise ConfigError("signals repeat")
        levels = self.allowed.get("career_level", ())
        if bad := [v for v in self.level_aliases.values() if v not in levels]:
            raise ConfigError(f"level aliases lead to unknown levels {bad}")
        if self.segment not in ("business_unit", "job_family", "career_level", "employment_type"):
            raise ConfigError(f"unknown segment {self.segment}")
        if bad := [f for *_, f in self.indicators.values() if f not in ("M", "Q", "A")]:
            raise ConfigError(f"unknown frequencies {bad}")

    @property
    def country_names(self) -> dict[str, str]:
        """Every accepted spelling of a country; a country's own code is one."""
        return {c: c for c in self.countries} | self.country_aliases

    @property
    def variants(self) -> list[tuple[str, str, int, str]]:
        """(objective, variant, months, level) of every cohort objective."""
        out = []
        for o in self.objectives:
            if o.measure == "cohort":
                every = o.levels or self.allowed.get("career_level", ())
                out += [(o.id, "main", o.months, v) for v in every]
                out += [(o.id, o.sensitivity_variant, o.months, v) for v in o.sensitivity_levels or ()]
        return out


#: The targets, lags and thresholds of the product whose results are to be matched; fixed values.
STANDARD_OBJECTIVES = (
    Objective("NEW_HIRE_6M", "cohort", "at_least", 0.86, 6),
    Objective("SENIOR_HIRE_12M", "cohort", "at_least", 0.90, 12, ("Senior Leader",), ("Senior Leader", "Manager")),
    Objective("REGRETTED_TURNOVER_12M", "turnover", "at_most", 0.075, 12),
)
STANDARD_SIGNALS = (
    Signal("unemployment_rate", 62),
    Signal("job_vacancy_rate", 90),
    Signal("hicp_inflation_first_release", 25, "FIN"),
    Signal("economic_sentiment", 10),
    Signal("gdp_growth", 200),
)
EUROSTAT_COUNTRIES = {"BG": "BG", "EL": "GR", "IE": "IE", "IT": "IT", "PL": "PL", "RO": "RO"}
WORLD_BANK_COUNTRIES = {"BGR": "BG", "GRC": "GR", "IRL": "IE", "ITA": "IT", "POL": "PL", "ROU": "RO"}


def standard(as_of: date = date(2025, 12, 31), reporting_start: date = date(2021, 1, 1)) -> Settings:
    """Settings with the standard values, for lifecycle files with the twelve standard columns."""
    return Settings(
        as_of=as_of,
        reporting_start=reporting_start,
        objectives=STANDARD_OBJECTIVES,
        signals=STANDARD_SIGNALS,
        effective_to=as_of,
        signal_grid_start=date(2020, 1, 1),
        countries=("BG", "GR", "IE", "IT", "PL", "RO"),
        country_aliases={"EL": "GR", "ROM": "RO"},
        level_aliases={"Sr Mgmt": "Senior Leader"},
        allowed={
            "business_unit": ("Supply Chain", "Sales", "Finance", "Digital"),
            "career_level": ("Individual Contributor", "Manager", "Senior Leader"),
            "employment_type": ("Permanent", "Fixed Term"),
            "source_system": ("HCM_A", "HCM_B"),
            "termination_type": ("Voluntary", "Involuntary", "End of Contract"),
        },
        geo_map={("eurostat", g): c for g, c in EUROSTAT_COUNTRIES.items()} | {("worldbank", g): c for g, c in WORLD_BANK_COUNTRIES.items()},
        indicators={
            "unemployment_rate": ("labour_market", "Unemployment rate", "percent", "M"),
            "job_vacancy_rate": ("labour_market", "Job vacancy rate", "percent", "Q"),
            "hicp_inflation": ("cost_of_living", "Inflation", "percent", "M"),
            "hicp_inflation_first_release": ("cost_of_living", "Inflation as first released", "percent", "M"),
            "economic_sentiment": ("economic_cycle", "Economic sentiment", "index", "M"),
            "gdp_growth": ("economic_cycle", "GDP growth", "percent", "A"),
        },
    )
