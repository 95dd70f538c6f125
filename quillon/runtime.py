"""What the environment of a process says: folders, HTTP limits, logs. Options of the command line go before it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from quillon.config import ConfigError

PREFIX = "QUILLON_"
LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR")


@dataclass(frozen=True)
class Runtime:
    """Each field is read from PREFIX and its name in capitals; an unknown name behind the prefix is an error."""

    config: str | None = None
    data: str = "."
    http_timeout: float = 30.0
    http_tries: int = 4
    log_level: str = "INFO"

    def __post_init__(self):
        if not 0 < self.http_timeout < float("inf"):
            raise ConfigError(f"{PREFIX}HTTP_TIMEOUT: {self.http_timeout} is no time to wait")
        if self.http_tries < 1:
            raise ConfigError(f"{PREFIX}HTTP_TRIES: {self.http_tries} is less than one")
        if self.log_level not in LEVELS:
            raise ConfigError(f"{PREFIX}LOG_LEVEL: {self.log_level} is none of {', '.join(LEVELS)}")

    def folder(self, name: str) -> str:
        """A folder of the data folder, which may be an address."""
        return name if self.data == "." else f"{self.data.rstrip('/')}/{name}"


def runtime(environment: Mapping[str, str]) -> Runtime:
    kinds = {"config": str, "data": str, "http_timeout": float, "http_tries": int, "log_level": str.upper}
    given = {k.removeprefix(PREFIX).lower(): v for k, v in environment.items() if k.startswith(PREFIX) and v}
    if odd := sorted(set(given) - set(kinds)):
        raise ConfigError(f"unknown in the environment: {', '.join(PREFIX + k.upper() for k in odd)}")
    out = {}
    for name, text in given.items():
        try:
            out[name] = kinds[name](text)
        except ValueError as e:
            raise ConfigError(f"{PREFIX}{name.upper()}: {text!r} is no number") from e
    return Runtime(**out)
