"""What every provider's payload is decoded to, and the errors of decoding."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class SourceContractError(ValueError):
    """A payload that isn't what the provider promises."""


class CurateError(ValueError):
    """An input that can't be curated."""


@dataclass(frozen=True)
class Indicator:
    """A series to fetch: filters pin dimensions to one value; geos are the provider's names of places."""

    id: str
    provider: str
    dataset: str
    frequency: str
    geos: tuple[str, ...] = ()
    filters: dict[str, str] = field(default_factory=dict)
    release_dimension: str | None = None
    since: str = "2019"


@dataclass(frozen=True)
class Request:
    url: str
    params: list[tuple[str, str]]


@dataclass(frozen=True)
class Parsed:
    """rows: geo, period, value, status, dimensions (a map of what was not pinned)."""

    rows: DataFrame
    source_updated: str | None
    status_labels: dict[str, str]


@dataclass(frozen=True)
class Series:
    """A payload taken apart by a task of its own: rows of geo, period, value, status and the dimensions that weren't pinned."""

    rows: Iterator[tuple[str, str, float | None, str | None, dict[str, str]]]
    updated: str | None
    labels: dict[str, str]


class Source(Protocol):
    def request(self, indicator: Indicator) -> Request: ...

    def parse(self, spark: SparkSession, payload: bytes, indicator: Indicator) -> Parsed: ...
