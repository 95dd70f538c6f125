"""Stored payloads as a source of Spark: a partition for each series and place, checked where it is read.

    spark.dataSource.register(Snapshots)
    spark.read.format("quillon_series").option("indicators", listed(indicators)).load(folder)

The folder may be in any file system that pyarrow opens by its address. A payload that isn't sealed by its sidecar, or not what its
provider promises, ends the read, unless the option missing is skip."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quillon.plans.external import SCHEMA
from quillon.sources import jsonstat, worldbank
from quillon.sources.contract import Indicator, SourceContractError

#: How a provider's payload is taken apart into Series.
DECODERS = {"eurostat": jsonstat.series, "worldbank": worldbank.series}


def listed(indicators: tuple[Indicator, ...]) -> str:
    """Indicators as the text of an option."""
    return json.dumps([asdict(i) for i in indicators])


@dataclass
class Part(InputPartition):
    """A series with one of its places; without one, all that weren't asked for."""

    indicator: int
    place: str | None


class Snapshots(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quillon_series"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.skip = options["path"], options.get("missing", "fail") == "skip"
        self.indicators = [Indicator(**i | {"geos": tuple(i["geos"])}) for i in json.loads(options["indicators"])]

    def partitions(self) -> list[Part]:
        return [Part(n, place) for n, i in enumerate(self.indicators) for place in (*i.geos, None)]

    def sealed(self, i: Indicator) -> tuple[bytes, dict]:
        """A payload and its sidecar."""
        store, at = fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)
        body, side = (store.open_input_stream(f"{at}/{i.provider}/{i.id}.{kind}").read() for kind in ("json", "meta.json"))
        meta = json.loads(side)
        if hashlib.sha256(body).hexdigest() != meta["sha256"]:
            raise SourceContractError(f"{i.id}: the checksum of the snapshot differs")
        return body, meta

    def read(self, part: Part) -> Iterator[tuple]:
        i = self.indicators[part.indicator]
        try:
            body, meta = self.sealed(i)
            series = DECODERS[i.provider](body, i)
        except (SourceContractError, OSError, ValueError, KeyError):
            if self.skip:
                return
            raise
        for geo, period, value, status, dims in series.rows:
            if geo == part.place or part.place is None and geo not in i.geos:
                release = dims.get(i.release_dimension) if i.release_dimension else None
                yield (i.id, i.provider, i.dataset, i.frequency, geo, period, release, value, status, series.labels.get(status), series.updated, meta["fetched_at"], meta["sha256"])
