"""Fetching or replaying a list of indicators; one that fails doesn't stop the others."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.config import ConfigError
from quillon.plans.external import SCHEMA
from quillon.sources.contract import Indicator, Parsed, Source
from quillon.sources.files import SnapshotMeta, SnapshotStore, digest, json_file
from quillon.sources.http import fetch
from quillon.sources.jsonstat import JsonStat
from quillon.sources.worldbank import WorldBank

ADAPTERS: dict[str, type] = {"eurostat": JsonStat, "worldbank": WorldBank}


def sources(base_urls: dict[str, str]) -> dict[str, Source]:
    """An adapter for every provider, at another address where one is given."""
    if odd := sorted(set(base_urls) - set(ADAPTERS)):
        raise ConfigError(f"no adapter for {', '.join(odd)}")
    return {name: make(*[base_urls[name]] if name in base_urls else ()) for name, make in ADAPTERS.items()}


SOURCES = sources({})
COUNTRIES = ("BG", "EL", "IE", "IT", "PL", "RO")
# The provider's names of the standard indicators.
STANDARD = (
    Indicator("unemployment_rate", "eurostat", "une_rt_m", "M", COUNTRIES, {"age": "TOTAL", "freq": "M", "s_adj": "SA", "sex": "T", "unit": "PC_ACT"}, since="2019-01"),
    Indicator("job_vacancy_rate", "eurostat", "jvs_q_r21", "Q", COUNTRIES, {"freq": "Q", "indic_em": "JVR", "nace_r2_1": "B-T", "s_adj": "NSA", "sizeclas": "TOTAL"}, since="2019-01"),
    Indicator("hicp_inflation", "eurostat", "prc_hicp_minr", "M", COUNTRIES, {"coicop18": "TOTAL", "freq": "M", "unit": "RCH_A"}, since="2019-01"),
    Indicator("hicp_inflation_first_release", "eurostat", "prc_hicp_fpd", "M", COUNTRIES, {"coicop18": "TOTAL", "freq": "M", "unit": "RCH_A"}, "release", "2019-01"),
    Indicator("economic_sentiment", "eurostat", "ei_bssi_m_r2", "M", COUNTRIES, {"freq": "M", "indic": "BS-ESI-I", "s_adj": "SA"}, since="2019-01"),
    Indicator("gdp_growth", "worldbank", "NY.GDP.MKTP.KD.ZG", "A", ("BGR", "GRC", "IRL", "ITA", "POL", "ROU"), since="2019-01"),
)


@dataclass
class Outcome:
    indicator_id: str
    ok: bool
    state: str = ""
    error: str = ""
    coverage: list[dict] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)


def coverage(parsed: Parsed, indicator: Indicator) -> tuple[list[dict], list[str]]:
    """Values by place with first and last period; places that are missing or weren't asked for."""
    by = parsed.rows.filter("value is not null").groupBy("geo").agg(F.count("*").alias("n"), F.min("period").alias("first"), F.max("period").alias("last")).orderBy("geo")
    rows = [r.asDict() for r in by.collect()]
    have, wanted = {r["geo"] for r in rows}, set(indicator.geos)
    warnings = [f"no values for {g}" for g in sorted(wanted - have)] + [f"{g} wasn't asked for" for g in sorted(have - wanted) if wanted]
    return rows, warnings if rows else [*warnings, "no values at all"]


def ingest(spark: SparkSession, store: SnapshotStore, indicators: tuple[Indicator, ...], live: bool = False, get: Callable = fetch, sources: dict[str, Source] = SOURCES) -> list[Outcome]:
    """Live: fetch, check by decoding, store. Replay: read what is stored and decode it."""
    out = []
    for i in indicators:
        try:
            source = sources[i.provider]
            if live:
                request = source.request(i)
                status, payload = get(request)
                parsed = source.parse(spark, payload, i)
                n = parsed.rows.filter("value is not null").count()
                meta = SnapshotMeta(i.provider, i.id, i.dataset, request.url, [list(p) for p in request.params], datetime.now(timezone.utc).isoformat(timespec="seconds"), status, digest(payload), len(payload), parsed.source_updated, n)
                state = store.write(payload, meta)
            else:
                payload, _ = store.read(i.provider, i.id)
                parsed, state = source.parse(spark, payload, i), "replayed"
            rows, warnings = coverage(parsed, i)
            out.append(Outcome(i.id, True, state, "", rows, warnings))
        except Exception as e:  # noqa: BLE001  reported by indicator
            out.append(Outcome(i.id, False, "", f"{type(e).__name__}: {e}"))
    return out


def manifest(path: str, run_id: str, outcomes: list[Outcome]) -> None:
    json_file(path, {"run_id": run_id, "indicators": [asdict(o) for o in outcomes]})


def staged(spark: SparkSession, store: SnapshotStore, indicators: tuple[Indicator, ...], sources: dict[str, Source] = SOURCES) -> tuple[DataFrame, list[str]]:
    """All stored series in the shape that external.curate takes, and the indicators that could not be read."""
    out, missing = spark.createDataFrame([], SCHEMA), []
    names = out.columns
    for i in indicators:
        try:
            payload, meta = store.read(i.provider, i.id)
            parsed = sources[i.provider].parse(spark, payload, i)
        except Exception:  # noqa: BLE001  listed for the report
            missing.append(i.id)
            continue
        labels = parsed.status_labels
        label = F.try_element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]), F.col("status")) if labels else F.lit(None).cast("string")
        release = F.try_element_at("dimensions", F.lit(i.release_dimension)) if i.release_dimension else F.lit(None).cast("string")
        rows = parsed.rows.select(
            F.lit(i.id).alias("indicator_id"), F.lit(i.provider).alias("provider"), F.lit(i.dataset).alias("dataset"), F.lit(i.frequency).alias("frequency"), "geo",
            F.col("period").alias("source_period"), release.alias("release_code"), "value", "status", label.alias("status_label"), F.lit(parsed.source_updated).cast("string").alias("source_updated"),
            F.lit(meta.fetched_at).alias("fetched_at"), F.lit(meta.sha256).alias("snapshot_sha256"),
        )
        out = out.unionByName(rows.select(names))
    return out, missing
