"""Named query catalogue: key → callable(spark, sf_dir) → DataFrame.

Every query reads the gold/silver tables the lake wrote from the source
folder (built once per application), never a fixed or made-up input; those of
``ingest`` send these tables through the ingest jobs first.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actuaria.plans import ingest, monitoring, quality, reporting, stakeholder
from actuaria.plans.store import lake
from actuaria.sources import silver

QueryFn = Callable[[SparkSession, str], DataFrame]


def _bind(fn, table: str, needs_as_of: bool, as_of: _dt.datetime | None) -> QueryFn:
    """Wrap a catalogue function taking a frame (and ``as_of``) into (spark, sf_dir)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lk = lake(spark, sf_dir)
        src = {"current": lk.fact_current, "legacy": lk.fact_legacy, "silver": lk.silver}[table]()
        return fn(src, as_of or lk.as_of) if needs_as_of else fn(src)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def fact_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold fact as built today (inner territory join, census via zip)."""
    return lake(spark, sf_dir).fact_current()


def fact_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The legacy gold fact ('Unknown' territory label, census via geo id)."""
    return lake(spark, sf_dir).fact_legacy()


def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver premium rows of the newest batch only."""
    return silver.latest_batch(lake(spark, sf_dir).silver())


def schema_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per batch, rows and how many carry the column added in schema v2."""
    df = lake(spark, sf_dir).evolving_premiums()
    return df.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count("cgr").alias("cgr_populated"),
        F.count("cgr_factor").alias("cgr_factor_populated"),
    )


def catalogue(as_of: _dt.datetime | None = None) -> dict[str, QueryFn]:
    """All queries; ``as_of`` is the clock of those that need one (default: the data's last day)."""
    out: dict[str, QueryFn] = {}
    for key, fn in reporting.LEGACY.items():
        out[key] = _bind(fn, "legacy", False, as_of)
    for key, fn in reporting.SILVER.items():
        out[key] = _bind(fn, "silver", False, as_of)
    for key, fn in quality.LEGACY.items():
        out[key] = _bind(fn, "legacy", key in quality.NEEDS_AS_OF, as_of)
    for key, fn in quality.SILVER.items():
        out[key] = _bind(fn, "silver", False, as_of)
    for key, fn in monitoring.LEGACY.items():
        out[key] = _bind(fn, "legacy", key in monitoring.NEEDS_AS_OF, as_of)
    for key, fn in stakeholder.QUERIES.items():
        out[key] = _bind(fn, "current", key in stakeholder.NEEDS_AS_OF, as_of)
    out["fact_current"] = fact_current
    out["fact_legacy"] = fact_legacy
    out["latest_batch"] = latest_batch
    out["schema_union"] = schema_union
    out |= ingest.QUERIES
    return out
