"""Report mart and flat export.

The reference renders each query as a dashboard panel or pipes ``psql``
output to a dated log file.  Here a run publishes every selected catalogue
result to ``<out>/<report>/run_date=<d>/`` as parquet (dynamic partition
overwrite: re-running a day replaces that day only), and the BI export
writes the flat fact extract as CSV or parquet.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def publish(spark: SparkSession, sf_dir: str, out_dir: str, run_date: _dt.date,
            keys: Iterable[str] | None = None) -> dict[str, str]:
    """Write each report's rows under its own folder; returns key → path.

    The reports are computed as of noon of ``run_date``.
    """
    from actuaria.plans.catalogue import catalogue

    cat = catalogue(_dt.datetime.combine(run_date, _dt.time(12)))
    written: dict[str, str] = {}
    for key in keys or cat:
        path = f"{out_dir.rstrip('/')}/{key}"
        (
            cat[key](spark, sf_dir)
            .withColumn("run_date", F.lit(run_date))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_date").parquet(path)
        )
        written[key] = path
    return written


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Flat export for BI tools (header row for CSV); overwrites ``path``."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
