"""Tables that are replaced as a whole, seen by readers before or after, never in between.

``<table>/data/<id>`` holds a version's files and ``<table>/versions/<number>`` its id.  A version is written and checked
first and then published by making the next number's file, which only one can make.  Readers take the highest number.  The last
``keep`` versions stay, for readers that began with an older one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from actuaria.sources import files


def versions(spark: SparkSession, table: str) -> list[tuple[int, str]]:
    """(number, data folder) of the published versions, the newest last."""
    folder = f"{table}/versions"
    found = files.list_files(spark, folder) if files.exists(spark, folder) else []
    told = [(int(f.name), files.read_text(spark, f.path)) for f in found if f.name.isdigit()]
    return [(n, f"{table}/data/{name}") for n, name in sorted(told) if name]  # a file without a name is being made


def current(spark: SparkSession, table: str) -> str | None:
    found = versions(spark, table)
    return found[-1][1] if found else None


def read(spark: SparkSession, table: str) -> DataFrame:
    """The newest version; a table that was never published is an error."""
    folder = current(spark, table)
    if folder is None:
        raise ValueError(f"{table} has no published version")
    return spark.read.parquet(folder)


def publish(
    spark: SparkSession, df: DataFrame, table: str, check: Callable[[DataFrame, int], None] | None = None, keep: int = 3
) -> tuple[int, int]:
    """Write ``df`` as the next version; (number, rows).

    ``check`` gets the written table and the rows that were observed on the way, and raises to keep it back; so does a
    count that differs.  Then the version before stays the newest and the files that were written go.
    """
    name = uuid.uuid4().hex
    folder = f"{table}/data/{name}"
    try:
        obs = Observation("published")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(folder)
        rows = int(obs.get["rows"])
        written = spark.read.parquet(folder)
        if written.count() != rows:
            raise ValueError(f"{written.count()} of {rows} rows were written to {folder}")
        if check:
            check(written, rows)
        number = max([n for n, _ in versions(spark, table)], default=0) + 1
        while not files.create_once(spark, f"{table}/versions/{number:010d}", name):
            number += 1
    except Exception:
        files.delete(spark, folder)
        raise
    for old, path in versions(spark, table)[:-keep]:
        files.delete(spark, f"{table}/versions/{old:010d}")
        files.delete(spark, path)
    return number, rows
