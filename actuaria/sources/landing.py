"""Landing CSV → bronze parquet.

* discovery (S1/S2/S10): one listing of the landing folder; ``_*``, ``.*`` and
  names that don't end in ``.csv`` are passed over, a missing folder is an error;
* consume-once (S7): the batch job and the stream claim files in one ledger (see
  ``ledger``); with ``archive_dir`` loaded files are moved there after the ledger is written;
* parse (S3/S8): files are grouped by dataset and header line, and every group is
  read with its own header, so columns are bound by name.  Values of declared
  columns are cast by name.  Records with too many or too few fields and values
  that cannot be cast go to the quarantine with the record's text;
* lineage (S4): ``ingested_at`` / ``batch_id`` are stamped as literals;
* write (S6): ``bronze/<dataset>/batch_id=<ds>/source_file=<name>/`` with dynamic
  partition overwrite, the quarantine likewise: loading a file again replaces its
  own rows, a second file of the batch is kept beside the first;
* isolation (S8): a group that fails is loaded file by file, and only the files that
  fail by themselves are reported as failed, with the whole reason;
* summary (S5/S9): per file rows = bronze rows + bad rows, appended to the ledger with the
  schema of the file's bronze rows.  Header-only files are ``empty``, zero-byte files ``failed``;
  both stay unconsumed.

A quoted field may hold line breaks.  All files are split over tasks: those without any quote by Spark's
own reader, those with quotes by ``split_csv``.
"""

from __future__ import annotations

import csv
import datetime as _dt
import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actuaria.sources import files, ledger, split_csv
from actuaria.sources.files import FileInfo

CORRUPT = "_corrupt_record"
FILE = "_file"


def dataset_of(file_name: str) -> str:
    """Dataset family of a landing file: the stem, lower-case, ``.``/``-`` → ``_``,
    with a trailing ``_<yyyymmdd>`` (or ``-<yyyymmdd>``) removed."""
    stem = re.sub(r"\.csv$", "", file_name, flags=re.IGNORECASE)
    stem = re.sub(r"[._-]\d{8}$", "", stem)
    return re.sub(r"[.\-]", "_", stem).lower()


def list_landing(spark: SparkSession, landing_dir: str) -> list[FileInfo]:
    """The candidate CSV files, non-recursive."""
    return [f for f in files.list_files(spark, landing_dir) if f.name.endswith(".csv") and f.name[0] not in "_."]


def header_of(spark: SparkSession, info: FileInfo) -> tuple[str, ...]:
    """The column names of a file's first line; none for a zero-byte file."""
    line = files.first_line(spark, info.path) if info.length else None
    if not line:
        return ()
    return tuple(next(csv.reader([line.removeprefix("﻿")])))


def _read(spark: SparkSession, paths: list[str], header: tuple[str, ...]) -> DataFrame:
    """All columns as text under the given header, the corrupt record and the file's name."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header] + [T.StructField(CORRUPT, T.StringType())])
    quoted = split_csv.with_quotes(spark, paths)
    name = lambda path: path.rsplit("/", 1)[-1]
    broken = {name(unquote(path)) for path in quoted}
    plain = [path for path in paths if name(path) not in broken]
    parts = []
    if plain:
        parts.append(
            spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("escape", '"').csv(plain)
            .select("*", F.col("_metadata.file_name").alias(FILE))
        )
    if quoted:
        parts.append(split_csv.read_csv(spark, [path for path in paths if name(path) in broken], schema, CORRUPT))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _typed(raw: DataFrame, header: tuple[str, ...], declared: T.StructType | None) -> tuple[DataFrame, Column]:
    """The declared columns cast by name (missing ones null), and the condition of a bad row."""
    kinds = {f.name: f.dataType for f in declared.fields} if declared else {}
    name = lambda c: F.col(f"`{c}`")
    bad = name(CORRUPT).isNotNull()
    out = []
    for c in header:
        if c in kinds and kinds[c] != T.StringType():
            cast = F.trim(name(c)).try_cast(kinds[c])
            bad = bad | (F.coalesce(F.trim(name(c)), F.lit("")) != "") & cast.isNull()
            out.append(cast.alias(c))
        else:
            out.append(name(c))
    out += [F.lit(None).cast(k).alias(c) for c, k in kinds.items() if c not in header]
    record = F.coalesce(name(CORRUPT), F.to_csv(F.struct(*[name(c) for c in header])))
    typed = raw.select(*out, name(FILE), bad.alias("_bad"), F.when(bad, record).alias("_record"))
    return typed, F.col("_bad")


def _load(
    spark: SparkSession, group: list[FileInfo], dataset: str, header: tuple[str, ...], root: str, batch_id: str,
    stamp: Column, declared: T.StructType | None,
) -> tuple[dict[str, tuple[int, int]], str]:
    """Write one group's bronze and quarantine partitions; (rows, bad rows) per file, and the schema of the rows.

    Good records go from the parser to bronze.  Only the files that turn out to hold bad ones are parsed once more, into a staging
    table that the quarantine and their tallies read; the tallies of the others are bronze's own.
    """
    lineage = [F.lit(batch_id).alias("batch_id"), F.col(FILE).alias("source_file")]

    def parsed(some: list[FileInfo]) -> tuple[DataFrame, Column]:
        return _typed(_read(spark, [f.path for f in some], header), header, declared)

    def put(df: DataFrame, folder: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(
            "batch_id", "source_file"
        ).parquet(f"{root}/{folder}/{dataset}")

    typed, bad = parsed(group)
    obs = Observation(f"bronze_{dataset}")
    seen = typed.observe(obs, F.collect_set(FILE).alias("files"), F.collect_set(F.when(bad, F.col(FILE))).alias("broken"))
    good = seen.where(~bad).drop("_bad", "_record").withColumn("ingested_at", stamp)
    bronze = good.select("*", *lineage).drop(FILE)
    put(bronze, "bronze")
    broken, counts = set(obs.get["broken"]), {}
    if broken:
        typed, bad = parsed([f for f in group if f.name in broken])
        staging = f"{root}/_staging/{dataset}/batch_id={batch_id}"
        typed.write.mode("overwrite").option("compression", "zstd").parquet(staging)
        staged = spark.read.schema(typed.schema).parquet(staging)
        put(staged.where(bad).select(F.col("_record").alias("record"), *lineage), "quarantine")
        counted = staged.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad"))
        counts = {r[FILE]: (int(r["rows"]), int(r["bad"])) for r in counted.collect()}
    whole = sorted(set(obs.get["files"]) - broken)
    if whole:
        written = spark.read.schema(bronze.schema).parquet(f"{root}/bronze/{dataset}")
        written = written.where((F.col("batch_id") == batch_id) & F.col("source_file").isin(whole))
        counts |= {r["source_file"]: (int(r["count"]), 0) for r in written.groupBy("source_file").count().collect()}
    return counts, good.drop(FILE).schema.json()


def load_files(
    spark: SparkSession, found: list[FileInfo], root: str, batch_id: str, ingested_at: _dt.datetime,
    schemas: Mapping[str, T.StructType] | None = None,
) -> list[tuple]:
    """Load these files into bronze; one row (file .. length, schema) of the ledger for each of them."""
    schemas = dict(schemas or {})
    stamp = F.lit(ingested_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    groups: dict[tuple[str, tuple[str, ...]], list[FileInfo]] = {}
    told: list[tuple] = []

    def tell(f: FileInfo, rows: int, bad: int, status: str, reason: str | None, schema: str | None = None) -> None:
        told.append((f.name, dataset_of(f.name), batch_id, rows, bad, status, reason, f.modified, f.length, schema))

    for f in found:
        try:
            header = header_of(spark, f)
            if not header:
                raise ValueError("no columns: the file has no header line")
            groups.setdefault((dataset_of(f.name), header), []).append(f)
        except Exception as exc:  # per-file isolation (S8)
            tell(f, 0, 0, "failed", str(exc))
    for (dataset, header), group in sorted(groups.items()):

        def load(some: list[FileInfo]) -> None:
            for last in (False, False, True):
                try:
                    counts, schema = _load(spark, some, dataset, header, root, batch_id, stamp, schemas.get(dataset))
                    break
                except Exception as exc:  # executors came or went between two passes: pass again
                    if last or split_csv.SplitsMoved.__name__ not in str(exc):
                        raise
            for f in some:
                rows, bad = counts.get(f.name, (0, 0))
                if rows:
                    tell(f, rows, bad, "loaded", None, schema)
                else:
                    tell(f, rows, bad, "empty", "file contains no data rows")

        try:
            load(group)
        except Exception:
            for f in group:
                try:
                    load([f])
                except Exception as exc:
                    tell(f, 0, 0, "failed", str(exc))
    return told


def consume(
    spark: SparkSession, found: list[FileInfo], root: str, batch_id: str, ingested_at: _dt.datetime, loader: str,
    schemas: Mapping[str, T.StructType] | None = None, lease: int = ledger.LEASE,
) -> DataFrame:
    """Load those of the files that nobody has loaded or is loading; their entries in the ledger."""
    claimed = ledger.claim(spark, root, ledger.fresh(spark, root, found), batch_id, ingested_at, loader, lease)
    left = {f.path for f in ledger.fresh(spark, root, [f for f, _, _ in claimed])}  # loaded by another one meanwhile
    groups: dict[tuple[str, _dt.datetime], list[FileInfo]] = {}
    for f, batch, stamp in claimed:
        if f.path in left:
            groups.setdefault((batch, stamp), []).append(f)
    rows = [r for (batch, stamp), group in sorted(groups.items()) for r in load_files(spark, group, root, batch, stamp, schemas)]
    out = ledger.record(spark, root, rows, loader)
    ledger.release(spark, root, [f for f, _, _ in claimed])
    return out


def ingest(
    spark: SparkSession,
    landing_dir: str,
    root: str,
    batch_id: str,
    ingested_at: _dt.datetime,
    schemas: Mapping[str, T.StructType] | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Load every new landing CSV into bronze; return this run's summary rows."""
    found = list_landing(spark, landing_dir)
    out = consume(spark, found, root, batch_id, ingested_at, f"batch {batch_id}", schemas)
    if archive_dir:
        loaded = {r["file"] for r in out.where("status = 'loaded'").select("file").collect()}
        for f in found:
            if f.name in loaded:
                files.move_into(spark, f.path, archive_dir)
    return out
