"""Bronze → silver (S12-S24), with schema evolution and a latest-batch view.

* Column names are sanitised (``.``/``-`` → ``_``: ``GEO.id2`` → ``GEO_id2``);
  a collision (``a-b`` beside ``a.b``, case-insensitively) is an error.
* Silver reads what bronze holds of a batch, all of its files.
* Each bronze batch is written to ``silver/<dataset>/batch_id=<b>/generation=<schema>/``;
  re-running a batch replaces it instead of appending duplicates (the reference
  appends every file on every run; ``mode="append"`` reproduces that when duplicates are wanted).
* Schema evolution (S17): a batch may add columns and change types.  A ledger names
  the schema of every batch; all batches of one schema are read with it, without looking
  into footers, and cast upwards to the types that hold them all (``types.wider``).  Older batches
  read new columns as NULL.  A ``contract`` keeps columns at its types: rows whose
  values don't cast to them go to ``quarantine_silver``.
* Lineage: bronze ``ingested_at``/``batch_id`` are kept and ``loaded_at`` is
  added; ``restamp=True`` overwrites ``ingested_at`` like the reference.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actuaria.sources import files, ledger, types

REQUIRED_ROLES = ("premiums", "territory", "dp03", "dp05")


def sanitize(df: DataFrame) -> DataFrame:
    new = [re.sub(r"[.\-]", "_", c) for c in df.columns]
    lowered = [c.lower() for c in new]
    dupes = sorted({c for c in lowered if lowered.count(c) > 1})
    if dupes:
        raise ValueError(f"column names collide after sanitising: {dupes}")
    return df.select(*[F.col(f"`{old}`").alias(n) for old, n in zip(df.columns, new)])


def by_generation(spark: SparkSession, base: str, generations: list[tuple[T.StructType, list[Column]]], keys: list[str]) -> DataFrame:
    """One table of parts with schemas of their own: every part is read with its schema and cast to the types that hold all.

    ``generations``: schemas and the conditions on the partition columns ``keys`` (text) that hold where they are used.
    """
    whole = types.unify([schema for schema, _ in generations])
    table = None
    for schema, where in generations:
        full = T.StructType([*schema.fields, *[T.StructField(k, T.StringType()) for k in keys]])
        some = where[0]
        for condition in where[1:]:
            some = some | condition
        part = types.conform(spark.read.schema(full).parquet(base).where(some), whole, keys)
        table = part if table is None else table.unionByName(part)
    return table


def _bronze(spark: SparkSession, root: str, dataset: str, batch_ids: Iterable[str] | None = None) -> tuple[DataFrame, set[str]]:
    """The rows of ``read_bronze``, and the batches that they are of."""
    last = Window.partitionBy("batch_id", "file").orderBy(F.desc("at"))
    told = ledger.entries(spark, root).filter((F.col("dataset") == dataset) & (F.col("status") == "loaded"))
    if batch_ids is not None:
        told = told.filter(F.col("batch_id").isin(list(batch_ids)))
    told = told.withColumn("__n", F.row_number().over(last)).filter("__n = 1")
    rows = (
        told.groupBy("schema", "batch_id").agg(F.collect_list("file").alias("files"))
        .groupBy("schema").agg(F.collect_list(F.struct("batch_id", "files")).alias("batches"), F.min("batch_id").alias("first"))
        .orderBy("first", "schema").collect()
    )
    if not rows:
        raise ValueError(f"bronze holds nothing of {dataset}")
    generations = [
        (T.StructType.fromJson(json.loads(r["schema"])),
         [(F.col("batch_id") == b["batch_id"]) & F.col("source_file").isin(b["files"]) for b in sorted(r["batches"])])
        for r in rows
    ]
    table = by_generation(spark, f"{root}/bronze/{dataset}", generations, ["batch_id", "source_file"]).drop("source_file")
    return table, {b["batch_id"] for r in rows for b in r["batches"]}


def read_bronze(spark: SparkSession, root: str, dataset: str, batch_ids: Iterable[str] | None = None) -> DataFrame:
    """Bronze rows of all batches, or of the named ones, with ``batch_id``; files are as the ledger describes them."""
    return _bronze(spark, root, dataset, batch_ids)[0]


SCHEMA_LOG = "dataset string, batch_id string, generation string, schema string, rows long, appended boolean, at timestamp_ntz"


def _schema_log(root: str) -> str:
    return f"{root}/ops/silver_schemas"


def generations(spark: SparkSession, root: str, dataset: str) -> list[tuple[str, T.StructType, list[str]]]:
    """(generation, schema, batches) of a silver table, by first batch: what the schema ledger says last of every batch."""
    if not files.exists(spark, _schema_log(root)):
        return []
    told = spark.read.schema(SCHEMA_LOG).parquet(_schema_log(root)).filter(F.col("dataset") == dataset)
    replaced = F.max(F.when(~F.col("appended"), F.col("at"))).over(Window.partitionBy("batch_id"))
    told = told.withColumn("__from", replaced).filter("__from IS NULL OR at >= __from")
    rows = told.groupBy("generation", "schema").agg(F.array_sort(F.collect_set("batch_id")).alias("batches")).collect()
    found = [(r["generation"], T.StructType.fromJson(json.loads(r["schema"])), r["batches"]) for r in rows]
    return sorted(found, key=lambda g: (g[2][0], g[0]))


def load_silver(
    spark: SparkSession,
    root: str,
    dataset: str,
    loaded_at: _dt.datetime,
    batch_ids: Iterable[str] | None = None,
    restamp: bool = False,
    mode: str = "overwrite",
    contract: T.StructType | None = None,
) -> int:
    """Load bronze batches of ``dataset`` into silver; returns rows written."""
    df, batches = _bronze(spark, root, dataset, None if batch_ids is None else list(batch_ids))
    return write_silver(spark, root, dataset, sanitize(df), loaded_at, restamp, mode, contract, batches.pop() if len(batches) == 1 else None)


def write_silver(
    spark: SparkSession, root: str, dataset: str, df: DataFrame, loaded_at: _dt.datetime, restamp: bool = False,
    mode: str = "overwrite", contract: T.StructType | None = None, batch: str | None = None,
) -> int:
    """Write batches (``batch_id``) of a silver table in the schema of ``df`` and tell the schema ledger; returns rows written.

    The rows come first and the ledger last, so a load that is lost in between leaves what was read before.  ``batch`` names the
    batch of all rows where they are of one: Spark sorts rows by the columns of the written table's partitions, but not by literals.
    """
    stamp = F.lit(loaded_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    df = df.withColumn("loaded_at", stamp)
    if restamp or "ingested_at" not in df.columns:
        df = df.withColumn("ingested_at", stamp)
    if contract:
        df = types.hold_to(df, contract)
    fields = [f for f in df.schema.fields if f.name not in ("batch_id", "__record")]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields]).json()
    generation = hashlib.sha256(schema.encode()).hexdigest()[:16]
    good = (df.where("__record IS NULL") if contract else df).select(*[f.name for f in fields], "batch_id")
    folders = {"generation": F.lit(generation)} | ({} if batch is None else {"batch_id": F.lit(batch)})
    obs = Observation(f"silver_{dataset}")
    (
        good.observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set("batch_id").alias("batches")).withColumns(folders)
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy("batch_id", "generation").parquet(f"{root}/silver/{dataset}")
    )
    if contract:
        held = df.where("__record IS NOT NULL").select(F.col("__record").alias("record"), "batch_id")
        held.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/quarantine_silver/{dataset}")
    at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    told = [(dataset, b, generation, schema, int(obs.get["rows"]), mode == "append", at) for b in sorted(obs.get["batches"])]
    if told:
        spark.createDataFrame(told, SCHEMA_LOG).coalesce(1).write.mode("append").parquet(_schema_log(root))
        for _, b, *_ in told if mode != "append" else ():
            for other in files.list_folders(spark, f"{root}/silver/{dataset}/batch_id={b}"):
                if other != f"generation={generation}":
                    files.delete(spark, f"{root}/silver/{dataset}/batch_id={b}/{other}")
    return int(obs.get["rows"])


#: What an added column is called in the load report.
SQL_TYPES: dict[type[T.DataType], str] = {
    T.ByteType: "INTEGER", T.ShortType: "INTEGER", T.IntegerType: "INTEGER", T.LongType: "BIGINT",
    T.FloatType: "NUMERIC", T.DoubleType: "NUMERIC", T.DecimalType: "NUMERIC",
    T.DateType: "TIMESTAMP", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP",
    T.BooleanType: "BOOLEAN",
}


def added_columns(before: T.StructType, after: T.StructType) -> list[tuple[str, str]]:
    """Columns ``after`` adds to ``before`` (case-insensitive), with their SQL type (else TEXT)."""
    have = {c.lower() for c in before.names}
    return [(f.name, SQL_TYPES.get(type(f.dataType), "TEXT")) for f in after.fields if f.name.lower() not in have]


LOAD_SCHEMA = "dataset string, rows bigint, status string, reason string, added string, widened string"


def load_all(spark: SparkSession, root: str, datasets: Iterable[str], loaded_at: _dt.datetime,
             batch_ids: Iterable[str] | None = None) -> DataFrame:
    """Load several datasets; one failing dataset is reported, the rest load.

    ``added`` names the columns that the load added to an existing silver table, ``widened`` those whose type it
    changed.  The report is appended to ``ops/load_log`` as well.
    """
    report = []
    ids = list(batch_ids) if batch_ids is not None else None
    for ds in datasets:
        try:
            before = table_schema(spark, root, ds)
            rows = load_silver(spark, root, ds, loaded_at, ids)
            after = table_schema(spark, root, ds)
            new = added_columns(before, after) if before else []
            wide = types.widened(before, after) if before else []
            report.append((ds, rows, "loaded", None, ", ".join(f"{c} {t}" for c, t in new), ", ".join(f"{c} {t}" for c, t in wide)))
        except Exception as exc:  # per-table isolation
            report.append((ds, 0, "failed", str(exc), "", ""))
    out = spark.createDataFrame(report, LOAD_SCHEMA)
    out.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(f"{root}/ops/load_log")
    return out


def silver_tables(spark: SparkSession, root: str) -> list[str]:
    """The names of the silver tables, ``stg_<dataset>``."""
    return [f"stg_{name}" for name in files.list_folders(spark, f"{root}/silver")]


def has_table(spark: SparkSession, root: str, table: str) -> bool:
    """P-13: whether a silver table exists."""
    return table in silver_tables(spark, root)


def table_schema(spark: SparkSession, root: str, dataset: str) -> T.StructType | None:
    """The columns of a silver table over all of its batches; None if there are none."""
    found = generations(spark, root, dataset)
    return types.unify([schema for _, schema, _ in found]) if found else None


def read_silver(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """The evolved silver table: all batches, in the types that hold them all."""
    found = generations(spark, root, dataset)
    if not found:
        raise ValueError(f"silver holds nothing of {dataset}")
    parts = [(schema, [(F.col("generation") == g) & F.col("batch_id").isin(batches)]) for g, schema, batches in found]
    return by_generation(spark, f"{root}/silver/{dataset}", parts, ["batch_id", "generation"]).drop("generation")


def latest_batch(df: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Rows of the newest batch only.

    The newest batch is a scalar subquery.  Where the table is partitioned by the
    batch, it reads no data column, and the filter prunes the other partitions.
    """
    return df.where(F.col(batch_col) == df.agg(F.max(batch_col)).scalar())


def resolve_roles(tables: Iterable[str]) -> dict[str, str]:
    """S21/S22 catalog step: newest table per role by name, newest first.

    ``tables`` are names like ``stg_<dataset>``; a role matches when its word
    occurs in the name (case-insensitive).  Fewer than four tables or a
    missing role is an error listing what was found.
    """
    names = sorted((t for t in tables if t.lower().startswith("stg_")), reverse=True)
    if not names:
        raise ValueError("no silver tables found")
    for t in names:
        if not all(c.isalnum() or c in "_-" for c in t):
            raise ValueError(f"invalid table name: {t}")
    found = {role: [t for t in names if role in t.lower()] for role in REQUIRED_ROLES}
    plain = [t for t in found["premiums"] if "cgr" not in t.lower()]
    found["premiums"] = plain or found["premiums"]
    if len(names) < len(REQUIRED_ROLES) or not all(found.values()):
        raise ValueError("missing required tables: " + ", ".join(f"{r}={len(v)}" for r, v in found.items()))
    return {role: v[0] for role, v in found.items()}
