"""Silver tables by name in the session catalog (S16, S17, S21, P-11, P-13).

Tables are made with ``saveAsTable`` under a folder of the lake, appended to by name, and evolve: new columns by ALTER TABLE
ADD COLUMNS, and a column whose type has to grow by writing the table anew beside the old files and then setting
its location, so that readers see one or the other.  Spark's built-in catalog is enough.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actuaria.sources import files, silver, types


def quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def table_name(dataset: str) -> str:
    """``stg_<dataset>``; anything but letters, digits, _ is an error."""
    if not dataset or not all(c.isalnum() or c == "_" for c in dataset):
        raise ValueError(f"invalid table name: {dataset}")
    return f"stg_{dataset}".lower()


def exists(spark: SparkSession, database: str, table: str) -> bool:
    """Whether the catalog has the table (P-13)."""
    return spark.catalog.tableExists(f"{quoted(database)}.{quoted(table)}")


def tables(spark: SparkSession, database: str, prefix: str = "stg_") -> list[str]:
    """The database's tables whose names begin with ``prefix`` (S21, P-11)."""
    if not spark.catalog.databaseExists(database):
        return []
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary and t.name.startswith(prefix.lower()))


def columns(spark: SparkSession, database: str, table: str) -> T.StructType:
    return spark.table(f"{quoted(database)}.{quoted(table)}").schema


def load(spark: SparkSession, root: str, database: str, dataset: str, df: DataFrame) -> dict[str, list[tuple[str, str]]]:
    """Create the table of a dataset, or evolve it and append ``df`` by name; what was added and widened.

    Column names are sanitised.  Columns are matched whatever their case; those that ``df`` lacks become null.
    """
    df = silver.sanitize(df)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    name, full = table_name(dataset), f"{quoted(database)}.{quoted(table_name(dataset))}"
    if not exists(spark, database, name):
        df.write.format("parquet").option("path", f"{root}/catalog/{name}/{uuid.uuid4().hex}").saveAsTable(full)
        return {"added": [], "widened": []}
    have = columns(spark, database, name)
    whole = types.unify([have, df.schema])
    added, wide = silver.added_columns(have, df.schema), types.widened(have, whole)
    new = [f for f in whole.fields if f.name.lower() not in {c.lower() for c in have.names}]
    if new:
        spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({', '.join(f'{quoted(f.name)} {f.dataType.simpleString()}' for f in new)})")
        # A column that is added stands behind the others.
        have = columns(spark, database, name)
    if wide:
        rewrite(spark, root, database, name, types.unify([have, df.schema]))
    order = columns(spark, database, name)
    types.conform(df, order, []).write.insertInto(full)
    return {"added": added, "widened": wide}


def rewrite(spark: SparkSession, root: str, database: str, name: str, schema: T.StructType) -> None:
    """The table's rows in ``schema`` at a new place, which then becomes the table's.

    The files at the old place stay for readers that began there; ``sweep`` takes them away.
    """
    full = f"{quoted(database)}.{quoted(name)}"
    place = f"{root}/catalog/{name}/{uuid.uuid4().hex}"
    types.conform(spark.table(full), schema, []).write.parquet(place)
    spark.sql(f"DROP TABLE {full}")  # an external table: its files stay
    spark.catalog.createTable(f"{quoted(database)}.{quoted(name)}", path=place, source="parquet", schema=schema)


def sweep(spark: SparkSession, root: str, database: str) -> int:
    """Take away the files of places that no table has any more; run it when no reader is left.  Returns their number."""
    gone = 0
    for name in files.list_folders(spark, f"{root}/catalog"):
        kept = set()
        if exists(spark, database, name):
            told = spark.sql(f"DESCRIBE FORMATTED {quoted(database)}.{quoted(name)}").filter("col_name = 'Location'").first()
            kept = {told["data_type"].rstrip("/").rsplit("/", 1)[-1]}
        for place in files.list_folders(spark, f"{root}/catalog/{name}"):
            if place not in kept:
                files.delete(spark, f"{root}/catalog/{name}/{place}")
                gone += 1
    return gone


def load_batches(spark: SparkSession, root: str, database: str, datasets: Iterable[str], batch_id: str) -> DataFrame:
    """S20 by table name: append one bronze batch of every dataset; one row per dataset, failures told and passed over."""
    report = []
    for dataset in datasets:
        try:
            df = silver.read_bronze(spark, root, dataset, [batch_id])
            done = load(spark, root, database, dataset, df)
            text = {k: ", ".join(f"{c} {t}" for c, t in v) for k, v in done.items()}
            report.append((dataset, df.count(), "loaded", None, text["added"], text["widened"]))
        except Exception as exc:
            report.append((dataset, 0, "failed", str(exc), "", ""))
    return spark.createDataFrame(report, silver.LOAD_SCHEMA)


def latest(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Role → the newest batch of its table, by the names in the catalog."""
    found = silver.resolve_roles(tables(spark, database))
    return {role: silver.latest_batch(spark.table(f"{quoted(database)}.{quoted(t)}")) for role, t in found.items()}


def batch_counts(spark: SparkSession, database: str, table: str) -> DataFrame:
    """(batch_id, rows) of a table by name."""
    return spark.table(f"{quoted(database)}.{quoted(table)}").groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
