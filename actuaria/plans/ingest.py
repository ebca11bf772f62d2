"""Queries over the ingest features: split CSV, both ways in, type changes, tables by name, late rows, sketches.

Each one first puts the given tables into the form that the feature takes in (CSV files, batches, rows in a folder) and then
runs the library's own ingest on all of them, in a fresh folder of the shared folder.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actuaria.constants import AS_OF
from actuaria.plans import gold, sketches
from actuaria.plans.store import kept, lake
from actuaria.session import shared_dir
from actuaria.sources import binding, catalog, declared, files, landing, silver, split_csv
from actuaria.streaming import ingest_stream

WIDE_AT, TEXT_AT = "1997-01", "1999-01"  # the batches from which premiums come with wider types


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/actuaria-{name}/{uuid.uuid4().hex}"


def _csv(df: DataFrame, folder: str) -> None:
    df.write.option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(folder)


def _land(spark: SparkSession, df: DataFrame, root: str, name: str) -> None:
    """``df`` as CSV files ``<name>_<day>.csv`` in the landing folder, one per partition."""
    _csv(df, f"{root}/parts/{name}")
    day = dt.date(2001, 1, 1)
    for f in files.list_files(spark, f"{root}/parts/{name}"):
        if f.name.endswith(".csv"):
            files.move(spark, f.path, f"{root}/landing/{name}_{day:%Y%m%d}.csv")
            day += dt.timedelta(days=1)


def csv_quoted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: documents from CSV files whose quoted texts hold line breaks, commas and quotes, read in splits."""
    folder = f"{_fresh(spark, 'csv')}/documents"
    _csv(binding.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), folder)
    names = ["doc_id", "text", "lang", "source", "_bad"]
    read = split_csv.read_csv(spark, [folder], T.StructType([T.StructField(c, T.StringType()) for c in names]), "_bad")
    return read.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.length("text").cast("long").alias("n_chars"),
        F.md5("text").alias("text_md5"), F.col("_bad").isNotNull().alias("is_bad"),
    )


def ingest_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions by the stream, premiums by the batch job, one ledger, silver, published gold; the fact by town."""
    lk, root = kept(spark, sf_dir), _fresh(spark, "ingest")
    if lk:
        premiums, territory, dp03, dp05 = lk.silver(), lk.dim("territory"), lk.dim("dp03"), lk.dim("dp05")
    else:  # the files alone don't need a lake
        premiums = binding.premiums(spark, sf_dir)
        territory, dp03, dp05 = (read(spark, sf_dir).coalesce(1) for read in (binding.territory, binding.census_dp03, binding.census_dp05))
    geo = lambda df: df.withColumnRenamed("GEO_id2", "GEO.id2")
    for name, df in (("territory", territory), ("acs_dp03", geo(dp03)), ("acs_dp05", geo(dp05))):
        _land(spark, df, root, name)
    schemas = declared.schemas_for(["premiums", "territory", "acs_dp03", "acs_dp05"])
    ingest_stream.run_available(spark, f"{root}/landing", root, schemas, after=ingest_stream.to_silver(root))
    _land(spark, premiums.select(*declared.PREMIUMS.names), root, "premiums")
    landing.ingest(spark, f"{root}/landing", root, AS_OF.strftime("%Y%m%d"), AS_OF, schemas)
    silver.load_all(spark, root, ["premiums"], AS_OF)
    gold.build_gold(spark, root)
    return gold.read_gold(spark, root).groupBy("county", "town", "gender").agg(
        F.count(F.lit(1)).alias("record_count"), F.count("birthdate").alias("birthdates"),
        F.sum("current_premium").cast("decimal(38,4)").alias("total_premium"), F.sum("ypc").alias("claims"),
        F.max("acs03_total_population").alias("population"),
    )


def _premiums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The premiums' rows in any order: of the lake that is there, else from the tables, of which only the columns that are used move."""
    lk = kept(spark, sf_dir)
    return lk.silver() if lk else binding.premiums(spark, sf_dir)


def _generations(premiums: DataFrame) -> list[DataFrame]:
    """The premiums of three times: with narrow types, with wider ones and the cgr columns, with text."""
    src = premiums.select("batch_id", "ingested_at", "territory", "ypc", "current_premium", "cgr")
    old = src.where(F.col("batch_id") < WIDE_AT).select("batch_id", "ingested_at", "territory", "ypc", F.col("current_premium").cast("decimal(12,2)").alias("current_premium"))
    wide = src.where((F.col("batch_id") >= WIDE_AT) & (F.col("batch_id") < TEXT_AT))
    wide = wide.withColumn("territory", F.col("territory").cast("long")).withColumn("current_premium", F.col("current_premium").cast("decimal(20,4)"))
    new = src.where(F.col("batch_id") >= TEXT_AT).withColumn("ypc", F.concat(F.lit("c"), F.col("ypc").cast("string")))
    return [old, wide, new]


def _by_batch(df: DataFrame) -> DataFrame:
    # Spark sorts all rows for the least and greatest text of a group: the rows are hashed into (batch, ypc) first, and those are sorted.
    held = df.groupBy("batch_id", "ypc").agg(
        F.count(F.lit(1)).alias("n"), F.sum("territory").alias("territories"), F.sum("current_premium").alias("premium"), F.count("cgr").alias("cgr"),
    )
    return held.groupBy("batch_id").agg(
        F.sum("n").alias("record_count"), F.sum("territories").alias("territories"), F.min("ypc").alias("least_ypc"),
        F.max("ypc").alias("most_ypc"), F.sum("premium").cast("decimal(38,4)").alias("total_premium"), F.sum("cgr").alias("cgr_populated"),
    )


def schema_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches whose columns grow from int to long, decimal to wider decimal and int to text, read as one table."""
    root = _fresh(spark, "widen")
    for part in _generations(lake(spark, sf_dir).silver()):  # clustered by time: a task writes few batches
        silver.write_silver(spark, root, "premiums", part, AS_OF)
    return _by_batch(silver.read_silver(spark, root, "premiums"))


def catalog_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S16, S17, P-13: the same batches appended to a table of the session catalog by name."""
    root = _fresh(spark, "catalog")
    database = f"silver_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {catalog.quoted(database)} LOCATION '{root}/warehouse'")
    for part in _generations(_premiums(spark, sf_dir)):
        catalog.load(spark, root, database, "premiums", part)
    return _by_batch(spark.table(f"{catalog.quoted(database)}.stg_premiums"))


def daily_counts_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.9: rows per load day, counted by the stream over the fact's files."""
    lk = lake(spark, sf_dir)
    schema = T.StructType([T.StructField("ingested_at", lk.fact_legacy().schema["ingested_at"].dataType)])
    counted = ingest_stream.run_daily_counts(spark, lk.path("gold", "fact_legacy"), schema, _fresh(spark, "daily"))
    return counted.select("ingestion_date", "record_count")


def distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: distinct counts per territory from sketches of every batch, beside the exact ones; ``within``: off by 2 % at most."""
    root, columns = _fresh(spark, "sketches"), ["birthdate", "zipcode", "current_premium"]
    rows = lake(spark, sf_dir).fact_legacy().select("territory_label", "batch_id", *columns)
    sketches.add_batches(spark, root, "fact_legacy", rows, ["territory_label"], columns)
    found = sketches.distinct_counts(sketches.read(spark, root, "fact_legacy"), ["territory_label"])
    named = F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]))
    exact = rows.select("territory_label", named).groupBy("territory_label", "name").agg(F.count_distinct("value").alias("n_exact"))
    off = F.abs(F.col("n_distinct") - F.col("n_exact")) <= F.greatest(0.02 * F.col("n_exact"), F.lit(1.0))
    return found.join(exact, ["territory_label", "name"]).select("territory_label", "name", "n_values", "n_exact", off.alias("within"))


QUERIES = {
    f.__name__: f for f in (csv_quoted_scan, ingest_to_gold, schema_widen, catalog_evolved, daily_counts_live, distinct_sketches)
}
