"""Incremental ingest with Structured Streaming (S11 re-aimed, S7 consume-once).

The reference polls a landing folder every 60 s with a file sensor, gives up softly after 30 minutes and moves
consumed files to an archive.  Here a stream of file names does this:

* ``run_available`` takes the files that have arrived and stops; ``run_until_idle`` goes on polling until nothing has
  come for a while, and says so if nothing came at all;
* each micro-batch loads its files through the batch loader and the ledger that it shares with the batch job (see
  ``ledger``): whichever comes first, and however often either is repeated, a file is loaded once;
* ``after`` is called with the datasets and batches that a micro-batch brought: ``to_silver`` and ``to_gold`` take them on.
  They overwrite the micro-batch's own batches, so a micro-batch that is retried changes nothing;
* ``cleanSource=archive`` moves consumed files to an archive folder (it must lie
  outside the source glob); files are archived one trigger late.

``run_daily_counts`` is the live form of the freshness report: rows per day, later arrivals included.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actuaria.plans import gold
from actuaria.sources import files, landing, ledger, silver
from actuaria.sources.files import FileInfo

#: Called with (spark, {dataset: batches}) after a micro-batch has been loaded.
After = Callable[[SparkSession, dict[str, list[str]]], None]


def landing_stream(spark: SparkSession, landing_dir: str, archive_dir: str | None = None, max_files: int | None = None) -> DataFrame:
    """(path, modified, length) of the landing files as they arrive; contents are not read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    r = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.csv")
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(landing_dir).select("path", F.col("modificationTime").alias("modified"), "length")


def load_micro_batch(
    df: DataFrame, root: str, schemas: Mapping[str, T.StructType] | None = None, loader: str = "stream landing"
) -> list[tuple]:
    """Load the files that ``df`` names; (file, dataset, batch, status, reason) of those that were not loaded before."""
    at = lambda ms: dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).replace(tzinfo=None)
    rows = df.select("path", F.unix_millis("modified").alias("ms"), "length").collect()
    found = [FileInfo(p, p.rsplit("/", 1)[-1], n, at(ms)) for p, ms, n in sorted(rows)]
    if not found:
        return []
    newest = max(f.modified for f in found)
    out = landing.consume(df.sparkSession, found, root, newest.strftime("%Y%m%d"), newest, loader, schemas)
    return [tuple(r) for r in out.select("file", "dataset", "batch_id", "status", "reason").collect()]


def to_silver(root: str) -> After:
    """Load what a micro-batch brought into the evolving silver tables."""

    def after(spark: SparkSession, brought: dict[str, list[str]]) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        for dataset, batches in sorted(brought.items()):
            silver.load_silver(spark, root, dataset, now, batches)

    return after


def to_gold(root: str) -> After:
    """Silver, and the fact anew as soon as every role has a table."""
    load = to_silver(root)

    def after(spark: SparkSession, brought: dict[str, list[str]]) -> None:
        load(spark, brought)
        try:
            silver.resolve_roles(silver.silver_tables(spark, root))
        except ValueError:
            return
        gold.build_gold(spark, root)

    return after


def _writer(root: str, schemas: Mapping[str, T.StructType] | None, name: str, after: After | None, seen: list[float]):
    """The function of each micro-batch.

    What it brought is asked from the ledger, not from this run, so that a retry takes the files on that were loaded before
    the failure.  A file that fails stops the stream with its reason, and the next run tries again.
    """

    def write_batch(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        names = [r["path"].rsplit("/", 1)[-1] for r in df.select("path").collect()]
        if not names:
            return
        seen.append(time.monotonic())
        failed = [(r[0], r[4]) for r in load_micro_batch(df, root, schemas, f"stream {name}") if r[3] == "failed"]
        if after:
            brought: dict[str, list[str]] = {}
            told = ledger.summary(spark, root).filter((F.col("status") == "loaded") & F.col("file").isin(names))
            for r in told.select("dataset", "batch_id").distinct().collect():
                brought.setdefault(r["dataset"], []).append(r["batch_id"])
            after(spark, brought)
        if failed:
            raise RuntimeError(f"micro-batch {epoch}: {failed}")

    return write_batch


def run_available(
    spark: SparkSession, landing_dir: str, root: str, schemas: Mapping[str, T.StructType] | None = None,
    archive_dir: str | None = None, name: str = "landing", max_files: int | None = None, after: After | None = None,
) -> DataFrame:
    """Ingest every landing file not yet seen and stop; the summary of all files so far."""
    q = (
        landing_stream(spark, landing_dir, archive_dir, max_files)
        .writeStream.foreachBatch(_writer(root, schemas, name, after, []))
        .option("checkpointLocation", f"{root}/_checkpoints/{name}")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return ledger.summary(spark, root)


def run_until_idle(
    spark: SparkSession, landing_dir: str, root: str, schemas: Mapping[str, T.StructType] | None = None, poll: float = 60,
    idle: float = 1800, archive_dir: str | None = None, name: str = "landing", max_files: int | None = None, after: After | None = None,
) -> tuple[int, DataFrame]:
    """Poll the landing folder every ``poll`` seconds until nothing has come for ``idle`` seconds.

    Returns the number of micro-batches that brought files and the summary of all files so far.  0 says that nothing came in
    time: no failure, the steps behind it may go on with what there is.  A file that comes within the wait is loaded and the wait begins anew.
    """
    seen: list[float] = []
    q = (
        landing_stream(spark, landing_dir, archive_dir, max_files)
        .writeStream.foreachBatch(_writer(root, schemas, name, after, seen))
        .option("checkpointLocation", f"{root}/_checkpoints/{name}")
        .trigger(processingTime=f"{max(1, int(poll * 1000))} milliseconds")
        .start()
    )
    try:
        last = time.monotonic()
        while not q.awaitTermination(max(0.2, min(poll, idle) / 2)):
            if q.status["isTriggerActive"] and q.status["isDataAvailable"]:
                last = time.monotonic()  # at work
            last = max([last, *seen[-1:]])
            if time.monotonic() - last > idle:
                break
    finally:
        q.stop()
    return len(seen), ledger.summary(spark, root)


def daily_counts(events: DataFrame, ts_col: str = "ingested_at", watermark: str = "1 day") -> DataFrame:
    """Streaming rows per day: ``(ingestion_date, record_count)`` with a watermark."""
    return (
        events.withWatermark(ts_col, watermark)
        .groupBy(F.window(ts_col, "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select(F.to_date(F.col("w.start")).alias("ingestion_date"), "record_count")
    )


def run_daily_counts(spark: SparkSession, source_dir: str, schema: T.StructType, root: str,
                     name: str = "daily_counts", watermark: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """Stream parquet rows from ``source_dir`` until caught up: (ingestion_date, record_count, late_count).

    The table equals the batch answer over the rows seen, however late they come: every micro-batch writes its own counts
    per day, to a partition of its own that a retry overwrites, and reading adds them up, so no state is held and nothing
    is dropped.  ``late_count`` tells how many of a day's rows came after its end had been left behind by more than the
    ``watermark`` (``daily_counts`` would have dropped them).  Rows without a time are counted under a null day.
    """
    out, ends = f"{root}/stream/{name}", f"{root}/stream/{name}_ends"
    src = spark.readStream.schema(schema).parquet(source_dir).select(F.col("ingested_at").cast("timestamp").alias("ingested_at"))

    def add(df: DataFrame, epoch: int) -> None:
        own = df.sparkSession
        before = None
        if files.exists(own, ends):
            before = own.read.schema("newest timestamp, epoch long").parquet(ends).filter(F.col("epoch") < epoch).agg(F.max("newest")).first()[0]
        day = F.to_date("ingested_at")
        closed = F.lit(False) if before is None else F.coalesce(F.date_add(day, 1).cast("timestamp") <= F.lit(before - watermark), F.lit(False))
        counts = df.groupBy(day.alias("ingestion_date")).agg(
            F.count(F.lit(1)).alias("record_count"), F.count_if(closed).alias("late_count"), F.max("ingested_at").alias("newest")
        )
        put = counts.withColumn("epoch", F.lit(epoch)).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        put.partitionBy("epoch").parquet(out)
        written = own.read.schema("newest timestamp, epoch long").parquet(out).filter(F.col("epoch") == epoch)
        newest = written.agg(F.max("newest").alias("newest")).withColumn("epoch", F.lit(epoch))
        newest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(ends)

    q = (
        src.writeStream.foreachBatch(add).option("checkpointLocation", f"{root}/_checkpoints/{name}")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    held = spark.read.schema("ingestion_date date, record_count long, late_count long").parquet(out)
    return held.groupBy("ingestion_date").agg(F.sum("record_count").alias("record_count"), F.sum("late_count").alias("late_count"))
