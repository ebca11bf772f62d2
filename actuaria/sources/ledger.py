"""One ledger of consumed landing files, for the batch job and the stream.

A file is its name, modification time and length.  It is loaded in these steps, whoever does it:

1. ``fresh`` passes over what the ledger calls loaded;
2. ``claim`` makes a claim file that can be made only once; it holds the batch id and time stamp under which the file is loaded, whoever goes on with it;
3. what was loaded by another one meanwhile is given back;
4. bronze partitions are named by the claim's batch and the file, and overwritten, so that loading twice changes nothing;
5. ``record`` appends the outcome to the ledger; then the claims are given back.

A loader that was lost leaves its claims.  It takes them up itself when it runs again; another one does so after ``lease`` seconds, with
the batch id of the claim.  ``compact`` keeps the last entry of every file.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actuaria.sources import files, published
from actuaria.sources.files import FileInfo

SCHEMA = (
    "file string, dataset string, batch_id string, rows long, bad_rows long, status string, reason string, "
    "modified timestamp_ntz, length long, schema string, loader string, at timestamp_ntz"
)
LEASE = 3600


def _log(root: str) -> str:
    return f"{root}/ops/ingest_log"


def _compacted(root: str) -> str:
    return f"{root}/ops/ingest_ledger"


def entries(spark: SparkSession, root: str) -> DataFrame:
    """Every entry that was recorded; an empty table before the first one."""
    parts = [spark.createDataFrame([], SCHEMA)]
    if (folder := published.current(spark, _compacted(root))) is not None:
        parts.append(spark.read.schema(SCHEMA).parquet(folder))
    if files.exists(spark, _log(root)):
        parts.append(spark.read.schema(SCHEMA).parquet(_log(root)))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def summary(spark: SparkSession, root: str) -> DataFrame:
    """The last entry of every file."""
    last = Window.partitionBy("file", "modified", "length").orderBy(F.desc("at"), F.desc(F.col("status") == "loaded"))
    return entries(spark, root).withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n")


def fresh(spark: SparkSession, root: str, found: list[FileInfo]) -> list[FileInfo]:
    """The files that the ledger does not call loaded."""
    if not found:
        return []
    names = spark.createDataFrame([(f.name, f.modified, f.length) for f in found], "file string, modified timestamp_ntz, length long")
    done = entries(spark, root).filter("status = 'loaded'").select("file", "modified", "length")
    left = {tuple(r) for r in names.join(done, ["file", "modified", "length"], "left_anti").collect()}
    return [f for f in found if (f.name, f.modified, f.length) in left]


def _claim_path(root: str, f: FileInfo) -> str:
    name = hashlib.sha256(json.dumps([f.name, f.modified.isoformat(), f.length]).encode()).hexdigest()
    return f"{root}/ops/claims/{name}"


def claim(
    spark: SparkSession, root: str, found: list[FileInfo], batch_id: str, stamp: dt.datetime, loader: str, lease: int = LEASE
) -> list[tuple[FileInfo, str, dt.datetime]]:
    """(file, batch id, time stamp) of the files that this loader may load now."""
    mine = []
    for f in found:
        path = _claim_path(root, f)
        own = json.dumps({"batch_id": batch_id, "stamp": stamp.isoformat(), "loader": loader, "at": time.time()})
        if files.create_once(spark, path, own):
            mine.append((f, batch_id, stamp))
            continue
        text = files.read_text(spark, path)
        if not text:  # being written, or given back just now: next time
            continue
        held = json.loads(text)
        if held["loader"] == loader or time.time() - held["at"] > lease:
            mine.append((f, held["batch_id"], dt.datetime.fromisoformat(held["stamp"])))
    return mine


def release(spark: SparkSession, root: str, found: list[FileInfo]) -> None:
    for f in found:
        files.delete(spark, _claim_path(root, f))


def record(spark: SparkSession, root: str, rows: list[tuple], loader: str) -> DataFrame:
    """Append (file .. length, schema) rows; returns them as a table."""
    at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out = spark.createDataFrame([(*r, loader, at) for r in rows], SCHEMA)
    if rows:
        out.coalesce(1).write.mode("append").parquet(_log(root))
    return out


def compact(spark: SparkSession, root: str) -> int:
    """Publish the last entry of every file as one table and take away what it holds; returns its rows.

    No loader may record entries meanwhile: run it between loads.
    """
    before = files.tree(spark, _log(root)) if files.exists(spark, _log(root)) else []
    _, rows = published.publish(spark, summary(spark, root).coalesce(1), _compacted(root))
    for path, _, _ in before:
        files.delete(spark, path)
    return rows
