"""Helpers shared by the operators: tables in the shared folder, Arrow columns."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actuaria.session import shared_dir

#: The white space that separates words in every contract: blank and \t..\r.
WORD_RE = "[^\\x20\\x09-\\x0D]+"
SPACE_RE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, too."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


class Workspace:
    """A fresh folder below ``spark.checkpoint.dir`` for the written tables of one call.

    A written table cuts the lineage: after a lost executor its rows are read
    again from the shared folder instead of being computed again.
    """

    def __init__(self, spark: SparkSession, name: str):
        importable(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet, to a path of its own, and read it back with the same schema."""
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables of one to three numbers a row are broadcast up to this many rows: some 100 MB in memory.
MOST_BROADCAST = 1_500_000


def sized(df: DataFrame, numbers: Column | None = None) -> DataFrame:
    """``df``, a written table, to be broadcast if what it holds is counted to be little.

    Counted are its rows, of a few numbers each, or ``numbers`` (an aggregate).  Above
    the bound it is returned as it is, for a shuffle join.
    """
    held = df.count() if numbers is None else df.agg(numbers).first()[0] or 0
    return F.broadcast(df) if held <= MOST_BROADCAST else df


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """The strings of an Arrow column, null as the empty string."""
    return ["" if t is None else t for t in column.to_pylist()]


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts give an empty one."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RE))


def word_count(text: Column) -> Column:
    """Number of words of a text; null and blank texts have none."""
    return F.size(words_of(text)).cast("long")


def slices(batches: Iterable[pa.RecordBatch], text: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice hold about ``most_bytes``.

    A longer single text is a slice of its own: memory is bounded by the longest
    text, not by the number of rows in a batch.
    """
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)
