"""CSV files whose quoted fields hold line breaks, read by many tasks (S3).

Spark splits a text file at any line break, also inside quotes, so such files are usually
parsed whole, each in one task.  Here they are read as lines of splits:

1. every split says where it would end, inside or outside a quoted field, for both ways in which it may begin;
2. the splits of a file are chained from its begin, which tells how each of them really begins: one number per split;
3. every split joins its lines to records.  The first lines of a split that begins inside quotes, and the last ones of a
   split that ends there, are pieces of a record; they are put together by file and place; only where there are such pieces is the text gone through once more for them.

Records are then parsed by ``from_csv``.  A quote opens a field at its begin only, and "" inside is a quote; a
closing quote followed by other text than a delimiter ends the quoting, as Spark's parser has it.  Line breaks are \\n; a \\r before the one that ends a
record goes with it.  Empty lines between records are passed over.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actuaria.session import importable

#: A line that begins outside of quotes and ends inside: whole fields, then an open one.
_OPENS = re.compile(r'(?:"(?:[^"]|"")*+"[^,]*+,|[^",][^,]*+,|,)*+"(?:[^"]|"")*+')
#: The rest of a quoted field and what follows it up to the next field.
_CLOSES = re.compile(r'(?:[^"]|"")*+"[^,]*+(,|\Z)')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted field, if it begins so or not."""
    if '"' not in line:
        return inside
    if not inside:
        return _OPENS.fullmatch(line) is not None
    closed = _CLOSES.match(line)
    if closed is None:
        return True
    return closed.group(1) == "," and _OPENS.fullmatch(line, closed.end()) is not None


class SplitsMoved(RuntimeError):
    """The file was split at other places in the second pass, for example as there are fewer executors now."""


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, value): lines, the place where their split begins, and the file's path."""
    importable(spark)
    read = spark.read.option("lineSep", "\n").text(paths)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def with_quotes(spark: SparkSession, paths: list[str]) -> set[str]:
    """The paths, as Spark names them, of the files that hold a quote at all."""
    held = lines_of(spark, paths).filter(F.contains("value", F.lit('"'))).select("file").distinct()
    return {r["file"] for r in held.collect()}


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value")))


def split_ends(lines: DataFrame) -> dict[str, list[tuple[int, bool]]]:
    """For every file its splits in order: (begin, whether it begins inside quotes).

    Two flags per split come to the driver: some 100 bytes for each 128 MB of text.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple[str, int], tuple[bool, bool]] = {}
        for file, block, line in _by_split(batches):
            held = ends.get((file, block), (False, True))
            if '"' in line:
                held = (ends_inside(line, held[0]), ends_inside(line, held[1]))
            ends[file, block] = held
        if ends:
            columns = zip(*((f, b, o, i) for (f, b), (o, i) in ends.items()))
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "block", "out", "into"])

    found: dict[str, list[tuple[int, bool]]] = {}
    state = False
    for r in sorted(lines.mapInArrow(emit, "file string, block long, out boolean, into boolean").collect()):
        if r["file"] not in found:
            state = False
        found.setdefault(r["file"], []).append((r["block"], state))
        state = r["into"] if state else r["out"]
    return found


def records_of(lines: DataFrame, begins: dict[str, list[tuple[int, bool]]], header: bool) -> DataFrame:
    """(file, record): the records of the files, without the first of each if it is a header."""
    places = {f: ([b for b, _ in splits], [s for _, s in splits]) for f, splits in begins.items()}
    names = ["file", "block", "kind", "record"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        now, block, inside, kind, held = None, 0, False, "whole", []

        def table() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 4, kinds)], names)
            rows.clear()
            return out

        for file, at, line in _by_split(batches):
            if (file, at) != now:
                if held:
                    rows.append((*now, "tail" if kind == "tail" else "head", "\n".join(held)))
                starts, states = places.get(file, ([], []))
                k = bisect_left(starts, at)
                if k == len(starts) or starts[k] != at:
                    raise SplitsMoved(f"{file} is split at {at} now")
                now, block, inside, held = (file, at), at, states[k], []
                kind = "tail" if inside else "first" if header and block == 0 else "whole"
            inside = ends_inside(line, inside)
            held.append(line)
            if not inside:
                record = held[0] if len(held) == 1 else "\n".join(held)
                if kind == "tail" or kind == "whole" and record.strip("\r"):
                    rows.append((file, block, kind, record.removesuffix("\r")))
                kind, held = "whole", []
                if len(rows) >= 4096:
                    yield table()
        if held:
            rows.append((*now, "tail" if kind == "tail" else "head", "\n".join(held)))
        if rows:
            yield table()

    pieces = lines.mapInArrow(emit, "file string, block long, kind string, record string")
    if not any(state for splits in begins.values() for _, state in splits):  # a head is the open record at a file's end
        return pieces.select("file", "record")
    whole = pieces.filter("kind = 'whole'").select("file", "record")
    # At most two pieces a split; a head begins a record, the tails behind it go on with it.
    order = F.struct("block", (F.col("kind") == "head").alias("later"))
    ahead = Window.partitionBy("file").orderBy("block", F.col("kind") == "head").rowsBetween(Window.unboundedPreceding, 0)
    cut = pieces.filter("kind <> 'whole'").withColumn("nth", F.sum(F.when(F.col("kind") == "head", 1).otherwise(0)).over(ahead))
    parts = cut.groupBy("file", "nth").agg(F.sort_array(F.collect_list(F.struct(order.alias("at"), "record"))).alias("parts"))
    return whole.unionByName(parts.select("file", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")))


def read_records(spark: SparkSession, paths: list[str], header: bool = True) -> DataFrame:
    """(file, record) of CSV files, quoted line breaks inside records; splits are read by different tasks."""
    lines = lines_of(spark, paths)
    return records_of(lines, split_ends(lines), header)


def read_csv(spark: SparkSession, paths: list[str], schema: T.StructType, corrupt: str) -> DataFrame:
    """The columns of ``schema`` and ``_file``, like Spark's reader with ``multiLine`` under a given schema and a header line.

    ``corrupt`` names the column of ``schema`` that takes records which don't fit.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "escape": '"'}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("record", ddl, options)
    named = F.element_at(F.split("file", "/"), -1)
    rows = read_records(spark, paths).select(parsed.alias("__row"), F.url_decode(F.replace(named, F.lit("+"), F.lit("%2B"))).alias("_file"))
    return rows.select("__row.*", "_file")
