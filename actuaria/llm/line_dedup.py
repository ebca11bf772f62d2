"""Operator 1: reversible line dedup with sharded cuckoo filters and exact counts.

The index holds, in the shared folder,

* ``postings`` (key, doc_id): which document has which long line;
* ``refs`` (key, n_docs, keeper): the exact reference counts;
* ``filters`` (shard, cells): one cuckoo filter a shard, of the keys whose count
  has reached ``min_docs``.

Inserting documents adds to the counts and adds the keys that reach the limit to
their shard's filter.  Deleting documents subtracts, finds the next keeper and
takes the keys that fall below the limit out of the filter, so it undoes the
insert.  Cleaning asks the filters first, for every line of every document: lines
that they don't hold are no repeated lines; only those that they hold are looked up
in the exact table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import Workspace, slices, texts_of
from actuaria.llm.cuckoo import CuckooFilter, Full

#: Copies of a shard's filter, to which its lines are dealt by document.
COPIES = 32
STRIPPED = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The digest of a line, None if its bare text is shorter than ``min_chars`` code points."""
    bare = line.strip(STRIPPED)
    if len(bare) < min_chars or (len(bare) < 4 * min_chars and len(bare.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(bare.lower(), digest_size=16).digest()  # bytes.lower() changes A-Z only


def postings_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """(key, doc_id), once for each long line that a document holds."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            keys: list[bytes] = []
            ids: list[int | None] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                own = {line_key(x, min_chars) for x in text.encode("utf-8", "surrogatepass").split(b"\n")} - {None}
                keys.extend(own)
                ids.extend([doc_id] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["key", "doc_id"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(emit, "key binary, doc_id long").distinct()


@dataclass(frozen=True)
class LineIndex:
    """One generation of the index; inserting and deleting give the next one."""

    work: Workspace
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    min_docs: int
    min_chars: int
    shards: int
    generation: int = 0

    @classmethod
    def empty(cls, work: Workspace, min_docs: int = 5, min_chars: int = 40, shards: int = 256) -> LineIndex:
        make = work.spark.createDataFrame
        return cls(
            work, make([], "key binary, doc_id long"), make([], "key binary, n_docs long, keeper long"),
            make([], "shard int, cells binary"), min_docs, min_chars, shards,
        )

    def shard(self):
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int")

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with these documents.

        A line counts once a document: lines that the index holds for an id already are
        not counted again, new ones of a known id are added to it.
        """
        w, g = self.work, self.generation + 1
        added = postings_of(docs, self.min_chars)
        if self.generation:
            held = self.postings.select(F.col("key").alias("h_key"), F.col("doc_id").alias("h_id"))
            added = added.join(held, (F.col("key") == F.col("h_key")) & F.col("doc_id").eqNullSafe(F.col("h_id")), "left_anti")
        added = w.write(added, f"added-{g}")
        delta = added.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
        before = self.refs.withColumn("old", F.col("n_docs"))
        refs = w.write(
            before.unionByName(delta.withColumn("old", F.lit(0).cast("long")))
            .groupBy("key")
            .agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"), F.sum("old").alias("old")),
            f"refs-{g}",
        )
        crossed = refs.filter((F.col("old") < self.min_docs) & (F.col("n_docs") >= self.min_docs))
        return self._next(self.postings.unionByName(added), refs.drop("old"), crossed.select("key", F.lit(True).alias("add")))

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents of ``ids`` (doc_id): as if they had never been inserted."""
        w, g = self.work, self.generation + 1
        gone = ids.select(F.col("doc_id").cast("long").alias("gone")).distinct()
        kept = w.write(self.postings.join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti"), f"kept-{g}")
        dropped = self.postings.join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_semi").groupBy("key").agg(
            F.count(F.lit(1)).alias("less")
        )
        # Only keys that lost a document can have another keeper.
        left = kept.join(dropped, "key", "left_semi").groupBy("key").agg(F.max("doc_id").alias("next"))
        refs = w.write(
            self.refs.join(dropped, "key", "left").join(left, "key", "left").select(
                "key", (F.col("n_docs") - F.coalesce("less", F.lit(0))).alias("n_docs"),
                F.when(F.col("less").isNull(), F.col("keeper")).otherwise(F.col("next")).alias("keeper"),
                F.col("n_docs").alias("old"),
            ),
            f"refs-{g}",
        )
        crossed = refs.filter((F.col("old") >= self.min_docs) & (F.col("n_docs") < self.min_docs))
        return self._next(kept, refs.filter("n_docs > 0").drop("old"), crossed.select("key", F.lit(False).alias("add")))

    def _next(self, postings: DataFrame, refs: DataFrame, crossed: DataFrame) -> LineIndex:
        w, g = self.work, self.generation + 1

        def update(changes: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            shard = int((changes if len(changes) else held)["shard"].iloc[0])
            cuckoo = CuckooFilter.of_bytes(held["cells"].iloc[0] if len(held) else None)
            try:
                for key, add in zip(changes["key"], changes["add"]):
                    cuckoo.add(key) if add else cuckoo.remove(key)
            except Full:
                return pd.DataFrame({"shard": [shard], "cells": [None]})
            return pd.DataFrame({"shard": [shard], "cells": [cuckoo.to_bytes()]})

        def rebuild(keys: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "cells": [CuckooFilter.of_keys(list(keys["key"])).to_bytes()]})

        schema = "shard int, cells binary"
        updated = w.write(
            crossed.withColumn("shard", self.shard()).groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(update, schema),
            f"updated-{g}",
        )
        full = updated.filter("cells is null").select("shard")
        rebuilt = (
            refs.filter(F.col("n_docs") >= self.min_docs).select("key", self.shard().alias("shard")).join(full, "shard", "left_semi")
            .groupBy("shard").applyInPandas(rebuild, schema)
        )
        filters = w.write(updated.filter("cells is not null").unionByName(rebuilt), f"filters-{g}")
        return LineIndex(w, postings, refs, filters, self.min_docs, self.min_chars, self.shards, g)

    def may_repeat(self, lines: DataFrame) -> DataFrame:
        """The rows of ``lines`` (key, doc_id, or key alone) whose keys their shard's filter holds.

        Filters and lines are dealt by shard and sorted, the filter first, so a task
        streams through any number of lines with one filter in memory.  The lines of a
        shard are dealt further by document, to as many copies of its filter, so that a line
        of very many documents is no single task's.
        """

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, cuckoo = None, None
            for batch in batches:
                asked = batch.column("key").to_pylist()
                hits = np.zeros(len(asked), dtype=bool)
                waiting: list[int] = []
                for i, (number, data) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("cells").to_pylist())):
                    if number != shard or data is not None:
                        if waiting and cuckoo is not None:
                            hits[waiting] = cuckoo.contains([asked[k] for k in waiting])
                        shard, cuckoo, waiting = number, CuckooFilter.of_bytes(data) if data is not None else None, []
                    if data is None:
                        waiting.append(i)
                if waiting and cuckoo is not None:
                    hits[waiting] = cuckoo.contains([asked[k] for k in waiting])
                yield batch.filter(pa.array(hits)).select(["key", "doc_id"])

        if "doc_id" not in lines.columns:
            lines = lines.withColumn("doc_id", F.lit(None).cast("long"))
        copies = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
        asked = lines.select(
            self.shard().alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(COPIES)).cast("int").alias("copy"), F.lit(1).alias("kind"),
            F.lit(None).cast("binary").alias("cells"), "key", "doc_id",
        )
        held = self.filters.select(
            "shard", copies.alias("copy"), F.lit(0).alias("kind"), "cells", F.lit(None).cast("binary").alias("key"),
            F.lit(None).cast("long").alias("doc_id"),
        )
        dealt = held.unionByName(asked).repartition("shard", "copy").sortWithinPartitions("shard", "kind")
        return dealt.mapInArrow(probe, "key binary, doc_id long")

    def repeated(self) -> DataFrame:
        """(doc_id, key): the lines to drop, those of repeated keys outside their keeper."""
        exact = self.refs.filter(F.col("n_docs") >= self.min_docs)
        hits = self.may_repeat(self.postings)
        return hits.join(exact, "key").filter(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "key")


def drop_lines(docs: DataFrame, index: LineIndex) -> DataFrame:
    """``docs`` with __kept (text), __n_lines and __n_dropped: for documents that the index holds.

    A null or empty text is one empty line, which stays; long texts are handled
    whole, one at a time.  Rows that share an id are one document to the index,
    and each of them loses the lines that the document loses.  Null ids are one
    document, lower than any other.  Extra columns pass through; names that begin
    with two underscores are reserved.
    """
    min_chars = index.min_chars
    drops = index.repeated().groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("key").alias("__drop"))

    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def rewrite(text: pd.Series, drop: pd.Series) -> pd.DataFrame:
        kept, total, less = [], [], []
        for t, d in zip(text, drop):
            raw = (t or "").encode("utf-8", "surrogatepass")
            lines = raw.split(b"\n")
            stay = lines
            if d is not None and len(d):
                gone = set(map(bytes, d))
                stay = [x for x in lines if line_key(x, min_chars) not in gone]
            kept.append(b"\n".join(stay).decode("utf-8", "surrogatepass") if stay is not lines else t or "")
            total.append(len(lines))
            less.append(len(lines) - len(stay))
        return pd.DataFrame({"kept": kept, "n_lines": total, "n_dropped": less})

    joined = docs.join(drops, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left")
    done = joined.withColumn("__r", rewrite(F.col("text"), F.col("__drop")))
    return done.withColumns(
        {"__kept": F.col("__r.kept"), "__n_lines": F.col("__r.n_lines"), "__n_dropped": F.col("__r.n_dropped")}
    ).drop("__r", "__id", "__drop")


def dedup_lines(docs: DataFrame, work: Workspace, min_docs: int = 5, min_chars: int = 40, shards: int = 256) -> DataFrame:
    """Index all of ``docs`` and drop their repeated lines; see ``drop_lines``."""
    index = LineIndex.empty(work, min_docs, min_chars, shards).insert(docs)
    return drop_lines(docs, index)
