"""Operator 8: substring dedup by hashing lines.

A text's units are its lines, cut further behind sentence ends, so that a passage
inside a longer line is found too; sentences of a word or two go with the sentence
behind them.  Units are normalised and their digests grouped over the whole corpus; the
earliest occurrence, by document id and offset, stays.  Neighbouring units that occur
earlier elsewhere form runs.  A run is joined to its kept occurrence and extended word
by word over the neighbouring units as long as both texts agree, however far; runs that
meet are one, and those of enough words are removed, with their offsets in the
original text.

Long sentences are cut further behind words whose hash is the least around, so that
passages in them have units, too.  What is missed: a passage in which no unit lies
whole, such as the end of one short sentence and the beginning of the next; and a
passage whose every unit is kept from other places than the words beside it.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actuaria.llm.common import Workspace, slices, texts_of

#: A sentence ends behind a line break, or behind white space that follows . ! or ?
_SENTENCE = re.compile(r"[^\n.!?]*(?:[.!?]+(?![ \t])[^\n.!?]*)*(?:[.!?]+[ \t]+|\n|$)")
_WORD = re.compile(r"\S+")
_DIGEST = struct.Struct(">qi")
#: Units of more words are cut where the hash of two words is the least among REACH on both sides.
LONGEST, REACH = 24, 4
#: Sentences of fewer words go with those behind them; runs of fewer words are not extended.
ANCHOR = 4
#: An extension looks at so many words, and while all agree at eight times as many.
FIRST_LOOK = 24


def units_of(text: str) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(start, end, words, key, tail, around) of the units; code points, white space around left out.

    Normalised: lower case, white space runs as one blank, none at the ends.  key and tail
    are the digest; around holds 16 bits of the hash of the word before and of the word behind.
    """
    words, starts, ends, edges = [], [], [], [0]
    for m in _SENTENCE.finditer(text):
        before = len(words)
        for w in _WORD.finditer(text, m.start(), m.end()):
            words.append(w.group().lower())
            starts.append(w.start())
            ends.append(w.end())
        if len(words) - before >= ANCHOR:
            edges += [edges[-1] + c for c in cuts(words[edges[-1] :])] + [len(words)]
    if edges[-1] < len(words):
        edges += [edges[-1] + c for c in cuts(words[edges[-1] :])] + [len(words)]
    for a, b in zip(edges, edges[1:]):
        digest = hashlib.blake2b(" ".join(words[a:b]).encode("utf-8", "surrogatepass"), digest_size=12).digest()
        key, tail = _DIGEST.unpack(digest)
        around = (hash_of(words[a - 1]) & 0xFFFF if a else 0) << 16 | (hash_of(words[b]) & 0xFFFF if b < len(words) else 0)
        yield starts[a], ends[b - 1], b - a, key, tail, around


def hash_of(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def cuts(words: list[str]) -> list[int]:
    """The places at which a long unit is cut; they follow from the words around them alone."""
    if len(words) <= LONGEST:
        return []
    hashes = [zlib.crc32(f"{a} {b}".encode("utf-8", "surrogatepass")) for a, b in zip(words, words[1:])]
    found = []
    for i, h in enumerate(hashes):
        around = hashes[max(0, i - REACH) : i + REACH + 1]
        if h == min(around) and around.count(h) == 1:
            found.append(i + 1)
    return found


def units(docs: DataFrame) -> DataFrame:
    """(doc_id, row, pos, at, start, end, words, key, tail, around): row is a hash of the text, pos counts the units, at the words before."""
    schema = "doc_id long, row long, pos int, at int, start int, end int, words int, key long, tail int, around long"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.int64(), pa.int32(), pa.int64()]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            rows = []
            for doc_id, row, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), texts_of(batch.column("text"))
            ):
                at = 0
                for pos, unit in enumerate(units_of(text)):
                    rows.append((doc_id, row, pos, at, *unit))
                    at += unit[2]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("row"), "text").mapInArrow(emit, schema)


def beside(text: str, place: int, left: bool, most: int) -> tuple[list[int], list[int]]:
    """Hashes of up to ``most`` words before or behind a place, nearest first, with the offsets of their far ends."""
    if not left:
        found = list(islice(_WORD.finditer(text, place), most))
        return [hash_of(m.group().lower()) for m in found], [m.end() for m in found]
    reach = 8 * most
    while True:
        low = max(0, place - reach)
        found = list(_WORD.finditer(text, low, place))  # places in the whole text
        if low and found and found[0].start() == low:
            del found[0]  # perhaps a part of a word
        if len(found) >= most or not low:
            break
        reach *= 4
    found = found[: -most - 1 : -1]
    return [hash_of(m.group().lower()) for m in found], [m.start() for m in found]


def neighbours(docs: DataFrame, asked: DataFrame, most: int) -> DataFrame:
    """(doc_id, row, place, left, near, ends) for the asked (doc_id, row, place, left), each once."""
    schema = "doc_id long, row long, place int, left boolean, near array<long>, ends array<int>"
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            rows = [
                (doc_id, row, p["place"], p["left"], *beside(text, p["place"], p["left"], most))
                for doc_id, row, places, text in zip(
                    *(batch.column(c).to_pylist() for c in ("doc_id", "row", "places")), texts_of(batch.column("text"))
                )
                for p in places
            ]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "row", "place", "left", "near", "ends"]
            )

    places = asked.groupBy("doc_id", "row").agg(F.collect_set(F.struct("place", "left")).alias("places"))
    places = places.withColumnsRenamed({"doc_id": "__id", "row": "__row"})
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    joined = texts.join(places, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row")))
    return joined.select("doc_id", "row", "places", "text").mapInArrow(emit, schema).dropDuplicates(["doc_id", "row", "place", "left"])


def compared(docs: DataFrame, edges: DataFrame, most: int, work: Workspace) -> DataFrame:
    """The edges that agree on ``n`` words, more than none, with the ends ``to`` and ``k_to``; ``open`` if all ``most`` agree."""
    asked = edges.select("doc_id", "row", "place", "left").unionByName(
        edges.select(F.col("k_doc").alias("doc_id"), F.col("k_row").alias("row"), F.col("k_place").alias("place"), "left")
    )
    near = work.write(neighbours(docs, asked.distinct(), most), "near")
    own = near.select(*[F.col(c).alias(f"o_{c}") for c in near.columns])
    kept = near.select(*[F.col(c).alias(f"n_{c}") for c in near.columns])
    met = edges.join(
        own, F.col("doc_id").eqNullSafe(F.col("o_doc_id")) & (F.col("row") == F.col("o_row")) & (F.col("place") == F.col("o_place"))
        & (F.col("left") == F.col("o_left")),
    ).join(
        kept, F.col("k_doc").eqNullSafe(F.col("n_doc_id")) & (F.col("k_row") == F.col("n_row")) & (F.col("k_place") == F.col("n_place"))
        & (F.col("left") == F.col("n_left")),
    )
    same = F.zip_with("o_near", "n_near", lambda a, b: F.coalesce(a == b, F.lit(False)))
    agreed = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0).cast("long")) - 1, F.size(same)).cast("int")
    return met.withColumn("n", agreed).filter("n > 0").select(
        "doc_id", "row", "run", "left", "k_doc", "k_row", "n", F.get("o_ends", F.col("n") - 1).alias("to"),
        F.get("n_ends", F.col("n") - 1).alias("k_to"), (F.col("n") == most).alias("open"),
    )


def extended(docs: DataFrame, runs: DataFrame, work: Workspace) -> DataFrame:
    """``runs`` with start, end, low and high moved outwards as far as the words beside the kept occurrence agree.

    Only sides whose next words have equal hashes are looked at.  Sides on which all the
    words looked at agree are looked at again, from there, with eight times as many.
    """
    side = lambda left, place, doc, row, kept, next_: F.struct(
        F.lit(left).alias("left"), F.col(place).alias("place"), F.col(doc).alias("k_doc"), F.col(row).alias("k_row"),
        F.col(kept).alias("k_place"), next_.alias("next"),
    )
    before = lambda c: F.shiftright(c, 16)
    behind = lambda c: F.col(c).bitwiseAND(0xFFFF)
    sides = F.array(
        side(True, "start", "first.doc_id", "first.row", "first.start", before("around_first") == before("first.around")),
        side(False, "end", "last.doc_id", "last.row", "last.end", behind("around_last") == behind("last.around")),
    )
    edges = runs.filter(F.col("high") - F.col("low") >= ANCHOR).select("doc_id", "row", "run", F.inline(sides))
    edges = work.write(edges.filter("next").drop("next"), "edges")
    most, steps = FIRST_LOOK, []
    while True:
        met = work.write(compared(docs, edges, most, work), "met")
        steps.append(met.select("doc_id", "row", "run", "left", "n", "to"))
        edges = met.filter("open").select(
            "doc_id", "row", "run", "left", F.col("to").alias("place"), "k_doc", "k_row", F.col("k_to").alias("k_place")
        )
        if edges.isEmpty():
            break
        most *= 8
    moved = (
        reduce(DataFrame.unionByName, steps)
        .groupBy(F.col("doc_id").alias("m_doc"), F.col("row").alias("m_row"), F.col("run").alias("m_run"))
        .agg(
            F.sum(F.when(F.col("left"), F.col("n"))).alias("m_low"), F.min(F.when(F.col("left"), F.col("to"))).alias("m_start"),
            F.sum(F.when(~F.col("left"), F.col("n"))).alias("m_high"), F.max(F.when(~F.col("left"), F.col("to"))).alias("m_end"),
        )
    )
    joined = runs.join(
        moved, F.col("doc_id").eqNullSafe(F.col("m_doc")) & (F.col("row") == F.col("m_row")) & (F.col("run") == F.col("m_run")), "left"
    )
    return joined.select(
        "doc_id", "row", F.coalesce("m_start", "start").alias("start"), F.coalesce("m_end", "end").alias("end"),
        (F.col("low") - F.coalesce("m_low", F.lit(0))).alias("low"), (F.col("high") + F.coalesce("m_high", F.lit(0))).alias("high"),
        "n_units", F.col("first.doc_id").alias("kept"),
    )


def repeated_spans(docs: DataFrame, work: Workspace, min_words: int = 30) -> DataFrame:
    """(doc_id, row, start, end, n_units, n_words, kept_doc_id): one row per removed span.

    Offsets are code points of the original text, end exclusive.  ``kept_doc_id``
    holds the first unit's earliest occurrence.  ``n_units`` counts whole repeated units;
    the words of an extension count in ``n_words``.  A unit that occurs twice within a
    document counts as repeated as well.  Null and empty texts have no units.  Null
    ids rank before all others, and equal ids by a hash of their texts (``row``);
    rows that repeat in id and text are one document and come once.  An empty
    table gives an empty one.  Other columns are not read.
    A digest's occurrences are reduced by partial minima, so a unit that a third of
    the documents share costs one row per task in the first shuffle, and Spark can
    split it in the join.
    """
    found = work.write(units(docs), "units")
    place = F.struct("doc_id", "row", "pos", "start", "end", "around")
    first = found.groupBy("key", "tail").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    first = work.write(first, "first")  # as a table, so that the join's shuffles are its own and can be split
    later = (
        found.join(first, ["key", "tail"]).filter(~place.eqNullSafe(F.col("first")))
        .select("doc_id", "row", "pos", "at", "start", "end", "words", "around", "first")
    )
    document = Window.partitionBy("doc_id", "row")
    # Repeated rows have the same places: dense_rank, and no sums over a run's rows.
    runs = later.withColumn("run", F.col("pos") - F.dense_rank().over(document.orderBy("pos")))
    runs = runs.groupBy("doc_id", "row", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max("pos") - F.min("pos") + 1).cast("long").alias("n_units"),
        F.min("at").alias("low"), F.max(F.col("at") + F.col("words")).alias("high"),
        F.min_by("first", "pos").alias("first"), F.max_by("first", "pos").alias("last"),
        F.min_by("around", "pos").alias("around_first"), F.max_by("around", "pos").alias("around_last"),
    )
    reached = extended(docs, work.write(runs, "runs"), work)
    # Runs that meet or overlap are one: word places tell.
    ahead = document.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    apart = reached.withColumn("new", F.coalesce(F.col("low") > F.max("high").over(ahead), F.lit(True)).cast("int"))
    apart = apart.withColumn("island", F.sum("new").over(document.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0)))
    return (
        apart.groupBy("doc_id", "row", "island")
        .agg(
            F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_units").alias("n_units"),
            (F.max("high") - F.min("low")).cast("long").alias("n_words"), F.min_by("kept", "low").alias("kept_doc_id"),
        )
        .filter(F.col("n_words") >= min_words)
        .drop("island")
    )


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans cut out of ``text``; white space around a cut stays."""
    cuts = spans.groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cuts")
    )

    @F.udf("string", useArrow=True)
    def cut(text, gone):
        if not gone:
            return text
        edges = [0, *(x for s in gone for x in (s["start"], s["end"])), len(text)]
        return "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))

    joined = docs.join(
        cuts, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__row")), "left"
    )
    return joined.withColumn("text", cut("text", "__cuts")).drop("__id", "__row", "__cuts")
