"""Operator 11: spelling variants by PartEnum signatures.

A word's letters, numbered by occurrence ("letter a, second one"), are a binary vector.
One replaced letter changes two of its places and one inserted or deleted letter one, so
words one edit apart are near in Hamming distance: at most two between words of one
length, one between lengths that differ by one.

The places are dealt over PARTS parts by a hash.  Of vectors that differ in at most k places, all but k
parts agree, so a signature for every choice of parts without k of them, made of the letters in
these, meets in at least one choice: equal signatures are joined, nothing is missed, and every pair is
verified by its edit distance.  Lengths are part of a signature (a class of one length
with k = 2, a class of each two neighbouring lengths with k = 1), as PartEnum does with set sizes.

A signature that more than ``hot`` words share is replaced by two finer ones, with the first and with the last half of
the word: an edit leaves one of the halves as it is, so this loses nothing either.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actuaria.llm.common import Workspace, slices, texts_of

#: Parts that a vector's places are dealt over, for k = 2 and for k = 1.
PARTS = {2: 5, 1: 3}
#: Distinct words that a task counts before it hands its counts on.
HELD = 200_000
COUNTS = "word string, n long"


def damaged_words(docs: DataFrame, least: int, every: int | None) -> DataFrame:
    """(word, n): the words of at least ``least`` code points with partial counts, a word in several rows.

    With ``every``, a run of which the crc32 of ``<doc_id>:<run>`` is divisible by it loses its code point
    crc % length first; a null id is written as nothing.
    """
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in slices(batches, "text", 4 << 20):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                # bytes.lower() changes A-Z alone
                found = Counter(runs.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in found.items():
                    h = zlib.crc32(run.encode(), before) if every else 1
                    if every and h % every == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least:
                            continue
                    held[run] += n
                if len(held) >= HELD:
                    yield table()
                    held.clear()
        if held:
            yield table()

    return docs.select("doc_id", "text").mapInArrow(emit, COUNTS)


def part_hashes(words: list[str], parts: int) -> np.ndarray:
    """For each word and part the sum of the hashes of its numbered letters in that part."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    place = np.arange(len(codes))
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    nth = place - np.maximum.accumulate(np.where(new, place, 0))
    mixed = mix(codes << np.uint64(40) | nth.astype(np.uint64))
    sums = np.zeros((len(words), parts), dtype=np.uint64)
    np.add.at(sums, (owner, (mixed >> np.uint64(33)) % np.uint64(parts)), mixed)
    return sums


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiplications by odd constants and shifts."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def signatures_of(words: list[str]) -> Iterator[tuple[np.ndarray, int]]:
    """(a signature for every word, 0 or 1 for the smaller or larger length of its class), one array after another."""
    size = np.array([len(w) for w in words], dtype=np.uint64)
    for k, parts in PARTS.items():
        sums = part_hashes(words, parts)
        for number, chosen in enumerate(combinations(range(parts), parts - k)):
            for low in (0,) if k == 2 else (0, 1):
                of_class = (size - np.uint64(low)) * np.uint64(4096) + np.uint64(64 * k + number)
                value = mix(of_class + np.uint64(1))
                for p in chosen:
                    value = mix(value * np.uint64(31) + sums[:, p])
                yield value.view(np.int64), low


def signatures(words: DataFrame) -> DataFrame:
    """(sig, low, word) of every word: low is 1 where the word is the longer one of a class of two lengths."""
    schema = "sig long, low int, word string"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", 1 << 18):
            own = batch.column("word").to_pylist()
            for values, low in signatures_of(own):
                lows = pa.array(np.full(len(own), low, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(values), lows, batch.column("word")], ["sig", "low", "word"])

    return words.select("word").mapInArrow(emit, schema)


def near_pairs(words: DataFrame, work: Workspace, hot: int = 32) -> DataFrame:
    """(a, b): every pair of different words one edit apart, once, a before b.

    The words of a signature are listed by at most ``hot`` in a row.  One row holds a small signature whole, and its
    pairs are made in the row; the words of larger ones are joined on the signature and a half of the word.
    """
    alike = Window.partitionBy("sig")
    placed = signatures(words).withColumn("at", F.row_number().over(alike.orderBy("word", "low")))
    counted = placed.withColumn("size", F.count(F.lit(1)).over(alike)).filter("size > 1")
    lists = counted.groupBy("sig", "size", F.floor((F.col("at") - 1) / hot).alias("part")).agg(
        F.collect_list(F.struct("word", "low")).alias("words")
    )
    lists = work.write(lists, "lists")
    one = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    small = lists.filter(F.col("size") <= hot).select("words", F.explode("words").alias("a")).select("a", F.explode("words").alias("b"))
    # The longer word of a class is cut by the shorter one's length: an edit leaves the first or the last part as it is.
    size = F.length("w.word") - F.col("w.low")
    first = (size / 2).cast("int")
    halves = F.array(
        F.concat(F.lit("<"), F.substring("w.word", F.lit(1), first)), F.concat(F.lit(">"), F.right("w.word", size - first))
    )
    large = lists.filter(F.col("size") > hot).select("sig", F.explode("words").alias("w"))
    large = work.write(large.select("sig", F.explode(halves).alias("half"), F.col("w.word").alias("word")), "large")
    met = large.select("sig", "half", F.struct("word").alias("a")).join(large.select("sig", "half", F.struct("word").alias("b")), ["sig", "half"])
    pairs = [df.filter((F.col("a.word") < F.col("b.word")) & one).select(F.col("a.word").alias("a"), F.col("b.word").alias("b")) for df in (small, met)]
    return pairs[0].unionByName(pairs[1]).distinct()


def roots(forms: DataFrame, work: Workspace) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last, by doubling.

    A form is ``ratio`` times as frequent as its word, so paths are as short as the logarithm of the largest count.
    """
    step = work.write(forms.select("word", F.col("form").alias("root")), "step0")
    k = 0
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("last"))
        joined = step.join(further, "root", "left")
        k += 1
        step = work.write(joined.select("word", F.coalesce("last", "root").alias("root"), F.col("last").isNotNull().alias("moved")), f"step{k}")
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        step = step.drop("moved")


def variants(counts: DataFrame, work: Workspace, ratio: int = 10, hot: int = 32) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for (word, n), each word once and null words left out.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point.
    ``form`` is the near word of the largest n, the smallest in code-point order of several, if that n is at least
    ``ratio`` times the word's; else null.  ``root`` is the last form that is reached from the word, or the word itself;
    as n grows from form to form, there is no circle.  ``n_near`` counts near words, 0 if there are none.
    A word of any length has as many signatures as a short one.  An empty table gives an empty one.
    """
    words = work.write(counts.filter("word IS NOT NULL").select("word", F.col("n").cast("long")), "words")
    pairs = work.write(near_pairs(words, work, hot), "pairs")
    both = pairs.toDF("word", "other").union(pairs.select("b", "a"))
    both = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    first = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first.alias("first"))
    near = work.write(best.select("word", "n_near", F.col("first.form").alias("form"), (-F.col("first.less")).alias("form_n")), "near")
    strong: Column = F.col("form_n") >= ratio * F.col("n")
    told = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("form")).alias("form"),
        F.when(strong, F.col("form_n")).alias("form_n"),
    )
    told = work.write(told, "told")
    ends = roots(told.filter("form IS NOT NULL"), work)
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, work: Workspace, least: int = 7, fewest: int = 2, every: int | None = 31) -> DataFrame:
    """``variants`` of the words of ``text`` that come at least ``fewest`` times.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of at least ``least`` code points; null and empty texts
    have none.  ``every`` damages some of them (see ``damaged_words``); null switches this off.
    Repeated rows count again.  Other columns than doc_id and text are not read.
    Words are counted inside the tasks, so the shuffle carries each word once a task, however frequent it is.
    """
    counts = damaged_words(docs, least, every).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)
    return variants(counts, work)
