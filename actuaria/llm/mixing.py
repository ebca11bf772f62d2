"""Operator 6: mix sources to target weights.

Every document gets a pseudo-random key (md5 of a seed and its id).  Within a
source the documents are range-partitioned by that key and sorted, distributed
prefix sums of word counts place every document, and the cut falls exactly on
the source's budget: whole epochs first, then the documents before the cut, the
one on the cut in part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actuaria.llm.common import Workspace, sized, word_count

#: Empty matches between a word and the white space behind it.
WORD_END_RE = "(?<=[^\\x20\\x09-\\x0D])(?=[\\x20\\x09-\\x0D])"


def source_targets(sources: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """``sources`` (source, source_size, n_docs), one row per source → with ``target``.

    Sources in code-point order, null last, take the weights in turn.  They share
    the sum of all sizes by weight, but none above ``max_epochs`` times its size:
    the excess goes to the others by weight.  So target = min(cap, level * weight)
    with one common level.  Over the sources sorted by cap/weight, the level if all
    before are capped falls once it fits, so the highest that fits is the first.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = sources.withColumn(
        "weight",
        F.element_at(
            cycle,
            F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))).cast("int") + 1,
        ).cast("long"),
    ).withColumn("cap", F.col("source_size") * max_epochs)
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / F.sum(
        "weight"
    ).over(onward).cast("double")
    return (
        ranked.withColumn("level", level)
        .withColumn("fits", F.col("level") <= F.col("cap").cast("double") / F.col("weight").cast("double"))
        .withColumn("common", F.max(F.when(F.col("fits"), F.col("level"))).over(everything))
        .select(
            "source", "source_size", "n_docs",
            F.least(F.col("cap").cast("double"), F.coalesce("common", F.lit(0.0)) * F.col("weight").cast("double")).alias("target"),
        )
    )


def random_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def mix_sources(
    docs: DataFrame,
    work: Workspace,
    weights: Sequence[int] = (1, 2, 3),
    max_epochs: int = 3,
    seed: str = "mix:",
    rows_per_range: int = 4096,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row per row of ``docs``.

    ``size`` counts words; ``taken`` counts the words that the mix takes from the
    document, repeats included.  Sum of ``taken`` per source = floor(target).
    Null texts and texts without words have size 0 and taken 0.  Null sources are
    one source, the last.  Null ids share one key; rows that tie in key, id and
    size are alike for the result, so reruns agree.  Repeated rows count each.  An
    empty table gives an empty one.  Other columns of ``docs`` are not read.
    A hot source is cut into ranges of about ``rows_per_range`` documents, so no
    window group grows with the source.
    """
    sized = work.write(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), random_key(F.col("doc_id"), seed).alias("key")),
        "sized",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = work.write(source_targets(totals, weights, max_epochs), "targets").withColumnRenamed("source", "s")

    share = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    placed = (
        sized.join(targets, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("range", F.floor(share * F.ceil(F.col("n_docs") / F.lit(rows_per_range))).cast("int"))
        .drop("s", "n_docs")
    )
    ranges = placed.groupBy("source", "range").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("ahead")
    )
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = summed.join(ranges, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor("target").cast("long") - F.col("epochs") * F.col("source_size") - F.col("ahead") - F.col("inside")
    return joined.withColumn("epochs", epochs).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.least(F.greatest(rest, F.lit(0)), F.col("size"))).cast("long").alias("taken"),
    )


def repeat_taken(docs: DataFrame, work: Workspace, **options) -> DataFrame:
    """The mixed documents themselves, columns of ``docs``: for the pipeline.

    A document comes once for each time it is taken; a last partial time holds its
    first words up to the cut, white space as it was.  Documents of which nothing
    is taken go, so those without words go.  ``n_chars``, where present, counts
    the new text.  Rows that share id, source and size share the words taken for
    them evenly, in whole words.
    """
    names = docs.columns
    taken = mix_sources(docs, work, **options)
    shared = taken.groupBy("doc_id", "source", "size").agg(F.floor(F.sum("taken") / F.count(F.lit(1))).cast("long").alias("__taken"))
    shared = work.write(
        shared.filter("__taken > 0").select(
            F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "__taken"
        ),
        "taken",
    )
    mixed = docs.withColumn("__words", word_count(F.col("text"))).join(
        sized(shared),
        F.col("doc_id").eqNullSafe(F.col("__id"))
        & F.col("source").eqNullSafe(F.col("__source"))
        & (F.col("__words") == F.col("__size")),
    )
    times = F.ceil(F.col("__taken") / F.col("__size")).cast("int")
    mixed = mixed.withColumn("__time", F.explode(F.sequence(F.lit(1), times)))
    left = (F.col("__taken") - (F.col("__time") - 1) * F.col("__size")).cast("int")
    upto = F.array_join(F.slice(F.split("text", WORD_END_RE), 1, left), "")
    mixed = mixed.withColumn("text", F.when(left < F.col("__size"), upto).otherwise(F.col("text")))
    if "n_chars" in names:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(*[F.col(f"`{c}`") for c in names])
