"""Duplicate detection.

Key-based duplicates group on the key columns (NULL keys form one group, as
in SQL GROUP BY).  Counting is a combinable aggregate, so a hot key (one key
holding a third of the rows) is collapsed map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprint(columns: Sequence[str], sep: str = "||", null_token: str | None = None) -> Column:
    """``MD5(CONCAT_WS(sep, ...))``; NULLs are skipped like CONCAT_WS does.

    With ``null_token`` a NULL counts as that text, so ("a", NULL, "b") and
    ("a", "b", NULL) differ.
    """
    texts = [F.col(c).cast("string") for c in columns]
    if null_token is not None:
        texts = [F.coalesce(t, F.lit(null_token)) for t in texts]
    return F.md5(F.concat_ws(sep, *texts))


def group_counts(df: DataFrame, keys: Sequence[str | Column], count_name: str = "record_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))


def duplicate_groups(df: DataFrame, keys: Sequence[str | Column], count_name: str = "duplicate_count") -> DataFrame:
    """One row per key combination that occurs more than once."""
    return group_counts(df, keys, count_name).where(F.col(count_name) > 1)


def duplicate_stats(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """One row: total rows, duplicate groups, extra rows — one scan, one shuffle.

    All rows are grouped (not only the duplicated ones) so the table total
    comes out of the same pass instead of a second scalar-subquery scan.
    ``_extra`` is NULL when there is no duplicate group (SQL SUM over nothing).
    """
    g = group_counts(df, keys, "_n")
    return g.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("_total"),
        F.count(F.when(F.col("_n") > 1, F.lit(1))).alias("_groups"),
        F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)).cast("bigint").alias("_extra"),
    )


def top_duplicates_with_list(
    df: DataFrame,
    keys: Sequence[str],
    top: int,
    list_col: str,
    list_name: str,
    sep: str = ", ",
) -> DataFrame:
    """Top ``top`` duplicate groups by size, with the sorted list of ``list_col``.

    Rows are first counted per (keys, listed value): the shuffle and every
    later buffer hold distinct values with counts.  The groups are ranked by the
    sums, the top ones (bounded by ``top``) are broadcast and matched with
    null-safe equality, and a value is repeated by its count only when the text
    is formed.
    """
    counts = df.groupBy(*keys, list_col).agg(F.count(F.lit(1)).alias("_n"))
    counted = counts.groupBy(*keys).agg(F.sum("_n").alias("duplicate_count")).where(F.col("duplicate_count") > 1)
    order = [F.col("duplicate_count").desc_nulls_first()] + [F.col(k).asc_nulls_first() for k in keys]
    winners = counted.orderBy(*order).limit(top)
    renamed = winners.select(*[F.col(k).alias(f"_t_{k}") for k in keys], "duplicate_count")
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_t_{k}"))
        cond = c if cond is None else cond & c
    hits = counts.join(F.broadcast(renamed), cond, "inner").where(F.col(list_col).isNotNull())
    valued = F.array_sort(F.collect_list(F.struct(F.col(list_col).alias("v"), F.col("_n").alias("n"))))
    listed = hits.groupBy(*keys, "duplicate_count").agg(valued.alias("_values"))
    text = F.array_join(
        F.flatten(F.transform("_values", lambda x: F.array_repeat(x["v"].cast("string"), x["n"].cast("int")))), sep
    )
    return listed.select(*keys, "duplicate_count", text.alias(list_name))
