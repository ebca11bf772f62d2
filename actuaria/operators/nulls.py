"""Null and completeness profiles.

The reference writes these as one UNION ALL branch per column, each with its
own scan and a scalar-subquery total (or a theta OR-join against a list of
column names).  Here every profile is ONE aggregation pass over the input —
one conditional count per column plus the total — unpivoted afterwards with
``inline(array(struct ...))``; the unpivot runs on a single row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actuaria.functions.expr import count_if, pct


def unpivot(row: DataFrame, entries: Sequence[Sequence[tuple[str, Column]]]) -> DataFrame:
    """Turn a one-row metrics frame into one output row per entry."""
    return row.select(F.inline(F.array(*[F.struct(*[c.alias(n) for n, c in e]) for e in entries])))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``_total`` plus ``_n{i}`` = NULL count of ``columns[i]``."""
    return df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)],
    )


def null_profile(df: DataFrame, columns: Sequence[str], pct_name: str = "null_percentage",
                 digits: int = 2, floor_one: bool = False) -> DataFrame:
    """(column_name, null_count, <pct_name>) for each column, one scan.

    ``floor_one`` reproduces the as-written theta LEFT JOIN + ``COUNT(*)``:
    a column with no NULL still yields one null-extended row, so its count is
    ``greatest(n, 1)``.  That closed form replaces the nested-loop join.
    """
    counts = null_counts(df, columns)
    entries = []
    for i, c in enumerate(columns):
        n = F.col(f"_n{i}")
        if floor_one:
            n = F.greatest(n, F.lit(1)).cast("bigint")
        entries.append([
            ("column_name", F.lit(c)),
            ("null_count", n),
            (pct_name, pct(n, F.col("_total"), digits)),
        ])
    return unpivot(counts, entries)


def completeness(df: DataFrame, checks: Mapping[str, Column], label: str = "column_name",
                 total: str = "total_records", filled: str = "non_null_count",
                 pct_name: str = "completeness_percent") -> DataFrame:
    """(label, total, filled, pct) per named predicate, one scan."""
    names = list(checks)
    row = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[count_if(checks[k]).alias(f"_k{i}") for i, k in enumerate(names)],
    )
    entries = [
        [
            (label, F.lit(k)),
            (total, F.col("_total")),
            (filled, F.col(f"_k{i}")),
            (pct_name, pct(F.col(f"_k{i}"), F.col("_total"))),
        ]
        for i, k in enumerate(names)
    ]
    return unpivot(row, entries)


def critical_nulls(df: DataFrame, checks: Mapping[str, Column], pass_text: str, fail_text: str) -> DataFrame:
    """Status, problematic_records, affected_columns (sorted, distinct).

    ``checks`` maps a column name to the predicate that marks a problematic
    row; predicates keep SQL three-valued logic (a NULL predicate never
    counts, e.g. ``gender IS NULL AND gender NOT IN (...)``).
    """
    names = sorted(checks)
    row = df.agg(*[count_if(checks[k]).alias(f"_c{i}") for i, k in enumerate(names)])
    total = sum((F.col(f"_c{i}") for i in range(len(names))), F.lit(0)).cast("bigint")
    affected = F.concat_ws(", ", *[F.when(F.col(f"_c{i}") > 0, F.lit(k)) for i, k in enumerate(names)])
    return row.select(
        F.when(total == 0, F.lit(pass_text)).otherwise(F.lit(fail_text)).alias("status"),
        total.alias("problematic_records"),
        F.when(total > 0, affected).alias("affected_columns"),
    )
