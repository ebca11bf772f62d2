"""Quality score and alert inputs.

Both the report card and the alert need table-wide counts AND the number of
duplicate key groups.  The reference computes them with one scan per check
plus a scalar subquery per duplicate test; here one grouping on the
duplicate key carries every other metric along as a partial aggregate, so
the whole report is one scan and one shuffle:

    rows ──groupBy(dup key)──▶ per-group (n, non-null/matched counts, max ts)
         ──global agg──────▶ one metrics row

Metrics that depend only on key columns (NULL counts of key columns) are
derived from the group key itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actuaria.functions.expr import count_if


def metrics_with_dup_groups(
    df: DataFrame,
    keys: Sequence[str],
    counts: Mapping[str, Column],
    max_of: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row: ``_total``, ``_dup_groups`` and every named count / max.

    ``counts`` maps an output name to a row predicate; ``max_of`` maps an
    output name to a column whose maximum is wanted.
    """
    max_of = dict(max_of or {})
    per = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[count_if(p).alias(f"_c_{name}") for name, p in counts.items()],
        *[F.max(c).alias(f"_m_{name}") for name, c in max_of.items()],
    )
    return per.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("_total"),
        F.count(F.when(F.col("_n") > 1, F.lit(1))).alias("_dup_groups"),
        *[F.coalesce(F.sum(f"_c_{name}"), F.lit(0)).cast("bigint").alias(name) for name in counts],
        *[F.max(f"_m_{name}").alias(name) for name in max_of],
    )


def grade(score: Column, bands: Sequence[tuple[float, str]], rest: str) -> Column:
    """First band whose minimum the score reaches (bands in descending order)."""
    out = None
    for lo, label in bands:
        out = F.when(score >= F.lit(lo), F.lit(label)) if out is None else out.when(score >= F.lit(lo), F.lit(label))
    return out.otherwise(F.lit(rest))
