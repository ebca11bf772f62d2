"""Segment summaries, shares, ratio KPIs and waterfalls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actuaria.functions.expr import div, first_match
from actuaria.operators.nulls import unpivot


def top_k(df: DataFrame, order: Sequence[Column], k: int | None) -> DataFrame:
    """ORDER BY ... LIMIT k as a top-k (``TakeOrderedAndProject``).

    Callers pass the reference's sort keys followed by unique tie-breakers so
    the rows kept at the LIMIT edge do not depend on the plan (P4).
    """
    ordered = df.orderBy(*order)
    return ordered.limit(k) if k is not None else ordered


def sorted_small(df: DataFrame, *order: Column) -> DataFrame:
    """ORDER BY for outputs whose size is fixed by the query (one row per
    listed column / step): sorted in one partition, without the sampling job
    and exchange a global range sort plans.  Not for data-sized outputs."""
    return df.coalesce(1).sortWithinPartitions(*order)


def segment_summary(
    df: DataFrame,
    keys: Sequence[str | Column],
    metrics: Sequence[Column],
    order: Sequence[Column] | None = None,
    k: int | None = None,
    where: Column | None = None,
    having: Column | None = None,
) -> DataFrame:
    """Filter → group by keys → metrics → having → ordered top-k."""
    src = df.where(where) if where is not None else df
    out = src.groupBy(*keys).agg(*metrics)
    if having is not None:
        out = out.where(having)
    if order is not None:
        out = top_k(out, order, k)
    return out


def with_share(grouped: DataFrame, count_col: str, name: str, digits: int = 2) -> DataFrame:
    """``ROUND(n * 100.0 / SUM(n) OVER (), digits)`` on an aggregated frame.

    The un-partitioned window runs on the aggregated rows only (one row per
    group), never on the fact rows.
    """
    total = F.sum(F.col(count_col)).over(Window.partitionBy())
    return grouped.withColumn(
        name, F.round(F.try_divide(F.col(count_col).cast("double") * F.lit(100.0), total.cast("double")), digits)
    )


def tier(ratio: Column, tiers: Sequence[tuple[str, float]], rest: str) -> Column:
    """N20 tier: first band whose bound exceeds the ratio; NULL ratio → ``rest``."""
    return first_match([(ratio < F.lit(bound), label) for label, bound in tiers], rest)


def margin_pct(revenue: Column, cost: Column, digits: int = 2) -> Column:
    """``ROUND((1 - cost / NULLIF(revenue, 0)) * 100, digits)``."""
    return F.round((F.lit(1.0) - div(cost, revenue)) * F.lit(100.0), digits)


def waterfall(df: DataFrame, steps: Sequence[tuple[str, Column]], value_name: str = "value",
              label_name: str = "metric", order_name: str = "cumulative_order") -> DataFrame:
    """One aggregation, one output row per step in order (was a 4-scan UNION ALL)."""
    row = df.agg(*[agg.alias(f"_w{i}") for i, (_, agg) in enumerate(steps)])
    entries = [
        [(label_name, F.lit(label)), (value_name, F.col(f"_w{i}")), (order_name, F.lit(i))]
        for i, (label, _) in enumerate(steps)
    ]
    return unpivot(row, entries)
