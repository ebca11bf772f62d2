"""Bucketing (N18): label + sort order from ordered upper bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from actuaria.functions.expr import first_match


def bucket_below(x: Column, bands: Sequence[tuple[str, float]], rest: str | None) -> tuple[Column, Column]:
    """``CASE WHEN x < b1 THEN l1 ... ELSE rest END`` and its 1-based sort order.

    A NULL ``x`` falls through every ``<`` test: it gets ``rest`` (as SQL's
    ELSE does) when ``rest`` is given, else NULL.
    """
    label = first_match([(x < F.lit(b), lbl) for lbl, b in bands], rest)
    order = first_match([(x < F.lit(b), i + 1) for i, (_, b) in enumerate(bands)],
                        len(bands) + 1 if rest is not None else None)
    return label, order


def bucket_equal(x: Column, points: Sequence[tuple[str, float]], at_least: tuple[str, float] | None) -> tuple[Column, Column]:
    """``CASE WHEN x = p1 THEN l1 ... WHEN x >= last THEN lbl END`` (no ELSE → NULL)."""
    cases = [(x == F.lit(p), lbl) for lbl, p in points]
    orders = [(x == F.lit(p), i + 1) for i, (_, p) in enumerate(points)]
    if at_least is not None:
        cases.append((x >= F.lit(at_least[1]), at_least[0]))
        orders.append((x >= F.lit(at_least[1]), len(points) + 1))
    return first_match(cases), first_match(orders)
