"""Validity and consistency checks (N7-N10), each a single aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actuaria.functions.expr import count_if, pct, try_date
from actuaria.operators.nulls import unpivot


def cast_validity(df: DataFrame, columns: Sequence[str], to: str, with_bad: bool = False) -> DataFrame:
    """Per field, rows with a value and how many of them cast to ``to``.

    ``with_bad`` adds the rows whose value does not cast, as ``bad``.

    The catalogue names the first count ``non_numeric_count`` although it is
    the non-NULL count; the name is kept.  ``try_cast`` replaces a failing
    CAST, so one bad value no longer aborts the whole report.
    """
    row = df.agg(*[
        agg
        for i, c in enumerate(columns)
        for agg in (
            count_if(F.col(c).isNotNull()).alias(f"_nn{i}"),
            count_if(F.col(c).try_cast(to).isNotNull()).alias(f"_ok{i}"),
        )
    ])
    return unpivot(row, [
        [("field", F.lit(c)), ("non_numeric_count", F.col(f"_nn{i}")), ("valid_numeric", F.col(f"_ok{i}"))]
        + ([("bad", F.col(f"_nn{i}") - F.col(f"_ok{i}"))] if with_bad else [])
        for i, c in enumerate(columns)
    ])


def match_counts(df: DataFrame, matched: Column) -> DataFrame:
    """Total, matched, unmatched and match percentage in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        count_if(matched).alias("matched"),
        count_if(~matched).alias("unmatched"),
    ).withColumn("match_percentage", pct(F.col("matched"), F.col("total_records")))


def date_range_counts(df: DataFrame, text_col: str, lo, hi) -> DataFrame:
    """Text dates inside / outside [lo, hi]; uncastable text counts as neither."""
    d = try_date(text_col)
    return df.where(F.col(text_col).isNotNull()).agg(
        F.count(F.lit(1)).alias("total_records"),
        count_if((d >= F.lit(lo)) & (d <= F.lit(hi))).alias("valid_dates"),
        count_if((d < F.lit(lo)) | (d > F.lit(hi))).alias("invalid_dates"),
    )


def sign_counts(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """``positive_<name>`` / ``zero_or_negative_<name>`` per column."""
    present = None
    for c, _ in columns:
        p = F.col(c).isNotNull()
        present = p if present is None else present | p
    return df.where(present).agg(
        F.count(F.lit(1)).alias("total_records"),
        *[
            agg
            for c, name in columns
            for agg in (
                count_if(F.col(c) > 0).alias(f"positive_{name}"),
                count_if(F.col(c) <= 0).alias(f"zero_or_negative_{name}"),
            )
        ],
    )
