"""Batch, freshness and trend operators.

Time-window predicates are written as plain range comparisons on the raw
timestamp column so they reach the parquet scan as pushed filters (a
``to_date(col) = d`` test is rewritten to ``d <= col < d + 1``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actuaria.functions.expr import div


def ts_ntz(value: _dt.datetime | _dt.date) -> Column:
    """A timezone-free timestamp literal (string → TIMESTAMP_NTZ)."""
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime.combine(value, _dt.time())
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def as_date(value) -> _dt.date:
    return value.date() if isinstance(value, _dt.datetime) else value


def on_day(ts_col: str, day: _dt.date) -> Column:
    """``DATE(ts) = day`` as a pushable half-open range."""
    return (F.col(ts_col) >= ts_ntz(day)) & (F.col(ts_col) < ts_ntz(day + _dt.timedelta(days=1)))


def since(ts_col: str, start: _dt.datetime | _dt.date) -> Column:
    return F.col(ts_col) >= ts_ntz(start)


def month_start(day: _dt.date, months_back: int = 0) -> _dt.date:
    y, m = day.year, day.month - months_back
    while m <= 0:
        y, m = y - 1, m + 12
    return _dt.date(y, m, 1)


def years_before(day: _dt.date, years: int) -> _dt.date:
    """Calendar subtraction (``d - INTERVAL 'n years'``); Feb 29 → Feb 28."""
    try:
        return day.replace(year=day.year - years)
    except ValueError:
        return day.replace(year=day.year - years, day=28)


def daily_counts(df: DataFrame, ts_col: str = "ingested_at", date_name: str = "ingestion_date",
                 count_name: str = "record_count") -> DataFrame:
    return df.groupBy(F.to_date(ts_col).alias(date_name)).agg(F.count(F.lit(1)).alias(count_name))


def row_count_trend(df: DataFrame, ts_col: str = "ingested_at") -> DataFrame:
    """Per day count, previous day's count, change and % change.

    The window has no partition key but runs over the per-day aggregate
    (one row per calendar day), never over the fact rows.
    """
    d = daily_counts(df, ts_col, "ingestion_date", "daily_record_count")
    prev = F.lag("daily_record_count").over(Window.orderBy("ingestion_date"))
    change = F.col("daily_record_count") - F.col("previous_day_count")
    return d.withColumn("previous_day_count", prev).select(
        "ingestion_date", "daily_record_count", "previous_day_count",
        change.alias("record_change"),
        F.round(div(change, F.col("previous_day_count")) * F.lit(100.0), 2).alias("pct_change"),
    )


def batch_count_stats(df: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """N12 input: one row with batches, mean/min/max/stddev of per-batch counts."""
    per = df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(
        F.count_distinct(batch_col).alias("_batches"),
        F.try_divide(F.sum("_n").cast("double"), F.count("_n").cast("double")).alias("_avg"),
        F.min("_n").alias("_min"),
        F.max("_n").alias("_max"),
        F.stddev_samp("_n").alias("_std"),
    )


def period_summary(df: DataFrame, grain: str, start, metrics: list[Column], ts_col: str = "ingested_at",
                   label: str = "week_starting") -> DataFrame:
    """Rows since ``start`` grouped by ``date_trunc(grain, ts)`` as a DATE.

    ``grain`` is any ``date_trunc`` unit ('week' starts on Monday, 'month');
    the ``since`` filter is a pushable range on the raw timestamp.
    """
    return df.where(since(ts_col, start)).groupBy(
        F.to_date(F.date_trunc(grain, ts_col)).alias(label)
    ).agg(*metrics)
