"""Monitoring catalogue: 8 scheduled checks on the legacy fact.

The clock (``CURRENT_DATE`` / ``NOW()``) is the explicit ``as_of``; every
time window is a range on ``ingested_at`` that reaches the parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria import constants as K
from actuaria.functions.expr import count_if, pct
from actuaria.operators.batches import as_date, month_start, on_day, period_summary, since, ts_ntz
from actuaria.operators.nulls import null_profile


def _n():
    return F.count(F.lit(1))


def mon_2_1_health(f: DataFrame) -> DataFrame:
    """Row count of the latest ingest day (not the whole table) vs the floor."""
    g = f.groupBy(F.to_date("ingested_at").alias("_day")).agg(
        _n().alias("current_row_count"),
        F.to_date(F.max("ingested_at")).alias("latest_ingestion_date"),
    )
    return g.select(
        F.lit("fact_insurance_performance").alias("table_name"),
        "current_row_count", "latest_ingestion_date",
        F.when(F.col("current_row_count") > K.HEALTHY_MIN_ROWS, F.lit(K.HEALTH_OK))
        .otherwise(F.lit(K.HEALTH_CHECK)).alias("status"),
    ).orderBy(F.col("latest_ingestion_date").desc_nulls_first()).limit(1)


def mon_2_2_weekly(f: DataFrame, as_of) -> DataFrame:
    start = as_date(as_of) - _dt.timedelta(days=7)
    return period_summary(
        f, "week", start,
        [
            _n().alias("records_processed"),
            F.count_distinct("territory_label").alias("territories_covered"),
            count_if(F.col("territory_label") != K.UNKNOWN_TERRITORY).alias("matched_territories"),
        ],
    ).orderBy(F.col("week_starting").desc_nulls_first())


def mon_2_3_monthly(f: DataFrame, as_of) -> DataFrame:
    start = month_start(as_date(as_of), 1)
    gender = count_if(F.col("gender").isNotNull())
    matched = count_if(F.col("territory_label") != K.UNKNOWN_TERRITORY)
    return f.where(since("ingested_at", start)).agg(
        F.date_format(F.max("ingested_at"), "yyyy-MM").alias("month"),
        _n().alias("total_records"),
        gender.alias("gender_populated"),
        matched.alias("territory_matched"),
        pct(gender, _n()).alias("gender_completeness_pct"),
        pct(matched, _n()).alias("territory_match_pct"),
    )


def mon_2_4_today(f: DataFrame, as_of) -> DataFrame:
    day = as_date(as_of)
    return f.where(on_day("ingested_at", day)).groupBy(F.to_date("ingested_at").alias("_d")).agg(
        F.lit("DAG 1: Ingestion").alias("dag_name"),
        F.max("ingested_at").alias("last_run"),
        _n().alias("records_from_last_batch"),
    ).drop("_d")


def mon_2_5_nulls(f: DataFrame) -> DataFrame:
    return null_profile(f, ["GEO_id", "gender", "territory_label"], pct_name="null_pct")


def mon_5_1_stale(f: DataFrame, as_of) -> DataFrame:
    last = F.max("ingested_at")
    return f.agg(
        F.when(last < ts_ntz(as_of - _dt.timedelta(hours=24)), F.lit(K.PIPELINE_STALE))
        .otherwise(F.lit(K.PIPELINE_RECENT)).alias("status"),
        last.alias("last_run_time"),
    )


def mon_5_2_gender(f: DataFrame, as_of) -> DataFrame:
    """Today's gender completeness; no rows today → NULL → 'OK' (0/0 guarded)."""
    p = pct(count_if(F.col("gender").isNotNull()), _n())
    return f.where(since("ingested_at", as_date(as_of))).agg(
        F.when(p < K.GENDER_ALERT_PCT, F.lit(K.GENDER_LOW)).otherwise(F.lit(K.GENDER_OK)).alias("quality_status"),
        p.alias("gender_completeness_pct"),
    )


def mon_3_1_daily(f: DataFrame, as_of) -> DataFrame:
    return f.agg(
        F.lit("Daily Health Check").alias("report_name"),
        ts_ntz(as_of).alias("check_time"),
        _n().alias("total_records"),
    ).limit(1)


LEGACY = {
    "mon_2_1_health": mon_2_1_health,
    "mon_2_2_weekly": mon_2_2_weekly,
    "mon_2_3_monthly": mon_2_3_monthly,
    "mon_2_4_today": mon_2_4_today,
    "mon_2_5_nulls": mon_2_5_nulls,
    "mon_5_1_stale": mon_5_1_stale,
    "mon_5_2_gender": mon_5_2_gender,
    "mon_3_1_daily": mon_3_1_daily,
}
NEEDS_AS_OF = {"mon_2_2_weekly", "mon_2_3_monthly", "mon_2_4_today", "mon_5_1_stale", "mon_5_2_gender",
               "mon_3_1_daily"}
