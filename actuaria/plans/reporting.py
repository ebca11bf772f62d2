"""Reporting catalogue: 19 queries on the legacy fact (one on silver).

UNION ALL of per-column branches and scalar-subquery totals are answered in
one aggregation pass each (see ``operators.nulls``); every ORDER BY ... LIMIT
carries unique tie-breakers so the rows at the limit edge are fixed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actuaria.functions.expr import (
    avg_exact, avg_round, count_if, fixed2_text, money_round, pct, sum_if, sum_money,
)
from actuaria.constants import UNKNOWN_TERRITORY
from actuaria.operators.checks import cast_validity
from actuaria.operators.duplicates import duplicate_groups
from actuaria.operators.nulls import null_profile, unpivot
from actuaria.operators.segments import segment_summary

DUP_KEYS = ["GEO_id", "gender", "birthdate"]

EXPORT_COLUMNS = [
    "GEO_id", "gender", "birthdate", "territory_label", "territory_area", "territory_town",
    "territory_county", "current_premium", "indicated_premium", "cgr_factor",
    "acs03_total_population", "acs03_median_age", "acs03_married_percent",
    "acs05_total_population", "acs05_speak_english_only", "ingested_at", "batch_id",
]


def _n():
    return F.count(F.lit(1))


def _asc(*cols):
    return [F.col(c).asc_nulls_first() for c in cols]


def rpt_1_1_summary(f: DataFrame) -> DataFrame:
    return f.agg(
        _n().alias("total_records"),
        F.count_distinct("GEO_id").alias("unique_geo_ids"),
        F.count_distinct("territory_label").alias("unique_territories"),
        F.min("ingested_at").alias("earliest_record"),
        F.max("ingested_at").alias("latest_record"),
    )


def rpt_1_2_territory_perf(f: DataFrame) -> DataFrame:
    return segment_summary(
        f, ["territory_label"],
        [
            _n().alias("record_count"),
            avg_exact("current_premium").alias("avg_premium"),
            money_round(F.max("current_premium")).alias("max_premium"),
            money_round(F.min("current_premium")).alias("min_premium"),
        ],
        order=[F.col("record_count").desc_nulls_first(), *_asc("territory_label")], k=20,
        where=F.col("territory_label").isNotNull(),
    )


def rpt_1_3_join_success(f: DataFrame) -> DataFrame:
    unmatched = sum_if(F.col("territory_label") == UNKNOWN_TERRITORY)
    matched = sum_if(F.col("territory_label") != UNKNOWN_TERRITORY)
    return f.agg(
        unmatched.alias("unmatched_territory"),
        matched.alias("matched_territory"),
        pct(matched, _n()).alias("match_percentage"),
    )


def rpt_1_4_census_coverage(f: DataFrame) -> DataFrame:
    return f.agg(
        sum_if(F.col("acs03_total_population").isNotNull()).alias("acs03_coverage"),
        sum_if(F.col("acs05_total_population").isNotNull()).alias("acs05_coverage"),
        _n().alias("total_records"),
    )


def rpt_2_1_nulls(f: DataFrame) -> DataFrame:
    return null_profile(f, ["GEO_id", "gender", "territory_label", "acs03_total_population"])


def rpt_2_2_dup_gold(f: DataFrame) -> DataFrame:
    return duplicate_groups(f, DUP_KEYS).orderBy(
        F.col("duplicate_count").desc_nulls_first(), *_asc(*DUP_KEYS)
    ).limit(20)


def rpt_2_3_dup_silver(silver: DataFrame) -> DataFrame:
    return duplicate_groups(silver, DUP_KEYS).orderBy(F.col("duplicate_count").desc_nulls_first())


def rpt_2_4_type_validity(f: DataFrame) -> DataFrame:
    return cast_validity(f, ["current_premium", "indicated_premium"], "decimal(38,4)")


def rpt_2_5_freshness(f: DataFrame) -> DataFrame:
    return f.groupBy(F.to_date("ingested_at").alias("ingestion_date")).agg(
        _n().alias("record_count"),
        F.min("ingested_at").alias("earliest_time"),
        F.max("ingested_at").alias("latest_time"),
    ).orderBy(F.col("ingestion_date").desc_nulls_first()).limit(10)


def rpt_2_6_batches(f: DataFrame) -> DataFrame:
    return f.groupBy("batch_id").agg(
        _n().alias("record_count"),
        F.count_distinct("GEO_id").alias("unique_geo_ids"),
    ).orderBy(F.col("batch_id").desc_nulls_first())


def rpt_3_1_territory_cards(f: DataFrame) -> DataFrame:
    return segment_summary(
        f, [F.col("territory_label").cast("string").alias("territory")],
        [
            _n().alias("total_records"),
            F.count_distinct("GEO_id").alias("unique_locations"),
            avg_round("current_premium").alias("avg_premium"),
            sum_money("current_premium").alias("total_premium"),
            count_if(F.col("gender") == "M").alias("male_count"),
            count_if(F.col("gender") == "F").alias("female_count"),
        ],
        order=[F.col("total_records").desc_nulls_first(), *_asc("territory")], k=20,
        where=F.col("territory_label").isNotNull(),
    )


def rpt_3_2_territory_demo(f: DataFrame) -> DataFrame:
    return segment_summary(
        f, [F.col("territory_label").cast("string").alias("territory")],
        [_n().alias("record_count"), avg_round("current_premium").alias("avg_premium")],
        order=[F.col("record_count").desc_nulls_first(), *_asc("territory")], k=15,
        where=F.col("territory_label").isNotNull(),
    )


def rpt_3_3_gender(f: DataFrame) -> DataFrame:
    """Share over ALL rows (NULL gender included in the denominator), one scan.

    Group every row by gender (the NULL group included), take the grand total
    with a window over the few aggregated rows, then drop the NULL group.
    """
    g = f.groupBy("gender").agg(
        _n().alias("record_count"),
        avg_round("current_premium").alias("avg_premium"),
        sum_money("current_premium").alias("total_premium"),
    )
    total = F.sum("record_count").over(Window.partitionBy())
    return g.withColumn("percentage", pct(F.col("record_count"), total)).where(
        F.col("gender").isNotNull()
    ).select("gender", "record_count", "percentage", "avg_premium", "total_premium").orderBy(
        F.col("record_count").desc_nulls_first()
    )


def rpt_3_4_census_avg(f: DataFrame) -> DataFrame:
    return f.where(F.col("acs03_total_population").isNotNull()).agg(
        F.lit("Census Records").alias("metric"),
        _n().alias("record_count"),
        F.round(avg_exact("acs03_total_population"), 0).alias("avg_population"),
        avg_round("acs03_median_age", 1).alias("avg_median_age"),
        F.count_distinct("territory_label").alias("territories_with_census"),
    )


def rpt_3_5_premium_dist(f: DataFrame) -> DataFrame:
    return f.agg(
        _n().alias("total_records"),
        avg_round("current_premium").alias("avg_premium"),
        money_round(F.max("current_premium")).alias("max_premium"),
        money_round(F.min("current_premium")).alias("min_premium"),
        F.round(F.stddev_samp("current_premium"), 2).alias("stddev_premium"),
    )


def rpt_3_6_batch_series(f: DataFrame) -> DataFrame:
    return f.groupBy("batch_id").agg(
        F.max("ingested_at").alias("time"),
        _n().alias("records_per_batch"),
        sum_money("current_premium").alias("batch_premium_total"),
        avg_round("current_premium").alias("batch_avg_premium"),
    ).select("time", F.col("batch_id").alias("batch"), "records_per_batch", "batch_premium_total",
             "batch_avg_premium").orderBy(F.col("batch").desc_nulls_first())


def rpt_4_1_health(f: DataFrame) -> DataFrame:
    return f.agg(
        _n().alias("total_records"),
        F.count_distinct("GEO_id").alias("unique_geos"),
        F.count_distinct("territory_label").alias("unique_territories"),
        F.count_distinct("batch_id").alias("total_batches"),
    )


def rpt_4_2_quality_score(f: DataFrame) -> DataFrame:
    """Four completeness metrics as '97.00%' text; the territory metric tests
    IS NOT NULL (as written), so it reads 100 % even with 'Unknown' rows."""
    row = f.agg(
        _n().alias("_total"),
        count_if(F.col("GEO_id").isNotNull()).alias("_geo"),
        count_if(F.col("gender").isNotNull()).alias("_gender"),
        count_if(F.col("territory_label").isNotNull()).alias("_terr"),
        count_if(F.col("acs03_total_population").isNotNull()).alias("_census"),
    )
    metrics = [
        ("GEO_ID Completeness", "_geo"),
        ("Gender Completeness", "_gender"),
        ("Territory Join Success", "_terr"),
        ("Census Data Coverage", "_census"),
    ]
    return unpivot(row, [
        [("metric", F.lit(label)),
         ("score", F.concat(fixed2_text(pct(F.col(c), F.col("_total"))), F.lit("%")))]
        for label, c in metrics
    ])


def rpt_5_1_export(f: DataFrame, limit: int = 1000) -> DataFrame:
    """Flat export of matched rows; ordered by every exported column so the
    1000 rows kept are the same on every run (the source had no ORDER BY)."""
    return f.where(F.col("territory_label").isNotNull()).select(*EXPORT_COLUMNS).orderBy(
        *_asc(*EXPORT_COLUMNS)
    ).limit(limit)


LEGACY = {
    "rpt_1_1_summary": rpt_1_1_summary,
    "rpt_1_2_territory_perf": rpt_1_2_territory_perf,
    "rpt_1_3_join_success": rpt_1_3_join_success,
    "rpt_1_4_census_coverage": rpt_1_4_census_coverage,
    "rpt_2_1_nulls": rpt_2_1_nulls,
    "rpt_2_2_dup_gold": rpt_2_2_dup_gold,
    "rpt_2_4_type_validity": rpt_2_4_type_validity,
    "rpt_2_5_freshness": rpt_2_5_freshness,
    "rpt_2_6_batches": rpt_2_6_batches,
    "rpt_3_1_territory_cards": rpt_3_1_territory_cards,
    "rpt_3_2_territory_demo": rpt_3_2_territory_demo,
    "rpt_3_3_gender": rpt_3_3_gender,
    "rpt_3_4_census_avg": rpt_3_4_census_avg,
    "rpt_3_5_premium_dist": rpt_3_5_premium_dist,
    "rpt_3_6_batch_series": rpt_3_6_batch_series,
    "rpt_4_1_health": rpt_4_1_health,
    "rpt_4_2_quality_score": rpt_4_2_quality_score,
    "rpt_5_1_export": rpt_5_1_export,
}

SILVER = {"rpt_2_3_dup_silver": rpt_2_3_dup_silver}
