"""Stakeholder catalogue: 23 business questions on the current fact.

Each function takes the gold ``fact_current`` frame (and ``as_of`` where the
question depends on the clock) and returns the answer as a lazy DataFrame.
Output column names and types are fixed: counts BIGINT, money totals
DECIMAL(38,2), averages/ratios DOUBLE rounded as in the question.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actuaria import constants as K
from actuaria.functions.expr import (
    avg_exact, avg_round, count_if, div, money_round, non_blank, pct, round_int, sum_money, try_date,
    age_years,
)
from actuaria.operators.buckets import bucket_below, bucket_equal
from actuaria.operators.nulls import completeness
from actuaria.operators.segments import margin_pct, segment_summary, sorted_small, tier, waterfall, with_share

def n_rows():
    return F.count(F.lit(1))


def _cnt(name: str):
    return n_rows().alias(name)


# -- Q1 premium performance by territory -------------------------------------
def stk_1_1_revenue_rank(f: DataFrame) -> DataFrame:
    cur, utp = F.sum("current_premium"), F.sum("underlying_total_premium")
    g = f.groupBy(F.col("territory").alias("territory_id"), "town", "county").agg(
        _cnt("policy_count"),
        avg_round("current_premium").alias("avg_premium"),
        money_round(cur).alias("total_revenue"),
        money_round(utp).alias("total_cost"),
        money_round(cur - utp).alias("gross_margin"),
        F.round(div(cur - utp, cur) * F.lit(100.0), 2).alias("margin_percentage"),
    )
    return g.orderBy(
        F.col("total_revenue").desc_nulls_first(),
        F.col("territory_id").asc_nulls_first(), F.col("town").asc_nulls_first(), F.col("county").asc_nulls_first(),
    ).limit(20)


def stk_1_2_territory_stats(f: DataFrame) -> DataFrame:
    per = f.groupBy("territory").agg(
        _cnt("policy_count"),
        avg_exact("current_premium").alias("avg_premium"),
        F.sum("current_premium").alias("total_revenue"),
    )
    return per.agg(
        F.count_distinct("territory").alias("total_territories"),
        round_int(avg_exact("policy_count"), to="int").alias("avg_policies_per_territory"),
        F.max("policy_count").alias("max_policies_in_territory"),
        F.round(F.try_divide(F.sum("avg_premium"), F.count("avg_premium").cast("double")), 2)
        .alias("company_wide_avg_premium"),
        sum_money("total_revenue").alias("company_total_revenue"),
    )


# -- Q2 gender ----------------------------------------------------------------
def stk_2_1_gender(f: DataFrame) -> DataFrame:
    g = f.where(F.col("gender").isNotNull()).groupBy("gender").agg(
        _cnt("policy_count"),
        avg_round("current_premium").alias("avg_current_premium"),
        avg_round("indicated_premium").alias("avg_indicated_premium"),
        avg_round("underlying_total_premium").alias("avg_underlying_premium"),
        avg_round("ypc").alias("avg_prior_claims"),
        avg_round("cgr_factor").alias("avg_cgr_factor"),
    )
    return with_share(g, "policy_count", "percentage_of_total").select(
        "gender", "policy_count", "percentage_of_total", "avg_current_premium", "avg_indicated_premium",
        "avg_underlying_premium", "avg_prior_claims", "avg_cgr_factor",
    )


def stk_2_2_gender_variance(f: DataFrame) -> DataFrame:
    per = f.where(F.col("gender").isNotNull()).groupBy("gender").agg(
        avg_exact("current_premium").alias("avg_premium")
    )
    hi, lo = F.max("avg_premium"), F.min("avg_premium")
    return per.agg(
        F.lit("Premium Variance by Gender").alias("metric"),
        F.concat(
            F.round(div(hi - lo, lo) * F.lit(100.0), 2).cast("decimal(38,2)").cast("string"), F.lit("%")
        ).alias("variance_percentage"),
        F.round(hi - lo, 2).alias("absolute_difference"),
    )


def _demographics(f: DataFrame) -> DataFrame:
    return segment_summary(
        f,
        ["territory", "town"],
        [
            _cnt("policy_count"),
            avg_round("current_premium").alias("avg_premium"),
            round_int(avg_exact("acs03_total_population"), to="int").alias("total_population"),
            avg_round("acs03_median_age", 1).alias("median_age"),
            avg_round("acs03_married_percent", 1).alias("percent_married"),
            round_int(avg_exact("acs05_total_population"), to="int").alias("diverse_population_estimate"),
        ],
        order=[F.col("policy_count").desc_nulls_first(), F.col("territory").asc_nulls_first(),
               F.col("town").asc_nulls_first()],
        k=50,
        where=F.col("acs03_total_population").isNotNull(),
    )


def stk_2_3_risk_profile(f: DataFrame) -> DataFrame:
    """Same body as 3.1 in the catalogue (the title promises gender; kept as written)."""
    return _demographics(f)


def stk_3_1_demographics(f: DataFrame) -> DataFrame:
    return _demographics(f)


def stk_3_2_age_band(f: DataFrame) -> DataFrame:
    label, _ = bucket_below(F.col("acs03_median_age"), K.MEDIAN_AGE_BANDS, K.MEDIAN_AGE_REST)
    return f.where(F.col("acs03_median_age").isNotNull()).groupBy(label.alias("age_group")).agg(
        _cnt("policy_count"),
        avg_round("current_premium").alias("avg_premium"),
        avg_round("ypc").alias("avg_prior_claims"),
        avg_round("cgr_factor").alias("avg_cgr_factor"),
    ).orderBy(F.col("age_group").asc_nulls_last())


# -- Q4 profitability ---------------------------------------------------------
def stk_4_1_profitability(f: DataFrame) -> DataFrame:
    cur, utp = F.sum("current_premium"), F.sum("underlying_total_premium")
    ratio = div(cur, utp)
    g = f.groupBy("territory", "town", "county").agg(
        _cnt("policy_count"),
        avg_round("current_premium").alias("avg_current_premium"),
        avg_round("underlying_premium").alias("avg_underlying_premium"),
        avg_round("underlying_total_premium").alias("avg_total_cost"),
        F.round(ratio, 4).alias("loss_ratio"),
        tier(ratio, K.PROFIT_TIERS, K.PROFIT_TIER_REST).alias("profitability_tier"),
        margin_pct(cur, utp).alias("margin_percentage"),
    )
    return g.orderBy(
        F.col("margin_percentage").desc_nulls_first(), F.col("territory").asc_nulls_first(),
        F.col("town").asc_nulls_first(), F.col("county").asc_nulls_first(),
    ).limit(30)


def stk_4_2_company_ratio(f: DataFrame) -> DataFrame:
    cur, utp = F.sum("current_premium"), F.sum("underlying_total_premium")
    return f.agg(
        F.round(div(cur, utp), 4).alias("overall_loss_ratio"),
        margin_pct(cur, utp).alias("overall_margin_percent"),
    )


def stk_4_3_cgr(f: DataFrame) -> DataFrame:
    return f.where(F.col("cgr").isNotNull()).groupBy(F.col("cgr").alias("cgr_category")).agg(
        _cnt("policy_count"),
        avg_round("current_premium").alias("avg_premium"),
        avg_round("cgr_factor", 3).alias("avg_cgr_factor"),
        avg_round("ypc").alias("avg_prior_claims"),
    ).orderBy(F.col("policy_count").desc_nulls_first())


# -- Q5 age cohorts -------------------------------------------------------------
def stk_5_1_age_cohort(f: DataFrame, as_of) -> DataFrame:
    age = age_years(try_date("birthdate"), as_of)
    label, order = bucket_below(F.col("_age"), K.HOLDER_AGE_BANDS, K.HOLDER_AGE_REST)
    cohorts = (
        f.where(non_blank("birthdate"))
        .select("current_premium", "ypc", age.alias("_age"))
        .where(F.col("_age").between(K.HOLDER_AGE_MIN, K.HOLDER_AGE_MAX))
        .select(label.alias("age_group"), order.alias("sort_order"), "current_premium", "ypc")
    )
    return cohorts.groupBy("age_group", "sort_order").agg(
        _cnt("policy_count"),
        avg_round("current_premium").alias("avg_premium"),
        money_round(F.min("current_premium")).alias("min_premium"),
        money_round(F.max("current_premium")).alias("max_premium"),
        F.round(F.stddev_samp("current_premium"), 2).alias("stddev_premium"),
        avg_round("ypc").alias("avg_prior_claims"),
    ).orderBy("sort_order").drop("sort_order")


# -- Q6 prior claims ------------------------------------------------------------
#: Cents per coarse range of the median's first step.
COARSE_CENTS = 1 << 14


def median_money(df: DataFrame, keys: list[str], c: str, name: str) -> DataFrame:
    """Exact ``PERCENTILE_CONT(0.5)`` of a 2-decimal money column per group, rounded to cents.

    Ordinary counts per (group, cents) find the middle in two steps: a running count
    over coarse ranges tells which ranges hold the one or two middle ranks, and a
    running count inside those ranges finds the values.  No state holds a group.
    The mean of two cents is an exact half-cent, rounded HALF_UP in decimal.
    Groups without values have no row.
    """
    cents = (F.col(c) * F.lit(100)).cast("bigint")
    counts = df.where(F.col(c).isNotNull()).groupBy(*keys, cents.alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_r", F.floor(F.col("_c") / COARSE_CENTS).cast("bigint"))
    ranges = counts.groupBy(*keys, "_r").agg(F.sum("_n").alias("_held"))
    group = Window.partitionBy(*keys)
    running = group.orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
    ranges = ranges.withColumns({"_upto": F.sum("_held").over(running), "_all": F.sum("_held").over(group)})
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    ranges = ranges.withColumns({"_before": F.col("_upto") - F.col("_held"), "_low": low, "_high": high}).where(
        ((F.col("_before") < F.col("_low")) & (F.col("_low") <= F.col("_upto")))
        | ((F.col("_before") < F.col("_high")) & (F.col("_high") <= F.col("_upto")))
    )
    inside = Window.partitionBy(*keys, "_r").orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys] + [F.col("_r") == F.col("_m_r")]
    marked = ranges.select(*[F.col(k).alias(f"_m_{k}") for k in keys], F.col("_r").alias("_m_r"), "_before", "_low", "_high")
    found = counts.join(marked, same).withColumn("_to", F.col("_before") + F.sum("_n").over(inside))
    middle = lambda rank: F.min(F.when(F.col("_to") >= F.col(rank), F.col("_c")))
    twice = (middle("_low") + middle("_high")).cast("decimal(38,0)")
    return found.groupBy(*keys).agg(F.round(twice * F.lit(0.005).cast("decimal(4,3)"), 2).cast("double").alias(name))


def stk_6_1_claims_bucket(f: DataFrame) -> DataFrame:
    label, order = bucket_equal(F.col("ypc"), K.CLAIM_BUCKETS, K.CLAIM_BUCKET_REST)
    bucketed = f.where(F.col("ypc").isNotNull()).select(
        label.alias("prior_claims_bucket"), order.alias("sort_order"), "current_premium"
    )
    medians = median_money(bucketed, ["sort_order"], "current_premium", "median_premium")
    g = (
        bucketed.groupBy("prior_claims_bucket", "sort_order")
        .agg(
            _cnt("policy_count"),
            avg_round("current_premium").alias("avg_premium"),
            F.round(F.stddev_samp("current_premium"), 2).alias("stddev_premium"),
            money_round(F.min("current_premium")).alias("min_premium"),
            money_round(F.max("current_premium")).alias("max_premium"),
        )
        .join(medians, "sort_order", "left")
    )
    return with_share(g, "policy_count", "percent_of_portfolio").orderBy("sort_order").select(
        "prior_claims_bucket", "policy_count", "percent_of_portfolio", "avg_premium", "stddev_premium",
        "min_premium", "max_premium", "median_premium",
    )


def stk_6_2_claims_count(f: DataFrame) -> DataFrame:
    a_cur, a_ind = avg_exact("current_premium"), avg_exact("indicated_premium")
    return f.where(F.col("ypc").isNotNull() & F.col("ypc").between(0, 10)).groupBy(
        F.col("ypc").alias("prior_claims_count")
    ).agg(
        _cnt("policy_count"),
        F.round(a_cur, 2).alias("avg_premium"),
        F.round(a_ind, 2).alias("avg_indicated"),
        F.round(div(a_cur - a_ind, a_ind) * F.lit(100.0), 2).alias("percent_adjustment_from_indicated"),
    ).orderBy("prior_claims_count")


# -- Q7 geography ----------------------------------------------------------------
def stk_7_1_county(f: DataFrame) -> DataFrame:
    pop = avg_exact("acs03_total_population")
    return f.where(F.col("county").isNotNull()).groupBy("county").agg(
        F.count_distinct("town").alias("num_towns"),
        _cnt("total_policies"),
        F.count_distinct("territory").alias("coverage_territories"),
        avg_round("current_premium").alias("avg_premium"),
        sum_money("current_premium").alias("county_total_revenue"),
        round_int(pop, to="int").alias("est_county_population"),
        F.round(F.try_divide(n_rows().cast("double") * F.lit(1000.0), pop), 2).alias("policies_per_1000_population"),
    ).orderBy(F.col("total_policies").desc_nulls_first(), F.col("county").asc_nulls_first())


def stk_7_2_town(f: DataFrame) -> DataFrame:
    claims = count_if(F.col("ypc") > 0)
    return segment_summary(
        f,
        ["town", "county"],
        [
            _cnt("total_policies"),
            avg_round("current_premium").alias("avg_premium"),
            sum_money("current_premium").alias("town_total_revenue"),
            F.count_distinct("gender").alias("demographic_diversity"),
            claims.alias("policies_with_claims"),
            pct(claims, n_rows()).alias("claim_frequency_percent"),
        ],
        order=[F.col("total_policies").desc_nulls_first(), F.col("town").asc_nulls_first(),
               F.col("county").asc_nulls_first()],
        k=50,
        where=non_blank("town"),
    )


# -- Q8 premium accuracy ---------------------------------------------------------
def stk_8_1_premium_tiers(f: DataFrame) -> DataFrame:
    a_ind, a_sel, a_cur = avg_exact("indicated_premium"), avg_exact("selected_premium"), avg_exact("current_premium")
    return f.where(
        F.col("indicated_premium").isNotNull() & F.col("selected_premium").isNotNull()
        & F.col("current_premium").isNotNull()
    ).agg(
        _cnt("total_records"),
        F.round(a_ind, 2).alias("avg_indicated_premium"),
        F.round(a_sel, 2).alias("avg_selected_premium"),
        F.round(a_cur, 2).alias("avg_current_premium"),
        F.round(div(a_sel, a_ind), 4).alias("selection_factor"),
        F.round(div(a_cur, a_ind), 4).alias("current_to_indicated_ratio"),
    )


def stk_8_2_discount_hist(f: DataFrame) -> DataFrame:
    # Compare the variance after rounding to 6 decimals, so an exact
    # -20 % computed as -20.000000000000004 lands in its true bucket.
    variance = F.round(
        div(F.col("current_premium") - F.col("indicated_premium"), F.col("indicated_premium")) * F.lit(100.0), 6
    )
    label, order = bucket_below(F.col("_v"), K.VARIANCE_BANDS, K.VARIANCE_REST)
    g = (
        f.where(F.col("indicated_premium").isNotNull() & (F.col("indicated_premium") > 0))
        .select(variance.alias("_v"))
        .select(label.alias("variance_bucket"), order.alias("sort_order"))
        .groupBy("variance_bucket", "sort_order")
        .agg(_cnt("policy_count"))
    )
    return with_share(g, "policy_count", "percentage").orderBy("sort_order").select(
        "variance_bucket", "policy_count", "percentage"
    )


# -- Q9 expenses -------------------------------------------------------------------
def stk_9_1_expense(f: DataFrame) -> DataFrame:
    cur, utp = F.sum("current_premium"), F.sum("underlying_total_premium")
    fe, up = F.sum("fixed_expenses"), F.sum("underlying_premium")
    return f.agg(
        money_round(cur).alias("total_premium"),
        money_round(utp).alias("total_underlying_cost"),
        money_round(fe).alias("total_fixed_expenses"),
        money_round(up - fe).alias("total_claims_cost"),
        F.round(div(up - fe, cur) * F.lit(100.0), 2).alias("claims_percentage"),
        F.round(div(fe, cur) * F.lit(100.0), 2).alias("expense_percentage"),
        F.round(div(cur - utp, cur) * F.lit(100.0), 2).alias("profit_margin_percent"),
    )


def stk_9_2_expense_territory(f: DataFrame) -> DataFrame:
    cur, fe = F.sum("current_premium"), F.sum("fixed_expenses")
    g = f.groupBy("territory", "town", "county").agg(
        _cnt("policy_count"),
        money_round(cur).alias("total_premium"),
        money_round(fe).alias("total_expenses"),
        avg_round("fixed_expenses").alias("avg_expense_per_policy"),
        F.round(div(fe, cur) * F.lit(100.0), 2).alias("expense_ratio_percent"),
    )
    return g.orderBy(
        F.col("expense_ratio_percent").desc_nulls_first(), F.col("territory").asc_nulls_first(),
        F.col("town").asc_nulls_first(), F.col("county").asc_nulls_first(),
    ).limit(30)


def stk_9_3_waterfall(f: DataFrame) -> DataFrame:
    return waterfall(
        f,
        [
            ("Current Premium", avg_round("current_premium")),
            ("Less: Fixed Expenses", avg_round("fixed_expenses")),
            ("Less: Underlying Premium", avg_round("underlying_premium")),
            ("Gross Profit", avg_round(F.col("current_premium") - F.col("underlying_total_premium"))),
        ],
    ).transform(lambda d: sorted_small(d, F.col("cumulative_order")))


# -- Q10 data quality ----------------------------------------------------------------
def stk_10_1_scorecard(f: DataFrame) -> DataFrame:
    acs03 = count_if(F.col("acs03_total_population").isNotNull())
    return f.agg(
        _cnt("total_records"),
        F.count_distinct("territory").alias("unique_territories"),
        count_if(non_blank("gender")).alias("records_with_gender"),
        count_if(non_blank("birthdate")).alias("records_with_birthdate"),
        acs03.alias("records_with_acs03"),
        count_if(F.col("acs05_total_population").isNotNull()).alias("records_with_acs05"),
        pct(acs03, n_rows()).alias("census_coverage_percent"),
        F.to_date(F.max("ingested_at")).alias("latest_data_date"),
    )


def stk_10_2_completeness(f: DataFrame) -> DataFrame:
    return completeness(
        f,
        {
            "Territory": F.col("territory").isNotNull(),
            "Gender": F.col("gender").isNotNull(),
            "Birthdate": non_blank("birthdate"),
            "Current Premium": F.col("current_premium").isNotNull(),
            "ACS DP03 (Census)": F.col("acs03_total_population").isNotNull(),
            "ACS DP05 (Census)": F.col("acs05_total_population").isNotNull(),
            "YPC (Prior Claims)": F.col("ypc").isNotNull(),
            "CGR Factor": F.col("cgr_factor").isNotNull(),
        },
    )


def stk_10_3_coverage_gaps(f: DataFrame) -> DataFrame:
    with03 = count_if(F.col("acs03_total_population").isNotNull())
    missing = count_if(F.col("acs03_total_population").isNull())
    return segment_summary(
        f,
        ["territory", "town", "county"],
        [
            _cnt("total_policies"),
            with03.alias("with_acs03"),
            count_if(F.col("acs05_total_population").isNotNull()).alias("with_acs05"),
            missing.alias("missing_census"),
            pct(with03, n_rows()).alias("census_coverage_percent"),
        ],
        order=[F.col("missing_census").desc_nulls_first()],
        having=F.col("missing_census") > 0,
    )


QUERIES = {
    "stk_1_1_revenue_rank": stk_1_1_revenue_rank,
    "stk_1_2_territory_stats": stk_1_2_territory_stats,
    "stk_2_1_gender": stk_2_1_gender,
    "stk_2_2_gender_variance": stk_2_2_gender_variance,
    "stk_2_3_risk_profile": stk_2_3_risk_profile,
    "stk_3_1_demographics": stk_3_1_demographics,
    "stk_3_2_age_band": stk_3_2_age_band,
    "stk_4_1_profitability": stk_4_1_profitability,
    "stk_4_2_company_ratio": stk_4_2_company_ratio,
    "stk_4_3_cgr": stk_4_3_cgr,
    "stk_5_1_age_cohort": stk_5_1_age_cohort,
    "stk_6_1_claims_bucket": stk_6_1_claims_bucket,
    "stk_6_2_claims_count": stk_6_2_claims_count,
    "stk_7_1_county": stk_7_1_county,
    "stk_7_2_town": stk_7_2_town,
    "stk_8_1_premium_tiers": stk_8_1_premium_tiers,
    "stk_8_2_discount_hist": stk_8_2_discount_hist,
    "stk_9_1_expense": stk_9_1_expense,
    "stk_9_2_expense_territory": stk_9_2_expense_territory,
    "stk_9_3_waterfall": stk_9_3_waterfall,
    "stk_10_1_scorecard": stk_10_1_scorecard,
    "stk_10_2_completeness": stk_10_2_completeness,
    "stk_10_3_coverage_gaps": stk_10_3_coverage_gaps,
}

NEEDS_AS_OF = {"stk_5_1_age_cohort"}
