"""Portability rules and operator edge cases on small hand-written frames."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from actuaria import constants as K
from actuaria.functions.expr import age_years, avg_round, fixed2_text, pct, round_int, try_date
from actuaria.operators.buckets import bucket_below, bucket_equal
from actuaria.operators.duplicates import duplicate_stats, fingerprint, top_duplicates_with_list
from actuaria.operators.nulls import critical_nulls, null_profile
from actuaria.plans import quality, stakeholder
from actuaria.plans.gold import geo_key


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_age_years_leap_day_and_birthday(spark):
    df = spark.createDataFrame(
        [("2000-02-29", dt.date(2001, 2, 28)), ("2000-02-29", dt.date(2001, 3, 1)),
         ("1983-11-04", dt.date(2001, 11, 4)), ("1983-11-05", dt.date(2001, 11, 4))],
        "b string, a date",
    )
    got = [
        r[0] for r in df.select(
            F.year("a") - F.year(try_date("b")) - (F.date_format("a", "MMdd") < F.date_format(try_date("b"), "MMdd")).cast("int")
        ).collect()
    ]
    assert got == [0, 1, 18, 17]
    # the library helper with a fixed clock
    r = one(spark.createDataFrame([("2000-02-29",)], "b string").select(age_years(try_date("b"), dt.date(2001, 2, 28))))
    assert r[0] == 0


def test_try_date_blank_and_impossible(spark):
    rows = spark.createDataFrame([("",), ("1999-02-29",), ("1919-12-31",)], "b string").select(try_date("b")).collect()
    assert [r[0] for r in rows] == [None, None, dt.date(1919, 12, 31)]


def test_pct_zero_divisor_is_null(spark):
    r = one(spark.createDataFrame([(1, 0)], "a long, b long").select(pct("a", "b")))
    assert r[0] is None


def test_round_int_rounds_not_truncates(spark):
    rows = spark.createDataFrame([(2.5,), (3.7,), (-2.5,)], "x double").select(round_int(F.col("x"))).collect()
    assert [r[0] for r in rows] == [3, 4, -3]


def test_fixed2_text_keeps_two_decimals(spark):
    rows = spark.createDataFrame([(97.0,), (66.6949,)], "x double").select(fixed2_text(F.col("x"))).collect()
    assert [r[0] for r in rows] == ["97.00", "66.69"]


def test_variance_edges_land_in_their_bucket(spark):
    # exact -20 % computed in floating point is -20.000000000000004
    df = spark.createDataFrame([(Decimal("100.00"), Decimal("125.0000")), (Decimal("100.00"), Decimal("100.0000"))],
                               "current_premium decimal(18,2), indicated_premium decimal(18,4)")
    rows = {r["variance_bucket"]: r["policy_count"] for r in stakeholder.stk_8_2_discount_hist(df).collect()}
    assert rows == {"Discount 10-20%": 1, "Markup 0-10%": 1}


def test_claim_bucket_negative_and_fraction_are_null(spark):
    df = spark.createDataFrame([(-1.0,), (1.5,), (0.0,), (7.0,)], "ypc double")
    label, order = bucket_equal(F.col("ypc"), K.CLAIM_BUCKETS, K.CLAIM_BUCKET_REST)
    assert [r[0] for r in df.select(label).collect()] == [None, None, "No Claims", "4+ Claims"]


def test_bucket_below_null_goes_to_rest(spark):
    df = spark.createDataFrame([(None,), (29.9,), (60.0,)], "x double")
    label, order = bucket_below(F.col("x"), K.MEDIAN_AGE_BANDS, K.MEDIAN_AGE_REST)
    rows = df.select(label, order).collect()
    assert [tuple(r) for r in rows] == [("60+", 5), ("Under 30", 1), ("60+", 5)]


def test_fingerprint_null_skipping_collision(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    hashes = {r[0] for r in df.select(fingerprint(["x", "y", "z"])).collect()}
    assert len(hashes) == 1  # CONCAT_WS skips NULLs: the two rows collide, as in the source


def test_null_profile_clean_column_and_as_written_floor(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a long, b string")
    fixed = {r["column_name"]: r["null_count"] for r in null_profile(df, ["a", "b"]).collect()}
    raw = {r["column_name"]: r["null_count"] for r in null_profile(df, ["a", "b"], floor_one=True).collect()}
    assert fixed == {"a": 0, "b": 2}
    assert raw == {"a": 1, "b": 2}


def test_null_profile_empty_table(spark):
    df = spark.createDataFrame([], "a long")
    r = one(null_profile(df, ["a"]))
    assert r["null_count"] == 0 and r["null_percentage"] is None


def test_critical_nulls_gender_branch_never_counts(spark):
    df = spark.createDataFrame([(None, None, "x")], "GEO_id string, gender string, birthdate string")
    r = one(quality.dq_1_3_critical(df))
    assert r["problematic_records"] == 1 and r["affected_columns"] == "GEO_id"
    clean = spark.createDataFrame([("1", "M", "x")], "GEO_id string, gender string, birthdate string")
    r = one(critical_nulls(clean, {"GEO_id": F.col("GEO_id").isNull()}, "ok", "bad"))
    assert tuple(r) == ("ok", 0, None)


def test_duplicate_stats_without_duplicates(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "k string, n string")
    r = one(duplicate_stats(df, ["k", "n"]))
    assert (r["_total"], r["_groups"], r["_extra"]) == (2, 0, None)


def test_null_keys_group_together(spark):
    df = spark.createDataFrame([(None, "x"), (None, "x"), ("a", "x")], "k string, v string")
    r = one(duplicate_stats(df, ["k"]))
    assert (r["_groups"], r["_extra"]) == (1, 1)


def test_top_duplicates_with_null_keys_and_sorted_list(spark):
    ts = [dt.datetime(2001, 1, 3), dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)]
    df = spark.createDataFrame([(None, t) for t in ts] + [("b", ts[0])], "k string, t timestamp_ntz")
    rows = top_duplicates_with_list(df, ["k"], 10, "t", "lst").collect()
    assert len(rows) == 1
    assert rows[0]["k"] is None and rows[0]["duplicate_count"] == 3
    assert rows[0]["lst"] == "2001-01-01 00:00:00, 2001-01-02 00:00:00, 2001-01-03 00:00:00"


def test_median_money_exact_half_cent(spark):
    df = spark.createDataFrame([(0.0, Decimal("100.01")), (0.0, Decimal("100.02"))],
                               "ypc double, current_premium decimal(18,2)")
    r = one(stakeholder.median_money(df, ["ypc"], "current_premium", "m"))
    assert r["m"] == 100.02  # 100.015 rounded half up, exactly


def test_median_money_matches_the_sorted_middle(spark):
    rng = random.Random(4)
    groups = {g: [Decimal(rng.randrange(0, 60_000_00)) / 100 for _ in range(n)] for g, n in (("a", 1), ("b", 2), ("c", 7), ("d", 200), ("e", 201))}
    groups["ties"] = [Decimal("5.00")] * 4 + [Decimal("900.01")] * 4
    groups[None] = [Decimal("-3.10"), Decimal("2.25"), Decimal("700.00")]
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x decimal(18,2)")
    got = {r["g"]: r["m"] for r in stakeholder.median_money(df, ["g"], "x", "m").collect()}
    for g, vs in groups.items():
        s = sorted(vs)
        middle = (s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2
        assert got[g] == float(middle.quantize(Decimal("0.01"), rounding="ROUND_HALF_UP"))
    assert set(got) == set(groups)


def test_geo_key_float_id_matches(spark):
    df = spark.createDataFrame([(21502.0, "21502")], "a double, b string")
    r = one(df.select(geo_key(F.col("a")) == geo_key(F.col("b"))))
    assert r[0] is True


def test_avg_round_all_null_group(spark):
    df = spark.createDataFrame([(1, None)], "g long, x decimal(18,2)")
    r = one(df.groupBy("g").agg(avg_round("x").alias("a")))
    assert r["a"] is None


def test_profitability_zero_cost_is_loss_making(spark):
    df = spark.createDataFrame(
        [(1, "T", "C", Decimal("10.00"), Decimal("0"), Decimal("0"))],
        "territory long, town string, county string, current_premium decimal(18,2), "
        "underlying_premium decimal(18,4), underlying_total_premium decimal(18,4)",
    )
    r = one(stakeholder.stk_4_1_profitability(df))
    assert r["loss_ratio"] is None and r["profitability_tier"] == "Loss-Making"


def test_ties_at_limit_edge_are_deterministic(spark):
    rows = [(i % 3, "town", "c", Decimal("1.00"), Decimal("1.0000")) for i in range(30)]
    df = spark.createDataFrame(rows, "territory long, town string, county string, "
                                     "current_premium decimal(18,2), underlying_total_premium decimal(18,4)")
    a = [tuple(r) for r in stakeholder.stk_1_1_revenue_rank(df.repartition(5)).collect()]
    b = [tuple(r) for r in stakeholder.stk_1_1_revenue_rank(df.repartition(2)).collect()]
    assert a == b


def test_single_batch_cv_is_fail(spark):
    df = spark.createDataFrame([("b1",), ("b1",)], "batch_id string")
    r = one(quality.dq_4_2_batch_cv(df))
    assert r["std_dev"] is None and r["status"] == K.CV_FAIL


def test_report_card_scores(spark):
    schema = T.StructType([
        T.StructField("GEO_id", T.StringType()), T.StructField("gender", T.StringType()),
        T.StructField("birthdate", T.StringType()), T.StructField("zipcode", T.StringType()),
        T.StructField("territory_label", T.StringType()), T.StructField("ingested_at", T.TimestampNTZType()),
    ])
    now = dt.datetime(2001, 11, 4, 12)
    df = spark.createDataFrame([("1", "M", "x", "z", "1", now), ("2", "F", "y", "z", "2", now)], schema)
    r = one(quality.dq_5_1_report_card(df, now))
    assert (r["overall_score"], r["passing_tests"], r["quality_grade"]) == (100.0, 6, K.GRADE_EXCELLENT)
    stale = one(quality.dq_5_1_report_card(df, now + dt.timedelta(days=3)))
    assert stale["overall_score"] == round(550 / 6, 1) and stale["quality_grade"] == K.GRADE_GOOD


def test_fingerprint_null_token_tells_places_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain, token = fingerprint(["x", "y", "z"]), fingerprint(["x", "y", "z"], null_token="<null>")
    assert df.select(plain).distinct().count() == 1 and df.select(token).distinct().count() == 2


def test_cast_validity_counts_bad_values(spark):
    from actuaria.operators.checks import cast_validity

    df = spark.createDataFrame([("1", None), ("x", "2"), (None, "3")], "a string, b string")
    got = {r["field"]: (r["non_numeric_count"], r["valid_numeric"], r["bad"]) for r in cast_validity(df, ["a", "b"], "int", True).collect()}
    assert got == {"a": (2, 1, 1), "b": (2, 2, 0)}


def test_one_town_per_territory_does_not_fan_out(spark):
    from actuaria.plans import gold
    from actuaria.plans.store import lake

    lk = lake(spark, "/root/testdata/sf0.001")
    dims = lk.dim("territory"), lk.dim("dp03"), lk.dim("dp05")
    single = gold.fact_current(lk.silver(), *dims, dedupe_territory=True)
    assert single.count() == lk.silver().where("territory < 23").count() < lk.fact_current().count()
