"""Bind the test tables to the reference's source roles.

The test tables carry no policy data, so each role is derived from them with
a fixed rule (see FIXTURES.md §3).  Every frame here is a lazy plan over the
parquet scans: only the columns a role needs are read, and the filters reach
the scan.

Roles
* premiums   lineitem ⋈ orders ⋈ supplier, one row per line item
* territory  nation ⋈ region (nations 0..22), a second town for nations % 4 = 0
* dp03/dp05  census tables keyed by zip code, aggregated from customer/supplier
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the binding (FIXTURES.md §3).
TERRITORY_MAX_NATION = 23  # nations >= 23 have no territory row
SECOND_TOWN_EVERY = 4  # nations with key % 4 = 0 get a second town
SECOND_TOWN_SUFFIX = " EAST"
ZIP_BASE = 20000
DP03_SKIP_EVERY = 5  # customer nations with key % 5 = 0 have no DP03 row
DP05_SKIP_EVERY = 3  # supplier nations with key % 3 = 0 have no DP05 row
BLANK_BIRTH_PRIORITY = "5-LOW"
BLANK_BIRTH_LINE = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(text: str, typ: str) -> Column:
    return F.lit(Decimal(text)).cast(typ)


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ supplier ⋈ orders: the narrow columns that ``shaped`` makes the premiums from, with ``ingested_at``.

    Plan: plain joins, no hints.  Supplier is broadcast while its bytes are under Spark's
    threshold and comes first, so that its key doesn't move; lineitem ⋈ orders is a shuffle join
    at size, and as its exchanges are the planner's own, Spark splits a skewed key.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 100).alias("customer"), F.to_date("o_orderdate").alias("order_day"),
        (F.col("o_orderpriority") == BLANK_BIRTH_PRIORITY).alias("low"),
    )
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    rows = li.join(su, F.col("l_suppkey") == F.col("s_suppkey")).join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        F.col("s_nationkey").alias("nation"), "l_linenumber", "l_quantity", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_discount").cast("decimal(3,2)").alias("discount"), "l_tax", "l_returnflag", "l_linestatus",
        F.col("l_shipdate").alias("ingested_at"), "customer", "order_day", "low",
    )


def shaped(rows: DataFrame) -> DataFrame:
    """The premiums' columns, each made from its row of ``joined`` alone."""
    price, disc, nation = F.col("price"), F.col("discount"), F.col("nation")
    ship_day = F.to_date("ingested_at").cast("string")
    birth = F.concat((F.lit(1900) + F.col("customer")).cast("string"), F.substring(F.col("order_day").cast("string"), 5, 6))
    blank_birth = F.col("low") & (F.col("l_linenumber") == BLANK_BIRTH_LINE)

    return rows.select(
        nation.cast("int").alias("territory"),
        F.when(F.col("l_returnflag") == "A", "F").when(F.col("l_returnflag") == "R", "M").alias("gender"),
        F.when(blank_birth, F.lit("")).otherwise(birth).alias("birthdate"),
        (F.col("l_linenumber") - 1).cast("int").alias("ypc"),
        price.cast("decimal(18,2)").alias("current_premium"),
        (price * (F.lit(80) + F.col("l_quantity")).cast("decimal(3,0)") * _dec("0.01", "decimal(3,2)"))
        .cast("decimal(18,4)").alias("indicated_premium"),
        (price * (_dec("1.00", "decimal(3,2)") - disc)).cast("decimal(18,4)").alias("selected_premium"),
        (price * _dec("0.70", "decimal(3,2)")).cast("decimal(18,4)").alias("underlying_premium"),
        (price * disc).cast("decimal(18,4)").alias("fixed_expenses"),
        (price * (F.lit(70) + F.lit(5) * (nation % 16)).cast("decimal(4,0)") * _dec("0.01", "decimal(3,2)"))
        .cast("decimal(18,4)").alias("underlying_total_premium"),
        (F.lit(1.0) + F.col("l_tax")).cast("decimal(5,2)").alias("cgr_factor"),
        F.concat(F.col("l_linestatus"), F.col("l_returnflag")).alias("cgr"),
        "ingested_at",
        F.substring(ship_day, 1, 7).alias("batch_id"),
        # legacy-only columns of the premiums file
        (F.lit(ZIP_BASE) + nation).cast("string").alias("GEO_id"),
        (F.lit(ZIP_BASE) + F.col("customer") % 25).cast("string").alias("zipcode"),
        F.lit("XX").alias("state_province_code"),
        nation.cast("bigint").alias("county_code"),
        (F.lit(24000) + nation).cast("bigint").alias("fips_county_code"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).cast("int").alias("division_number"),
        F.col("l_linestatus").alias("rating_level"),
    )


def premiums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver ``stg_premiums``: policy rows with lineage and legacy columns."""
    return shaped(joined(spark, sf_dir))


def territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Territory definitions: (territory, area, town, county, zipcode)."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    base = (
        n.where(F.col("n_nationkey") < TERRITORY_MAX_NATION)
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    )

    def shape(town: Column) -> list[Column]:
        return [
            F.col("n_nationkey").cast("bigint").alias("territory"),
            F.col("n_regionkey").cast("bigint").alias("area"),
            town.alias("town"),
            F.col("r_name").alias("county"),
            (F.lit(ZIP_BASE) + F.col("n_nationkey")).cast("bigint").alias("zipcode"),
        ]

    first = base.select(*shape(F.col("n_name")))
    second = base.where(F.col("n_nationkey") % SECOND_TOWN_EVERY == 0).select(
        *shape(F.concat(F.col("n_name"), F.lit(SECOND_TOWN_SUFFIX)))
    )
    return first.unionByName(second)


def census_dp03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACS DP03 by zip: total population, median age, married percent."""
    c = table(spark, sf_dir, "customer").select("c_nationkey")
    return (
        c.where(F.col("c_nationkey") % DP03_SKIP_EVERY != 0)
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("HC01_VC03"))
        .select(
            (F.lit(ZIP_BASE) + F.col("c_nationkey")).cast("bigint").alias("GEO_id2"),
            F.col("HC01_VC03").cast("bigint").alias("HC01_VC03"),
            (F.lit(25) + F.lit(2) * F.col("c_nationkey")).cast("double").alias("HC01_VC04"),
            (F.lit(40) + F.col("c_nationkey")).cast("double").alias("HC01_VC05"),
        )
    )


def census_dp05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACS DP05 by zip: total population, speak-English-only count."""
    s = table(spark, sf_dir, "supplier").select("s_nationkey")
    return (
        s.where(F.col("s_nationkey") % DP05_SKIP_EVERY != 0)
        .groupBy("s_nationkey")
        .agg(F.count(F.lit(1)).alias("HC01_VC03"))
        .select(
            (F.lit(ZIP_BASE) + F.col("s_nationkey")).cast("bigint").alias("GEO_id2"),
            F.col("HC01_VC03").cast("bigint").alias("HC01_VC03"),
            (F.lit(80) + F.col("s_nationkey")).cast("bigint").alias("HC01_VC04"),
        )
    )
