"""Gold fact builders.

``fact_current`` is the shape the ingest jobs build today: an inner join of
premiums with the territory dimension (fans out where a territory has two
towns) and left joins of the two census tables through the territory's zip.

``fact_legacy`` is the older shape that the reporting, quality and monitoring
catalogues query: one row per premium, territory columns from a left join on
the geo id, ``'Unknown'`` when no territory matched, census by geo id.

Both join the (large) premiums side to written dimension tables, whose bytes Spark
knows: it broadcasts them under its threshold and shuffles, with its skew split,
above.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from actuaria.constants import UNKNOWN_TERRITORY
from actuaria.sources import published, silver

PREMIUM_COLUMNS = [
    "gender", "birthdate", "ypc", "current_premium", "indicated_premium", "selected_premium",
    "underlying_premium", "fixed_expenses", "underlying_total_premium", "cgr_factor", "cgr",
    "ingested_at", "batch_id",
]

CURRENT_COLUMNS = PREMIUM_COLUMNS + [
    "territory", "area", "town", "county", "zipcode",
    "acs03_total_population", "acs03_median_age", "acs03_married_percent",
    "acs05_total_population", "acs05_speak_english_only",
]

LEGACY_COLUMNS = [
    "GEO_id", "gender", "birthdate", "state_province_code", "zipcode", "county_code",
    "fips_county_code", "division_number", "rating_level", "current_premium",
    "indicated_premium", "cgr_factor", "territory_label", "territory_area", "territory_town",
    "territory_county", "acs03_total_population", "acs03_median_age", "acs03_married_percent",
    "acs05_total_population", "acs05_speak_english_only", "ingested_at", "batch_id",
]

DIMENSION_ROWS = 100_000  # up to so many rows the dimensions are taken to be broadcast, so that premiums stay where they are

REQUIRED = {
    "territory": {"territory", "zipcode", "area", "town", "county"},
    "premiums": {"territory"},
    "dp03": {"geo_id2", "hc01_vc03", "hc01_vc04", "hc01_vc05"},
    "dp05": {"geo_id2", "hc01_vc03", "hc01_vc04"},
}


def require_columns(df: DataFrame, role: str, required: set[str] | None = None) -> None:
    """Case-insensitive required-column contract (S24); lists what is missing."""
    need = REQUIRED[role] if required is None else required
    have = {c.lower() for c in df.columns}
    missing = sorted(need - have)
    if missing:
        raise ValueError(f"{role} table missing required columns: {missing}")


def geo_key(c: Column) -> Column:
    """Geo ids compared as text; numbers go through BIGINT so 21502.0 → '21502'."""
    return F.coalesce(c.try_cast("bigint").cast("string"), c.cast("string"))


def census_dim(dp03: DataFrame, dp05: DataFrame) -> tuple[DataFrame, DataFrame]:
    d3 = dp03.select(
        geo_key(F.col("GEO_id2")).alias("_g3"),
        F.col("HC01_VC03").alias("acs03_total_population"),
        F.col("HC01_VC04").alias("acs03_median_age"),
        F.col("HC01_VC05").alias("acs03_married_percent"),
    )
    d5 = dp05.select(
        geo_key(F.col("GEO_id2")).alias("_g5"),
        F.col("HC01_VC03").alias("acs05_total_population"),
        F.col("HC01_VC04").alias("acs05_speak_english_only"),
    )
    return d3, d5


def one_town(territory: DataFrame) -> DataFrame:
    """One row per territory and zip, with its alphabetically first town."""
    return territory.groupBy("territory", "zipcode").agg(
        F.min("area").alias("area"), F.min("town").alias("town"), F.min("county").alias("county")
    )


def fact_current(premiums: DataFrame, territory: DataFrame, dp03: DataFrame, dp05: DataFrame,
                 dedupe_territory: bool = False) -> DataFrame:
    """Premiums ⋈ territory (inner, integer key) ⟕ DP03 ⟕ DP05 via the zip.

    Territories with two towns fan premiums out (kept); ``dedupe_territory`` joins
    the first town only.
    """
    for df, role in ((premiums, "premiums"), (territory, "territory"), (dp03, "dp03"), (dp05, "dp05")):
        require_columns(df, role)
    d3, d5 = census_dim(dp03, dp05)
    p = premiums.select(*PREMIUM_COLUMNS, F.col("territory").try_cast("int").alias("_pt"))
    t = (one_town(territory) if dedupe_territory else territory).select(
        "territory", "area", "town", "county", "zipcode",
        F.col("territory").try_cast("int").alias("_tt"),
        geo_key(F.col("zipcode")).alias("_tz"),
    )
    joined = (
        p.join(t, F.col("_pt") == F.col("_tt"), "inner")
        .join(d3, F.col("_tz") == F.col("_g3"), "left")
        .join(d5, F.col("_tz") == F.col("_g5"), "left")
    )
    return joined.select(*CURRENT_COLUMNS)


def legacy_territory(territory: DataFrame) -> DataFrame:
    """One row per (territory, zip): first town alphabetically (legacy label source)."""
    return (
        one_town(territory).select(
            geo_key(F.col("zipcode")).alias("_gz"),
            F.col("territory").cast("string").alias("_label"),
            F.col("area").alias("territory_area"),
            F.col("town").alias("territory_town"),
            F.col("county").alias("territory_county"),
        )
    )


def fact_legacy(premiums: DataFrame, territory: DataFrame, dp03: DataFrame, dp05: DataFrame) -> DataFrame:
    """Premiums ⟕ territory ⟕ DP03 ⟕ DP05, all on the geo id; 'Unknown' label."""
    d3, d5 = census_dim(dp03, dp05)
    lt = legacy_territory(territory)
    p = premiums.withColumn("_geo", geo_key(F.col("GEO_id")))
    joined = (
        p.join(lt, F.col("_geo") == F.col("_gz"), "left")
        .join(d3, F.col("_geo") == F.col("_g3"), "left")
        .join(d5, F.col("_geo") == F.col("_g5"), "left")
    )
    return joined.withColumn(
        "territory_label", F.coalesce(F.col("_label"), F.lit(UNKNOWN_TERRITORY))
    ).select(*LEGACY_COLUMNS)


def by_time(df: DataFrame, times: DataFrame, rows_per_file: int = 50_000, most_rows: int = 500_000) -> DataFrame:
    """``df`` dealt by ``ingested_at`` so that files are narrow in time, and sorted in each; nulls come first.

    ``times`` has the column ``ingested_at`` alone, of the same rows or about the same: a count per day tells which
    partitions a day fills, so ``df`` itself is not run for a sample.  A day that fills several is spread over them by a hash.  The days
    are one row each, so their running total is a small window and they are broadcast.  Partitions hold about ``most_rows`` at most
    whatever their usual number, so that they are sorted in memory.
    """
    spark = df.sparkSession
    days = times.groupBy(F.to_date("ingested_at").alias("__day")).agg(F.count(F.lit(1)).alias("n"))
    total = max(1, int(days.agg(F.sum("n")).first()[0] or 0))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true":
        n = min(n, -(-total // rows_per_file))
    n = max(n, -(-total // most_rows))
    before = Window.orderBy(F.col("__day").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    place = days.select("__day", (F.coalesce(F.sum("n").over(before), F.lit(0)) * n / total).alias("__begin"), (F.col("n") * n / total).alias("__share"))
    columns = df.columns
    spread = F.pmod(F.xxhash64(*columns), F.lit(1 << 20)) / (1 << 20)
    placed = df.join(F.broadcast(place), F.to_date("ingested_at").eqNullSafe(F.col("__day")), "left")
    number = F.floor(F.col("__begin") + F.when(F.col("__share") > 1, F.col("__share") * spread).otherwise(0))
    number = F.coalesce(F.least(number, F.lit(n - 1)), F.lit(0)).cast("int")
    return placed.repartitionById(n, number).select(*columns).sortWithinPartitions("ingested_at")


def at_once(times: DataFrame) -> bool:
    """Whether all rows have the same ``ingested_at``, as those of a batch that was stamped in one load: none can be dealt by it."""
    at = F.col("ingested_at")
    first, last, known, rows = times.agg(F.min(at), F.max(at), F.count(at), F.count(F.lit(1))).first()
    return first == last and known in (0, rows)


def in_slices(table: DataFrame, sizes: Mapping[str, int], least: int = 8 << 20, most: int = 64) -> DataFrame:
    """``table``, partitioned by ``batch_id``, as a union of scans of consecutive batches: a task reads batches near in time.

    What is made of it row by row and written stays as narrow in time as its files, without a shuffle.  ``sizes`` are the bytes of
    the batches; a slice has about ``least`` or more, and there are ``most`` slices at most.  Null batches are in the first.
    """
    total = sum(sizes.values())
    n = max(1, min(most, total // least))
    first, before = {}, 0
    for batch in sorted(sizes):
        first.setdefault(before * n // max(1, total), batch)
        before += sizes[batch]
    bounds, batch_id = [*first.values()], F.col("batch_id")
    if len(bounds) < 2:
        return table
    parts = [table.where(batch_id.isNull() | (batch_id < bounds[1]))]
    parts += [table.where((batch_id >= a) & (batch_id < b)) for a, b in zip(bounds[1:], bounds[2:])]
    parts.append(table.where(batch_id >= bounds[-1]))
    return reduce(DataFrame.unionByName, parts)


def write_fact(df: DataFrame, path: str, times: DataFrame | None = None) -> int:
    """Rebuild a fact table; returns its rows (S25, S26), observed while writing.

    Rows are clustered by load time, so a time window's filter skips files and row
    groups by their minima and maxima.
    """
    obs = Observation()
    (
        by_time(df, (df if times is None else times).select("ingested_at")).observe(obs, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    )
    return int(obs.get["rows"])


def build_gold(spark: SparkSession, root: str) -> int:
    """The daily gold build from loaded silver: tables → roles → contract → newest batches → fact.

    Lists the silver tables under ``root``, picks one per role, checks every table's
    columns, joins the newest batch of each and publishes the result as the next version of ``<root>/gold/fact_current``: readers
    (``read_gold``) see the last version or this one, and a build that fails leaves the last one.  An empty fact is a failure.
    """
    roles = silver.resolve_roles(silver.silver_tables(spark, root))
    frames = {}
    for role, name in roles.items():
        df = silver.read_silver(spark, root, name.removeprefix("stg_"))
        require_columns(df, role)
        frames[role] = silver.latest_batch(df)
    premiums, dims = frames["premiums"], [frames[role] for role in ("territory", "dp03", "dp05")]
    times = premiums.select("ingested_at")
    if at_once(times):  # the rows stay where they are
        clustered = fact_current(premiums, *dims)
    elif sum(d.count() for d in dims) <= DIMENSION_ROWS:  # the premiums move alone, before the territories' towns multiply them
        clustered = fact_current(by_time(premiums.select(*PREMIUM_COLUMNS, "territory"), times), *dims)
    else:
        clustered = by_time(fact_current(premiums, *dims), times)
    return published.publish(spark, clustered, f"{root}/gold/fact_current", check_fact)[1]


def check_fact(written: DataFrame, rows: int) -> None:
    """What a fact must be to be published: the columns of the contract, and rows."""
    if written.columns != CURRENT_COLUMNS:
        raise ValueError(f"fact has columns {written.columns}")
    if not rows:
        raise ValueError("fact is empty")


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    """The fact that was published last."""
    return published.read(spark, f"{root}/gold/fact_current")
