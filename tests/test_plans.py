"""Plan-shape assertions: the physical plans we rely on at scale."""

import datetime as dt
import os
import re
import shutil

from actuaria.plans import quality, reporting, stakeholder
from actuaria.plans.store import lake

SF = "/root/testdata/sf0.001"


def nodes(text, name):
    """Number of physical operators called ``name`` (detail headers '(n) name')."""
    return len(re.findall(rf"^\(\d+\) {re.escape(name)}\b", text, flags=re.M))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    import io
    import contextlib

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_gold_joins_broadcast_dimensions(spark):
    lk = lake(spark, SF)
    from actuaria.plans import gold

    fc = gold.fact_current(lk.silver(), lk.dim("territory"), lk.dim("dp03"), lk.dim("dp05"))
    text = formatted(fc)
    assert nodes(text, "BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text


def test_null_profile_is_one_scan(spark):
    f = lake(spark, SF).fact_legacy()
    text = formatted(quality.dq_1_1_null_gold(f))
    assert nodes(text, "Scan parquet") == 1
    assert "NestedLoopJoin" not in text
    text = formatted(stakeholder.stk_10_2_completeness(lake(spark, SF).fact_current()))
    assert nodes(text, "Scan parquet") == 1


def test_scan_prunes_columns_and_pushes_filters(spark):
    lk = lake(spark, SF)
    text = formatted(stakeholder.stk_3_2_age_band(lk.fact_current()))
    read_schema = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")]
    assert read_schema and all("acs05" not in ln and "birthdate" not in ln for ln in read_schema)
    assert "PushedFilters: [IsNotNull(acs03_median_age)]" in text


def test_time_window_filters_reach_the_scan(spark):
    from actuaria.constants import AS_OF
    from actuaria.plans import monitoring

    text = formatted(monitoring.mon_2_4_today(lake(spark, SF).fact_legacy(), AS_OF))
    assert "GreaterThanOrEqual(ingested_at" in text and "LessThan(ingested_at" in text


def test_top_k_uses_take_ordered(spark):
    f = lake(spark, SF).fact_legacy()
    assert "TakeOrderedAndProject" in plan(reporting.rpt_1_2_territory_perf(f))


def test_report_card_single_scan(spark):
    from actuaria.constants import AS_OF

    text = formatted(quality.dq_5_1_report_card(lake(spark, SF).fact_legacy(), AS_OF))
    assert nodes(text, "Scan parquet") == 1


def test_premiums_join_is_the_planners(spark):
    from actuaria.sources import binding

    text = plan(binding.premiums(spark, SF))
    assert "REPARTITION" not in text


def test_skewed_premiums_key_is_split(spark, scratch):
    from pyspark.sql import functions as F

    from actuaria.sources import binding

    hot = f"{scratch}/hot"
    for name in ("orders", "supplier"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{hot}/{name}.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    one = lines.first()["l_orderkey"]
    many = lines.crossJoin(spark.range(12)).withColumn("l_orderkey", F.when(F.col("id") % 3 > 0, F.lit(one)).otherwise(F.col("l_orderkey"))).drop("id")
    many.repartition(6).write.parquet(f"{hot}/lineitem.parquet")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = binding.premiums(spark, hot)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        assert "skew=true" in plan(df)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_latest_batch_reads_one_partition(spark):
    from actuaria.sources import silver

    text = formatted(silver.latest_batch(lake(spark, SF).silver()))
    assert re.search(r"PartitionFilters: \[isnotnull\(batch_id#\d+\), \(batch_id#\d+ = Subquery", text)


def test_gold_row_groups_are_narrow_in_time(spark, scratch):
    import pyarrow.parquet as pq

    from actuaria.plans import gold

    folder, spans = f"{scratch}/fact", []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many files as a big fact has
    try:
        gold.write_fact(lake(spark, SF).fact_legacy(), folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(f"{folder}/{name}").metadata
            at = [meta.schema.column(i).name for i in range(meta.num_columns)].index("ingested_at")
            spans += [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
    ranges = sorted((s.min, s.max) for s in spans)
    assert len(ranges) > 1 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_median_has_no_group_state(spark):
    text = plan(stakeholder.stk_6_1_claims_bucket(lake(spark, SF).fact_current()))
    assert "percentile" not in text and "ObjectHashAggregate" not in text


def test_lake_sees_changed_sources(spark, scratch):
    src = f"{scratch}/sf"
    os.makedirs(src)
    for name in os.listdir(SF):
        if name != "lineitem.parquet":
            shutil.copyfile(f"{SF}/{name}", f"{src}/{name}")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    lines.limit(1000).write.parquet(f"{src}/lineitem.parquet/part=1")
    assert lake(spark, src).rows["premiums"] == 1000 and lake(spark, src) is lake(spark, src)
    lines.limit(500).write.mode("append").parquet(f"{src}/lineitem.parquet/part=1")
    assert lake(spark, src).rows["premiums"] == 1500


def test_clock_can_be_set(spark):
    from actuaria.plans.catalogue import catalogue

    def rows(as_of, key):
        return [tuple(r) for r in catalogue(as_of)[key](spark, SF).collect()]

    other = dt.datetime(1999, 6, 1, 12)
    for key in ("dq_5_2_summary", "mon_2_4_today", "stk_5_1_age_cohort"):
        assert rows(None, key) != rows(other, key)
    from actuaria.constants import AS_OF

    assert rows(None, "stk_5_1_age_cohort") == rows(AS_OF, "stk_5_1_age_cohort")
