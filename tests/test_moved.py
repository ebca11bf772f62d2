"""What queries move and write: tables on first use, narrow rows, partitions that fit in memory, no second shuffle."""

import datetime as dt
import os
import shutil
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from actuaria.plans import gold, ingest, stakeholder, store
from actuaria.sources import binding, files, landing, silver
from actuaria.sources.declared import schemas_for

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def source(scratch):
    """A copy of the tables, of which no lake is there."""
    src = f"{scratch}/sf"
    os.makedirs(src)
    for name in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        shutil.copyfile(f"{SF}/{name}.parquet", f"{src}/{name}.parquet")
    return src


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("query", [ingest.schema_widen, ingest.catalog_evolved])
def test_silver_alone_writes_no_gold(spark, source, query):  # F1, F5
    assert query(spark, source).count()
    lk = store.lake(spark, source)
    assert files.list_folders(spark, lk.path("gold")) == [] and set(lk.rows) == {"premiums", *store.DIMENSIONS}


def test_premiums_are_dealt_by_time_before_they_are_shaped(spark):  # F1
    narrow = binding.joined(spark, SF)
    dealt = gold.by_time(narrow, narrow.select("ingested_at"))
    assert len(dealt.columns) < len(binding.premiums(spark, SF).columns)
    assert rows(binding.shaped(dealt)) == rows(binding.premiums(spark, SF))


def test_one_fact_is_written_without_a_shuffle(spark, source):  # F2, F3
    lk = store.lake(spark, source)
    assert stakeholder.stk_10_1_scorecard(lk.fact_current()).first()["total_records"] == lk.rows["fact_current"]
    assert files.list_folders(spark, lk.path("gold")) == ["fact_current"]
    dims = [lk.dim(d) for d in store.DIMENSIONS]
    sliced = gold.fact_current(gold.in_slices(lk.silver(), lk._batch_bytes(), least=1, most=5), *dims)
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "Exchange hashpartitioning" not in plan and "REPARTITION" not in plan
    assert rows(sliced) == rows(gold.fact_current(lk.silver(), *dims)) == rows(lk.fact_current())


def test_slices_hold_every_batch_once_and_are_narrow(spark, scratch):  # F2
    months = [None, *[f"2001-{m:02d}" for m in range(1, 13)]]
    spark.createDataFrame([(b, i) for b in months for i in range(40)], "batch_id string, n int").coalesce(1).write.partitionBy("batch_id").parquet(scratch + "/t")
    table = spark.read.parquet(scratch + "/t")
    table = table.withColumn("batch_id", F.col("batch_id").cast("string"))
    sliced = gold.in_slices(table, {b: 100 for b in months if b}, least=1, most=4)
    assert rows(sliced) == rows(table)
    seen = sliced.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("batch_id").alias("n")).collect()
    assert max(r["n"] for r in seen) <= 3
    assert gold.in_slices(table, {}) is table and gold.in_slices(table, {"2001-01": 5}, least=1) is table


def test_partitions_by_time_are_bounded_in_rows(spark):  # F3
    df = spark.range(2000).select("id", F.date_add(F.lit(dt.date(2001, 1, 1)), (F.col("id") % 7).cast("int")).cast("timestamp_ntz").alias("ingested_at"))
    dealt = gold.by_time(df, df.select("ingested_at"), most_rows=50)
    counts = dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert dealt.rdd.getNumPartitions() >= 40 and max(r["count"] for r in counts) <= 150
    assert rows(dealt) == rows(df)


def test_only_bad_records_keep_their_text(spark, scratch):  # F4
    os.makedirs(f"{scratch}/landing")
    with open(f"{scratch}/landing/territory_20250101.csv", "w") as f:
        f.write("territory,zipcode,town\n1,20001,A\nx,20002,B\n3,20003,C\n")
    landing.ingest(spark, f"{scratch}/landing", f"{scratch}/lake", "20250101", dt.datetime(2025, 1, 1), schemas_for(["territory"]))
    staged = spark.read.parquet(f"{scratch}/lake/_staging/territory/batch_id=20250101")
    assert {(r["zipcode"], r["_record"]) for r in staged.collect()} == {(20001, None), (20002, "x,20002,B"), (20003, None)}
    assert [r["record"] for r in spark.read.parquet(f"{scratch}/lake/quarantine/territory").collect()] == ["x,20002,B"]


def test_landing_files_need_no_lake(spark, source):  # F4
    found = rows(ingest.ingest_to_gold(spark, source))
    assert store.kept(spark, source) is None
    store.lake(spark, source)
    assert store.kept(spark, source) is not None and rows(ingest.ingest_to_gold(spark, source)) == found


def test_catalog_table_needs_no_lake(spark, source):  # F5
    t = lambda *a: dt.datetime(*a)
    lines = [
        (1, 1, 1, 5.0, 100.25, 0.05, 0.02, "A", "F", t(1996, 5, 1)), (1, 2, 2, 6.0, 10.5, 0.0, 0.0, "N", "O", t(1996, 5, 2)),
        (1, 2, 2, 6.0, 10.5, 0.0, 0.0, "N", "O", t(1996, 5, 2)), (2, 1, 7, 1.0, 7.75, 0.1, 0.08, "R", "F", t(1998, 2, 3)),
        (2, 3, 3, 1.0, 8.0, 0.1, 0.08, None, "F", t(1999, 1, 1)), (3, 1, 4, 1.0, 9.0, 0.1, 0.08, "A", "O", t(2000, 7, 8)),
        (4, 1, 4, 1.0, 11.0, 0.1, 0.08, "A", "O", None), (9, 1, 4, 1.0, 12.0, 0.1, 0.08, "A", "O", t(1999, 3, 3)),
        (None, 1, 4, 1.0, 13.0, 0.1, 0.08, "A", "O", t(1999, 3, 3)), (4, 1, None, 1.0, None, 0.1, 0.08, "A", "O", t(1999, 3, 4)),
    ]
    orders = [(1, 10, t(1995, 1, 1), "5-LOW"), (2, 11, t(1995, 1, 2), None), (3, 12, None, "1-URGENT"), (3, 13, t(1995, 1, 3), "5-LOW"), (4, None, None, None), (None, 1, None, None)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                     "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        "supplier": ([(1, 4), (2, 24), (None, 1)], "s_suppkey long, s_nationkey int"),
    }
    for name, (held, schema) in tables.items():
        os.remove(f"{source}/{name}.parquet")
        spark.createDataFrame(held, schema).write.parquet(f"{source}/{name}.parquet")
    found = rows(ingest.catalog_evolved(spark, source))
    assert store.kept(spark, source) is None  # the lake's shuffles and wide rows are not paid for
    assert {r[0]: r[1:] for r in found} == {
        "1996-05": (3, 52, "0", "1", Decimal("121.25"), 0), "1998-02": (1, 4, "6", "6", Decimal("7.75"), 1), "2000-07": (2, 8, "c3", "c3", Decimal("18"), 2),
        "1999-03": (1, 4, None, None, None, 1),
    }
    store.lake(spark, source)
    assert rows(ingest.catalog_evolved(spark, source)) == found == rows(ingest.schema_widen(spark, source))


def test_rows_of_batches_are_not_sorted(spark):  # F5
    held = [("b1", None, "c1", "1.5", "x"), ("b1", 2, "c10", None, None), ("b1", 3, None, "2.25", "y"), (None, 4, "c2", "3", None), ("b2", None, None, None, None)]
    df = spark.createDataFrame(held, "batch_id string, territory long, ypc string, current_premium string, cgr string").withColumn("current_premium", F.col("current_premium").cast("decimal(20,4)"))
    counted = ingest._by_batch(df)
    assert rows(counted) == Counter([
        ("b1", 3, 5, "c1", "c10", Decimal("3.75"), 2), (None, 1, 4, "c2", "c2", Decimal("3"), 0), ("b2", 1, None, None, None, None, 0),
    ])
    assert rows(ingest._by_batch(df.limit(0))) == Counter()
    nodes = [line for line in counted._jdf.queryExecution().sparkPlan().toString().splitlines() if "Aggregate" in line]
    assert "HashAggregate" in nodes[-1] and "ypc" in nodes[-1].split("functions")[0]


def test_only_files_with_bad_records_are_staged(spark, scratch):  # F1 of round 4
    land, root = f"{scratch}/landing", f"{scratch}/lake"
    os.makedirs(land)
    texts = {
        "territory_20250101.csv": "territory,zipcode,town\n1,20001,A\n2,20002,\n", "territory_20250102.csv": "territory,zipcode,town\nx,20003,C\n4,20004,D\n",
        "territory_20250103.csv": "territory,zipcode,town\n", "territory_20250104.csv": 'territory,zipcode,town\n5,20005,"E, ""F"""\n6,20006,"G\nH"\n',
        "territory_20250105.csv": 'territory,zipcode,town\n7,y,"I"\n', "dp03_20250101.csv": "GEO.id2,HC01_VC03\n20001,7\n",
    }
    for name, text in texts.items():
        with open(f"{land}/{name}", "w") as f:
            f.write(text)
    # A file of the batch that was loaded before and is without records now: its old rows are not counted as its own.
    stale = spark.createDataFrame([(9, 20009, "Z", "20250101", "territory_20250103.csv")], "territory long, zipcode long, town string, batch_id string, source_file string")
    stale.write.partitionBy("batch_id", "source_file").parquet(f"{root}/bronze/territory")
    told = landing.ingest(spark, land, root, "20250101", dt.datetime(2025, 1, 1), schemas_for(["territory", "dp03"]))
    assert {r["file"]: (r["rows"], r["bad_rows"], r["status"]) for r in told.collect()} == {
        "territory_20250101.csv": (2, 0, "loaded"), "territory_20250102.csv": (2, 1, "loaded"), "territory_20250103.csv": (0, 0, "empty"),
        "territory_20250104.csv": (2, 0, "loaded"), "territory_20250105.csv": (1, 1, "loaded"), "dp03_20250101.csv": (1, 0, "loaded"),
    }
    assert files.list_folders(spark, f"{root}/_staging") == ["territory"]
    staged = spark.read.parquet(f"{root}/_staging/territory/batch_id=20250101")
    assert {r["_file"] for r in staged.collect()} == {"territory_20250102.csv", "territory_20250105.csv"}
    assert rows(silver.read_bronze(spark, root, "territory").select("territory", "zipcode", "town")) == Counter(
        [(1, 20001, "A"), (2, 20002, None), (4, 20004, "D"), (5, 20005, 'E, "F"'), (6, 20006, "G\nH")]
    )
    assert rows(spark.read.parquet(f"{root}/quarantine/territory").select("record", "source_file")) == Counter(
        [("x,20003,C", "territory_20250102.csv"), ("7,y,I", "territory_20250105.csv")]
    )


def test_one_batch_is_written_to_silver_under_its_name(spark, scratch, monkeypatch):  # F1 of round 4
    land, root, given, write = f"{scratch}/landing", f"{scratch}/lake", [], silver.write_silver
    os.makedirs(land)
    monkeypatch.setattr(silver, "write_silver", lambda *a: given.append(a[-1]) or write(*a))
    for day in ("20250101", "20250102"):
        with open(f"{land}/x_{day}.csv", "w") as f:
            f.write(f"a\n{day}\n1\n")
        landing.ingest(spark, land, root, day, dt.datetime(2025, 1, 1))
    assert silver.load_silver(spark, root, "x", dt.datetime(2025, 1, 3), ["20250101"]) == 2
    first = rows(silver.read_silver(spark, root, "x").select("a", "batch_id"))
    assert silver.load_silver(spark, root, "x", dt.datetime(2025, 1, 3)) == 4
    assert given == ["20250101", None] and first == Counter([("20250101", "20250101"), ("1", "20250101")])
    assert rows(silver.read_silver(spark, root, "x").select("a", "batch_id")) == first + Counter([("20250102", "20250102"), ("1", "20250102")])


def _silver_of(spark, root, stamps):
    """Silver tables of a few rows; the newest batch of the premiums has these load times."""
    at, money = dt.datetime(2025, 1, 3), ("indicated_premium", "selected_premium", "underlying_premium", "fixed_expenses", "underlying_total_premium", "cgr_factor", "cgr")
    held = [(i % 3, "F", "1980-01-01", i, Decimal(i), t, "b2") for i, t in enumerate(stamps)] + [(1, "M", None, 0, Decimal(99), at, "b1")]
    premiums = spark.createDataFrame(held, "territory int, gender string, birthdate string, ypc int, current_premium decimal(18,4), ingested_at timestamp_ntz, batch_id string")
    tables = {
        "premiums": premiums.withColumns({c: F.lit(None).cast("decimal(18,4)") for c in money}),
        "territory": spark.createDataFrame([(1, 20001, 5, "A", "C", at, "b"), (1, 20001, 5, "B", "C", at, "b"), (2, 20002, 5, "D", "C", at, "b")],
                                           "territory long, zipcode long, area long, town string, county string, ingested_at timestamp_ntz, batch_id string"),
        "dp03": spark.createDataFrame([("20001", 10, 1.0, 2.0, at, "b")], "GEO_id2 string, HC01_VC03 long, HC01_VC04 double, HC01_VC05 double, ingested_at timestamp_ntz, batch_id string"),
        "dp05": spark.createDataFrame([("20002", 11, 9, at, "b")], "GEO_id2 string, HC01_VC03 long, HC01_VC04 long, ingested_at timestamp_ntz, batch_id string"),
    }
    for name, df in tables.items():
        silver.write_silver(spark, root, name, df, at)
    return tables


@pytest.mark.parametrize("stamps, moves", [([1, 1, 1, 1, 1], False), ([None, None, None], False), ([1, 1, 2, 2, 2], True), ([1, None, 1, 1], True)])
def test_rows_of_one_load_time_stay_where_they_are(spark, scratch, monkeypatch, stamps, moves):  # F1 of round 4
    dealt, deal = [], gold.by_time
    monkeypatch.setattr(gold, "by_time", lambda *a: dealt.append(1) or deal(*a))
    tables = _silver_of(spark, f"{scratch}/lake", [t and dt.datetime(2025, 1, 3, t) for t in stamps])
    whole = gold.fact_current(tables["premiums"].where("batch_id = 'b2'"), *[tables[d] for d in store.DIMENSIONS])
    assert gold.build_gold(spark, f"{scratch}/lake") == whole.count() > 0
    assert rows(gold.read_gold(spark, f"{scratch}/lake")) == rows(whole) and bool(dealt) == moves
