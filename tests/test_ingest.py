"""Landing → bronze → silver ingest and the streaming file source, in scratch folders."""

import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from actuaria.sources import landing, silver
from actuaria.sources.declared import schemas_for
from actuaria.streaming import ingest_stream

T0 = dt.datetime(2025, 1, 1, 2, 0)
PREM = T.StructType([
    T.StructField("territory", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("current_premium", T.DoubleType()),
])


def write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_landing_discovery_quarantine_and_consume_once(spark, scratch):
    land, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    os.makedirs(land)
    write(f"{land}/premiums.csv", "territory,gender,current_premium\n1502,M,10.5\n1521,F,oops\n")
    write(f"{land}/territory-definitions-table.csv", "county,territory\nALLEGANY,1502\n")
    write(f"{land}/empty.csv", "territory,gender,current_premium\n")
    write(f"{land}/_hidden.csv", "a\n1\n")
    write(f"{land}/x.csv.tmp", "a\n1\n")

    t0 = dt.datetime(2025, 1, 1, 2, 0)
    out = {r["file"]: r for r in landing.ingest(spark, land, root, "20250101", t0, {"premiums": PREM}).collect()}
    assert set(out) == {"premiums.csv", "territory-definitions-table.csv", "empty.csv"}
    assert (out["premiums.csv"]["rows"], out["premiums.csv"]["bad_rows"]) == (2, 1)
    assert out["empty.csv"]["status"] == "empty"
    assert out["territory-definitions-table.csv"]["dataset"] == "territory_definitions_table"

    bronze = silver.read_bronze(spark, root, "premiums")
    assert bronze.count() == 1 and bronze.first()["batch_id"] == "20250101"
    assert spark.read.parquet(f"{root}/quarantine/premiums").count() == 1

    # rerun: consumed files are skipped, the header-only file is seen again
    again = {r["file"] for r in landing.ingest(spark, land, root, "20250101", t0, {"premiums": PREM}).collect()}
    assert again == {"empty.csv"}


def test_silver_evolution_idempotence_and_latest_batch(spark, scratch):
    land, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    os.makedirs(land)
    write(f"{land}/census_dp03_20250101.csv", "GEO.id2,HC01_VC03\n21502,10\n")
    landing.ingest(spark, land, root, "20250101", dt.datetime(2025, 1, 1))
    assert silver.load_silver(spark, root, "census_dp03", T0, ["20250101"]) == 1

    write(f"{land}/census_dp03_20250102.csv", "GEO.id2,HC01_VC03,HC01_VC04\n21521,20,38.5\n")
    landing.ingest(spark, land, root, "20250102", dt.datetime(2025, 1, 2))
    silver.load_silver(spark, root, "census_dp03", T0, ["20250102"])
    silver.load_silver(spark, root, "census_dp03", T0, ["20250102"])  # rerun replaces, no duplicates

    s = silver.read_silver(spark, root, "census_dp03")
    assert "GEO_id2" in s.columns and "HC01_VC04" in s.columns
    rows = {r["batch_id"]: r for r in s.collect()}
    assert len(rows) == 2 and rows["20250101"]["HC01_VC04"] is None

    latest = silver.latest_batch(s).collect()
    assert [r["batch_id"] for r in latest] == ["20250102"]


def test_sanitize_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`a-b` int, `a.b` int")
    try:
        silver.sanitize(df)
    except ValueError as exc:
        assert "a_b" in str(exc)
    else:
        raise AssertionError("collision not detected")


def test_resolve_roles():
    names = ["stg_premiums", "stg_cgr_premiums_table_20251218", "stg_territory_definitions_table_20251218",
             "stg_ACS_MD_15_5YR_DP03_20251218", "stg_ACS_MD_15_5YR_DP05_20251218"]
    roles = silver.resolve_roles(names)
    assert roles["premiums"] == "stg_premiums"
    assert roles["dp03"].endswith("DP03_20251218")
    try:
        silver.resolve_roles(names[:2])
    except ValueError:
        pass
    else:
        raise AssertionError("missing roles not reported")


def load(spark, land, root, day="20250101", schemas=None, **options):
    rows = landing.ingest(spark, land, root, day, T0, schemas, **options).collect()
    return {r["file"]: r for r in rows}


def bronze_rows(spark, root, dataset, *columns):
    return sorted((tuple(r) for r in silver.read_bronze(spark, root, dataset).select(*columns).collect()), key=str)


def quarantined(spark, root, dataset):
    return sorted(r["record"] for r in spark.read.parquet(f"{root}/quarantine/{dataset}").collect())


def test_second_arrival_in_a_batch_is_kept_beside_the_first(spark, scratch):
    land, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    os.makedirs(land)
    write(f"{land}/premiums.csv", "territory,gender\n1,M\n2,F\n")
    load(spark, land, root)
    write(f"{land}/premiums_20250101.csv", "territory,gender\n3,M\n")
    assert set(load(spark, land, root)) == {"premiums_20250101.csv"}
    assert bronze_rows(spark, root, "premiums", "territory", "gender") == [("1", "M"), ("2", "F"), ("3", "M")]
    assert load(spark, land, root) == {}


def test_columns_are_bound_by_name(spark, scratch):
    land, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    os.makedirs(land)
    write(f"{land}/premiums.csv", "territory,gender,current_premium\n1,M,10.5\n")
    write(f"{land}/premiums_20250102.csv", "gender,extra,current_premium,territory\nF,e,20,2\n")
    out = load(spark, land, root, schemas={"premiums": PREM})
    assert {r["status"] for r in out.values()} == {"loaded"}
    columns = ("territory", "gender", "current_premium", "extra")
    assert bronze_rows(spark, root, "premiums", *columns) == [("1", "M", 10.5, None), ("2", "F", 20.0, "e")]


def test_bad_records_are_quarantined_whole(spark, scratch):
    land, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    os.makedirs(land)
    write(f"{land}/x.csv", "a,b\n1,2\n1,2,3,4\n5\n")
    write(f"{land}/premiums.csv", "gender,territory,current_premium\nM,1,oops\nF,2,3.5\n,3,\n")
    out = load(spark, land, root, schemas={"premiums": PREM})
    assert (out["x.csv"]["rows"], out["x.csv"]["bad_rows"]) == (3, 2)
    assert bronze_rows(spark, root, "x", "a", "b") == [("1", "2")] and quarantined(spark, root, "x") == ["1,2,3,4", "5"]
    assert (out["premiums.csv"]["rows"], out["premiums.csv"]["bad_rows"]) == (3, 1)
    assert bronze_rows(spark, root, "premiums", "territory", "current_premium") == [("2", 3.5), ("3", None)]
    assert quarantined(spark, root, "premiums") == ["M,1,oops"]
    for name, r in out.items():
        dataset = r["dataset"]
        assert r["rows"] == silver.read_bronze(spark, root, dataset).count() + len(quarantined(spark, root, dataset)), name


def test_quoted_line_breaks_stay_in_one_record(spark, scratch):
    land, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    os.makedirs(land)
    write(f"{land}/notes.csv", 'id,note\n1,"two\nlines, ""quoted"""\n2,plain\n')
    load(spark, land, root)
    assert bronze_rows(spark, root, "notes", "id", "note") == [("1", 'two\nlines, "quoted"'), ("2", "plain")]


def test_failures_are_told_per_file_and_whole(spark, scratch):
    land, root, kept = (os.path.join(scratch, d) for d in ("landing", "lake", "archive"))
    os.makedirs(land)
    write(f"{land}/zero.csv", "")
    write(f"{land}/premiums.csv", "territory\n1\n")
    write(f"{land}/premiums_20250102.csv", "a,a\n1,2\n")  # one name twice: cannot be written
    out = load(spark, land, root, archive_dir=kept)
    assert out["zero.csv"]["status"] == "failed" and "no header" in out["zero.csv"]["reason"]
    assert out["premiums.csv"]["status"] == "loaded" and out["premiums_20250102.csv"]["status"] == "failed"
    assert len(out["premiums_20250102.csv"]["reason"]) > 40
    assert sorted(os.listdir(kept)) == ["premiums.csv"] and "premiums.csv" not in os.listdir(land)
    with pytest.raises(Exception):
        load(spark, os.path.join(scratch, "nowhere"), root)


def test_csv_to_gold_to_a_query(spark, scratch):
    from actuaria.plans import gold, stakeholder

    land, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    os.makedirs(land)
    names = "territory,gender,birthdate,ypc,current_premium,indicated_premium,selected_premium,underlying_premium,fixed_expenses,underlying_total_premium,cgr_factor,cgr"
    write(f"{land}/premiums_20250101.csv", f"{names}\n9,M,1980-01-01,0,1,1,1,1,1,1,1,A\n")
    write(f"{land}/territory-definitions-table.csv", "county,county_code,territory,zipcode,town,area\nALLEGANY,1,1502,21502,CRESAPTOWN,160\nALLEGANY,1,1521,21521,BARTON,160\n")
    write(f"{land}/ACS-DP03.csv", "GEO.id2,HC01_VC03,HC01_VC04,HC01_VC05\n21502,10,38.5,50\n")
    write(f"{land}/ACS-DP05.csv", "GEO.id2,HC01_VC03,HC01_VC04\n21502,11,9\n")
    sets = ["premiums", "territory_definitions_table", "acs_dp03", "acs_dp05"]
    load(spark, land, root, schemas=schemas_for(sets))
    silver.load_all(spark, root, sets, T0)
    write(f"{land}/premiums_20250102.csv", f"{names}\n1502,M,1980-01-01,0,100.10,1,1,1,1,1,1,A\n1502,F,1980-01-01,1,0.20,1,1,1,1,1,1,A\n1521,F,1980-01-01,1,50,1,1,1,1,1,1,A\n")
    load(spark, land, root, "20250102", schemas=schemas_for(sets))
    assert silver.load_silver(spark, root, "premiums", T0, ["20250102"]) == 3
    assert silver.has_table(spark, root, "stg_premiums") and not silver.has_table(spark, root, "stg_other")
    assert gold.build_gold(spark, root) == 3
    fact = gold.read_gold(spark, root)
    assert sorted((r["town"], str(r["current_premium"]), r["acs03_median_age"]) for r in fact.collect()) == [
        ("BARTON", "50.0000", None), ("CRESAPTOWN", "0.2000", 38.5), ("CRESAPTOWN", "100.1000", 38.5)
    ]
    first = stakeholder.stk_1_1_revenue_rank(fact).first()
    assert first["territory_id"] == 1502 and str(first["total_revenue"]) == "100.30"


def test_stream_picks_up_only_new_files(spark, scratch):
    land, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    os.makedirs(land)
    write(f"{land}/premiums.csv", "territory,gender,current_premium\n1,M,1.0\n2,F,2.0\n9,F,oops\n")
    ingest_stream.run_available(spark, land, root, {"premiums": PREM})
    assert silver.read_bronze(spark, root, "premiums").count() == 2 and quarantined(spark, root, "premiums") == ["9,F,oops"]
    write(f"{land}/premiums-20250102.csv", "gender,territory,current_premium\nM,3,3.0\n")
    ingest_stream.run_available(spark, land, root, {"premiums": PREM})
    assert bronze_rows(spark, root, "premiums", "territory") == [("1",), ("2",), ("3",)]


def test_retried_micro_batch_changes_nothing(spark, scratch, monkeypatch):
    land, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    os.makedirs(land)
    write(f"{land}/premiums.csv", "territory,gender,current_premium\n1,M,1.0\n2,F,2.0\n")
    whole, failed = ingest_stream.load_micro_batch, []

    def once(*args, **options):
        done = whole(*args, **options)
        if not failed:
            failed.append(done)
            raise RuntimeError("lost after the write")
        return done

    monkeypatch.setattr(ingest_stream, "load_micro_batch", once)
    with pytest.raises(Exception):
        ingest_stream.run_available(spark, land, root, {"premiums": PREM})
    ingest_stream.run_available(spark, land, root, {"premiums": PREM})
    assert failed and bronze_rows(spark, root, "premiums", "territory") == [("1",), ("2",)]


def test_streaming_daily_window(spark, scratch):
    src, root = os.path.join(scratch, "events"), os.path.join(scratch, "lake")
    base = dt.datetime(2001, 1, 1)

    def add(hours):
        df = spark.createDataFrame([(base + dt.timedelta(hours=h),) for h in hours], "ingested_at timestamp")
        df.write.mode("append").parquet(src)
        out = ingest_stream.run_daily_counts(spark, src, df.schema, root)
        return {r["ingestion_date"].day: r["record_count"] for r in out.collect()}

    assert add(range(0, 90, 6)) == {1: 4, 2: 4, 3: 4, 4: 3}  # as a batch would count, the open day included
    assert add([90, 97]) == {1: 4, 2: 4, 3: 4, 4: 4, 5: 1}


def test_report_mart_and_export(spark, scratch):
    from actuaria.plans import mart
    from actuaria.plans.catalogue import catalogue

    sf = "/root/testdata/sf0.001"
    out = os.path.join(scratch, "mart")
    paths = mart.publish(spark, sf, out, dt.date(2001, 11, 4), ["stk_4_2_company_ratio", "rpt_4_1_health"])
    paths = mart.publish(spark, sf, out, dt.date(2001, 11, 4), ["stk_4_2_company_ratio"])  # rerun same day
    got = spark.read.parquet(paths["stk_4_2_company_ratio"])
    assert got.count() == 1 and "overall_loss_ratio" in got.columns

    exp = os.path.join(scratch, "export")
    mart.export(catalogue()["rpt_5_1_export"](spark, sf), exp)
    back = spark.read.option("header", True).csv(exp)
    assert back.count() == 1000 and "territory_label" in back.columns


def test_load_report_isolates_failures_and_type_map(spark, scratch):
    land, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    os.makedirs(land)
    write(f"{land}/census_dp05.csv", "GEO.id2,HC01_VC03\n21502,10\n")
    landing.ingest(spark, land, root, "20250101", dt.datetime(2025, 1, 1))
    rep = {r["dataset"]: r for r in silver.load_all(spark, root, ["census_dp05", "missing"], T0).collect()}
    assert rep["census_dp05"]["status"] == "loaded" and rep["census_dp05"]["rows"] == 1
    assert rep["missing"]["status"] == "failed"
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(1, 2.0, True, "s", [1])], "X int, y double, z boolean, w string, v array<int>")
    assert silver.added_columns(a.schema, b.schema) == [("y", "NUMERIC"), ("z", "BOOLEAN"), ("w", "TEXT"), ("v", "TEXT")]
