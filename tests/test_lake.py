"""Split CSV, ledger, type changes, published tables, arrival wait, late rows, catalog tables and sketches."""

import csv
import datetime as dt
import json
import os
import random
import threading
import time

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actuaria.plans import gold, sketches
from actuaria.sources import catalog, files, landing, ledger, published, silver, split_csv, types
from actuaria.sources.declared import schemas_for
from actuaria.streaming import ingest_stream

T0 = dt.datetime(2025, 1, 1, 2, 0)


def write(path, text):
    with open(path, "w", newline="") as fh:
        fh.write(text)


def schema_of(*kinds):
    return T.StructType([T.StructField(n, k) for n, k in kinds])


@pytest.fixture()
def land(scratch):
    os.makedirs(f"{scratch}/landing")
    return f"{scratch}/landing", f"{scratch}/lake"


def ingest(spark, land, day, schemas=None, **options):
    return {r["file"]: r for r in landing.ingest(spark, land[0], land[1], day, T0, schemas, **options).collect()}


# S3


def multi_line(spark, path, columns):
    schema = ", ".join(f"{c} string" for c in columns) + ", _bad string"
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad").csv(path)
    )


def in_splits(spark, path, columns, size):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_bad"]])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, str(size))
    try:
        return split_csv.read_csv(spark, [path], schema, "_bad").drop("_file").collect(), split_csv.lines_of(spark, [path]).rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_split_reader_equals_multi_line(spark, scratch):
    rng = random.Random(5)
    pieces = ["plain", 'say "hi"', "two\nlines", "a,b", '"', "", "\n\n", 'x"\n"y', "long " * 400 + "\n" + "end\n" * 200, " padded ", '","', "é\n世"]
    rows = [[str(k), rng.choice(pieces), rng.choice(pieces)] for k in range(900)]
    path = f"{scratch}/notes.csv"
    with open(path, "w", newline="") as fh:
        out = csv.writer(fh, lineterminator="\n")
        out.writerow(["id", "a", "b"])
        out.writerows(rows)
        fh.write("7000,too few\n7001,a,b,too many\n\n7002,stray \"quote,x\n7003,ends,\"open \n")
    wanted = sorted(map(tuple, multi_line(spark, path, ["id", "a", "b"]).collect()), key=str)
    for size in (2000, 30_000, 10_000_000):
        got, splits = in_splits(spark, path, ["id", "a", "b"], size)
        got = sorted(((*r[:3], r[3]) for r in got), key=str)
        assert [(*r[:2], (r[2] or "").rstrip("\n")) for r in got] == [(*r[:2], (r[2] or "").rstrip("\n")) for r in wanted]
        assert [bool(r[3]) for r in got] == [bool(r[3]) for r in wanted]
        assert splits >= (20 if size == 2000 else 1)


def test_one_field_over_many_splits_and_empty_files(spark, scratch):
    path = f"{scratch}/wide.csv"
    middle = "line with , and \"\" in it\n" * 3000
    write(path, f'id,a\n1,"{middle}"\n2,b\n3,"{middle}"\n')
    got, splits = in_splits(spark, path, ["id", "a"], 4000)
    assert sorted(r["id"] for r in got) == ["1", "2", "3"] and splits > 30
    assert {r["a"] for r in got} == {middle.replace('""', '"'), "b"}
    write(f"{scratch}/none.csv", "id,a\n")
    assert in_splits(spark, f"{scratch}/none.csv", ["id", "a"], 100)[0] == []


def test_line_states_match_a_state_machine():
    def walk(line, inside):
        state = "in" if inside else "start"
        k = 0
        while k < len(line):
            c = line[k]
            if state == "in":
                if c == '"' and line[k + 1 : k + 2] == '"':
                    k += 1
                elif c == '"':
                    state = "text"
            elif c == ",":
                state = "start"
            else:
                state = "in" if state == "start" and c == '"' else "text"
            k += 1
        return state == "in"

    rng = random.Random(1)
    for _ in range(20_000):
        line = "".join(rng.choice('"",,ab') for _ in range(rng.randint(0, 12)))
        for inside in (False, True):
            assert split_csv.ends_inside(line, inside) == walk(line, inside), (line, inside)


def test_splits_that_move_are_told(spark, scratch):
    path = f"{scratch}/x.csv"
    write(path, 'id,a\n' + '1,"b\nc"\n' * 50)
    lines = split_csv.lines_of(spark, [path])
    begins = {f: [(b + 1, s) for b, s in splits] for f, splits in split_csv.split_ends(lines).items()}
    with pytest.raises(Exception, match="SplitsMoved"):
        split_csv.records_of(lines, begins, True).collect()


# S7, S9


def test_batch_and_stream_load_a_file_once(spark, land):
    folder, root = land
    write(f"{folder}/premiums.csv", "territory,gender\n1,M\n2,F\n")
    ingest(spark, land, "20250101")
    told = ingest_stream.run_available(spark, folder, root)
    assert silver.read_bronze(spark, root, "premiums").count() == 2 and told.count() == 1
    write(f"{folder}/premiums_20250102.csv", "territory,gender\n3,M\n")
    write(f"{folder}/empty.csv", "territory\n")
    summary = ingest_stream.run_available(spark, folder, root)
    assert set(ingest(spark, land, "20250103")) == {"empty.csv"}
    assert silver.read_bronze(spark, root, "premiums").count() == 3
    assert {(r["file"], r["status"]) for r in summary.collect()} == {
        ("premiums.csv", "loaded"), ("premiums_20250102.csv", "loaded"), ("empty.csv", "empty"),
    }
    before = {tuple(r) for r in ledger.summary(spark, root).collect()}
    assert ledger.compact(spark, root) == 3 and {tuple(r) for r in ledger.summary(spark, root).collect()} == before
    assert set(ingest(spark, land, "20250104")) == {"empty.csv"} and ledger.summary(spark, root).count() == 3
    assert files.list_files(spark, f"{root}/ops/claims") == []


def test_lost_loader_leaves_its_claim(spark, land):
    folder, root = land
    write(f"{folder}/x.csv", "a\n1\n")
    found = landing.list_landing(spark, folder)
    assert len(ledger.claim(spark, root, found, "20250101", T0, "stream landing")) == 1  # and is lost
    landing.load_files(spark, found, root, "20250101", T0)
    assert ingest(spark, land, "20250105") == {}  # the claim is young
    late = landing.consume(spark, found, root, "20250105", T0, "batch 20250105", lease=-1).collect()
    assert [r["batch_id"] for r in late] == ["20250101"]  # under the claim's batch: over the rows that lie there already
    assert silver.read_bronze(spark, root, "x").count() == 1


def test_changed_file_of_a_name_is_loaded_again_and_archives_keep_both(spark, land, scratch):
    folder, root = land
    for k in range(3):
        write(f"{folder}/x.csv", "a\n" + "1\n" * (k + 1))
        assert ingest(spark, land, "20250101", archive_dir=f"{scratch}/archive")["x.csv"]["rows"] == k + 1
    kept = os.listdir(f"{scratch}/archive")
    assert len(kept) == 3 and "x.csv" in kept and all(n.endswith("x.csv") for n in kept)
    assert silver.read_bronze(spark, root, "x").count() == 3


# S17


def test_lattice():
    dec = T.DecimalType
    cases = [
        (T.ByteType(), T.IntegerType(), T.IntegerType()), (T.IntegerType(), T.LongType(), T.LongType()), (T.LongType(), dec(10, 2), dec(21, 2)),
        (dec(10, 2), dec(8, 4), dec(12, 4)), (dec(38, 0), dec(38, 10), T.DoubleType()), (dec(10, 2), T.DoubleType(), T.DoubleType()),
        (T.LongType(), T.StringType(), T.StringType()), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.BooleanType(), T.IntegerType(), T.StringType()),
        (T.NullType(), T.DateType(), T.DateType()),
    ]
    for a, b, wide in cases:
        assert types.wider(a, b) == types.wider(b, a) == wide


def test_type_changes_between_batches(spark, land):
    folder, root = land
    kinds = [T.IntegerType(), T.LongType(), T.DecimalType(20, 3), T.StringType()]
    values = [["1", "2147483647", ""], ["9007199254740993", "-5"], ["12345678901234567.125", "0.5"], ["n/a", "7"]]
    seen = []
    for k, (kind, held) in enumerate(zip(kinds, values)):
        day = f"2025010{k + 1}"
        write(f"{folder}/x_{day}.csv", "a,v\n" + "".join(f"{k},{v}\n" for v in held))
        ingest(spark, land, day, {"x": schema_of(("a", T.IntegerType()), ("v", kind))})
        assert silver.load_silver(spark, root, "x", T0, [day]) == len(held)
        seen += [(day, v or None) for v in held]
        got = silver.read_silver(spark, root, "x")
        wanted = duckdb.sql(
            "SELECT * FROM (VALUES " + ", ".join(f"('{d}', CAST({'NULL' if v is None else repr(v)} AS VARCHAR))" for d, v in seen) + ") t(batch_id, v)"
        ).fetchall()
        types_ = {"20250101": "INT", "20250102": "BIGINT", "20250103": "DECIMAL(20,3)", "20250104": "VARCHAR"}
        texts = {(d, v): duckdb.sql(f"SELECT CAST(CAST({'NULL' if v is None else repr(v)} AS {types_[d]}) AS VARCHAR)").fetchall()[0][0] for d, v in wanted}
        whole = {"DECIMAL(20,3)": "DECIMAL(22,3)"}.get(types_[day], types_[day])
        own = sorted(((r["batch_id"], None if r["v"] is None else str(r["v"])) for r in got.collect()), key=str)
        want = sorted(((d, duckdb.sql(f"SELECT CAST(CAST({'NULL' if t is None else repr(t)} AS {whole}) AS VARCHAR)").fetchall()[0][0]) for (d, _), t in texts.items()), key=str)
        assert own == want
    assert silver.table_schema(spark, root, "x")["v"].dataType == T.StringType()
    # A batch that is loaded again with another type takes the place of its old generation.
    write(f"{folder}/x_20250104.csv", "a,v\n3,8\n")
    ingest(spark, land, "20250104", {"x": schema_of(("a", T.IntegerType()), ("v", T.LongType()))})
    silver.load_silver(spark, root, "x", T0, ["20250104"])
    assert {str(r["v"]) for r in silver.read_silver(spark, root, "x").where("batch_id = '20250104'").collect()} == {"8.000"}


def test_files_of_one_batch_with_different_types(spark, land):
    folder, root = land
    write(f"{folder}/x.csv", "v\n1\n")
    ingest(spark, land, "20250101", {"x": schema_of(("v", T.IntegerType()))})
    write(f"{folder}/x_20250101.csv", "V,w\n2.5,z\n")
    ingest(spark, land, "20250101", {"x": schema_of(("V", T.DoubleType()))})
    silver.load_silver(spark, root, "x", T0)
    got = silver.read_silver(spark, root, "x").selectExpr("v AS value", "w").collect()
    assert sorted((r["value"], r["w"]) for r in got) == [(1.0, None), (2.5, "z")]


def test_narrowing_is_quarantined_under_a_contract(spark, land):
    folder, root = land
    write(f"{folder}/x.csv", "a,v\n1,5\n2,3000000000\n3,\n4,1.5\n5,word\n")
    ingest(spark, land, "20250101")
    contract = schema_of(("v", T.IntegerType()))
    assert silver.load_silver(spark, root, "x", T0, contract=contract) == 2
    got = silver.read_silver(spark, root, "x")
    assert got.schema["v"].dataType == T.IntegerType()
    assert sorted((r["a"], r["v"]) for r in got.collect()) == [("1", 5), ("3", None)]
    held = [json.loads(r["record"])["v"] for r in spark.read.parquet(f"{root}/quarantine_silver/x").collect()]
    assert sorted(held) == ["1.5", "3000000000", "word"]


def test_report_names_added_and_widened_columns(spark, land):
    folder, root = land
    write(f"{folder}/x_20250101.csv", "v\n1\n")
    ingest(spark, land, "20250101", {"x": schema_of(("v", T.IntegerType()))})
    silver.load_all(spark, root, ["x"], T0)
    write(f"{folder}/x_20250102.csv", "v,w\n2,b\n")
    ingest(spark, land, "20250102", {"x": schema_of(("v", T.LongType()))})
    report = silver.load_all(spark, root, ["x"], T0).first()
    assert (report["added"], report["widened"]) == ("w TEXT", "v bigint")
    assert spark.read.parquet(f"{root}/ops/load_log").count() == 2


# S25


def test_readers_never_see_a_rebuild(spark, scratch):
    table, done, seen, wrong = f"{scratch}/gold", threading.Event(), set(), []
    published.publish(spark, spark.range(100).selectExpr("id", "0 AS version"), table)

    def read():
        while not done.is_set():
            try:
                rows = published.read(spark, table).groupBy("version").count().collect()
                if len(rows) != 1 or rows[0]["count"] != 100:
                    wrong.append(rows)
                seen.add(rows[0]["version"])
            except Exception as exc:
                wrong.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 21):
        assert published.publish(spark, spark.range(100).selectExpr("id", f"{k} AS version"), table, keep=10) == (k + 1, 100)
    done.set()
    reader.join()
    assert not wrong and len(seen) > 2
    with pytest.raises(ValueError):
        published.publish(spark, spark.range(0).selectExpr("id", "99 AS version"), table, gold.check_fact)
    with pytest.raises(Exception):
        published.publish(spark, spark.range(5).selectExpr("raise_error('no') AS id"), table)
    assert published.read(spark, table).first()["version"] == 20
    published.publish(spark, spark.range(1).selectExpr("id", "21 AS version"), table, keep=2)
    assert len(published.versions(spark, table)) == 2 and len(os.listdir(f"{table}/data")) == 2


# S11, 2.9

NAMES = "territory,gender,birthdate,ypc,current_premium,indicated_premium,selected_premium,underlying_premium,fixed_expenses,underlying_total_premium,cgr_factor,cgr"
SETS = ["premiums", "territory_definitions_table", "acs_dp03", "acs_dp05"]


def source_files(folder):
    write(f"{folder}/premiums_20250101.csv", f"{NAMES}\n1502,M,1980-01-01,0,1,1,1,1,1,1,1,\"A\nB\"\n")
    write(f"{folder}/territory-definitions-table.csv", "county,county_code,territory,zipcode,town,area\nALLEGANY,1,1502,21502,CRESAPTOWN,160\n")
    write(f"{folder}/ACS-DP03.csv", "GEO.id2,HC01_VC03,HC01_VC04,HC01_VC05\n21502,10,38.5,50\n")
    write(f"{folder}/ACS-DP05.csv", "GEO.id2,HC01_VC03,HC01_VC04\n21502,11,9\n")


def test_waiting_for_files(spark, land):
    folder, root = land
    assert ingest_stream.run_until_idle(spark, folder, root, poll=0.5, idle=2)[0] == 0  # nothing came: no failure
    late = threading.Timer(2, lambda: write(f"{folder}/x.csv", "a\n1\n"))
    late.start()
    batches, told = ingest_stream.run_until_idle(spark, folder, root, poll=0.5, idle=8)
    late.join()
    assert batches == 1 and [(r["file"], r["rows"]) for r in told.collect()] == [("x.csv", 1)]


def test_stream_to_gold_and_its_retry(spark, land, monkeypatch):
    folder, root = land
    source_files(folder)
    whole, failed = gold.build_gold, []

    def once(*args):
        done = whole(*args)
        if not failed:
            failed.append(done)
            raise RuntimeError("lost after the build")
        return done

    monkeypatch.setattr(gold, "build_gold", once)
    with pytest.raises(Exception):
        ingest_stream.run_available(spark, folder, root, schemas_for(SETS), after=ingest_stream.to_gold(root))
    ingest_stream.run_available(spark, folder, root, schemas_for(SETS), after=ingest_stream.to_gold(root))
    fact = gold.read_gold(spark, root).collect()
    assert failed == [1] and [(r["town"], r["cgr"], r["acs03_median_age"]) for r in fact] == [("CRESAPTOWN", "A\nB", 38.5)]
    assert silver.read_silver(spark, root, "premiums").count() == 1


def test_late_rows_change_their_day(spark, scratch):
    src, base, rows = f"{scratch}/events", dt.datetime(2001, 1, 20), []

    def add(days):
        times = [base + dt.timedelta(days=d) for d in days]
        rows.extend(times)
        df = spark.createDataFrame([(t,) for t in times], "ingested_at timestamp")
        df.write.mode("append").parquet(src)
        got = {r["ingestion_date"]: (r["record_count"], r["late_count"]) for r in ingest_stream.run_daily_counts(spark, src, df.schema, f"{scratch}/lake").collect()}
        assert {d: n for d, (n, _) in got.items()} == {d: sum(t.date() == d for t in rows) for d in {t.date() for t in rows}}
        return {d: late for d, (_, late) in got.items() if late}

    assert add([0, 0.5, 1, 2]) == {}
    assert add([-10, 2.2, 3]) == {dt.date(2001, 1, 10): 1}
    assert add([-10, 0.1]) == {dt.date(2001, 1, 10): 2, dt.date(2001, 1, 20): 1}


# S16, S21, P-11, P-13


def test_catalog_tables(spark, land):
    folder, root = land
    name = f"db_{int(time.time() * 1000)}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/warehouse'")
    source_files(folder)
    ingest(spark, land, "20250101", schemas_for(SETS))
    assert {r["status"] for r in catalog.load_batches(spark, root, name, [*SETS, "missing"], "20250101").collect()} == {"loaded", "failed"}
    assert catalog.tables(spark, name) == sorted(f"stg_{s}" for s in SETS) and catalog.exists(spark, name, "stg_premiums")
    assert not catalog.exists(spark, name, "stg_other") and catalog.tables(spark, "nowhere") == []
    write(f"{folder}/premiums_20250102.csv", f"{NAMES},extra\n1502,F,1980-01-01,1,2,1,1,1,1,1,1,C,new\n")
    wide = schema_of(*[(f.name, T.LongType() if f.name == "territory" else f.dataType) for f in schemas_for(SETS)["premiums"].fields])
    ingest(spark, land, "20250102", {"premiums": wide})
    done = catalog.load_batches(spark, root, name, ["premiums"], "20250102").first()
    assert (done["added"], done["widened"], done["status"]) == ("extra TEXT", "territory bigint", "loaded")
    rows = {r["batch_id"]: (r["territory"], r["extra"], r["cgr"]) for r in spark.table(f"{name}.stg_premiums").collect()}
    assert rows == {"20250101": (1502, None, "A\nB"), "20250102": (1502, "new", "C")}
    newest = catalog.latest(spark, name)
    assert [r["extra"] for r in newest["premiums"].collect()] == ["new"]
    assert {r["batch_id"]: r["rows"] for r in catalog.batch_counts(spark, name, "stg_premiums").collect()} == {"20250101": 1, "20250102": 1}
    assert gold.fact_current(newest["premiums"], newest["territory"], newest["dp03"], newest["dp05"]).count() == 1
    assert catalog.sweep(spark, root, name) == 1 and spark.table(f"{name}.stg_premiums").count() == 2
    with pytest.raises(ValueError):
        catalog.table_name("x; drop")
    spark.sql(f"DROP DATABASE {name} CASCADE")


# A2


def test_sketches_are_near_and_read_only_new_batches(spark, scratch):
    rows = spark.range(200_000).selectExpr("id % 20 AS territory", "id AS policy", "id % 3000 AS person", "concat('b', id % 4) AS batch_id", "CAST(NULL AS STRING) AS none")
    root, by, columns = f"{scratch}/lake", ["territory"], ["policy", "person", "none"]
    for b in range(4):
        sketches.add_batches(spark, root, "s", rows.filter(F.col("batch_id") == f"b{b}"), by, columns)
    sketches.add_batches(spark, root, "s", rows.filter(F.col("batch_id") == "b3"), by, columns)  # again: replaced
    held = sketches.read(spark, root, "s")
    exact = {r["territory"]: r for r in rows.groupBy("territory").agg(F.countDistinct("policy").alias("policy"), F.countDistinct("person").alias("person")).collect()}
    for r in sketches.distinct_counts(held, by).collect():
        true = 0 if r["name"] == "none" else exact[r["territory"]][r["name"]]
        assert abs(r["n_distinct"] - true) <= 0.02 * true and r["n_values"] == (0 if r["name"] == "none" else 10_000)
    total = {r["name"]: r["n_distinct"] for r in sketches.distinct_counts(held).collect()}
    assert abs(total["policy"] - 200_000) < 4000 and abs(total["person"] - 3000) < 60
    plan = sketches.read(spark, root, "s", ["b1"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "b1" in plan
    with pytest.raises(ValueError):
        sketches.read(spark, root, "other")
