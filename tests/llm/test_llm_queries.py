"""The registered queries against their SQL, and the pipeline against its stages' promises."""

import os
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from actuaria.llm import queries as registered
from actuaria.llm.common import Workspace, table

SF = os.environ.get("ACTUARIA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_all_queries_are_registered():
    names = [n.split("_")[0] for n in registered.queries()]
    assert names == [f"op{k}" for k in range(1, 14)] and set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("key", sorted(registered.oracle_sql()))
def test_query_matches_sql(spark, duck, key):
    df = registered.queries()[key](spark, SF)
    result = duck.execute(registered.oracle_sql()[key])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(r[c] for c in names) for r in df.collect()) == Counter(result.fetchall())


@pytest.mark.parametrize("key", ["op2_license_scan", "op4_packing", "op7_toxicity", "op8_substring_dedup", "op10_secret_scan", "op12_best_fit_packing"])
def test_other_queries_run(spark, key):
    assert "doc_id" in registered.queries()[key](spark, SF).columns


def test_pipeline_stages(spark):
    work = Workspace(spark, "test")
    docs = first = table(spark, SF, "documents").withColumn("__extra", F.lit(1)).withColumn("size", F.lit("clash"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing", "packing"]
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = work.write(stage(spark, docs, SF), f"s{k}")
        seen.append(docs)
        if name != "packing":
            assert docs.columns == first.columns
            assert docs.filter(F.col("n_chars") != F.length("text")).count() == 0
    kept = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert kept[0] >= kept[2] >= kept[3] == kept[4] and kept[0] == kept[1]
    words = lambda d: d.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert words(seen[3]) <= words(seen[2])
    held = defaultdict(int)
    for r in seen[4].collect():
        held[r["sequence_id"]] += r["length"]
    assert all(0 < n <= 2048 for n in held.values())
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_of_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    work = Workspace(spark, "test")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = work.write(stage(spark, docs, SF), f"e{k}")
    assert docs.count() == 0


def test_near_duplicates_of_rows_without_ids_of_their_own(spark):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(1, text), (1, text), (2, text), (None, text), (None, "quite another text"), (5, None), (5, ""), (5, None), (None, None), (7, "a b c"), (7, "x y z")]
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], "doc_id long, text string, __row int, size string")
    kept = corpus_pipeline.dedup_near(spark, docs, SF)
    assert kept.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sum(t == text for _, t in found) == 1
    rest = sorted(((i, t) for i, t in found if t != text), key=str)
    assert rest == sorted([(None, "quite another text"), (5, None), (5, ""), (None, None), (7, "a b c"), (7, "x y z")], key=str)
    unique = spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.dedup_near(spark, unique, SF).collect()) == [1, 3]
