"""The corpus pipeline: toxicity, line dedup, near-duplicate join, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a stage's result is
written as Parquet and read again as the next one's ``docs``.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actuaria.llm import line_dedup, mixing, ngram_join, packing, toxicity
from actuaria.llm.common import Workspace, importable, sized, table


def small_batches(spark: SparkSession, documents: int = 2000) -> None:
    """Let Arrow batches hold fewer documents than Spark's 10,000, where the session says nothing of its own.

    A batch is held several times on its way between an executor and its Python worker.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(documents))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from ``labels``, does not reject."""
    small_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), Workspace(spark, "toxicity"))
    return toxicity.drop_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long lines that at least five of them share, but in one each."""
    small_batches(spark)
    done = line_dedup.dedup_lines(docs, Workspace(spark, "lines"))
    changed = {"text": F.when(F.col("__n_dropped") > 0, F.col("__kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("__n_dropped") > 0, F.length("__kept")).otherwise(F.col("n_chars")).cast(
            docs.schema["n_chars"].dataType
        )
    return done.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, Jaccard 0.8 or more.

    Of rows that are equal in id and text one stays.  Where ids are null or repeated, rows are told apart by numbers of
    their own, so an id with two texts is two documents and a null id keeps nothing but its own row.
    """
    small_batches(spark)
    work = Workspace(spark, "near")
    unclear = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL")
    if unclear.isEmpty():
        return docs.join(sized(gone_ids(docs, work)), F.col("doc_id").cast("long").eqNullSafe(F.col("__gone")), "left_anti")
    numbered = docs.dropDuplicates(["doc_id", "text"]).withColumn("__near_number", F.monotonically_increasing_id())
    numbered = work.write(numbered, "numbered")
    gone = gone_ids(numbered.select(F.col("__near_number").alias("doc_id"), "text"), work)
    return numbered.join(sized(gone), F.col("__near_number") == F.col("__gone"), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def gone_ids(docs: DataFrame, work: Workspace) -> DataFrame:
    """(__gone): the ids that are not the least of their group."""
    groups = ngram_join.jaccard_components(docs, work, size=5, percent=80)
    return work.write(groups.filter("component_id <> doc_id").select(F.col("doc_id").alias("__gone")), "gone")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the source weights take them."""
    return mixing.repeat_taken(docs, Workspace(spark, "mix"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    importable(spark)
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_near),
    ("mixing", mix),
    ("packing", pack),
]

#: The first stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = work.write(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
