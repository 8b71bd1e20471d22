"""A corpus pipeline: five stages over the documents, each written and read again.

1. toxicity: documents that the classifier rejects go;
2. near duplicates: one document of each group of alike texts stays;
3. decontamination: documents with a benchmark passage go;
4. secrets: finds are replaced by a mark, the documents stay;
5. packing: what is left, placed in training sequences.

All stages but the last return the columns of documents. No stage can be
expressed in SQL as a whole (a fitted model, set similarity, tokenizers), so
there is no ORACLE_SQL. The operators are tested against brute force; the test of
the pipeline checks what each stage keeps and how texts change.

Null texts are empty ones and pass all stages; rows that repeat an id and a text
are decided alike, and near_duplicates keeps one of them; extra columns stay up to
the last stage; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcweave.llm import decontaminate, jaccard_join, packing, secrets, toxicity
from arcweave.scratch import Scratch


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a score under 0.5."""
    scratch = Scratch(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out())
    weights = toxicity.fit(docs, labels, scratch)
    scored = toxicity.score(docs, weights, keep=tuple(docs.columns))
    return scored.where(F.col("toxicity_score") < 0.5).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of texts with a shingle similarity of 0.8 or more."""
    return jaccard_join.one_of_each_group(docs, Scratch(spark))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without any benchmark window."""
    scratch = Scratch(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(docs, items, scratch)
    bad = scratch.save(found.where(F.col("n_hit") > 0).select(F.col("text_key").alias("_key")).distinct(), "contaminated")
    key = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    few = bad.count() <= decontaminate.BROADCAST_WINDOWS
    return docs.join(F.broadcast(bad) if few else bad, key == F.col("_key"), "left_anti")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; a column n_chars follows the text."""
    scanned = secrets.scan(docs, keep=tuple(docs.columns))
    clean = scanned.withColumn("text", F.coalesce("scan_text", "text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("scan_text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return clean.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, and their places in sequences."""
    scratch = Scratch(spark)
    return packing.pack(scratch.save(packing.pieces(docs), "pieces"), scratch)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; stages are Parquet in the shared folder."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch.folder(name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
