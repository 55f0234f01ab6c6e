"""The training-data pipeline: each stage takes the documents that its predecessor kept.

quality classifier (rejected documents go) -> line dedup (later copies of line runs go, documents of which nothing is
left go) -> SimHash near-dedup (of each group the smallest doc_id stays) -> benchmark decontamination (hit spans go)
-> mixing sources to target weights (documents are repeated or left out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import fmindex, linedup, mixing, quality, simhash
from lexweave.llm.common import shared_dir, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(spark, docs, model)
    return scored.filter(F.col(scored.columns[-1]) == 1).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that line dedup empties are copies as a whole and go; those without lines before stay."""
    out = linedup.dedup_lines(spark, docs)
    n, gone = out.columns[-3:-1]
    out = out.filter((F.col(n) == 0) | (F.col(gone) < F.col(n)))
    return sized(out.select(*docs.columns))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(spark, docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sized(fmindex.decontaminate(spark, docs, table(spark, sf_dir, "benchmark")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, docs)


def sized(docs: DataFrame) -> DataFrame:
    """docs with n_chars brought up to date with text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources", mixing_stage),
]

#: The classifier, the fingerprints and the index are not expressible in SQL; tests hold run() against plain models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet in the shared folder and read again."""
    import uuid

    docs = table(spark, sf_dir, "documents")
    root = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
