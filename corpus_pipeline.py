"""From documents to token files: toxic texts out, one of each near-duplicate group, no benchmark, mixed, encoded.

Each stage gets what the one before kept, as Parquet in the shared folder, and all but the last
return the columns of ``documents``. No SQL can state the scores, ids and hashes, so ORACLE_SQL is
None; tests hold every stage against a plain version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from duewise.llm.decontamination import drop_contaminated
from duewise.llm.mixing import mixed_documents
from duewise.llm.near_duplicates import drop_near_duplicates
from duewise.llm.shared import table
from duewise.llm.token_files import token_files
from duewise.llm.toxicity import drop_toxic
from duewise.session import stage_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{stage_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
