"""Corpus pipeline: quality rules, near-duplicates, personal data, a mix of sources, tokens.

Each stage takes the documents that the one before kept, as a table, and returns documents again; the last one
returns tokens. `run` writes every stage's result to the shared folder and reads it for the next.
"""

from pyspark.sql import DataFrame, SparkSession

from groundline.llm import stages
from groundline.llm.common import stored

STAGES = [
    ("quality rules", stages.quality_rules),
    ("near-duplicates", stages.near_duplicates),
    ("personal data", stages.personal_data),
    ("mix", stages.mix_sources),
    ("tokens", stages.tokens),
]

ORACLE_SQL = None  # learned rules, 64-bit hashes and BPE are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; the last result is returned, not stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
