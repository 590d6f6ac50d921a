"""The corpus pipeline: documents pass the stages in order.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns the rows that it keeps (the last one its result).
``run`` writes each stage's rows as Parquet to the shared folder and reads
them again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm import bpe, mixing, ngram_join, suffix_dedup, toxicity
from sparkmart.llm._common import stored, workspace

STAGES = [
    ("toxicity", toxicity.stage),
    ("ngram_jaccard_join", ngram_join.stage),
    ("suffix_array_dedup", suffix_dedup.stage),
    ("mixing", mixing.stage),
    ("bpe", bpe.stage),
]

#: SQL can't express scores, components and tokens; tests/llm holds the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = workspace(spark, "pipeline")
    for place, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{place}_{name}")
    return docs
