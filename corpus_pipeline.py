"""Corpus pipeline: documents through the training-data operators, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame; ``run`` writes every stage's result as Parquet in the shared folder
and reads it back as the next one's documents. Once it stands, the result before it and
what the stage wrote on its way are removed. The first four return the columns of
documents, the last the places of their token pieces in training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlens.llm.common import materialise, read_table, remove_written, written
from feedlens.llm.decontaminate import decontamination_stage
from feedlens.llm.exact_dedup import exact_dedup_stage
from feedlens.llm.packing import packing_stage
from feedlens.llm.quality import quality_stage
from feedlens.llm.simhash import simhash_stage

STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# A trained classifier, XXH64 fingerprints and tokenizing are beyond SQL: the tests hold
# every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, others = read_table(spark, sf_dir, "documents"), set(written())
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
        remove_written(spark, [path for path in written()[:-1] if path not in others])
    return docs
