"""From raw documents to packed training sequences, in stages that read what the last one wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factorframe.llm import stages
from factorframe.llm.common import saved, table

STAGES = [
    ("language_id", stages.keep_known_languages),
    ("line_dedup", stages.cut_repeated_lines),
    ("minhash_near_dup", stages.keep_one_of_near_copies),
    ("benchmark_decontamination", stages.drop_benchmark_leaks),
    ("best_fit_packing", stages.pack_sequences),
]

#: Several stages are beyond SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes a table to the shared folder, which the next reads."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, name)
    return docs
