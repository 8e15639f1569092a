"""The operators as pipeline stages: (spark, docs, sf_dir) in, documents out.

Every stage but the last returns the columns that it was given, for the documents it keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from factorframe.llm import decontaminate, language_id, line_dedup, near_dup, packing
from factorframe.llm.common import saved, table, whole_rows


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without a letter, or unlike every language learnt, go."""
    profiles = language_id.learn_profiles(docs.where(~language_id.held_out(F.col("doc_id"))))
    judged = docs.select(whole_rows(docs), language_id.language_of(F.col("text"), profiles).alias("found"))
    return judged.where(language_id.accepted(F.col("found"))).select("row.*")


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later copies of three-line windows go, n_chars follows; a document goes when no word of it is left."""
    cut = line_dedup.dedup_lines(docs, keep_names=True)
    gone = (F.col("n_removed_lines") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = cut.where(~F.coalesce(gone, F.lit(False)))
    row = F.col("row")
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed_lines") > 0, F.length("text")).otherwise(row["n_chars"])}
    return cut.select(*[changed[f.name].cast(f.dataType).alias(f.name) if f.name in changed else row[f.name].alias(f.name) for f in docs.schema])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group of documents alike the one of the least doc_id stays, in one row.

    Documents without a doc_id are in no group and stay.
    """
    kept = near_dup.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    one = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.union(docs.where("doc_id IS NULL").select(*one.columns)).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that hold an item of ``benchmark`` go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the pieces of all documents with their places in sequences."""
    return packing.pack(saved(packing.pieces(docs), "pieces"))
