"""Token counts of the documents in flat token files, which have no index.

A flat file is a run of token ids in which every document ends with the separator's id. It is
held as a table of fixed-size blocks (file, block, data as little-endian 16- or 32-bit ids), cut
without regard to documents; ``blocks_of_files`` makes that table from binary files.

Each block is searched for separators as one vector. What crosses blocks is a prefix scan over one
row per block: how many tokens and documents come before it, and how many tokens of the document that
is open at its start. A document may span any number of blocks.

Defined results: tokens after the last separator of a file are an unfinished document (``ended`` false); two separators in a
row enclose an empty document of 0 tokens; an empty or null block has none; a block given twice is an error of the file
and counts twice. Null texts are written as empty documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from factorframe.llm.common import Batcher, id_texts, rows_of, saved, table
from factorframe.llm.tokens import encoder

SEPARATOR = 50_256
BLOCK_TOKENS = 1 << 16

_BLOCKS = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("data", pa.binary()), ("doc_ids", pa.list_(pa.int64()))]
)


def write_blocks(docs: DataFrame, *, block_tokens: int = BLOCK_TOKENS, separator: int = SEPARATOR, width: int = 2, tokenizer: str | None = None) -> DataFrame:
    """Documents as blocks of flat files, one file for each task.

    ``doc_ids`` names the documents that end in a block, in order; the scan carries it along but doesn't need it.
    """
    kind = f"<u{width}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, encode = Batcher(_BLOCKS, weight=8 << 20), encoder(tokenizer, strict=True).encode
        file, block = f"{TaskContext.get().partitionId():06d}", 0
        held: list[np.ndarray] = []
        size, ends = 0, []  # of the tokens held; the place and id of each document that ends in them
        for batch in batches:
            for doc_id, text in rows_of(batch):
                ids = np.append(encode(text), np.uint32(separator))
                held.append(ids.astype(kind))
                size += len(ids)
                ends.append((size, doc_id))
                if size < block_tokens:
                    continue
                flat = np.concatenate(held)
                full = size // block_tokens
                for i in range(full):
                    upto = (i + 1) * block_tokens
                    inside = [d for e, d in ends if e <= upto]
                    ends = ends[len(inside) :]
                    data = flat[i * block_tokens : upto].tobytes()
                    if filled := out.add(file, block, data, inside, weight=len(data)):
                        yield filled
                    block += 1
                held, size = [flat[full * block_tokens :]], size - full * block_tokens
                ends = [(e - full * block_tokens, d) for e, d in ends]
        if size:
            out.add(file, block, np.concatenate(held).tobytes(), [d for _, d in ends])
        yield out.flush()

    return id_texts(docs).mapInArrow(run, "file string, block long, data binary, doc_ids array<long>")


def blocks_of_files(spark: SparkSession, path: str, *, block_bytes: int = 2 * BLOCK_TOKENS) -> DataFrame:
    """Binary token files as blocks. Spark reads a file of this kind in one task, so keep each below some hundred MB."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    starts = F.sequence(F.lit(0), F.greatest(F.length("content") - 1, F.lit(0)), F.lit(block_bytes))
    return files.select("file", "content", F.posexplode(starts).alias("block", "start")).select(
        "file",
        F.col("block").cast("long").alias("block"),
        F.substring("content", F.col("start") + 1, F.lit(block_bytes)).alias("data"),
        F.lit(None).cast("array<long>").alias("doc_ids"),
    )


def count_tokens(blocks: DataFrame, *, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """file, document (from 0), doc_id (if the blocks name it), start, n_tokens without the separator, ended.

    ``blocks`` should be a written table, as it is read once for the summary and once for the places.
    """
    kind = f"<u{width}"
    stats = "n long, n_docs long, last long"

    @F.pandas_udf(stats)
    def summary(data):
        rows = []
        for x in data:
            ids = np.frombuffer(x or b"", kind)
            hits = np.flatnonzero(ids == separator)
            rows.append((len(ids), len(hits), int(hits[-1]) if len(hits) else -1))
        return pd.DataFrame(rows, columns=["n", "n_docs", "last"])

    @F.pandas_udf("array<long>")
    def separators(data):
        return pd.Series([np.flatnonzero(np.frombuffer(x or b"", kind) == separator) for x in data])

    each = blocks.select("file", "block", summary("data").alias("s")).select("file", "block", "s.*")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    carried = each.select(
        "file",
        "block",
        "n",
        "n_docs",
        "last",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("docs_before"),
        F.lead("block").over(order).isNull().alias("final"),
    )
    # The place after the last separator before this block: where its open document began.
    ended_at = F.when(F.col("last") >= 0, F.col("tokens_before") + F.col("last") + 1)
    carried = carried.withColumn("open_since", F.coalesce(F.max(ended_at).over(before), F.lit(0)))

    found = blocks.select("file", "block", "doc_ids", separators("data").alias("hits")).join(carried, ["file", "block"])
    at = lambda x: F.col("tokens_before") + x
    rows = F.transform(
        F.col("hits"),
        lambda x, i: F.struct(
            (F.col("docs_before") + i).alias("document"),
            F.try_element_at("doc_ids", i + F.lit(1)).alias("doc_id"),
            F.when(i == 0, F.col("open_since")).otherwise(at(F.get("hits", i - F.lit(1))) + 1).alias("start"),
            at(x).alias("end"),
            F.lit(True).alias("ended"),
        ),
    )
    rest_from = F.when(F.col("last") >= 0, at(F.col("last")) + 1).otherwise(F.col("open_since"))
    rest_to = F.col("tokens_before") + F.col("n")
    rest = F.struct(
        (F.col("docs_before") + F.col("n_docs")).alias("document"),
        F.lit(None).cast("long").alias("doc_id"),
        rest_from.alias("start"),
        rest_to.alias("end"),
        F.lit(False).alias("ended"),
    )
    rows = F.when(F.col("final") & (rest_to > rest_from), F.array_append(rows, rest)).otherwise(rows)
    return found.select("file", F.explode(rows).alias("d")).select(
        "file", "d.document", "d.doc_id", "d.start", (F.col("d.end") - F.col("d.start")).alias("n_tokens"), "d.ended"
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(saved(write_blocks(table(spark, sf_dir, "documents")), "token-blocks"))
