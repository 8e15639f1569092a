"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from factorframe.sources import storage

#: What separates words, for splitting in SQL; ``bytes.split()`` splits at the same six characters.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a lost executor costs none of it.

    Once it is written, the shuffle files it was made from are of no more use, and go.
    """
    spark = df.sparkSession
    path, before = storage.scratch_path(spark, label), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def drop_saved(*frames: DataFrame) -> None:
    """Delete the tables behind frames that ``saved`` gave and nothing reads any more."""
    for df in frames:
        storage.delete(df.sparkSession, df.saved_path)


def spread(df: DataFrame, per_partition: int = 1) -> int:
    """Partitions for a shuffle by hand, in step with the session's own number."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * per_partition)


def whole_rows(docs: DataFrame) -> Column:
    """All columns as one struct, so that no column added beside it can clash; ``select("row.*")`` undoes it."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")


def id_texts(docs: DataFrame) -> DataFrame:
    """Only doc_id and text: other columns, whatever their names, never reach the operators."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str | None]]:
    """The pairs of a batch of ``id_texts``; a text becomes Python's one at a time."""
    for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
        yield doc_id.as_py(), text.as_py()


class Batcher:
    """Gathers rows and gives them out as record batches of bounded size."""

    def __init__(self, schema: pa.Schema, rows: int = 20_000, weight: int = 16 << 20) -> None:
        self.schema, self.rows, self.weight = schema, rows, weight
        self._start()

    def _start(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.held = 0

    def add(self, *values, weight: int = 0) -> pa.RecordBatch | None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.held += weight
        if len(self.columns[0]) >= self.rows or self.held >= self.weight:
            return self.flush()
        return None

    def flush(self) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)]
        self._start()
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


class WordHashes(dict):
    """64-bit hashes of words (as bytes), each computed once; forgets all when it holds too many."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX2
    return x ^ (x >> np.uint64(29))


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of n-word shingles; fewer words make one shingle, none make none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    take = min(n, len(words))
    h = np.full(len(words) - take + 1, np.uint64(take))
    for i in range(take):
        h = mix(h * _MIX + words[i : len(words) - take + 1 + i])
    return np.unique(h)
