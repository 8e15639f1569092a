"""Factor tables: one row per user or item, an id and a feature vector."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import storage


#: Largest factor table that is sent to every executor, and the room of a row beside its vector.
BROADCAST_BYTES = 128 << 20
_ROW_OVERHEAD_BYTES = 64


@dataclass(frozen=True)
class FactorShape:
    """Size of a factor table: what block sizes and broadcasts are decided on."""

    rows: int
    rank: int

    @property
    def broadcastable(self) -> bool:
        """Whether the table is small enough to be sent to every executor."""
        return self.rows * (4 * self.rank + _ROW_OVERHEAD_BYTES) <= BROADCAST_BYTES


def factor_stats(factors: DataFrame, id_col: str = "id", features: str = "features") -> DataFrame:
    """One row: ``n``, ``null_ids``, ``distinct_ids``, ``min_rank``, ``max_rank`` and ``bad_vectors``.

    A bad vector has an element that is null, NaN or infinite. Only ids are shuffled.
    """
    broken = F.exists(features, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    size = F.when(F.col(features).isNull(), F.lit(0)).otherwise(F.size(features))
    return factors.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(id_col).isNull()).alias("null_ids"),
        F.count_distinct(id_col).alias("distinct_ids"),
        F.min(size).alias("min_rank"),
        F.max(size).alias("max_rank"),
        F.count_if(broken).alias("bad_vectors"),
    )


def factor_shape(
    factors: DataFrame, id_col: str = "id", features: str = "features", *, allow_empty: bool = False
) -> FactorShape:
    """Check a factor table and return its size.

    Raises ValueError unless both columns are there, every id is set and unique,
    every vector has the same length and finite elements only, and there is at
    least one row.
    """
    for column in (id_col, features):
        if column not in factors.columns:
            raise ValueError(f"column {column!r} is missing; there are {factors.columns}")
    stats = factor_stats(factors, id_col, features).first()
    if stats["n"] == 0:
        if allow_empty:
            return FactorShape(0, 0)
        raise ValueError("the factor table has no rows")
    if stats["null_ids"]:
        raise ValueError(f"{stats['null_ids']} factor rows have no id")
    if stats["distinct_ids"] != stats["n"]:
        raise ValueError(f"{stats['n'] - stats['distinct_ids']} factor rows repeat an id")
    if stats["bad_vectors"]:
        raise ValueError(f"{stats['bad_vectors']} factor vectors have an element that is no finite number")
    if stats["min_rank"] != stats["max_rank"] or stats["min_rank"] == 0:
        raise ValueError(
            f"factor vectors differ in length: {stats['min_rank']} to {stats['max_rank']}"
        )
    return FactorShape(stats["n"], stats["max_rank"])


def read_factors(spark: SparkSession, path: str, id_col: str = "id") -> DataFrame:
    """A checked factor table as ``id bigint, features array<float>``."""
    if not storage.exists(spark, path):
        raise FileNotFoundError(f"no factor table at {path}")
    raw = spark.read.parquet(path)
    factor_shape(raw, id_col)
    return as_factors(raw, id_col)


def as_factors(df: DataFrame, id_col: str = "id", features: str = "features") -> DataFrame:
    """Any id and vector columns in the shape the scoring operators take."""
    return df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(features).cast("array<float>").alias("features"),
    )


def factor_manifest(
    users: DataFrame,
    items: DataFrame,
    *,
    source_version: str,
    user_id_column: str = "id",
    item_id_column: str = "id",
) -> DataFrame:
    """One row that describes a pair of factor tables: counts, rank, origin."""
    sides = users.select(F.lit("user").alias("side"), "features").unionByName(
        items.select(F.lit("item").alias("side"), "features")
    )
    return sides.agg(
        F.count_if(F.col("side") == "user").alias("user_count"),
        F.count_if(F.col("side") == "item").alias("item_count"),
        F.max(F.size("features")).alias("rank"),
    ).select(
        "user_count",
        "item_count",
        "rank",
        F.lit(user_id_column).alias("user_id_column"),
        F.lit(item_id_column).alias("item_id_column"),
        F.lit(source_version).alias("source_version"),
    )
