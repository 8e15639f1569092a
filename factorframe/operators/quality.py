"""Cleaning, de-duplicating and splitting ratings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions import date_parts, key_fraction
from ..schema import DATE, PARTITION_COLS, RATING, RATING_KEY


def with_date_parts(df: DataFrame, columns: Iterable[str] = PARTITION_COLS) -> DataFrame:
    """Add the partition columns that derive from the date and are missing."""
    parts = date_parts()
    missing = {c: parts[c] for c in columns if c in parts and c not in df.columns}
    return df.withColumns(missing) if missing else df


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop those of ``columns`` that are there."""
    return df.drop(*[c for c in columns if c in df.columns])


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null in ``columns`` (default: in any column)."""
    return df.dropna(subset=list(columns) if columns else None)


def predicted_rows(df: DataFrame, prediction: str = "prediction", label: str | None = None) -> DataFrame:
    """Rows that have a prediction, and a label when one is named.

    A model with the ``nan`` cold-start rule marks unknown pairs with NaN.
    """
    kept = df.where(F.col(prediction).isNotNull() & ~F.isnan(F.col(prediction).cast("double")))
    return kept.where(F.col(label).isNotNull()) if label else kept


def relevant_rows(df: DataFrame, threshold: float, rating: str = RATING) -> DataFrame:
    """Rows rated at least ``threshold``."""
    return df.where(F.col(rating) >= threshold)


def keep_max(
    df: DataFrame, keys: Sequence[str] = RATING_KEY, target: str = RATING
) -> DataFrame:
    """One row per key: the highest target, then the latest date, nulls last.

    An aggregation, so a key that fills a third of the input shrinks to one row
    per task before anything is shuffled. Remaining ties are decided by the other
    columns, so the result does not depend on the order of arrival.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if rest == [target]:
        return df.groupBy(*keys).agg(F.max(target).alias(target)).select(df.columns)

    order = [target] + [c for c in rest if c == DATE]
    others = [c for c in rest if c not in order]
    if any(_has_map(df.schema[c].dataType) for c in others):
        # Maps cannot be compared, so the order ends at target and date.
        best = F.max_by(F.struct(*rest), F.struct(*order)).alias("best")
    else:
        best = F.max(F.struct(*order, *others)).alias("best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"best.{c}").alias(c) for c in df.columns]
    )


def _has_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.MapType):
        return True
    if isinstance(data_type, T.ArrayType):
        return _has_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_has_map(f.dataType) for f in data_type.fields)
    return False


def split_by_key(
    df: DataFrame,
    train_ratio: float = 0.8,
    keys: Sequence[str] = RATING_KEY,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Random train and test parts, drawn per key instead of per row.

    The draw depends on the key and seed alone: both parts agree when either is
    computed again, and a rating that arrives twice stays on its side.
    """
    if not 0.0 < train_ratio < 1.0:
        raise ValueError(f"train_ratio must lie between 0 and 1, got {train_ratio}")
    in_train = key_fraction(*keys, seed=seed) < train_ratio
    return df.where(in_train), df.where(~in_train)


def best_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str], k: int, rank: str) -> DataFrame:
    """The ``k`` rows of each group with the highest first order column."""
    first, *ties = order
    by = Window.partitionBy(*group).orderBy(F.desc(first), *[F.asc(c) for c in ties])
    return df.withColumn(rank, F.row_number().over(by)).where(F.col(rank) <= k)
