"""Drift reports from a stored row per month instead of from all ratings.

A month's row holds what adds up: its histogram over the rating domain, sum, numbers of rows and of values, and a quantile sketch.
Only months whose ratings have changed are summarised again; a report merges rows, a few hundred at most, and is the one that
:func:`data_drift` makes of the ratings, but for the median: that is within ``RANK_ERROR`` of rank of the middle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schema import MONTH, PARTITION_COLS, RATING, RATING_VALUES, YEAR
from ..sources import storage
from .drift import SIDES, _as_report
from .quality import with_date_parts

#: Size of a sketch, some 20 KB a month, and how far, in rank, a median of merged sketches may be from the middle.
SKETCH_K = 1024
RANK_ERROR = 0.01

Month = tuple[int, int]


def month_summaries(ratings: DataFrame, rating: str = RATING) -> DataFrame:
    """One row per month of ``ratings``: ``year, month, n1`` to ``n5``, ``total, n_values, sum, sketch``.

    Tasks sum up before the shuffle, so a month with most of the rows is a row per task.
    """
    value = F.col(rating).cast("double")
    return with_date_parts(ratings).groupBy(*PARTITION_COLS).agg(
        *[F.count_if(value == v).alias(f"n{v}") for v in RATING_VALUES],
        F.count(F.lit(1)).alias("total"),
        F.count(value).alias("n_values"),
        F.sum(value).alias("sum"),
        F.kll_sketch_agg_double(value, F.lit(SKETCH_K)).alias("sketch"),
    )


class MonthSummaries:
    """The rows of a dataset's months, stored below ``path`` in a folder each."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, month: Month) -> str:
        return f"{self.path}/{YEAR}={month[0]}/{MONTH}={month[1]}"

    def refresh(self, ratings: DataFrame, months: Iterable[Month] | None = None, *, rating: str = RATING) -> None:
        """Summarise months again, of which ``ratings`` holds all rows; default all months that it has.

        With ``months``, only their folders of a stored dataset are read, and those that have no rating any more go.
        A month's folder is replaced by a rename; a call that broke off is made again.
        """
        aside = storage.sibling(self.path, "summaries")
        rows = with_date_parts(ratings)
        if months is not None:
            months = sorted(set(months))
            inside = F.lit(False)
            for year in {y for y, _ in months}:
                inside = inside | ((F.col(YEAR) == year) & F.col(MONTH).isin([m for y, m in months if y == year]))
            rows = rows.where(inside)
        try:
            # A few rows: one file a month, and one task to write them.
            month_summaries(rows, rating).dropna(subset=list(PARTITION_COLS)).coalesce(1).write.partitionBy(*PARTITION_COLS).parquet(aside)
            made = {
                (int(y.partition("=")[2]), int(m.partition("=")[2]))
                for y in storage.list_dirs(self.spark, aside)
                for m in storage.list_dirs(self.spark, f"{aside}/{y}")
            }
            for month in sorted(made | set(months or [])):
                storage.delete(self.spark, self._folder(month))
                if month in made:
                    storage.rename(self.spark, f"{aside}/{YEAR}={month[0]}/{MONTH}={month[1]}", self._folder(month))
        finally:
            storage.delete(self.spark, aside)

    def read(self) -> DataFrame | None:
        """The stored rows; None when there is none."""
        return storage.read_parquet_if_exists(self.spark, self.path)


def drift_from_summaries(original: DataFrame, current: DataFrame) -> DataFrame:
    """The report of :func:`data_drift` from the rows of :func:`month_summaries` of both sides."""
    both = None
    for side, df in zip(SIDES, (original, current)):
        tagged = df.drop(*PARTITION_COLS).withColumn("side", F.lit(side))
        both = tagged if both is None else both.unionByName(tagged)
    columns: list[Column] = []
    for side in SIDES:
        def own(name: str, side: str = side) -> Column:
            return F.when(F.col("side") == side, F.col(name))

        def total(name: str) -> Column:
            return F.coalesce(F.sum(own(name)), F.lit(0))

        columns += [
            F.array(*[total(f"n{v}") for v in RATING_VALUES]).alias(f"{side}_counts"),
            F.try_divide(F.sum(own("sum")), F.sum(own("n_values"))).alias(f"{side}_mean"),
            F.kll_merge_agg_double(own("sketch")).alias(f"{side}_sketch"),
            F.sum(own("n_values")).alias(f"{side}_values"),
            total("total").alias(f"{side}_total"),
        ]
    merged = both.agg(*columns)
    for side in SIDES:
        middle = F.kll_sketch_get_quantile_double(f"{side}_sketch", F.lit(0.5))
        merged = merged.withColumn(f"{side}_median", F.when(F.col(f"{side}_values") > 0, middle))
    return _as_report(merged, "")
