"""Reading and writing rating datasets."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.quality import complete_rows, drop_columns, keep_max, with_date_parts
from ..schema import (
    ARRIVALS_CSV,
    DATE,
    ITEM,
    MONTH,
    PARTITION_COLS,
    RATING,
    RATING_KEY,
    USER,
    YEAR,
)
from . import storage
from .counts import RowCounts, UpsertCounts

_DEFAULT_WRITE_OPTIONS = {"compression": "snappy"}


def read_ratings(spark: SparkSession, path: str, *, merge_schema: bool = False) -> DataFrame:
    """A stored rating dataset; filters on ``year`` and ``month`` prune its folders."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_ratings_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """As :func:`read_ratings`; None when there is no dataset yet."""
    return storage.read_parquet_if_exists(spark, path)


def read_ratings_csv(spark: SparkSession, path: str | list[str], *, complete: bool = True) -> DataFrame:
    """Arrived ratings: CSV with a header. Rows with a null or bad field go, or have nulls if not ``complete``."""
    arrived = spark.read.schema(ARRIVALS_CSV).option("header", True).csv(path)
    typed = arrived.withColumn(DATE, F.try_to_date(DATE))
    return complete_rows(typed) if complete else typed


def write_ratings(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_cols: Sequence[str] = PARTITION_COLS,
    target_repartition: int | None = None,
    table_name: str | None = None,
    options: Mapping[str, str] | None = None,
    counts: RowCounts | None = None,
) -> None:
    """Write Parquet in one folder per partition value.

    The rows are rebalanced by partition: small partitions share a task and a
    large one is split over many, so neither a flood of small files nor a single
    writer for a hot month appears. ``target_repartition`` sets the number of
    shuffle partitions the rebalancing starts from. ``counts`` gets the rows as ``written``.
    """
    partition_cols = list(partition_cols)
    out = with_date_parts(df, partition_cols)
    if partition_cols:
        start = [target_repartition] if target_repartition else []
        out = out.hint("rebalance", *start, *partition_cols)
    if counts is not None:
        out = counts.tap(out, "written")
    writer = out.write.mode(mode).options(**{**_DEFAULT_WRITE_OPTIONS, **(options or {})})
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    if table_name:
        register_table(df.sparkSession, table_name, path, repair=bool(partition_cols))


def register_table(spark: SparkSession, name: str, path: str, *, repair: bool = True) -> None:
    """Name a Parquet dataset in the catalog and load its partitions."""
    quoted = ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted} USING PARQUET LOCATION '{location}'")
    if repair:
        spark.sql(f"MSCK REPAIR TABLE {quoted}")
    spark.catalog.refreshTable(quoted)


def upsert_ratings(
    new: DataFrame,
    path: str,
    *,
    keys: Sequence[str] = RATING_KEY,
    target: str = RATING,
    partition_cols: Sequence[str] = PARTITION_COLS,
    rewrite: str = "touched",
    stage: bool = True,
    target_repartition: int | None = None,
    table_name: str | None = None,
    options: Mapping[str, str] | None = None,
    with_counts: bool = False,
) -> DataFrame | tuple[DataFrame, UpsertCounts]:
    """Merge ratings into a dataset, keeping the highest rating of each key.

    A dataset that does not exist yet is written at once. Otherwise the complete
    new rows are staged next to the dataset first, as they come and without a
    shuffle, so their source is read once; the merge de-duplicates them.
    ``stage=False`` leaves that out for rows that are a stored dataset with the
    same partition columns. Then:

    ``rewrite="touched"``
        Only the partitions the new rows fall into are read, merged and replaced:
        the merged folders are written aside, and moved in when all are complete.
        A lost executor or driver loses nothing; the next call ends what broke off
        (see :func:`finish_swap`). Exact as long as the key fixes the
        partition; if the date is no key column, or the columns change, all
        partitions are rewritten.
    ``rewrite="all"``
        The whole dataset is cleaned and de-duplicated again, written aside and
        swapped in. For datasets that something else wrote.

    Returns the merged dataset, read back; ``with_counts`` also what came, was left out and was written, observed
    by the jobs that write.
    """
    if rewrite not in ("touched", "all"):
        raise ValueError(f"rewrite must be 'touched' or 'all', got {rewrite!r}")
    spark = new.sparkSession
    keys, partition_cols = list(keys), list(partition_cols)
    required = [*keys, target]
    layout = dict(
        partition_cols=partition_cols, target_repartition=target_repartition, options=options
    )

    counts = RowCounts() if with_counts else None

    def tap(df: DataFrame, name: str) -> DataFrame:
        return df if counts is None else counts.tap(df, name)

    def complete(df: DataFrame) -> DataFrame:
        return complete_rows(drop_columns(df, partition_cols), required)

    def clean(df: DataFrame) -> DataFrame:
        # Incomplete rows never win over complete ones of a key, so they can go first.
        return keep_max(complete(df), keys, target)

    def arrived(df: DataFrame) -> DataFrame:
        if counts is None:
            return df
        return tap(complete_rows(tap(df, "in"), required), "complete")

    finish_swap(spark, path)
    existing = storage.read_parquet_if_exists(spark, path)
    staged_path = storage.sibling(path, "staged") if stage and existing is not None else None
    try:
        if existing is None:
            write_ratings(clean(arrived(new)), path, **layout, counts=counts)
        else:
            added = new
            if staged_path:
                writer = complete(arrived(new)).write.options(**{**_DEFAULT_WRITE_OPTIONS, **(options or {})})
                writer.parquet(staged_path)
                added = with_date_parts(read_ratings(spark, staged_path), partition_cols)
                if partition_cols and added.isEmpty():
                    added = None
            # Elsewhere a key could sit in another partition, or a column be missing.
            local_change = (
                added is not None
                and DATE in keys
                and partition_cols
                and sorted(existing.dtypes) == sorted(added.dtypes)
            )
            depth = 0
            if rewrite == "touched" and local_change:
                old = _only_partitions_of(existing, added, partition_cols)
                depth = len(partition_cols)
            else:
                old = existing if added is not None or rewrite == "all" else None
            if old is not None:
                rows = old = tap(old, "existing")
                if added is not None:
                    rows = _union(old, added if staged_path else arrived(added), partition_cols)
                write_ratings(clean(rows), f"{_swap_path(path, depth)}/new", **layout, counts=counts)
                finish_swap(spark, path)
    finally:
        if staged_path:
            storage.delete(spark, staged_path)
        # What is not complete has changed nothing and goes; what is complete waits for the next call.
        _drop_unfinished(spark, path)
    if table_name:
        register_table(spark, table_name, path, repair=bool(partition_cols))
    merged = storage.read_parquet_if_exists(spark, path)
    merged = clean(new) if merged is None else merged
    if counts is None:
        return merged
    came = counts.rows("in", recount=True)
    left_out = came - counts.rows("complete", recount=True)
    return merged, UpsertCounts(came, left_out, counts.rows("existing"), counts.rows("written"))


def _union(existing: DataFrame, new: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Both datasets by column name; a column only one of them has is null in the other."""
    return drop_columns(existing, partition_cols).unionByName(
        drop_columns(new, partition_cols), allowMissingColumns=True
    )


def _only_partitions_of(
    existing: DataFrame, staged: DataFrame, partition_cols: Sequence[str]
) -> DataFrame:
    """The rows of ``existing`` in the partitions of ``staged``, as a folder filter.

    The partition values come from the dates of the staged rows, or from their folders
    without reading a column; there are at most as many as calendar months.
    """
    values = staged.select(*partition_cols).distinct().dropna().collect()
    inside = F.lit(False)
    if len(partition_cols) == 1:
        inside = F.col(partition_cols[0]).isin([row[0] for row in values])
    elif set(partition_cols) == {YEAR, MONTH}:
        months: dict[int, list[int]] = {}
        for row in values:
            months.setdefault(row[YEAR], []).append(row[MONTH])
        for year, in_year in sorted(months.items()):
            inside = inside | ((F.col(YEAR) == year) & F.col(MONTH).isin(sorted(in_year)))
    else:
        raise ValueError(f"partition columns must derive from the date, got {partition_cols}")
    return existing.where(inside)


#: Kinds of swap: of the whole dataset, or of its partition folders, that many levels down.
_DEPTHS = (0, 1, 2)


def _swap_path(path: str, depth: int) -> str:
    """Where new data waits to take the place of old: one name per dataset, so a later call finds it."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.swap{depth}-{name}" if parent else f".swap{depth}-{name}"


def finish_swap(spark: SparkSession, path: str) -> None:
    """Put complete new data in the place of the old, also after a call that broke off in between.

    Each folder is moved aside, then the new one moved in. What was moved aside goes when all
    are in. New data without Spark's mark of success was never complete and is deleted.
    """
    _drop_unfinished(spark, path)
    for depth in _DEPTHS:
        swap = _swap_path(path, depth)
        if not storage.exists(spark, f"{swap}/new"):
            # All folders are in: only the end was missing.
            storage.delete(spark, swap)
            continue
        for folder in _folders(spark, f"{swap}/new", depth):
            target, old = (f"{base}/{folder}".rstrip("/") for base in (path.rstrip("/"), f"{swap}/old"))
            if storage.exists(spark, target) and not storage.exists(spark, old):
                storage.rename(spark, target, old)
            storage.rename(spark, f"{swap}/new/{folder}".rstrip("/"), target)
        storage.delete(spark, swap)


def _folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below, or the folder itself as ``""``."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{d}".lstrip("/") for f in found for d in storage.list_dirs(spark, f"{path}/{f}".rstrip("/")) if "=" in d]
    return found


def _drop_unfinished(spark: SparkSession, path: str) -> None:
    for depth in _DEPTHS:
        swap = _swap_path(path, depth)
        begun = storage.exists(spark, f"{swap}/old")
        if storage.exists(spark, f"{swap}/new") and not begun and not storage.exists(spark, f"{swap}/new/_SUCCESS"):
            storage.delete(spark, swap)


def write_replay_csv(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """Ratings as CSV in date order: date, user, item, rating, no nulls, with header.

    The files sort by name in date order. Sorting by more than the date, down to
    the place of the row in the input, lets a date or a row with very many copies
    be divided between files. ``single_file`` gives one file, which one task has
    to write.
    """
    columns = [DATE, USER, ITEM, RATING]
    rows = complete_rows(df.select(*columns))
    ordered = rows.orderBy(*columns, F.monotonically_increasing_id()).select(*columns)
    if single_file:
        ordered = ordered.coalesce(1)
    ordered.write.mode("overwrite").option("header", True).csv(path)


def remove_sources(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Delete consumed inputs; returns those that could not be deleted."""
    failed = []
    for path in paths:
        try:
            if storage.exists(spark, path) and not storage.delete(spark, path):
                failed.append(path)
        except Exception:  # the work is done; a leftover input must not undo it
            failed.append(path)
    return failed
