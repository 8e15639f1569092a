"""Factor tables in buckets by id, and joins that do not shuffle them.

A factor table too large to be sent to every executor is shuffled by each job that joins it, vectors and all. Written once in
buckets, it stays where it is: only the rows to be scored move, to the bucket of their id. Ids that very many
rows ask for would fill one bucket's task; those above a share of all rows, so of a bounded number, get their vectors by
broadcast instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import dot
from ..sources import storage
from ..sources.factors import factor_shape
from .scoring import hot_ids

#: Buckets unless given: at rank 64, 25 billion bytes of vectors make buckets of about 128 MB.
BUCKETS = 200


def write_bucketed_factors(factors: DataFrame, name: str, *, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """Store a checked factor table in the catalog as ``name``, in buckets by id, one file each."""
    spark = factors.sparkSession
    factor_shape(factors)
    rows = factors.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<float>").alias("features"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    path = path or storage.scratch_path(spark, "bucketed-factors")
    writer = rows.repartition(buckets, "id").write.mode("overwrite").format("parquet").bucketBy(buckets, "id").sortBy("id")
    writer.option("path", path).saveAsTable(name)
    return spark.table(name)


def bucket_count(spark: SparkSession, name: str) -> int:
    """Number of buckets of a table; ValueError when it has none by ``id``."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if about.get("Bucket Columns") != "[`id`]":
        raise ValueError(f"{name} is not bucketed by id")
    return int(about["Num Buckets"])


def _with_vectors(rows: DataFrame, key: str, name: str, out: str, hot: list[int]) -> DataFrame:
    """``rows`` with the vector of each ``key`` as ``out``, null where there is none."""
    buckets = bucket_count(rows.sparkSession, name)
    vectors = rows.sparkSession.table(name).select(F.col("id").alias(f"{out}_id"), F.col("features").alias(out))
    wanted, given = F.col(key).cast("long"), [F.col(f"`{c}`") for c in rows.columns]
    # A row without an id goes to some bucket, by its other columns, and finds nothing there.
    place = F.coalesce(wanted, -1 - F.pmod(F.xxhash64(*given), F.lit(1 << 40)))
    is_hot = F.coalesce(wanted.isin(hot), F.lit(False))
    cold = rows.where(~is_hot).withColumn(f"{out}_place", place).repartition(buckets, f"{out}_place")
    joined = cold.join(vectors.hint("merge"), F.col(f"{out}_place") == F.col(f"{out}_id"), "left")
    joined = joined.select(*given, F.when(wanted.isNotNull(), F.col(out)).alias(out))
    if not hot:
        return joined
    few = F.broadcast(vectors.where(F.col(f"{out}_id").isin(hot)))
    return joined.unionByName(rows.where(is_hot).join(few, wanted == F.col(f"{out}_id"), "left").select(*given, out))


def found_rows(rows: DataFrame, key: str, name: str) -> int:
    """How many rows have a ``key`` that the table knows; only ids and their counts are joined."""
    sizes = rows.groupBy(F.col(key).cast("long").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(rows.sparkSession.table(name).select("id"), "id").agg(F.sum("n")).first()[0] or 0


def predict_pairs_bucketed(pairs: DataFrame, users: str, items: str, *, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """As :func:`predict_pairs`, from two tables that :func:`write_bucketed_factors` has stored.

    The pairs are counted by id first, then shuffled once for each table, the second time with one vector. The table that fewer
    pairs are known to comes first, so that only these carry one.
    """
    spark, joined = pairs.sparkSession, pairs
    sides = [(user, users, "_u"), (item, items, "_i")]
    for key, name, out in sorted(sides, key=lambda side: found_rows(pairs, *side[:2])):
        joined = _with_vectors(joined, key, name, out, hot_ids(pairs, key, bucket_count(spark, name)))
    return joined.select(*pairs.columns, F.coalesce(dot(F.col("_u"), F.col("_i")), F.lit(0.0)).alias("prediction"))
