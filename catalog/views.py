"""The given tables, seen as ratings, factors, feedback and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from factorframe.schema import DATE, ITEM, RATING, USER
from factorframe.sources import as_factors, storage

#: Ratings before this day are the original ones, later ones have arrived since.
CUT = "1999-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as ratings: the part is the item, the customer the user."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").cast("int").alias(ITEM),
        F.col("o_custkey").cast("int").alias(USER),
        ((F.col("l_quantity").cast("int") - 1) % 5 + 1).alias(RATING),
        F.to_date("o_orderdate").alias(DATE),
        F.col("l_orderkey").alias("order"),
        F.col("l_linenumber").cast("int").alias("line"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_ratings(spark, sf_dir).drop("order", "line")


def original(df: DataFrame) -> DataFrame:
    return df.where(F.col(DATE) < F.lit(CUT).cast("date"))


def current(df: DataFrame) -> DataFrame:
    return df.where(F.col(DATE) >= F.lit(CUT).cast("date"))


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings, standing in for a fitted factor table."""
    return as_factors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in their properties as ``n``."""
    return table(spark, sf_dir, "events").withColumn(
        "n", F.get_json_object("props", "$.k").cast("int")
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("user_id").alias("query_id"),
        F.col("n").cast("long").alias("item_id"),
        (F.col("value") / 100).alias("rating"),
    )


def job_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a job message; its type decides what kind, valid or not."""
    e = events(spark, sf_dir)
    kind = F.col("event_type")
    job_id = F.col("event_id").cast("string")

    def request(**fields) -> Column:
        body = F.struct(*[v.alias(k) for k, v in fields.items()])
        return F.to_json(F.struct(job_id.alias("job_id"), body.alias("request")))

    context = F.create_map(F.lit("source"), kind)
    user = F.col("user_id")
    one = F.array(
        F.struct(F.col("n").alias("item_id"), (F.col("value") / 100).alias("rating"))
    )
    value = (
        F.when(kind == "view", request(user_id=user, k=F.col("n")))
        .when(kind == "click", request(feedback=one, context=context))
        .when(
            kind == "purchase",
            request(
                user_id=user * 4,
                exclude_item_ids=F.array(F.col("n"), F.col("n") + 1),
                context=context,
            ),
        )
        .when(kind == "signup", request(k=F.lit(5)))
        .otherwise(F.concat(F.lit('{"job_id": "'), job_id, F.lit('", "request": ')))
    )
    return e.select(F.when(kind != "purchase", job_id).alias("key"), value.alias("value"))


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as results in order of arrival: one job per user."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", "FAILED")
        .when(kind == "view", "RUNNING")
        .when(kind == "signup", "PENDING")
        .otherwise("DONE")
    )
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("job_id"),
        status.alias("status"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        F.array().cast("array<struct<item_id:bigint,score:double>>").alias("items"),
        F.when(kind == "error", F.concat(F.lit("code "), F.col("n"))).alias("error"),
        F.when(kind == "click", F.create_map(F.lit("n"), F.col("n").cast("string"))).alias("context"),
        "event_id",
        F.col("ts").cast("timestamp").alias("arrived_at"),
    )


def write_blocked_text(rows: DataFrame, spark: SparkSession, header: Column, line: Column) -> str:
    """Write rows as blocks: ``header`` above the ``line`` of each row; returns the path.

    An item has a block for every ten thousand orders, each with its header, so a
    block stays small however many ratings an item has.
    """
    path = storage.scratch_path(spark, "blocked")
    block = Window.partitionBy(ITEM, F.floor(F.col("order") / 10_000)).orderBy("order", "line")
    opens = F.row_number().over(block) == 1
    rows.withColumn("opens", opens).select(
        F.explode(F.when(F.col("opens"), F.array(header, line)).otherwise(F.array(line))).alias("value")
    ).write.text(path)
    return path


def write_clean_blocked_text(rows: DataFrame, spark: SparkSession) -> str:
    return write_blocked_text(
        rows, spark, F.concat(F.col(ITEM), F.lit(":")), F.concat_ws(",", USER, RATING, DATE)
    )


def write_arrivals_csv(rows: DataFrame, spark: SparkSession) -> str:
    path = storage.scratch_path(spark, "arrivals")
    rows.select(DATE, USER, ITEM, RATING).write.option("header", True).csv(path)
    return path
