"""The factor model: fit, score, recommend and evaluate with Spark's ALS."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, functions as F

from ..schema import (
    ALS_MAX_ITER,
    ALS_RANK,
    ALS_REG,
    ITEM,
    RANKING_K,
    RATING,
    RELEVANCE_THRESHOLD,
    USER,
)
from ..sources.factors import as_factors
from ..sources.storage import ensure_checkpoint_dir
from .metrics import one_row, ranking_metrics, regression_metrics
from .quality import complete_rows
from .topk import top_k

#: Session setting with the default number of blocks.
BLOCKS_SETTING = "spark.factorframe.als.blocks"


def fit_factors(
    train: DataFrame,
    *,
    user: str = USER,
    item: str = ITEM,
    rating: str = RATING,
    rank: int = ALS_RANK,
    reg_param: float = ALS_REG,
    max_iter: int = ALS_MAX_ITER,
    implicit_prefs: bool = False,
    cold_start_strategy: str = "drop",
    nonnegative: bool = False,
    seed: int = 0,
    num_blocks: int | None = None,
    checkpoint_interval: int = 10,
) -> ALSModel:
    """Fit a factor model on ratings; the same input and seed give the same model.

    ``num_blocks`` is how many ways users and items are divided, and so how many
    tasks a half iteration has; raise it with the data. By default it is the
    session's ``spark.factorframe.als.blocks``, or 10: never derived from data or
    cluster, because the starting factors depend on it. Only the three columns are
    read.
    """
    num_blocks = num_blocks or int(train.sparkSession.conf.get(BLOCKS_SETTING, "10"))
    ensure_checkpoint_dir(train.sparkSession)
    als = ALS(
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        rank=rank,
        regParam=reg_param,
        maxIter=max_iter,
        implicitPrefs=implicit_prefs,
        coldStartStrategy=cold_start_strategy,
        nonnegative=nonnegative,
        seed=seed,
        numUserBlocks=num_blocks,
        numItemBlocks=num_blocks,
        checkpointInterval=checkpoint_interval,
    )
    return als.fit(train.select(user, item, rating))


def model_factors(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    """User and item factors of a model as factor tables."""
    return as_factors(model.userFactors), as_factors(model.itemFactors)


def score_ratings(model: ALSModel, ratings: DataFrame) -> DataFrame:
    """Add ``prediction``; users and items the model does not know are dropped or NaN."""
    return model.transform(ratings)


def recommend_for_users(
    model: ALSModel, users: DataFrame, k: int, *, user: str = USER, item: str = ITEM
) -> DataFrame:
    """``k`` items for each known user in ``users``, as rows of user, item, score and rank.

    Rated items are not left out. Equal scores rank by item id, so the result is
    the same on every run.
    """
    vectors, items = model_factors(model)
    asked = users.select(F.col(user).cast("long").alias("id")).distinct()
    queries = vectors.join(asked, "id", "left_semi").withColumnRenamed("id", "query_id")
    return top_k(queries, items, k).select(
        F.col("query_id").cast("int").alias(user),
        F.col("item_id").cast("int").alias(item),
        "score",
        "rank",
    )


def evaluate(
    model: ALSModel,
    test: DataFrame,
    *,
    user: str = USER,
    item: str = ITEM,
    rating: str = RATING,
    k: int = RANKING_K,
    threshold: float = RELEVANCE_THRESHOLD,
) -> DataFrame:
    """One row: regression and ranking metrics of a model on held-out ratings."""
    test = complete_rows(test, [user, item, rating])
    regression = regression_metrics(score_ratings(model, test), rating).select("rmse", "mae")
    recommended = recommend_for_users(model, test, k, user=user, item=item).drop("rank")
    ranking = ranking_metrics(
        test, recommended, k=k, threshold=threshold, user=user, item=item, rating=rating
    ).select(
        F.col("precision").alias(f"precision_at_{k}"),
        F.col("recall").alias(f"recall_at_{k}"),
        F.col("ndcg").alias(f"ndcg_at_{k}"),
    )
    count = test.agg(F.count(F.lit(1)).alias("test_ratings_count"))
    return one_row([count, regression, ranking]).select(
        "test_ratings_count",
        F.lit(model.rank).alias("model_rank"),
        "rmse",
        "mae",
        f"precision_at_{k}",
        f"recall_at_{k}",
        f"ndcg_at_{k}",
        F.lit(k).alias("k"),
        F.lit(float(threshold)).alias("rating_threshold"),
    )
