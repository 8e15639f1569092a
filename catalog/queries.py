"""One query per operator or plan, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from factorframe import operators as ops, plans, sources, streaming
from factorframe.functions import bin_rating, dot, histogram, kl_divergence
from factorframe.schema import DATE, ITEM, RATING, RATING_VALUES, USER
from factorframe.sources import storage

from . import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Model settings small enough for the test tables.
ALS_OPTIONS = {"rank": 8, "max_iter": 5}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def no_minus_zero(value: Column, digits: int = 6) -> Column:
    """Rounded, and without a sign on zero."""
    return F.round(value, digits) + F.lit(0.0)


def rounded(*names: str, digits: int = 6) -> list[Column]:
    return [no_minus_zero(F.col(n), digits).alias(n) for n in names]


def count_columns(counts: str, prefix: str = "n") -> list[Column]:
    return [F.get(counts, F.lit(i)).alias(f"{prefix}{v}") for i, v in enumerate(RATING_VALUES)]


def report_columns(infix: str, medians: bool = True) -> list[Column]:
    """The columns of a drift report without arrays."""
    columns = [
        *count_columns(f"original_{infix}counts", "original_n"),
        *count_columns(f"current_{infix}counts", "current_n"),
        F.round("kl_divergence", 9).alias("kl_divergence"),
    ]
    for side in ("original", "current"):
        columns += rounded(f"{side}_{infix}mean")
        columns += rounded(f"{side}_{infix}median") if medians else []
        columns.append(F.col(f"{side}_total"))
    return columns


# --- sources and sinks -------------------------------------------------------


@query
def ratings_view(spark, sf_dir):
    return views.ratings(spark, sf_dir)


@query
def blocked_text_roundtrip(spark, sf_dir):
    path = views.write_clean_blocked_text(views.numbered_ratings(spark, sf_dir), spark)
    return sources.read_blocked_ratings(spark, path)


@query
def blocked_text_malformed(spark, sf_dir):
    """The line number decides what is wrong with a line, the item with a header."""
    rows = views.numbered_ratings(spark, sf_dir)
    header = F.concat(F.when(F.col(ITEM) % 10 == 0, "n").otherwise(""), F.col(ITEM), F.lit(":"))
    user, rating, day = (F.col(c).cast("string") for c in (USER, RATING, DATE))
    line = (
        F.when(F.col("line") == 2, F.concat_ws(",", user, F.lit(""), day))
        .when(F.col("line") == 3, F.concat_ws(",", F.concat(F.lit("x"), user), rating, day))
        .when(F.col("line") == 4, F.concat_ws(",", user, rating))
        .when(F.col("line") == 5, F.concat_ws(",", user, rating, day, F.lit("")))
        .when(F.col("line") == 6, F.concat_ws(",", user, rating, F.lit("2005-13-45")))
        .when(F.col("line") == 7, F.concat_ws(",", F.lit(""), rating, F.lit("")))
        .otherwise(F.concat_ws(",", user, rating, day))
    )
    path = views.write_blocked_text(rows, spark, header, line)
    parsed = sources.read_blocked_ratings(spark, path)
    number = [F.coalesce(c, F.lit(-1)).alias(c) for c in (ITEM, USER, RATING)]
    day = F.coalesce(F.col(DATE).cast("string"), F.lit("none")).alias(DATE)
    return parsed.groupBy(*number, day).agg(F.count(F.lit(1)).alias("n"))


@query
def csv_arrivals(spark, sf_dir):
    """The line number decides which field of an arrival is broken."""
    line = F.col("line")
    rows = views.numbered_ratings(spark, sf_dir).select(
        F.when(line == 5, "soon").otherwise(F.col(DATE).cast("string")).alias(DATE),
        F.when(line == 3, "x").otherwise(F.col(USER).cast("string")).alias(USER),
        F.col(ITEM).cast("string").alias(ITEM),
        F.when(line != 2, F.col(RATING).cast("string")).alias(RATING),
    )
    return sources.read_ratings_csv(spark, views.write_arrivals_csv(rows, spark))


@query
def partition_counts(spark, sf_dir):
    path = storage.scratch_path(spark, "ratings")
    sources.write_ratings(views.ratings(spark, sf_dir), path)
    return (
        sources.read_ratings(spark, path)
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(RATING).alias("sum_rating"))
    )


@query
def upsert_merge(spark, sf_dir):
    """Original ratings, then later and overlapping ones with other values and nulls."""
    path = storage.scratch_path(spark, "ratings")
    rows = views.numbered_ratings(spark, sf_dir)
    sources.upsert_ratings(views.original(rows).drop("order", "line"), path)
    turned = F.when(F.col("line") != 7, 6 - F.col(RATING))
    later = rows.where(F.col(DATE) >= "1998-01-01").withColumn(RATING, turned).drop("order", "line")
    return sources.upsert_ratings(later, path)


@query
def upsert_rewrite_all(spark, sf_dir):
    """As ``upsert_merge`` onto a dataset with duplicates that something else wrote."""
    path = storage.scratch_path(spark, "ratings")
    rows = views.numbered_ratings(spark, sf_dir)
    sources.write_ratings(views.original(rows).drop("order", "line"), path)
    turned = F.when(F.col("line") != 7, 6 - F.col(RATING))
    later = rows.where(F.col(DATE) >= "1998-01-01").withColumn(RATING, turned).drop("order", "line")
    return sources.upsert_ratings(later, path, rewrite="all")


@query
def merge_by_files(spark, sf_dir):
    """As ``upsert_merge``, file by file; then rows that change nothing, and one commit back in time."""
    table = sources.VersionedRatings(spark, storage.scratch_path(spark, "ratings"))
    rows = views.numbered_ratings(spark, sf_dir)
    table.merge(views.original(rows))
    turned = F.when(F.col("line") != 7, 6 - F.col(RATING))
    later = rows.where(F.col(DATE) >= "1998-01-01").withColumn(RATING, turned)
    counts = table.merge(later)
    again = table.merge(later)
    in_between = table.read(again.commit - 1).count() == table.read().count()
    return table.read().withColumns(
        {
            "n_commits": F.lit(len(table.commits())),
            "some_replaced": F.lit(counts.replaced > 0),
            "again_nothing": F.lit((again.replaced, again.added) == (0, 0) and in_between),
        }
    )


@query
def replay_order(spark, sf_dir):
    """Per day of the replay files: how many ratings, and how many stand before an earlier one."""
    path = storage.scratch_path(spark, "replay")
    sources.write_replay_csv(views.ratings(spark, sf_dir), path)
    schema = f"{DATE} date, {USER} int, {ITEM} int, {RATING} int"
    lines = (
        spark.read.schema(schema)
        .option("header", True)
        .csv(path)
        .select(
            DATE,
            RATING,
            F.col("_metadata.file_name").alias("file"),
            F.monotonically_increasing_id().alias("at"),
        )
    )
    previous = F.lag(DATE).over(Window.partitionBy("file").orderBy("at"))
    return (
        lines.withColumn("misplaced", F.coalesce(previous > F.col(DATE), F.lit(False)))
        .groupBy(DATE)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(RATING).alias("sum_rating"),
            F.count_if("misplaced").alias("n_misplaced"),
        )
    )


@query
def factor_manifest(spark, sf_dir):
    f = views.factors(spark, sf_dir)
    users = f.join(views.table(spark, sf_dir, "customer"), F.col("id") == F.col("c_custkey"), "left_semi")
    return sources.factor_manifest(users, f, source_version="version_20050101_000000")


@query
def factor_checks(spark, sf_dir):
    """What the checks of a factor table look at."""
    return sources.factor_stats(views.factors(spark, sf_dir))


@query
def registered_table(spark, sf_dir):
    """Ratings upserted in two parts and read through the catalog."""
    path = storage.scratch_path(spark, "ratings")
    name = "ratings_of_the_catalog"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    r = views.ratings(spark, sf_dir)
    for part in (views.original(r), views.current(r)):
        sources.upsert_ratings(part, path, table_name=name)
    return spark.table(name)


# --- cleaning and splitting --------------------------------------------------


@query
def dedupe_keep_max(spark, sf_dir):
    return ops.keep_max(views.ratings(spark, sf_dir))


@query
def dedupe_latest_of_best(spark, sf_dir):
    """One rating per user and item: the highest, then the latest."""
    rows = views.numbered_ratings(spark, sf_dir).drop("order")
    return ops.keep_max(rows, keys=(ITEM, USER), target=RATING)


@query
def split_by_key(spark, sf_dir):
    train, test = ops.split_by_key(views.ratings(spark, sf_dir), 0.8)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


# --- distributions and drift -------------------------------------------------


@query
def rating_histogram(spark, sf_dir):
    counts = views.ratings(spark, sf_dir).groupBy(F.year(DATE).alias("year")).agg(
        histogram(F.col(RATING)).alias("counts")
    )
    return counts.select("year", *count_columns("counts"))


@query
def rating_location(spark, sf_dir):
    summary = ops.rating_summary(views.ratings(spark, sf_dir), exact=True)
    return summary.select(*rounded("mean", "median"), "total")


@query
def kl_by_year(spark, sf_dir):
    """Divergence of each year's ratings from those of all years."""
    r = views.ratings(spark, sf_dir)
    yearly = r.groupBy(F.year(DATE).alias("year")).agg(histogram(F.col(RATING)).alias("counts"))
    # A few years: their counts add up in a window over the aggregated rows.
    everything = Window.partitionBy()
    overall = F.array(*[F.sum(F.get("counts", F.lit(i))).over(everything) for i in range(5)])
    together = yearly.withColumn("overall", overall)
    divergence = kl_divergence(F.col("overall"), F.col("counts"))
    return together.select("year", F.round(divergence, 9).alias("kl_divergence"))


@query
def data_drift(spark, sf_dir):
    r = views.ratings(spark, sf_dir)
    return ops.data_drift(views.original(r), views.current(r)).select(*report_columns(""))


@query
def summary_drift(spark, sf_dir):
    """The drift report from month rows, after some months of the dataset have changed and only those were summarised again."""
    rows, path = views.numbered_ratings(spark, sf_dir), storage.scratch_path(spark, "ratings")
    stored = {side: ops.MonthSummaries(spark, storage.scratch_path(spark, side)) for side in ("original", "current")}
    stored["current"].refresh(views.current(rows))
    stored["original"].refresh(sources.upsert_ratings(views.original(rows).drop("order", "line"), path))
    turned = F.when(F.col("line") != 7, 6 - F.col(RATING))
    later = views.original(rows).where(F.col(DATE) >= "1998-01-01").withColumn(RATING, turned).drop("order", "line")
    merged = sources.upsert_ratings(later, path)
    stored["original"].refresh(merged, [(1998, m) for m in range(1, 13)])
    report = ops.drift_from_summaries(*(stored[side].read() for side in ("original", "current")))
    fine = []
    for side in ("original", "current"):
        below, upto = (
            F.aggregate(F.filter(F.arrays_zip(F.col(f"{side}_counts").alias("n"), F.array(*map(F.lit, RATING_VALUES)).alias("v")), keep), F.lit(0).cast("long"), lambda a, x: a + x["n"])
            for keep in (lambda x: x["v"] < F.col(f"{side}_median"), lambda x: x["v"] <= F.col(f"{side}_median"))
        )
        n = F.col(f"{side}_total")
        fine.append(((below / n <= 0.51) & (upto / n >= 0.49)).alias(f"{side}_median_fits"))
    return report.select(*report_columns("", medians=False), *fine)


@query
def bin_predictions(spark, sf_dir):
    binned = bin_rating(F.col("value") / 100)
    return views.events(spark, sf_dir).groupBy(binned.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def item_mean_predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Original and current ratings, predicted by the mean original rating of the item."""
    r = views.ratings(spark, sf_dir)
    means = views.original(r).groupBy(ITEM).agg(F.avg(RATING).alias("prediction"))
    return (
        views.original(r).join(means, ITEM, "left"),
        views.current(r).join(means, ITEM, "left"),
    )


@query
def prediction_drift(spark, sf_dir):
    report = ops.prediction_drift(*item_mean_predictions(spark, sf_dir), exact=True)
    return report.select(*report_columns("pred_"))


@query
def retrain_decision(spark, sf_dir):
    """Thresholds low enough that every mean shift gives a reason."""
    r = views.ratings(spark, sf_dir)
    report = ops.drift_report(
        ops.data_drift(views.original(r), views.current(r)),
        ops.prediction_drift(*item_mean_predictions(spark, sf_dir), exact=True),
    )
    decision = ops.retrain_decision(
        report,
        kl_threshold=1e-6,
        mean_shift_threshold=1e-4,
        median_shift_threshold=1e-4,
        kl_weight=0.5,
        mean_weight=0.4,
        median_weight=0.1,
    )
    return decision.select(
        "should_retrain",
        *rounded("drift_score", "data_drift_score", "model_drift_score", digits=4),
        F.size("reasons").cast("long").alias("n_reasons"),
        F.array_join("reasons", "; ").alias("reasons"),
        F.round(F.element_at("thresholds", "mean_shift"), 6).alias("mean_threshold"),
        F.round(F.element_at("weights", "kl"), 6).alias("kl_weight"),
    )


# --- scoring -----------------------------------------------------------------


@query
def predict_pairs_bucketed(spark, sf_dir):
    """As ``predict_pairs``, from factor tables in buckets that stay where they are."""
    f = views.factors(spark, sf_dir)
    names = [f"bucketed_{side}_factors" for side in ("user", "item")]
    for name in names:
        ops.write_bucketed_factors(f, name, buckets=16)
    pairs = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_suppkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
    )
    scored = ops.predict_pairs_bucketed(pairs, *names)
    return scored.withColumn("prediction", no_minus_zero(F.col("prediction")))


@query
def predict_pairs(spark, sf_dir):
    """Every order line as a pair; most parts are no known item."""
    f = views.factors(spark, sf_dir)
    pairs = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_suppkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
    )
    scored = ops.predict_pairs(pairs, f, f)
    return scored.withColumn("prediction", no_minus_zero(F.col("prediction")))


@query
def predict_lists(spark, sf_dir):
    """Each order as one request with a list of suppliers and a list of parts."""
    f = views.factors(spark, sf_dir)
    requests = (
        views.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("query_id"))
        .agg(F.collect_list(F.struct("l_suppkey", "l_partkey")).alias("pairs"))
        .select(
            "query_id",
            F.col("pairs.l_suppkey").alias("user_ids"),
            F.col("pairs.l_partkey").alias("item_ids"),
        )
    )
    answered = ops.predict_lists(requests, f, f)
    return answered.select("query_id", F.explode("ratings").alias("rating")).select(
        "query_id", *rounded("rating")
    )


def ranked_columns(df: DataFrame) -> DataFrame:
    score = no_minus_zero(F.col("score").cast("double"))
    return df.select("query_id", "item_id", score.alias("score"), F.col("rank").cast("int").alias("rank"))


@query
def topk_inner_product(spark, sf_dir):
    f = views.factors(spark, sf_dir)
    return ranked_columns(ops.top_k(f.withColumnRenamed("id", "query_id"), f, 10))


@query
def topk_with_exclusions(spark, sf_dir):
    f = views.factors(spark, sf_dir)
    exclude = views.feedback(spark, sf_dir).select("query_id", "item_id")
    return ranked_columns(ops.top_k(f.withColumnRenamed("id", "query_id"), f, 10, exclude))


@query
def topk_norm_index(spark, sf_dir):
    """Top ten over items whose lengths fall steeply, from blocks by length: exact, and most blocks are skipped."""
    f = views.factors(spark, sf_dir)
    scale = F.pow(F.lit(2.0), -F.pmod(F.col("id"), F.lit(97)).cast("double") / 8)
    items = f.withColumn("features", F.transform("features", lambda x: (x * scale).cast("float")))
    index = ops.NormIndex.build(items, block_items=max(60, items.count() // 16))
    exclude = views.feedback(spark, sf_dir).select("query_id", "item_id")
    found = index.top_k(f.withColumnRenamed("id", "query_id"), 10, exclude)
    path = storage.scratch_path(spark, "found")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    met = found.agg(F.avg("blocks_met")).first()[0] / len(index.lengths)
    return ranked_columns(found).withColumn("half_skipped", F.lit(met < 0.5))


@query
def recommend_known_users(spark, sf_dir):
    """Each customer asks for as many items as the number of its nation."""
    f = views.factors(spark, sf_dir)
    requests = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("query_id"),
        F.col("c_custkey").alias("user_id"),
        F.col("c_nationkey").alias("k"),
    )
    return ranked_columns(ops.recommend(requests, f, f))


@query
def exclude_scored(spark, sf_dir):
    """Order lines whose customer has no event about the part."""
    r = views.ratings(spark, sf_dir).select(
        F.col(USER).cast("long").alias("query_id"), F.col(ITEM).cast("long").alias("item_id"), RATING
    )
    return ops.exclude_items(r, views.feedback(spark, sf_dir))


# --- fold-in -----------------------------------------------------------------


@query
def mean_item_vector(spark, sf_dir):
    mean = ops.mean_item_vector(views.factors(spark, sf_dir))
    values = mean.select(F.posexplode("features").alias("dim", "value"))
    return values.select("dim", no_minus_zero(F.col("value").cast("double")).alias("value"))


@query
def normal_equations(spark, sf_dir):
    """Right-hand side, diagonal and next column of the equations, by row."""
    eq = ops.normal_equations(views.feedback(spark, sf_dir), views.factors(spark, sf_dir))
    rank = F.size("rhs")
    row = eq.select("query_id", "gram", rank.alias("rank"), F.posexplode("rhs").alias("dim", "rhs"))

    def entry(column) -> Column:
        return F.get("gram", F.col("dim") * F.col("rank") + column)

    return row.select(
        "query_id",
        "dim",
        *rounded("rhs"),
        no_minus_zero(entry(F.col("dim"))).alias("diagonal"),
        no_minus_zero(entry((F.col("dim") + 1) % F.col("rank"))).alias("next"),
    )


def summed_vectors(rows: DataFrame, weight: Column, rank: int, *by: str) -> DataFrame:
    """Per group the sum of ``weight`` times ``features``, as the array ``s``: one row per group and task moves, none per dimension."""
    sums = [F.sum(weight * F.col("features")[i].cast("double")).alias(f"s{i}") for i in range(rank)]
    return rows.groupBy(*by).agg(*sums).select(*by, F.array(*[f"s{i}" for i in range(rank)]).alias("s"))


@query
def fold_in_residual(spark, sf_dir):
    """Whether each solved vector meets its equations, checked apart from the solver."""
    items = views.factors(spark, sf_dir)
    feedback = views.feedback(spark, sf_dir)
    shape = sources.factor_shape(items)
    solved = ops.fold_in(feedback, items, shape=shape).withColumnRenamed("features", "x")
    used = ops.usable_feedback(feedback, items).join(solved, "query_id")
    error = F.col("n") * dot(F.col("features"), F.col("x")) - F.col("total")
    sums = summed_vectors(used.select("query_id", error.alias("e"), "features"), F.col("e"), shape.rank, "query_id")
    gaps = F.zip_with("s", "x", lambda s, x: F.abs(s + 0.1 * x))
    return sums.join(solved, "query_id").select(
        "query_id", (F.array_max(gaps) < 1e-3).alias("solved"), F.size("x").cast("long").alias("rank")
    )


@query
def fold_in_kinds(spark, sf_dir):
    """Implicit and nonnegative vectors against the conditions they must meet, checked apart from the solver."""
    items, feedback = views.factors(spark, sf_dir), views.feedback(spark, sf_dir)
    shape = sources.factor_shape(items)
    # All items: the products of their dimensions, rank² numbers.
    by_dim = items.select("features", F.posexplode("features").alias("dim", "v"))
    products = summed_vectors(by_dim, F.col("v").cast("double"), shape.rank, "dim")
    products = products.agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "s"))), lambda r: r["s"]).alias("p"))
    kinds = []
    for implicit, nonnegative in ((True, False), (False, True), (True, True)):
        x = ops.fold_in(feedback, items, implicit_prefs=implicit, alpha=0.5, nonnegative=nonnegative, shape=shape)
        x = x.withColumnRenamed("features", "x")
        weighted = ops.weighted_feedback(feedback, implicit_prefs=implicit, alpha=0.5).join(items, "id")
        used = weighted.join(x, "query_id")
        pull = F.col("weight") * dot(F.col("features"), F.col("x")) - F.col("target")
        sums = summed_vectors(used.select("query_id", pull.alias("pull"), "features"), F.col("pull"), shape.rank, "query_id")
        met = sums.join(x, "query_id").withColumn("g", F.zip_with("s", "x", lambda s, v: s + 0.1 * v))
        if implicit:
            met = met.crossJoin(products)  # one row
            met = met.withColumn("g", F.zip_with("g", F.transform("p", lambda row: dot(row, F.col("x"))), lambda g, s: g + s))
        ok = F.zip_with("g", "x", lambda g, v: F.abs(g) < 1e-2)
        if nonnegative:
            ok = F.zip_with("g", "x", lambda g, v: (v >= 0) & (g > -1e-2) & ((F.abs(g) < 1e-2) | (v == 0)))
        kinds.append(
            met.select(
                "query_id", F.lit(implicit).alias("implicit"), F.lit(nonnegative).alias("nonnegative"),
                F.forall(ok, lambda fine: fine).alias("met"), F.size("x").cast("long").alias("rank"),
            )
        )
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


@query
def feedback_increments(spark, sf_dir):
    """Every entry of the equations after three batches of feedback: the upper triangle, and the right-hand side as a last column."""
    items = views.factors(spark, sf_dir)
    events = views.events(spark, sf_dir).withColumn("batch", F.col("event_id") % 3)
    columns = [F.col("user_id").alias("query_id"), F.col("n").cast("long").alias("item_id"), (F.col("value") / 100).alias("rating")]
    sums = ops.FeedbackSums(spark, storage.scratch_path(spark, "sums"), items, fan_in=2)
    for batch in (0, 1, 1, 2):  # one of them comes again
        sums.add(events.where(F.col("batch") == batch).select(*columns), batch)
    total = sums.sums()
    size = F.size("rhs")
    places = F.flatten(F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.transform(F.sequence(i, size - 1), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    gram = total.select("query_id", F.inline(F.arrays_zip(places.alias("at"), F.col("gram").alias("value"))))
    rhs = total.select("query_id", size.alias("j"), F.posexplode("rhs").alias("i", "value"))
    value = no_minus_zero(F.col("value")).alias("value")
    return gram.select("query_id", "at.i", "at.j", value).unionByName(rhs.select("query_id", "i", "j", value))


@query
def fold_in_recommend(spark, sf_dir):
    """Items for each event user, from the events alone."""
    feedback = views.feedback(spark, sf_dir)
    requests = feedback.select("query_id").distinct()
    items = views.factors(spark, sf_dir)
    found = ops.fold_in_and_recommend(requests, feedback, items)
    # The same scores, summed pair by pair from the solved vectors.
    x = ops.fold_in(feedback, items, requests).select("query_id", F.col("features").alias("x"))
    summed = found.join(x, "query_id").join(items.withColumnRenamed("id", "item_id"), "item_id")
    gap = F.abs(dot(F.col("x"), F.col("features")) - F.col("score"))
    per_query = summed.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("last"), F.max(gap).alias("gap"))
    return per_query.select("query_id", "n", "last", (F.col("gap") < 1e-3).alias("agree"))


# --- evaluation --------------------------------------------------------------


@query
def regression_metrics(spark, sf_dir):
    _, predicted = item_mean_predictions(spark, sf_dir)
    return ops.regression_metrics(predicted).select(*rounded("rmse", "mae"), "n")


def nation_favourites(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Recommend to each customer what its nation bought most often before the cut."""
    customer = views.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    bought = views.original(views.ratings(spark, sf_dir)).join(
        customer, F.col(USER) == F.col("c_custkey")
    )
    counts = bought.groupBy("c_nationkey", ITEM).agg(F.count(F.lit(1)).alias("score"))
    best = ops.rank_recommendations(counts, k, user="c_nationkey").drop("rank")
    # k rows for each of the few nations, whatever the number of customers.
    return customer.join(F.broadcast(best), "c_nationkey").select(
        F.col("c_custkey").cast("int").alias(USER), ITEM, "score"
    )


@query
def ranking_metrics(spark, sf_dir):
    test = views.current(views.ratings(spark, sf_dir))
    found = ops.ranking_metrics(test, nation_favourites(spark, sf_dir, 10), k=10, threshold=4.0)
    return found.select(*rounded("precision", "recall", "ndcg"), "n_users")


@query
def ranking_per_user(spark, sf_dir):
    test = views.current(views.ratings(spark, sf_dir))
    found = ops.ranking_per_user(test, nation_favourites(spark, sf_dir, 5), k=5, threshold=4.0)
    return found.select(
        USER, "hits", "n_recommended", "n_relevant", *rounded("precision", "recall", "ndcg")
    )


@query
def nation_top_items(spark, sf_dir):
    """The items each nation buys most often; one nation may hold most customers."""
    customer = views.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    bought = views.ratings(spark, sf_dir).join(customer, F.col(USER) == F.col("c_custkey"))
    counts = bought.groupBy("c_nationkey", ITEM).agg(F.count(F.lit(1)).alias("score"))
    return ops.rank_recommendations(counts, 10, user="c_nationkey")


# --- the factor model --------------------------------------------------------


def fitted(spark: SparkSession, sf_dir: str):
    """A model and the held-out ratings, which are stored: queries read them several times, each time without joining and cleaning all."""
    clean, held_out = (storage.scratch_path(spark, x) for x in ("clean", "held-out"))
    ops.keep_max(views.ratings(spark, sf_dir)).write.parquet(clean)
    train, test = ops.split_by_key(spark.read.parquet(clean))
    test.write.parquet(held_out)
    return ops.fit_factors(train, **ALS_OPTIONS), spark.read.parquet(held_out)


@query
def als_predict(spark, sf_dir):
    """The held-out ratings that get a prediction, and whether it is a rating at all."""
    model, test = fitted(spark, sf_dir)
    scored = ops.score_ratings(model, test)
    return scored.select(ITEM, USER, DATE, RATING, F.col("prediction").between(-10, 20).alias("plausible"))


@query
def als_coverage(spark, sf_dir):
    """How many held-out ratings the model scores: those of known users and items."""
    model, test = fitted(spark, sf_dir)
    scored = ops.score_ratings(model, test).agg(F.count("prediction").alias("n_scored"))
    return scored.select("n_scored", F.lit(model.rank).alias("rank"))


@query
def als_scores_agree(spark, sf_dir):
    """Pairs scored from the factor tables against the model's own scores."""
    model, test = fitted(spark, sf_dir)
    users, items = ops.model_factors(model)
    theirs = ops.score_ratings(model, test).withColumnRenamed("prediction", "theirs")
    both = ops.predict_pairs(theirs, users, items, user=USER, item=ITEM)
    gap = F.abs(F.col("theirs") - F.col("prediction"))
    return both.agg(F.count(F.lit(1)).alias("n_scored"), (F.max(gap) < 1e-4).alias("agree"))


def recommended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten items for each user with held-out ratings."""
    model, test = fitted(spark, sf_dir)
    return ops.recommend_for_users(model, test, 10)


def rank_shape(ranked: DataFrame) -> DataFrame:
    """Per user: how many items, and whether ranks have no gap, scores fall, and no item comes twice."""
    before = F.lag("score").over(Window.partitionBy(USER).orderBy("rank"))
    falling = ranked.withColumn("falls", F.coalesce(before >= F.col("score"), F.lit(True)))
    n = F.count(F.lit(1))
    whole = (F.max("rank") == n) & (F.count_distinct("rank") == n) & (F.count_distinct(ITEM) == n)
    return falling.groupBy(USER).agg(n.alias("n"), (whole & F.bool_and("falls")).alias("in_order"))


@query
def als_topk(spark, sf_dir):
    return rank_shape(recommended(spark, sf_dir))


@query
def als_topk_nested(spark, sf_dir):
    """The model's own arrays of recommendations, flattened and ranked."""
    model, test = fitted(spark, sf_dir)
    nested = ops.recommend_nested(model, test.select(USER), 10)
    return rank_shape(ops.rank_recommendations(ops.flatten_recommendations(nested), 10))


@query
def als_topk_agree(spark, sf_dir):
    """The exact top-k against the model's own, place by place."""
    model, test = fitted(spark, sf_dir)
    ours = ops.recommend_for_users(model, test, 10).select(USER, "rank", F.col("score").alias("ours"))
    nested = ops.recommend_nested(model, test.select(USER), 10)
    theirs = ops.rank_recommendations(ops.flatten_recommendations(nested), 10)
    both = theirs.join(ours, [USER, "rank"], "full")
    gap = F.coalesce(F.abs(F.col("score") - F.col("ours")), F.lit(1.0))
    return both.agg(F.count(F.lit(1)).alias("n"), (F.max(gap) < 1e-4).alias("agree"))


@query
def als_evaluate(spark, sf_dir):
    """The evaluation row, with its metrics computed once more from the model's own lists."""
    model, test = fitted(spark, sf_dir)
    row = ops.evaluate(model, test)
    scored = model.transform(test)
    error = F.col(RATING) - F.col("prediction")
    errors = scored.agg(F.sqrt(F.avg(error * error)).alias("rmse_"), F.avg(F.abs(error)).alias("mae_"))
    nested = ops.recommend_nested(model, test.select(USER), 10)
    ranking = ops.ranking_metrics(test, ops.flatten_recommendations(nested), k=10, threshold=4.0)
    both = row.crossJoin(errors).crossJoin(ranking)  # one row each
    pairs = (("rmse", "rmse_"), ("mae", "mae_"), ("precision_at_10", "precision"), ("recall_at_10", "recall"), ("ndcg_at_10", "ndcg"))
    # Equal scores may take the place of one another in the two lists.
    gaps = F.greatest(*[F.abs(F.col(a) - F.col(b)) for a, b in pairs])
    return both.select("test_ratings_count", "model_rank", "k", "rating_threshold", (gaps < 1e-3).alias("agree"))


@query
def als_prediction_drift(spark, sf_dir):
    """How many predictions each side has, and whether the histograms hold them all."""
    model, test = fitted(spark, sf_dir)
    report = ops.prediction_drift(
        ops.score_ratings(model, views.original(test)), ops.score_ratings(model, views.current(test))
    )
    counted = [F.aggregate(f"{s}_pred_counts", F.lit(0).cast("long"), lambda x, n: x + n) for s in ("original", "current")]
    return report.select(
        "original_total",
        "current_total",
        ((counted[0] == F.col("original_total")) & (counted[1] == F.col("current_total"))).alias("all_binned"),
        (F.col("kl_divergence") >= 0).alias("divergence_made"),
    )


@query
def als_manifest(spark, sf_dir):
    """Fit, save a version, find it again, check it and describe it."""
    base = storage.scratch_path(spark, "models")
    model = ops.fit_factors(views.ratings(spark, sf_dir), **ALS_OPTIONS)
    sources.save_model(model, base, at=datetime(2005, 1, 1, tzinfo=timezone.utc))
    newest = sources.resolve_version(spark, base)
    return sources.compile_manifest(spark, newest).withColumn(
        "complete", F.lit(sources.is_complete(spark, newest))
    )


@query
def resolve_complete(spark, sf_dir):
    """The newest complete version, while a newer one has one table and the newest has half of the other."""
    base, f = storage.scratch_path(spark, "models"), views.factors(spark, sf_dir)
    for version, folders in (("20050101", ("userFactors", "itemFactors")), ("20050102", ("userFactors",)), ("20050103", ("userFactors", "itemFactors"))):
        for folder in folders:
            f.write.parquet(f"{base}/version_{version}_000000/{folder}")
    storage.delete(spark, f"{base}/version_20050103_000000/itemFactors/_SUCCESS")
    _, _, shape = streaming.LatestFactors(spark, base)()
    manifest = sources.compile_manifest(spark, sources.resolve_version(spark, base))
    return manifest.withColumns({"n_versions": F.lit(len(sources.list_versions(spark, base))), "loaded_rank": F.lit(shape.rank)})


# --- plans -------------------------------------------------------------------


def both_sides(train: DataFrame, test: DataFrame) -> DataFrame:
    columns = [ITEM, USER, DATE, RATING]
    return train.select(*columns, F.lit("train").alias("side")).unionByName(
        test.select(*columns, F.lit("test").alias("side"))
    )


@query
def ingest_plan(spark, sf_dir):
    """Original and current ratings as train and test text, ingested twice."""
    r = views.numbered_ratings(spark, sf_dir)
    base = storage.scratch_path(spark, "base")
    files = [views.write_clean_blocked_text(part, spark) for part in (views.original(r), views.current(r))]
    plans.ingest_ratings(spark, *files, base)
    return both_sides(*plans.ingest_ratings(spark, *files, base))


@query
def replay_plan(spark, sf_dir):
    """Blocked text turned into replay files, read back as arrivals."""
    path = storage.scratch_path(spark, "replay")
    text = views.write_clean_blocked_text(views.numbered_ratings(spark, sf_dir), spark)
    plans.build_replay(spark, text, path)
    return sources.read_ratings_csv(spark, path)


@query
def merge_staged(spark, sf_dir):
    """Current ratings arrive as CSV, are staged and merged into the original ones."""
    r = views.ratings(spark, sf_dir)
    base, staged = (storage.scratch_path(spark, x) for x in ("base", "staged"))
    for part, path in zip(ops.split_by_key(views.original(r)), plans.split_paths(base)):
        sources.upsert_ratings(part, path)
    plans.stage_arrivals(spark, views.write_arrivals_csv(views.current(r), spark), staged)
    plans.merge_staged(spark, staged, base)
    return both_sides(*(sources.read_ratings(spark, p) for p in plans.split_paths(base)))


@query
def plan_counts(spark, sf_dir):
    """What ingest, staging and merging say they read, left out and wrote, while they did it."""
    rows = views.numbered_ratings(spark, sf_dir)
    base, staged = (storage.scratch_path(spark, x) for x in ("base", "staged"))
    files = [views.write_clean_blocked_text(part, spark) for part in ops.split_by_key(views.original(rows))]
    turned = F.when(F.col("line") != 7, 6 - F.col(RATING))
    later = rows.where(F.col(DATE) >= "1998-01-01").withColumn(RATING, turned).drop("order", "line")
    found = [("ingest", side, c) for side, (_, c) in zip(("train", "test"), plans.ingest_ratings(spark, *files, base, with_counts=True))]
    train, test, arrived = plans.stage_arrivals(spark, views.write_arrivals_csv(later, spark), staged, with_counts=True)
    found += [("stage", "train", train[1]), ("stage", "test", test[1])]
    merged = plans.merge_staged(spark, staged, base)
    found += [("merge", "train", merged.train), ("merge", "test", merged.test)]
    out = [(step, side, c.rows_in, c.incomplete, c.existing, c.written, c.added) for step, side, c in found]
    out.append(("arrive", "", arrived.rows_in, arrived.incomplete, 0, arrived.rows_in - arrived.incomplete, 0))
    return spark.createDataFrame(
        out, "step string, side string, rows_in long, incomplete long, existing long, written long, added long"
    )


@query
def stage_stream(spark, sf_dir):
    """The arrivals as a stream of files."""
    staged, checkpoint = (storage.scratch_path(spark, x) for x in ("staged", "checkpoint"))
    arrivals = views.write_arrivals_csv(views.ratings(spark, sf_dir), spark)
    plans.stage_arrivals_stream(spark, arrivals, staged, checkpoint).awaitTermination()
    return both_sides(*(sources.read_ratings(spark, p) for p in plans.split_paths(staged)))


def ran_cycle(spark: SparkSession, sf_dir: str) -> tuple[plans.RunReport, str]:
    """Ingest, train, then a cycle that finds drift, merges and trains again."""
    r = views.numbered_ratings(spark, sf_dir)
    base, staged, models = (storage.scratch_path(spark, x) for x in ("base", "staged", "models"))
    train, test = (
        views.write_clean_blocked_text(p, spark) for p in ops.split_by_key(views.original(r))
    )
    plans.run_initial(spark, train, test, base, models, als_options=ALS_OPTIONS)
    report = plans.run_drift_cycle(
        spark,
        views.write_arrivals_csv(views.current(r), spark),
        staged,
        base,
        models,
        decision_options={"kl_threshold": 1e-6},
        als_options=ALS_OPTIONS,
    )
    return report, base


@query
def drift_cycle(spark, sf_dir):
    """What a cycle decided, on how many ratings the new model was tested, and whether its scores are in range."""
    report, _ = ran_cycle(spark, sf_dir)
    e = report.evaluation
    fine = 0 < e["rmse"] < 5 and all(0 <= e[f"{m}_at_10"] <= 1 for m in ("precision", "recall", "ndcg"))
    row = (report.retrained, report.decision["drift_score"] > 1, e["test_ratings_count"], e["model_rank"], fine)
    return spark.createDataFrame([row], "retrained boolean, over_one boolean, test_ratings_count long, model_rank int, in_range boolean")


class LostDriver(Exception):
    """Stands for a driver that goes while a cycle runs."""


class LosingLedger(plans.Ledger):
    """Goes when a step is over: before it is on record, or right after."""

    def __init__(self, spark: SparkSession, path: str, step: str, recorded: bool):
        super().__init__(spark, path)
        self.step, self.recorded = step, recorded

    def record(self, step, inputs, result):
        if step != self.step or self.recorded:
            super().record(step, inputs, result)
        if step == self.step:
            raise LostDriver(step)


@query
def resumed_cycle(spark, sf_dir):
    """A cycle whose driver is lost twice at each step, and its outcome: one, whatever was done again."""
    r = views.ratings(spark, sf_dir)
    base, staged, models, book = (storage.scratch_path(spark, x) for x in ("base", "staged", "models", "ledger"))
    for part, path in zip(ops.split_by_key(views.original(r)), plans.split_paths(base)):
        sources.upsert_ratings(part, path)
    plans.train_model(spark, plans.split_paths(base)[0], models, **ALS_OPTIONS)
    csv = views.write_arrivals_csv(views.current(r), spark)

    def cycle(ledger) -> plans.RunReport:
        return plans.run_drift_cycle(
            spark, csv, staged, base, models, remove_source=True,
            decision_options={"kl_threshold": 1e-6}, als_options=ALS_OPTIONS, ledger=ledger,
        )

    lost = dict.fromkeys(plans.CYCLE_STEPS, 0)
    for step in plans.CYCLE_STEPS:
        for recorded in (False, True):
            try:
                cycle(LosingLedger(spark, book, step, recorded))
            except LostDriver:
                lost[step] += 1
    report = cycle(book)
    same = cycle(book) == report
    n_train, n_test = (sources.read_ratings(spark, p).count() for p in plans.split_paths(base))
    outcome = (
        report.retrained, report.decision["drift_score"] > 1, report.evaluation["test_ratings_count"],
        n_train, n_test, len(sources.list_versions(spark, models)), same,
    )
    return spark.createDataFrame(
        [(i, step, n, *outcome) for i, (step, n) in enumerate(lost.items())],
        "place int, step string, times_lost int, retrained boolean, over_one boolean, test_ratings_count long, "
        "n_train long, n_test long, n_versions int, same_report boolean",
    )


@query
def drift_two_cycles(spark, sf_dir):
    """Stage and merge twice; per step how many ratings drift detection saw and what is stored after it.

    The second cycle must see its own arrivals only: what the first staged has gone with its merge.
    """
    r = views.ratings(spark, sf_dir)
    base, staged = (storage.scratch_path(spark, x) for x in ("base", "staged"))
    for part, path in zip(ops.split_by_key(views.original(r)), plans.split_paths(base)):
        sources.upsert_ratings(part, path)
    arrivals = views.current(r)
    rows = []
    for step, part in ((1, arrivals.where(F.year(DATE) == 1999)), (2, arrivals.where(F.year(DATE) > 1999))):
        plans.stage_arrivals(spark, views.write_arrivals_csv(part, spark), staged)
        seen = plans.detect_drift(spark, base, staged).select("data_drift.*").first()
        merged = plans.merge_staged(spark, staged, base, remove_staged=True)
        left = [sources.read_ratings_if_exists(spark, p) for p in plans.split_paths(staged)]
        stored = [sources.read_ratings(spark, p).count() for p in plans.split_paths(base)]
        rows.append(
            (step, seen["original_total"], seen["current_total"], *stored, merged.train_merged and merged.test_merged, left == [None, None])
        )
    return spark.createDataFrame(
        rows, "step int, original_total long, current_total long, n_train long, n_test long, merged boolean, removed boolean"
    )


@query
def drift_cycle_data(spark, sf_dir):
    """The ratings a cycle leaves for the next one."""
    _, base = ran_cycle(spark, sf_dir)
    return both_sides(*(sources.read_ratings(spark, p) for p in plans.split_paths(base)))


# --- jobs --------------------------------------------------------------------


@query
def validate_requests(spark, sf_dir):
    jobs = streaming.decode_jobs(views.job_messages(spark, sf_dir))
    return jobs.select(
        "job_id",
        F.coalesce("error", F.lit("")).alias("error"),
        F.coalesce("request.k", F.lit(-1)).alias("k"),
        F.coalesce(F.size("request.feedback"), F.lit(-1)).alias("n_feedback"),
        F.coalesce(F.size("request.exclude_item_ids"), F.lit(-1)).alias("n_excluded"),
    )


@query
def submit_jobs(spark, sf_dir):
    """Requests through the job encoding and back; the ids are random, so they are counted."""
    requests = views.events(spark, sf_dir).select("user_id", (F.col("n") + 1).alias("k"), "event_id")
    sent = storage.scratch_path(spark, "sent")
    given = streaming.submit_jobs(requests, send=lambda messages: messages.write.parquet(sent))
    jobs = streaming.decode_jobs(spark.read.parquet(sent)).where(F.col("error").isNull())
    # The ids that the submitter got, and what was sent under them. Both sides have a row per job, but parsed JSON is
    # estimated far too small, and a side that is estimated small goes through the driver unless a shuffle is asked for.
    asked = given.select("job_id", "status", "event_id", F.col("user_id").alias("asked"))
    found = asked.join(jobs.hint("merge"), "job_id")
    found = found.where(F.col("asked") == F.col("request.user_id"))
    return found.groupBy(F.col("request.user_id").alias("user_id"), F.col("request.k").alias("k")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("job_id").alias("n_ids"),
        F.count_distinct("event_id").alias("n_events"),
        F.count_if(F.col("status") == "PENDING").alias("n_pending"),
    )


def result_rows(results: DataFrame) -> DataFrame:
    """One row per recommended item; a result without items has one row of its own."""
    return results.select(
        "job_id",
        "status",
        F.coalesce("error", F.lit("")).alias("error"),
        F.coalesce(F.element_at("context", "source"), F.lit("")).alias("source"),
        F.posexplode_outer("items").alias("at", "item"),
    ).select(
        "job_id",
        "status",
        "error",
        "source",
        (F.coalesce("at", F.lit(-1)) + 1).alias("rank"),
        F.coalesce("item.item_id", F.lit(-1)).cast("long").alias("item_id"),
        no_minus_zero(F.coalesce("item.score", F.lit(0.0)), 4).alias("score"),
    )


@query
def answer_jobs(spark, sf_dir):
    """The jobs as one batch. Several branches read them, so they are decoded into a table."""
    f = views.factors(spark, sf_dir)
    decoded = storage.scratch_path(spark, "jobs")
    streaming.decode_jobs(views.job_messages(spark, sf_dir)).write.parquet(decoded)
    return result_rows(streaming.answer_jobs(spark.read.parquet(decoded), f, f))


@query
def stream_jobs(spark, sf_dir):
    """The jobs as a stream of files, the results as a table."""
    source, results, checkpoint = (
        storage.scratch_path(spark, x) for x in ("jobs", "results", "checkpoint")
    )
    views.job_messages(spark, sf_dir).write.json(source)
    f = views.factors(spark, sf_dir)
    shape = sources.factor_shape(f)
    streaming.answer_stream(
        streaming.file_messages(spark, source),
        lambda: (f, f, shape),
        streaming.table_sink(results),
        checkpoint,
    ).awaitTermination()
    return result_rows(streaming.read_results(spark, results))


@query
def result_messages(spark, sf_dir):
    """Results through the message encoding and back; those that break the rules are skipped."""
    log = views.status_log(spark, sf_dir)
    broken = F.when((F.col("status") == "FAILED") & F.col("error").endswith("7"), F.lit(None)).otherwise(
        F.col("error")
    )
    back = streaming.decode_results(streaming.encode_results(log.withColumn("error", broken)))
    return back.groupBy("job_id", "status").agg(
        F.count(F.lit(1)).alias("n"), F.count("error").alias("n_errors")
    )


NOW = "2024-01-31 00:00:00"
TTL_SECONDS = 12 * 3600


@query
def latest_status(spark, sf_dir):
    log = views.status_log(spark, sf_dir)
    latest = streaming.latest_status(log, ("event_id",), now=F.lit(NOW).cast("timestamp"), ttl_seconds=TTL_SECONDS)
    return latest.select(
        "job_id", "status", F.coalesce("error", F.lit("")).alias("error"), "event_id"
    )


@query
def lookup_status(spark, sf_dir):
    """Every customer asks for the job with its number."""
    ids = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("job_id"))
    log = views.status_log(spark, sf_dir)
    latest = streaming.latest_status(log, ("event_id",), now=F.lit(NOW).cast("timestamp"), ttl_seconds=TTL_SECONDS)
    return streaming.lookup_status(ids, latest).select(
        "job_id",
        "status",
        F.coalesce("error", F.lit("")).alias("error"),
        F.coalesce(F.element_at("context", "n"), F.lit("")).alias("n"),
        F.col("items").isNull().alias("no_items"),
    )


#: When the three thirds of the events arrive, and how long a result lives: the first third has expired by the last.
ARRIVALS = ("2024-01-11 00:30:00", "2024-01-21 00:30:00", "2024-01-31 00:30:00")
TABLE_TTL_SECONDS = 15 * 86400


@query
def status_table(spark, sf_dir):
    """Nine batches in three arrival hours, merged by threes; then the first hour expires."""
    log = views.status_log(spark, sf_dir).drop("arrived_at").withColumnRenamed("event_id", "seq")
    table = streaming.StatusTable(spark, storage.scratch_path(spark, "status"), ttl_seconds=TABLE_TTL_SECONDS, fan_in=3)
    hours = [datetime.fromisoformat(at).replace(tzinfo=timezone.utc) for at in ARRIVALS]
    day = F.dayofmonth("updated_at")
    for third, at in enumerate(hours):
        mine = log.where((day <= 10) if third == 0 else (day <= 20) & (day > 10) if third == 1 else day > 20)
        for part in range(3):
            batch = mine.where(F.col("seq") % 3 == part)
            table.append(batch, 3 * third + part, now=at)
            table.append(batch, 3 * third + part, now=at)  # a repeated batch changes nothing
    expired = table.expire(hours[-1])
    runs = [len(table.current_runs(h)) for h in table.hours()]
    return table.latest(hours[-1]).select(
        "job_id",
        "status",
        F.coalesce("error", F.lit("")).alias("error"),
        F.col("seq").alias("event_id"),
        "batch",
        F.lit(len(expired)).alias("n_expired_hours"),
        F.lit(len(runs)).alias("n_hours"),
        F.lit(max(runs)).alias("n_runs"),
    )
